"""Stage tables on shared storage (S1-S4) and the stage manifest.

Each stage is a Parquet directory; Spark's ``_SUCCESS`` marker says it is
complete, so a re-run skips finished stages.  Paths must be on storage every
executor and the driver share (the same kind of place as
``spark.checkpoint.dir``), never a machine-local folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when the stage directory holds a finished write (its ``_SUCCESS`` marker)."""
    try:
        spark.read.text(path.rstrip("/") + "/_SUCCESS")
        return True
    except AnalysisException:
        return False


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None,
                replace_partitions: bool = False) -> None:
    """Overwrite a stage table (Parquet, optionally partitioned, e.g. by house and year).

    With ``replace_partitions`` only the partitions present in ``df`` are replaced
    (a re-collected year replaces that year and keeps the others).  The root ``_SUCCESS`` says nothing about a
    single partition then; ``sources.ledger`` keeps which units of such a table are complete.
    """
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if replace_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def read_stage(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read a stage; a missing stage with a declared schema reads as empty."""
    if schema is not None and not is_complete(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    For a small aggregate that the rest of a plan refers to several times: its base is evaluated once, whatever its
    size, and the lineage is cut.  Only a session that names no shared folder (a local test) gets a temporary one.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    root = checkpoint_dir(spark)
    if not root:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plenaria-ckpt-"))
        root = checkpoint_dir(spark)
    return f"{root.rstrip('/')}/plenaria/{name}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder, if the session names one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext on this session (e.g. Spark Connect)
        return None
