"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's own checkpoint folder.

    Only a session that names neither (a local test) gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plenaria-llm-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per context, so that they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_plenaria_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="plenaria-code-")) / "plenaria-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._plenaria_shipped = True


def in_slices(batches, rows: int = 500):
    """The pandas batches in slices, so that what is made of a batch is never held for all of its rows at once."""
    for b in batches:
        for lo in range(0, len(b), rows):
            yield b.iloc[lo:lo + rows]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BROADCAST_ROWS = 500_000     # narrow tables up to so many rows are broadcast, larger ones are joined by shuffle


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, which is a written table of a few numbers per row, with a broadcast hint if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it; names are the same in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_rows(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``bad`` (doc_id, text_hash) does not list; keyed by id and text, null ids included.

    Every column of ``docs`` stays as it is, whatever its name.
    """
    g_id, g_hash = free_name(docs, "gone_id"), free_name(docs, "gone_hash")
    gone = written(bad.select(F.col("doc_id").alias(g_id), F.col("text_hash").alias(g_hash)).distinct(), "gone")
    return docs.join(broadcast_if_small(gone), docs["doc_id"].eqNullSafe(F.col(g_id))
                     & (F.xxhash64(docs["text"]) == F.col(g_hash)), "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a long, b long): rows (node, component), component = smallest node.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): every round is two grouped minima and
    joins on the node, so links never meet in one place; the rounds grow with the logarithm of the longest
    chain.  Each round's links are written to the shared folder, so no lineage builds up.  Self-links and nulls
    are ignored; no links give an empty table.
    """
    links = (edges.where(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    links, seen = written(links, "links"), None
    while True:
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or state == seen:
            return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
        seen = state
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        links = written(small, "links")
