"""Units of work in a partitioned stage table (S3): one partition per unit, and a ledger that says which are complete.

A re-collected unit (a house's year) replaces its partition and keeps the others, so the table's root marker says nothing
about it.  The ledger, a small Parquet table beside the data, gets a row per unit when a write begins and another one, with
the rows found in the data, when it has ended.  A unit is complete if its last row is of the second kind: a write that broke
off leaves the unit open, whatever it left in the folder, and the next work list has it again.  Rows carry their write, so
a reader takes a unit's rows from its last complete write only.  Units that were collected and
have no rows are complete too; their older rows are no longer read.

Every step is a job over all units together, nothing is kept on the driver, and the ledger has two rows per unit and write.
Units are rows of the columns ``by``; an empty text is null, as in a partition's name.  Two writes of the same unit at once
are not supported.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BEGUN, DONE = "begun", "done"
WRITE = "unit_write"      # column of the data: the write that a row is from


def ledger_path(path: str) -> str:
    return path.rstrip("/") + "-ledger"


def _units(units: DataFrame, by: list[str]) -> DataFrame:
    kinds = dict(units.dtypes)
    return units.select(*((F.nullif(F.col(c), F.lit("")) if kinds[c] == "string" else F.col(c)).alias(c) for c in by)).distinct()


def _same(left: DataFrame, right: DataFrame, by: list[str]) -> Column:
    both = F.lit(True)
    for c in by:
        both = both & left[c].eqNullSafe(right[f"u_{c}"])
    return both


def _renamed(units: DataFrame, by: list[str]) -> DataFrame:
    return units.select(*(F.col(c).alias(f"u_{c}") for c in by), *(c for c in units.columns if c not in by))


def _note(units: DataFrame, path: str, state: str, write: str, step: int) -> None:
    (units.withColumns({"state": F.lit(state), "write": F.lit(write), "step": F.lit(step).cast("long")})
     .coalesce(1).write.mode("append").parquet(ledger_path(path)))


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(ledger_path(path))
    except AnalysisException:      # no unit was ever begun
        return None


def begin_units(units: DataFrame, path: str, by: list[str]) -> str:
    """Open ``units``; until the write that is returned ends, they are not complete."""
    spark, write = units.sparkSession, uuid.uuid4().hex
    held = _ledger(spark, path)
    step = 1 + ((held.agg(F.max("step")).first()[0] or 0) if held is not None else 0)
    _note(_units(units, by).withColumn("n_rows", F.lit(None).cast("long")), path, BEGUN, write, step)
    return write


def write_units(df: DataFrame, units: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions of ``units`` with their rows of ``df``; rows of other units are not written."""
    spark = df.sparkSession
    units = _units(units, by)
    write = begin_units(units, path, by)
    opened = _ledger(spark, path).where(F.col("write") == write)
    step = opened.select("step").first()["step"] + 1
    mine = _renamed(opened.select(*by), by)
    keyed = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c, kind in df.select(*by).dtypes if kind == "string"})
    (keyed.join(mine, _same(keyed, mine, by), "left_semi").withColumn(WRITE, F.lit(write))
     .write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "dynamic").parquet(path))
    # a unit without rows may still have its older partition: only rows of this write count
    data = spark.read.schema(_schema(df)).parquet(path)
    found = _renamed(data.where(F.col(WRITE) == write).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")), by)
    counted = opened.select(*by).join(found, _same(opened, found, by), "left")
    _note(counted.select(*by, F.coalesce("n_rows", F.lit(0)).alias("n_rows")), path, DONE, write, step)


def _schema(df: DataFrame) -> StructType:
    return StructType([*df.schema.fields, StructField(WRITE, StringType())])


def unit_states(spark: SparkSession, path: str, by: list[str]) -> DataFrame | None:
    """by, state, write, n_rows: the last row of every unit; None if the ledger is not there."""
    held = _ledger(spark, path)
    if held is None:
        return None
    last = held.groupBy(*by).agg(F.max(F.struct("step", "state", "write", "n_rows")).alias("last"))
    return last.select(*by, "last.state", "last.write", "last.n_rows")


def pending_units(units: DataFrame, path: str, by: list[str]) -> DataFrame:
    """The ``units`` that are not complete, with their state: begun, or null if never."""
    units = _units(units, by)
    states = unit_states(units.sparkSession, path, by)
    if states is None:
        return units.withColumn("state", F.lit(None).cast("string"))
    states = _renamed(states, by)
    return (units.join(states, _same(units, states, by), "left")
            .where(~F.col("state").eqNullSafe(F.lit(DONE))).select(*by, "state"))


def read_units(spark: SparkSession, path: str, by: list[str], schema: StructType) -> DataFrame:
    """The rows of the complete units, with ``schema``, each from its last write; no rows if nothing was written."""
    states = unit_states(spark, path, by)
    if states is None:
        return spark.createDataFrame([], schema)
    data = spark.read.schema(StructType([*schema.fields, StructField(WRITE, StringType())])).parquet(path)
    whole = _renamed(states.where((F.col("state") == DONE) & (F.col("n_rows") > 0)).select(*by, F.col("write").alias("u_write")), by)
    return data.join(whole, _same(data, whole, by) & (data[WRITE] == whole["u_write"]), "left_semi").drop(WRITE)
