"""Year-partitioned files of the two house families, read as one table.

Each family (the Chamber; the Senate with Congress) is a Parquet dataset of its own, partitioned by the year it was collected
for.  Years of a family may differ in columns (a service adds a field) and so may the families: the columns of all files are
merged by name, one that a file does not have is null in its rows.  A year range is a filter on the partition column, so files
of other years are not read.

A family that was never collected gives no rows; if none was, the result is empty with ``schema``.  Merging the columns of a
family reads the footers of its files in a Spark job; with ``schema`` given it is skipped and only these columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

YEAR = "ano_coleta"
FAMILY = "familia"


def family_path(base: str, family: str) -> str:
    return f"{base.rstrip('/')}/{family}"


def write_family(df: DataFrame, base: str, family: str, year: str = "ano") -> None:
    """Append rows to a family, partitioned by ``year``; rows without a whole number there go to the null partition."""
    (df.withColumn(YEAR, F.col(year).try_cast("int")).write.mode("append").partitionBy(YEAR)
     .parquet(family_path(base, family)))


def _family(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame | None:
    reader = spark.read
    if schema is None:
        reader = reader.option("mergeSchema", True)
    else:
        reader = reader.schema(StructType([*schema.fields, StructField(YEAR, IntegerType())]))
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):      # never collected, or no file in it
            return None
        raise


def read_families(spark: SparkSession, base: str, families: list[str], first_year: int | None = None,
                  last_year: int | None = None, schema: StructType | None = None) -> DataFrame:
    """Rows of all ``families`` with ``familia`` and ``ano_coleta``, of the years in range (all, null too, without one)."""
    found = []
    for family in families:
        df = _family(spark, family_path(base, family), schema)
        if df is None:
            continue
        if first_year is not None:
            df = df.where(F.col(YEAR) >= first_year)
        if last_year is not None:
            df = df.where(F.col(YEAR) <= last_year)
        found.append(df.withColumn(FAMILY, F.lit(family)))
    if not found:
        fields = schema.fields if schema is not None else []
        return spark.createDataFrame([], StructType([*fields, StructField(YEAR, IntegerType()), StructField(FAMILY, StringType())]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
