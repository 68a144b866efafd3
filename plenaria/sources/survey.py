"""Survey CSV source (S5): explicit schema, sentinel -> null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria import vocab


def survey_schema(columns) -> str:
    return ", ".join(["wave INT"] + [f"{c} DOUBLE" for c in columns])


def read_survey_csv(spark: SparkSession, path: str, columns=tuple(vocab.SURVEY_PARTY_COLUMNS)) -> DataFrame:
    """Read the respondent CSV (header, declared schema; never inferred)."""
    return spark.read.schema(survey_schema(columns)).option("header", True).csv(path)


def sentinel_to_null(df: DataFrame, missing=vocab.SURVEY_MISSING, skip=("wave",)) -> DataFrame:
    """Numeric compare, so -999 and -999.0 are both caught."""
    return df.select(*[F.col(c) if c in skip else F.nullif(F.col(c), F.lit(missing)).alias(c)
                       for c in df.columns])
