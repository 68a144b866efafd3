"""Keep-first-per-key operators.

Both are written as aggregates of a struct minimum instead of a
``row_number()`` window: the aggregate runs a partial (map-side) step, so a key
that holds a large share of the rows collapses to one row per map task before
the shuffle, whereas a window would sort the whole hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_struct(columns: list[str]):
    """Struct that sorts ascending with nulls last, column by column."""
    fields = []
    for i, c in enumerate(columns):
        fields.append(F.col(c).isNull().alias(f"n{i}"))
        fields.append(F.col(c).alias(f"v{i}"))
    return F.struct(*fields)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per ``keys`` after an ascending sort on ``order`` (nulls last).

    Remaining columns break ties, so the result is deterministic; rows equal on
    every column are interchangeable.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = list(order) + rest
    best = df.groupBy(*keys).agg(F.min(ordered_struct(ordered)).alias("_first"))
    picked = [F.col("_first")[f"v{i}"].alias(c) for i, c in enumerate(ordered)]
    return best.select(*keys, *picked).select(*df.columns)


def first_success(attempts: DataFrame, key: str, attempt: str, ok: str,
                  fields: list[str], max_attempts: int) -> DataFrame:
    """Per key, the first successful attempt among the first ``max_attempts``.

    With no success the first failure is returned (failures carry the same empty
    result).  Attempts beyond ``max_attempts`` are ignored.
    """
    tried = attempts.filter(F.col(attempt) <= max_attempts)
    best = tried.groupBy(key).agg(
        F.min(F.struct((~F.col(ok)).alias("failed"), F.col(attempt).alias("attempt"),
                       *[F.col(f).alias(f) for f in fields])).alias("_first"))
    return best.select(key, F.col("_first.attempt").alias(attempt),
                       *[F.col(f"_first.{f}").alias(f) for f in fields])
