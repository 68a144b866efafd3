"""Counts, shares, cross-tabulations and grouping-set means."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plenaria import vocab


def exact_mean(c, scale: int = 2):
    """Mean of values with at most ``scale`` decimals: exact decimal sum, one division.

    A double sum depends on the order partial sums are merged in, and a mean of
    2-decimal scores often sits exactly on a rounding boundary; summing exactly
    makes the rounded mean the same on every run and partitioning.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double") / F.count(c)


def share_within(df: DataFrame, group: list[str], n: str = "n", out: str = "pct",
                 digits: int = 4) -> DataFrame:
    """100 * n / sum(n) within ``group`` (a 100 % stacked bar).

    Runs after the count aggregate, so the window only sees one row per cell.
    """
    w = Window.partitionBy(*group)
    return df.withColumn(out, F.round(F.lit(100.0) * F.col(n) / F.sum(n).over(w), digits))


def zero_fill(domain: DataFrame, counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Every domain value with its count, 0 where the data has none."""
    return (domain.join(counts, key, "left")
            .withColumn(n, F.coalesce(F.col(n), F.lit(0)).cast("bigint")))


def crosstab_margins(df: DataFrame, row: str, column: str, total: str = vocab.TOTAL) -> DataFrame:
    """Counts of ``row`` x ``column`` in long form, (row, column, n), with 'Total' rows for both margins.

    One cube over the values present; rows with a null on either side are left out, as in a pivoted cross-tab.
    """
    agg = (df.dropna(subset=[row, column]).cube(row, column)
           .agg(F.count(F.lit(1)).alias("n"), F.grouping(row).alias("_r"), F.grouping(column).alias("_c")))
    return agg.select(F.when(F.col("_r") == 1, F.lit(total)).otherwise(F.col(row)).alias(row),
                      F.when(F.col("_c") == 1, F.lit(total)).otherwise(F.col(column)).alias(column), "n")


def mean_with_total(df: DataFrame, by: str, sub: str, value: str, total_label: str = vocab.TOTAL,
                    out: str = "score_lr", digits: int = 4) -> DataFrame:
    """Mean per ``by`` (labelled ``total_label``) and per (``by``, ``sub``), in one pass.

    A rollup computes the grouping sets (by, sub), (by) and (); the grand total
    is dropped.
    """
    grouped = (df.select(by, sub, value).rollup(by, sub)
               .agg(exact_mean(value).alias(out), F.grouping(sub).alias("_gs"), F.grouping(by).alias("_gb")))
    return (grouped.filter(F.col("_gb") == 0)
            .withColumn(sub, F.when(F.col("_gs") == 1, F.lit(total_label)).otherwise(F.col(sub)))
            .withColumn(out, F.round(out, digits))
            .drop("_gs", "_gb"))


def melt(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Wide to long; null values are kept (filter afterwards if needed)."""
    return df.unpivot(ids, columns, name, value)
