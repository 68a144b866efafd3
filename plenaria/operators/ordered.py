"""Ordered outputs as data (O1, O5, A13, A16): every row gets its place in a global sort, without a single-task window.

The rows are range-partitioned on the sort columns, sorted inside each partition and written once in that order, with a
row's partition and its place there; a second job counts the rows per partition (at most one row for each shuffle
partition) and the running sums of these counts turn places inside partitions into gapless places of the whole.  The
write makes boundaries and places final: a range partitioning that is evaluated twice may sample other boundaries.

The columns that are not sort columns break ties, ascending, so that the order is the same in every run and a value that
holds a large share of the rows is spread over several ranges.  Rows that agree in every column are interchangeable; they
get places of their own and share a range.  Nulls come first in ascending and last in descending columns, as Spark sorts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from plenaria.sources.stages import written

PLACE_BITS = 33         # monotonically_increasing_id: the partition stands above, the place in it below


def _ties(df: DataFrame, order: list[Column | str]) -> list[Column]:
    """All columns that can be compared, except those that ``order`` names as plain text."""
    named = {c for c in order if isinstance(c, str)}
    return [F.col(f"`{f.name}`") for f in df.schema.fields
            if f.name not in named and not isinstance(f.dataType, (MapType, VariantType))]


def with_ordinal(df: DataFrame, order: list[Column | str], name: str = "ordem") -> DataFrame:
    """``df`` with ``name`` (long, 1 for the first row of the order, no gaps).

    ``order``: column names (ascending) or sort expressions such as ``F.desc("n")``.  Starts a job.  The names ``_part``,
    ``_n`` and ``_start`` are taken.
    """
    if {c.lower() for c in df.columns} & {name.lower(), "_part", "_n", "_start"}:
        raise ValueError(f"{name}, _part, _n and _start must not be columns already")
    keys = [F.asc(f"`{c}`") if isinstance(c, str) else c for c in order] + _ties(df, order)
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    held = written(sorted_rows.withColumn(name, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(name, PLACE_BITS)
    counts = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))       # one row per shuffle partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col(name).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + F.col("_start") + 1
    return (held.join(F.broadcast(starts), part == F.col("_part"))
            .select(*[F.col(f"`{c}`") for c in df.columns], place.cast("long").alias(name)))


def value_counts(df: DataFrame, column: str, name: str = "ordem") -> DataFrame:
    """(column, n, ordem): non-null values by descending count, equal counts by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return with_ordinal(counts, [F.desc("n"), column], name)


def matrix_order(cells: DataFrame, row: str, col: str, row_total: str, col_total: str) -> DataFrame:
    """Long-form matrix cells with the places of their row and column by descending totals (O5): ``linha``, ``coluna``.

    Totals are those of the cells; every row and column has one.  Equal totals go by value.
    """
    rows = with_ordinal(cells.select(row, row_total).distinct(), [F.desc(row_total), row], "linha")
    cols = with_ordinal(cells.select(col, col_total).distinct(), [F.desc(col_total), col], "coluna")
    return cells.join(rows.drop(row_total), row).join(cols.drop(col_total), col).select(*cells.columns, "linha", "coluna")
