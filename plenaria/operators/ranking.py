"""Top-k, top-k-with-remainder and two-level top-N trees.

Ties, which the pandas original leaves to sort internals, are broken by the key
ascending everywhere.  Top-k over counts is a ``TakeOrderedAndProject`` (partial
top-k per task); per-group top-N uses ``row_number() <= n`` so Spark plans a
partial ``WindowGroupLimit`` before the shuffle.  Every broadcast side is a
result of ``limit(k)`` and so has a proven size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plenaria import vocab


def tree_top_n(counts: DataFrame, group: str, item: str, n: str,
               n_groups: int, n_items: int, other: str = vocab.OTHERS,
               other_item: str = vocab.PLACEHOLDER) -> DataFrame:
    """Two-level top-N with remainders.

    ``counts`` holds one row per (group, item) with a count; it is read several times, so it should be a written
    table (``stages.written``) rather than a plan over a large base.  Output: for the
    ``n_groups`` largest groups, their ``n_items`` largest items plus one
    (group, other) remainder row; one (other, other_item) row for all smaller
    groups.  The output total equals the input total.

    Remainders come from group totals minus the shown items, so only the top
    items of each group are ranked (partial window group limit before the
    shuffle) and a group with very many items never moves as a whole.
    """
    totals = counts.groupBy(group).agg(F.sum(n).alias("_total"))
    top_groups = totals.orderBy(F.desc("_total"), F.asc(group)).limit(n_groups)
    top_items = (counts
                 .withColumn("_rn", F.row_number().over(
                     Window.partitionBy(group).orderBy(F.desc(n), F.asc(item))))
                 .filter(F.col("_rn") <= n_items)
                 .join(F.broadcast(top_groups.select(group)), group, "left_semi")
                 .select(group, item, n))
    shown = top_items.groupBy(group).agg(F.sum(n).alias("_shown"))
    remainders = (top_groups.join(shown, group, "left")
                  .select(F.col(group), F.lit(other).alias(item),
                          (F.col("_total") - F.coalesce(F.col("_shown"), F.lit(0))).alias(n))
                  .filter(F.col(n) > 0))
    small = (totals.join(F.broadcast(top_groups.select(group)), group, "left_anti")
             .agg(F.sum("_total").alias(n))
             .select(F.lit(other).alias(group), F.lit(other_item).alias(item), F.col(n))
             .filter(F.col(n) > 0))
    return top_items.unionByName(remainders).unionByName(small)
