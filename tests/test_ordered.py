"""Places in a global order: gapless, total, without a single-task window over the rows."""

import random

import pytest
from pyspark.sql import functions as F

from plenaria.operators import ordered


def test_places_are_those_of_a_sort(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None, "é", ""]), rng.choice([None, 1, 2, 3]), i) for i in range(3000)]
    rows += [("hot", 1, -1)] * 1500                          # repeated rows and a hot value
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(7)
    got = [tuple(r) for r in ordered.with_ordinal(df, ["k", F.desc("v"), "i"]).collect()]
    assert sorted(r[3] for r in got) == list(range(1, len(rows) + 1))

    def rank(r):
        return (r[0] is not None, (r[0] or "").encode(), r[1] is None, -(r[1] or 0), r[2])
    assert [r[:3] for r in sorted(got, key=lambda r: r[3])] == sorted(rows, key=rank)


def test_ties_go_by_the_other_columns(spark):
    df = spark.createDataFrame([("x", 3), ("x", 1), ("x", None), ("x", 2)], "k string, v int")
    got = ordered.with_ordinal(df, ["k"], "lugar").orderBy("lugar").collect()
    assert [tuple(r) for r in got] == [("x", None, 1), ("x", 1, 2), ("x", 2, 3), ("x", 3, 4)]


def test_a_hot_value_is_spread_over_ranges(spark):
    df = spark.range(40000).select(F.lit("x").alias("k"), "id")
    got = ordered.with_ordinal(df, ["k"])
    assert got.where(F.col("ordem") != F.col("id") + 1).count() == 0
    keys = [F.asc("k"), F.asc("id")]
    sizes = df.repartitionByRange(4, *keys).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r[1] for r in sizes) < 20000


def test_no_window_over_the_rows(spark):
    plan = ordered.with_ordinal(spark.range(10).toDF("k"), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert window.index("Aggregate") < window.index("Relation")      # the window reads the counts per partition


def test_nothing_counts_and_names(spark):
    empty = spark.createDataFrame([], "k string")
    assert ordered.with_ordinal(empty, ["k"]).columns == ["k", "ordem"]
    assert ordered.with_ordinal(empty, ["k"]).count() == 0
    with pytest.raises(ValueError, match="ordem"):
        ordered.with_ordinal(spark.createDataFrame([("x", 1)], "k string, Ordem int"), ["k"])
    counts = ordered.value_counts(spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None]], "k string"), "k")
    assert [tuple(r) for r in counts.orderBy("ordem").collect()] == [("c", 2, 1), ("a", 1, 2), ("b", 1, 3)]


def test_matrix_order(spark):
    cells = spark.createDataFrame([("p", "t", 1, 1, 3), ("q", "t", 2, 5, 3), ("p", "u", 0, 1, 3), ("q", "u", 3, 5, 3)],
                                  "p string, t string, n int, rt int, ct int")
    got = {(r["p"], r["t"]): (r["linha"], r["coluna"]) for r in ordered.matrix_order(cells, "p", "t", "rt", "ct").collect()}
    assert got == {("q", "t"): (1, 1), ("q", "u"): (1, 2), ("p", "t"): (2, 1), ("p", "u"): (2, 2)}
