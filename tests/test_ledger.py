"""Completion per unit of a partitioned stage table."""

import tempfile

import pytest
from pyspark.sql import functions as F

from plenaria.sources import ledger

BY = ["origem", "ano"]
SCHEMA = "seq long, origem string, ano string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_units_complete_one_by_one(spark):
    path = tempfile.mkdtemp(prefix="plenaria-ledger-") + "/t"
    work = spark.createDataFrame([("CD", "2001"), ("CD", "2002"), ("SF", "2001"), ("SF", None), ("SF", "")], "origem string, ano string")
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(ledger.pending_units(work, path, BY)) == rows(work.where("ano <> ''").withColumn("s", F.lit(None)).unionAll(
        spark.createDataFrame([("SF", None, None)], "origem string, ano string, s string")))
    assert ledger.read_units(spark, path, BY, empty.schema).count() == 0

    first = spark.createDataFrame([(1, "CD", "2001"), (2, "CD", "2001"), (3, "CD", "2002"), (4, "SF", None), (5, "XX", "2001")], SCHEMA)
    ledger.write_units(first, work.where("origem = 'CD' OR ano IS NULL"), path, BY)
    assert rows(ledger.pending_units(work, path, BY)) == [("SF", "2001", None)]
    assert rows(ledger.read_units(spark, path, BY, first.schema)) == [(1, "CD", "2001"), (2, "CD", "2001"), (3, "CD", "2002"), (4, "SF", None)]
    # a unit is replaced, the others stay; a unit that now has no rows is complete and empty
    again = spark.createDataFrame([(9, "CD", "2001")], SCHEMA)
    ledger.write_units(again, work.where("origem = 'CD'"), path, BY)
    assert rows(ledger.pending_units(work, path, BY)) == [("SF", "2001", None)]
    assert rows(ledger.read_units(spark, path, BY, first.schema)) == [(4, "SF", None), (9, "CD", "2001")]


def test_a_broken_replacement_is_seen(spark):
    path = tempfile.mkdtemp(prefix="plenaria-ledger-") + "/t"
    work = spark.createDataFrame([("CD", "2001"), ("CD", "2002")], "origem string, ano string")
    df = spark.createDataFrame([(1, "CD", "2001"), (2, "CD", "2002")], SCHEMA)
    ledger.write_units(df, work, path, BY)
    one = work.where("ano = '2001'")

    def fail(x):
        raise ValueError("lost")

    broken = spark.createDataFrame([(7, "CD", "2001")], SCHEMA).withColumn("seq", F.udf(fail, "long")("seq"))
    with pytest.raises(Exception, match="lost"):
        ledger.write_units(broken, one, path, BY)
    assert rows(ledger.pending_units(work, path, BY)) == [("CD", "2001", "begun")]
    assert rows(ledger.read_units(spark, path, BY, df.schema)) == [(2, "CD", "2002")]
    # a write that left files but did not end: they are not read
    (spark.createDataFrame([(8, "CD", "2001", "other")], SCHEMA + f", {ledger.WRITE} string").write.mode("append")
     .partitionBy(*BY).parquet(path))
    assert rows(ledger.read_units(spark, path, BY, df.schema)) == [(2, "CD", "2002")]
    ledger.write_units(spark.createDataFrame([(9, "CD", "2001")], SCHEMA), one, path, BY)
    assert rows(ledger.pending_units(work, path, BY)) == []
    assert rows(ledger.read_units(spark, path, BY, df.schema)) == [(2, "CD", "2002"), (9, "CD", "2001")]
