"""Year files of the two house families: merged columns, pruned years, families that are not there."""

import tempfile

from pyspark.sql.types import StringType, StructField, StructType

from plenaria.sources import families


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def base_dir(spark):
    base = tempfile.mkdtemp(prefix="plenaria-families-")
    families.write_family(spark.createDataFrame([("1", "2001", "x"), ("2", "2002", None)], "id string, ano string, so_cd string"), base, "camara")
    families.write_family(spark.createDataFrame([("3", "2001"), ("4", "sem ano")], "id string, ano string"), base, "senado")
    families.write_family(spark.createDataFrame([("5", "2003", "novo")], "id string, ano string, campo string"), base, "senado")
    return base


def test_columns_are_merged_by_name(spark):
    df = families.read_families(spark, base_dir(spark), ["camara", "senado", "nenhuma"])
    assert set(df.columns) == {"id", "ano", "so_cd", "campo", "ano_coleta", "familia"}
    assert rows(df, "id", "so_cd", "campo", "ano_coleta", "familia") == [
        ("1", "x", None, 2001, "camara"), ("2", None, None, 2002, "camara"), ("3", None, None, 2001, "senado"),
        ("4", None, None, None, "senado"), ("5", None, "novo", 2003, "senado")]


def test_other_years_are_not_read(spark):
    df = families.read_families(spark, base_dir(spark), ["camara", "senado"], 2002, 2003)
    assert rows(df, "id") == [("2",), ("5",)]
    assert len(df.inputFiles()) == 5      # every file is listed, the plan prunes
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(ano_coleta") == 2
    assert "DataFilters: []" in plan and "Exchange" not in plan


def test_a_given_schema_and_nothing_collected(spark):
    schema = StructType([StructField("id", StringType()), StructField("campo", StringType())])
    df = families.read_families(spark, base_dir(spark), ["camara", "senado"], schema=schema)
    assert df.columns == ["id", "campo", "ano_coleta", "familia"] and df.count() == 5
    nothing = families.read_families(spark, tempfile.mkdtemp(prefix="plenaria-families-"), ["camara", "senado"], schema=schema)
    assert nothing.columns == ["id", "campo", "ano_coleta", "familia"] and nothing.count() == 0
