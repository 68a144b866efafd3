"""The dashboard's views over one selection: the base is read once and written once, narrow."""

import pytest
from pyspark.sql import functions as F

from plenaria import catalog, vocab
from plenaria.operators.filters import FacetSpec, facet_filter
from plenaria.plans import dashboard, mart

SF = "/root/testdata/sf0.001"
NOTHING = FacetSpec(origem=["nenhuma"])


@pytest.fixture(scope="module")
def base(spark):
    return catalog.mart_table(spark, SF).select(*dashboard.BASE_COLUMNS, "origem_extenso").persist()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_views_are_those_of_the_selected_rows(base):
    spec = FacetSpec(origem=["Senado Federal"])
    names = ["by_legislature", "type_mix", "party_type_flow", "ideology_by_house"]
    views = dashboard.selected_views(base, spec, names)
    for name in names:
        assert rows(views[name]) == rows(dashboard.VIEWS[name][0](facet_filter(base, spec)))
    cells = dashboard.long_form(views)
    assert cells.columns == ["visao", "chave1", "chave2", "n", "valor"]
    assert {r[0]: r[1] for r in cells.groupBy("visao").count().collect()} == {n: views[n].count() for n in names}


def test_views_read_the_written_selection_only(base):
    view = dashboard.selected_views(base, FacetSpec(), ["by_band"])["by_band"]
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<espectro:string>" in plan


def test_nothing_selected(base):
    views = dashboard.selected_views(base, NOTHING)
    assert set(views) == set(dashboard.VIEWS)
    cells = dashboard.long_form(views)
    assert {(r["visao"], r["n"]) for r in cells.collect()} == {("by_legislature", 0)}      # the fixed sequence, zero-filled
    assert cells.count() == len(vocab.LEGISLATURES)


def test_missing_values(spark):
    schema = ", ".join(f"{c} {t}" for c, t in {**dict.fromkeys(dashboard.BASE_COLUMNS, "string"), "ano_int": "int",
                                              "score_lr": "double", "e_parlamentar": "boolean"}.items())
    df = spark.createDataFrame([(None,) * len(dashboard.BASE_COLUMNS)], schema)
    cells = dashboard.long_form(dashboard.selected_views(df, FacetSpec()))
    found = {r["visao"]: r["n"] for r in cells.where(F.col("n") > 0).collect()}
    assert found == {"author_groups": 1, "by_band": 1}
    assert mart.by_state(df).count() == 0
