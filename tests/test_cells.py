"""Distinct counts that add up, and KPIs of selections from one pre-aggregated table."""

import random

import pytest
from pyspark.sql import functions as F

from plenaria.operators import distinct_words
from plenaria.operators.filters import FacetSpec, facet_filter
from plenaria.plans import cells, mart

SCHEMA = ("ano_int int, origem string, origem_extenso string, tipo string, tipo_extenso string, legislatura string, regiao string, "
          "uf string, termo_busca string, tipo_autor string, espectro string, e_parlamentar boolean, situacao_norm string, "
          "parlamentar string")


def made(n, seed=5):
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    out = []
    for _ in range(n):
        house = pick("CD", "SF", "CN", None)
        out.append((pick(1995, 1996, 2010, None), house, {"CD": "Câmara dos Deputados", "SF": "Senado Federal"}.get(house),
                    pick("PL", "MPV", "SUG", None), pick("a", "b"), pick("50ª", None), pick("Sul", None), pick("SP; RJ", "RS", None),
                    pick("fome", "renda", None), pick("PT", "Popular", "PMDB; PT", None), pick("Centro", None), pick(True, False, None),
                    pick("Promulgada", "Outra", None), pick(None, *(f"P{i}" for i in range(200)))))
    return out


@pytest.fixture(scope="module")
def base(spark):
    # one combination holds a third of the rows
    hot = [(1995, "CD", "Câmara dos Deputados", "PL", "a", None, "Sul", "RS", "fome", "PT", "Centro", True, "Outra", "P1")] * 300
    return spark.createDataFrame(made(600) + hot, SCHEMA).persist()


@pytest.fixture(scope="module")
def table(base):
    return cells.kpi_cells(base)


@pytest.mark.parametrize("spec", [FacetSpec(), FacetSpec(origem=["Senado Federal"]), FacetSpec(uf=["SP"], ano=(1995, 1996)),
                                  FacetSpec(partido=["PT"], termo=["fome"]), FacetSpec(espectro=["nenhum"])])
def test_kpis_of_a_selection_are_those_of_its_rows(base, table, spec):
    assert cells.kpis_from_cells(table, spec).collect() == mart.kpis(facet_filter(base, spec)).collect()


def test_the_table_is_not_larger_than_the_base_and_keeps_its_rows(base, table):
    assert table.count() < base.count() and table.agg(F.sum("n")).first()[0] == base.count()


def test_members_by_level(base, table):
    got = {tuple(r) for r in cells.members_by(table, ["origem", "tipo"]).collect()}
    want = set()
    for level, keys in enumerate(([], ["origem"], ["origem", "tipo"])):
        for r in base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("e_parlamentar"), F.col("parlamentar"))).alias("m")).collect():
            d = r.asDict()
            want.add((level, d.get("origem"), d.get("tipo"), d["n"], d["m"]))
    assert got == want


def test_persons_are_refused_and_nothing_gives_nulls(spark, table):
    with pytest.raises(ValueError):
        cells.kpis_from_cells(table, FacetSpec(politico=["P1"]))
    none = spark.createDataFrame([], SCHEMA)
    assert cells.kpis_from_cells(cells.kpi_cells(none)).collect() == mart.kpis(none).collect()


def test_counts_over_several_words(spark):
    values = [(k, f"v{i:04d}") for i in range(1000) for k in range(3) if i % (k + 1) == 0] + [(0, None), (9, None), (1, "v0002")]
    df = spark.createDataFrame(values, "k int, v string")
    ids = distinct_words.dense_ids(df, "v")
    assert sorted(r["id"] for r in ids.collect()) == list(range(1000))
    words = distinct_words.with_words(df, "v", ids).groupBy("k", "palavra").agg(distinct_words.merged_bits().alias("bits"))
    assert {r["k"]: r["m"] for r in words.groupBy("k").agg(distinct_words.distinct_count().alias("m")).collect()} == {0: 1000, 1: 500, 2: 334, 9: 0}
    whole = words.groupBy("palavra").agg(distinct_words.merged_bits().alias("bits"))
    assert whole.agg(distinct_words.distinct_count()).first()[0] == 1000
