"""Token facets answered by an inverted index: the rows of the scan, pruned buckets, missing values."""

import pytest

from plenaria.operators import token_index
from plenaria.operators.filters import FacetSpec, facet_filter

SCHEMA = ("seq long, origem_extenso string, tipo string, tipo_extenso string, legislatura string, regiao string, uf string, "
          "termo_busca string, tipo_autor string, espectro string, parlamentar string, ano_int int")


def row(seq, uf=None, author=None, person=None, year=2000):
    return (seq, "Senado Federal", "PL", "Projeto de Lei", None, None, uf, "pobreza", author, None, person, year)


ROWS = [row(1, "SP; RJ", "PT; PMDB", "Ana Souza; José Lima"), row(2, "RJ", "MDB", "JOSÉ LIMA"), row(3, "SP;SP", "PT", "Ana Souza"),
        row(4), row(5, "", "", ""), row(6, "MG", "Poder Executivo", "José Lima, Ana Souza", 1990), row(None, "SP", "PT", "Ana Souza")]
SPECS = [FacetSpec(uf=["SP"]), FacetSpec(uf=["SP", "RJ"], partido=["PT"]), FacetSpec(politico=["Ana Souza"]),
         FacetSpec(politico=["José Lima"], ano=(1995, 2005)), FacetSpec(partido=["PMDB/MDB"], uf=["RJ"], politico=["José Lima"]),
         FacetSpec(uf=["XX"]), FacetSpec(ano=(1990, 1990)), FacetSpec(uf=["it's"])]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    path = str(tmp_path_factory.mktemp("index") / "tokens")
    token_index.write_index(rows, "seq", path, 16)
    return rows, path


@pytest.mark.parametrize("spec", SPECS)
def test_same_rows_as_the_scan(indexed, spec):
    rows, path = indexed
    got = sorted(map(repr, token_index.select_rows(rows, spec, "seq", path, 16).collect()))
    assert got == sorted(repr(r) for r in facet_filter(rows, spec).collect() if r["seq"] is not None or not (spec.uf or spec.partido or spec.politico))


def test_an_entry_per_row_and_token(indexed, spark):
    _, path = indexed
    entries = spark.read.parquet(path)
    assert entries.where("faceta = 'uf'").groupBy("token").count().where("token = 'SP'").first()["count"] == 2     # rows 1, 3
    assert entries.count() == entries.distinct().count()


def test_only_the_buckets_of_the_values_are_read(indexed, spark):
    _, path = indexed
    plan = token_index.keys_of(spark, path, "uf", ["SP"], buckets=16)._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "faceta" in pruned and "balde" in pruned


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    token_index.write_index(none, "seq", str(tmp_path / "none"))
    assert token_index.select_rows(none, FacetSpec(uf=["SP"]), "seq", str(tmp_path / "none")).count() == 0
