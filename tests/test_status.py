"""The status table of both houses from landed payloads."""

import json

from pyspark.sql import functions as F

from plenaria.plans.status import internal_id, matter_code, status_table
from plenaria.sources import bridge


def senate(*materias, wrap=True):
    m = [{"SituacaoAtual": {"Autuacoes": {"Autuacao": a}}} for a in materias]
    return json.dumps({"SituacaoAtualMateria": {"Materias": {"Materia": m if wrap else m[0]}}})


def sit(*pairs):
    found = [{k: v for k, v in zip(("DescricaoSituacao", "DataSituacao"), p) if v is not None} for p in pairs]
    return {"Situacoes": {"Situacao": found if len(found) != 1 else found[0]}}


def test_status_table_of_both_houses(spark):
    rows = [
        ("CD", "1", '{"dados":{"statusProposicao":{"descricaoSituacao":"Arquivada","url":"u"}}}'),
        ("CD", "2", "timeout"), ("CD", "3", None), ("CD", "4", '{"dados":[]}'),
        ("CD", "5", "erro"), ("CD", "5", '{"dados":{"statusProposicao":{"descricaoSituacao":"Norma"}}}'),
        ("SF", "1", senate(sit(("A", "d1")), wrap=False)),
        ("SF", "2", senate([sit(("A", "d1"), ("B", None)), {"Numero": 1}, sit((None, "d3"))], sit(("C", "d9")))),
        ("SF", "3", senate([])), ("SF", "4", "{}"), ("SF", "6", "[1]"), ("SF", "7", senate(sit(("é \"x\"", "d")))),
        ("SF", None, senate(sit(("A", "d1")))),
    ]
    df = spark.createDataFrame(rows, "casa string, chave string, raw string").withColumn("situacao", F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in status_table(df).collect()}
    assert got == {
        "1": ("Arquivada", "", "u"), "2": ("", "", ""), "3": ("", "", ""), "4": ("", "", ""), "5": ("Norma", "", ""),
        "SF-1": ("A", "d1", ""), "SF-2": ("B", "d3", ""), "SF-3": ("", "", ""), "SF-4": ("", "", ""), "SF-6": ("", "", ""),
        "SF-7": ('é "x"', "d", ""),
    }
    assert status_table(df.limit(0)).count() == 0


def test_ids_go_both_ways(spark):
    df = spark.createDataFrame([("CD", "12"), ("SF", "12"), ("CN", "7")], "casa string, chave string")
    df = df.withColumn("id", internal_id("casa", "chave")).withColumn("back", matter_code("id"))
    assert [tuple(r) for r in df.collect()] == [("CD", "12", "12", "12"), ("SF", "12", "SF-12", "12"), ("CN", "7", "SF-7", "7")]


def test_the_bridge_has_the_services_payloads(spark):
    """Every shape but the broken one is JSON, and a payload is parsed once."""
    shapes = spark.sql(f"SELECT raw FROM (SELECT {bridge._senate_status('k')} AS raw FROM (SELECT explode(sequence(0, 7)) AS k))")
    raws = [r[0] for r in shapes.collect()]
    assert sum(r.startswith('{"broken"') for r in raws) == 1
    assert all(isinstance(json.loads(r), dict) for r in raws if not r.startswith('{"broken"'))
    plan = status_table(spark.createDataFrame([("SF", "1", "{}")], "casa string, chave string, raw string"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_parse_json") <= 1 and "get_json_object" not in text
