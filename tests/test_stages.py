"""Stage runner, idempotence, sources, collection jobs and incremental ingestion."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from plenaria.catalog import proposals, status_source
from plenaria.plans import collect, mart, runner, scoring
from plenaria.sources import bridge, stages, survey
from plenaria.streaming import incremental

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stage_run_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="plenaria-stages-")
    layout = runner.StageLayout(root)
    p = proposals(spark, SF)
    att = bridge.bridge(spark, SF, "attempts")
    # responses are keyed by the proposal sequence; map them to internal ids
    keyed = att.join(p.select("seq", "id_interno"), "seq").drop("seq")
    keyed = keyed.groupBy("id_interno", "attempt").agg(F.min("raw").alias("raw"))
    args = (p, status_source(spark, SF), keyed, bridge.bridge(spark, SF, "survey"))
    first = runner.run(spark, layout, *args)
    assert all(stages.is_complete(spark, layout.path(s)) for s in runner.STAGES)
    snapshot = _rows(first["stage4_final"])
    second = runner.run(spark, layout, *args)
    assert _rows(second["stage4_final"]) == snapshot
    s4 = second["stage4_final"]
    assert s4.select("id_interno").distinct().count() == s4.count()
    assert {"situacao_norm", "llm_nota", "score_lr", "espectro"} <= set(s4.columns)
    assert scoring.pending(second["stage3_scored"]).count() == scoring.pending(first["stage3_scored"]).count()


def test_second_run_scores_pending_rows(spark):
    layout = runner.StageLayout(tempfile.mkdtemp(prefix="plenaria-resume-"))
    p = proposals(spark, SF).limit(40)
    ids = [r[0] for r in p.select("id_interno").distinct().collect()]
    bad, good = sorted(ids)[:2]

    def attempts(raw_bad):
        return spark.createDataFrame([(bad, 1, raw_bad), (good, 1, '{"nota": 9}')], "id_interno string, attempt int, raw string")

    rest = (status_source(spark, SF), bridge.bridge(spark, SF, "survey"))
    first = runner.run(spark, layout, p, rest[0], attempts("erro"), rest[1])["stage4_final"]
    before = {r["id_interno"]: r["llm_nota"] for r in first.collect()}
    runner.run(spark, layout, p, rest[0], attempts('{"nota": 2}'), rest[1])
    after = {r["id_interno"]: r["llm_nota"] for r in spark.read.parquet(layout.path("stage4_final")).collect()}
    kept = [i for i in (bad, good) if i in before]
    assert [before[i] for i in kept] == [{bad: None, good: 9.0}[i] for i in kept]
    assert [after[i] for i in kept] == [{bad: 2.0, good: 9.0}[i] for i in kept] and len(after) == len(before)


def test_worklist_empty_when_everything_done(spark):
    units = collect.worklist(spark, ["a", "b"], ["PL"], 2000, 2001)
    assert units.count() == 4
    done = units.withColumnRenamed("termo", "termo")
    assert collect.pending_work(units, done).count() == 0
    part = units.filter(F.col("ano") == 2000)
    assert sorted(tuple(r) for r in collect.pending_work(units, part).collect()) == [("a", "PL", 2001), ("b", "PL", 2001)]


def test_survey_csv_sentinel(spark):
    d = tempfile.mkdtemp(prefix="plenaria-csv-")
    path = os.path.join(d, "survey.csv")
    with open(path, "w") as f:
        f.write("wave,lrpt,lrpsdb\n1990,5,-999\n1990,-999.0,3\n1994,7,4\n")
    df = survey.sentinel_to_null(survey.read_survey_csv(spark, path, ["lrpt", "lrpsdb"]))
    assert _rows(df) == sorted([(1990, None, 3.0), (1990, 5.0, None), (1994, 7.0, 4.0)], key=repr)


def test_stage_io_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="plenaria-io-")
    path = root + "/t"
    assert not stages.is_complete(spark, path)
    assert stages.read_stage(spark, path, "a int").count() == 0
    stages.write_stage(spark.range(5).withColumn("y", F.col("id") % 2), path, ["y"])
    assert stages.is_complete(spark, path)
    assert stages.read_stage(spark, path).count() == 5
    # replace one partition only (a re-collected year)
    stages.write_stage(spark.range(2).withColumn("y", F.lit(1).cast("long")), path, ["y"], replace_partitions=True)
    got = sorted(tuple(r) for r in spark.read.parquet(path).groupBy("y").count().collect())
    assert got == [(0, 3), (1, 2)]


def test_collect_chamber_from_landing_json(spark):
    pages = spark.createDataFrame([
        ("pobreza", json.dumps({"dados": [{"id": 10, "siglaTipo": "PL", "numero": "1", "ano": 2001},
                                          {"id": 11, "siglaTipo": "SUG", "ano": 2001}]})),
        ("extrema pobreza", json.dumps({"dados": [{"id": 10, "siglaTipo": "PL", "numero": "1", "ano": 2001}]})),
        ("pobreza", "erro")], "termo_busca string, raw string")
    author_json = spark.createDataFrame([
        ("10", json.dumps({"dados": [{"nome": "Ana", "siglaPartido": "PT", "siglaUf": "SP", "tipo": "Deputado"},
                                     {"nome": "Bia", "siglaPartido": "", "siglaUf": "", "tipo": "Deputado(a)",
                                      "uri": "u/1"}]})),
        ("11", json.dumps({"dados": [{"nome": "Povo", "tipo": "Sociedade Civil"}]}))],
        "id_interno string, raw string")
    profiles = spark.createDataFrame([("u/1", "PSOL", "RJ")], "uri string, perfil_partido string, perfil_uf string")
    out = {r["id_interno"]: r for r in collect.collect_chamber(pages, author_json, profiles).collect()}
    assert out["10"]["termo_busca"] == "extrema pobreza"          # lowest term position wins
    assert (out["10"]["parlamentar"], out["10"]["uf"], out["10"]["tipo_autor"]) == ("Ana; Bia", "SP; RJ", "PT; PSOL")
    assert out["11"]["tipo_autor"] == "Popular; Comissão"


def test_collect_senate_from_landing_json(spark):
    procs = [{"id": 1, "codigoMateria": 100, "tipoDocumento": "Projeto de Lei Ordinária", "tipoConteudo": "Norma Geral",
              "identificacao": "PLS 1/2001", "dataApresentacao": "2001-02-03", "ementa": " Combate à pobreza ",
              "autoria": "Senador Zé (PT/SP)"},
             {"id": 2, "codigoMateria": 101, "tipoDocumento": "Projeto de Lei Ordinária", "tipoConteudo": "Norma Geral",
              "ementa": "Outro tema", "autoria": "Comissão de Assuntos Sociais"},
             {"id": 3, "codigoMateria": 102, "tipoDocumento": "Requerimento", "ementa": "pobreza"}]
    listing = spark.createDataFrame([(json.dumps(procs),)], "raw string")
    details = spark.createDataFrame([("1", "", "Social", "Renda"), ("2", "RENDA MÍNIMA", "Social", "Assistência")],
                                    "id_processo string, indexacao string, assunto_geral string, assunto_especifico string")
    out = {r["id_interno"]: r for r in collect.collect_senate(listing, details).collect()}
    assert set(out) == {"SF-100", "SF-101"}
    assert (out["SF-100"]["termo_busca"], out["SF-100"]["rota"], out["SF-100"]["ano"]) == ("pobreza", 1, "2001")
    assert (out["SF-100"]["parlamentar"], out["SF-100"]["tipo_autor"], out["SF-100"]["uf"]) == ("Zé", "PT", "SP")
    assert (out["SF-101"]["termo_busca"], out["SF-101"]["rota"]) == ("renda mínima", 2)
    assert out["SF-101"]["tipo_autor"] == "Comissão" and out["SF-101"]["assunto_especifico"] == "Assistência"


def test_incremental_ingestion_processes_each_file_once(spark):
    root = tempfile.mkdtemp(prefix="plenaria-stream-")
    landing, out, ckpt = root + "/landing", root + "/out", root + "/ckpt"
    os.makedirs(landing)

    def land(name, ids):
        with open(os.path.join(landing, name), "w") as f:
            f.write(json.dumps({"dados": [{"id": i, "siglaTipo": "PL", "ano": 2001} for i in ids]}) + "\n")

    land("pobreza__p1.json", [1, 2])
    incremental.ingest_pages(spark, landing, out, ckpt)
    assert spark.read.parquet(out).count() == 2
    land("renda_minima__p1.json", [3])
    incremental.ingest_pages(spark, landing, out, ckpt)
    rows = spark.read.parquet(out)
    assert rows.count() == 3
    assert sorted(r[0] for r in rows.select("termo_busca").distinct().collect()) == ["pobreza", "renda mínima"]   # the accented term, so that it joins the configured list


def test_context_status_and_profile_parsers(spark):
    from plenaria.sources import landing
    cd = spark.createDataFrame([
        ("u1", json.dumps({"dados": {"keywords": "renda", "ementaDetalhada": None,
                                     "statusProposicao": {"descricaoSituacao": "Arquivada", "url": "x"}}})),
        ("u2", "erro")], "uri string, raw string")
    assert sorted(tuple(r) for r in landing.chamber_context(cd).collect()) == [("u1", "renda", ""), ("u2", "", "")]
    st = landing.chamber_status(cd.withColumnRenamed("uri", "id_interno"))
    assert sorted(tuple(r) for r in st.collect()) == [("u1", "Arquivada", "x"), ("u2", "", "")]
    sf = spark.createDataFrame([
        ("a", json.dumps({"DetalheMateria": {"Materia": {"IndexacaoMateria": "", "EmentaMateria": "longa"}}})),
        ("b", json.dumps({"DetalheMateria": {"Materia": {"IndexacaoMateria": "idx"}}})), ("c", "{}")],
        "uri string, raw string")
    assert sorted(tuple(r) for r in landing.senate_context(sf).collect()) == [("a", "longa"), ("b", "idx"), ("c", "")]
    prof = spark.createDataFrame([("u", json.dumps({"dados": {"ultimoStatus": {"siglaPartido": "PT", "siglaUf": "SP"}}}))],
                                 "uri string, raw string")
    assert [tuple(r) for r in landing.member_profiles(prof).collect()] == [("u", "PT", "SP")]


def test_display_names(spark):
    from plenaria.plans.consolidate import to_display
    df = spark.createDataFrame([("CD", "PL")], "origem string, tipo string")
    assert to_display(df).columns == ["Origem", "Tipo de Proposta"]


def test_read_landing_files(spark):
    from plenaria.sources import landing
    d = tempfile.mkdtemp(prefix="plenaria-landing-")
    with open(os.path.join(d, "page1.json"), "w") as f:
        f.write(json.dumps({"dados": [{"id": 7, "siglaTipo": "PEC", "ano": 1999}]}) + "\n" + "erro\n")
    pages = landing.read_landing(spark, d, key="pagina")
    recs = landing.chamber_records(pages, keep=("pagina",))
    assert [(r["id_interno"], r["tipo"], r["ano"]) for r in recs.collect()] == [("7", "PEC", "1999")]


def test_resumed_scores_equal_the_merge_of_two_runs(spark):
    import random
    rng = random.Random(4)
    said = ["erro", '{"nota": 3}', '{"nota": 8}', '{"nota": null}', '{"categoria": "x"}']
    rows = [(k, a, rng.choice(said)) for k in range(60) for a in range(1, 5) if rng.random() < 0.7]
    parsed = scoring.parse_attempts(spark.createDataFrame(rows, "seq long, attempt int, raw string"))
    keys = spark.range(60).withColumnRenamed("id", "seq")
    previous = keys.join(scoring.first_scored(parsed.filter(F.col("attempt") == 1)), "seq", "left")
    fresh = scoring.first_scored(parsed.join(scoring.pending(previous).select("seq"), "seq", "left_semi"))
    assert _rows(scoring.scored_with_retries(keys, parsed, "seq")) == _rows(scoring.resume(previous, fresh, "seq"))


def test_houses_unite_and_feed_the_chain(spark):
    p = proposals(spark, SF)
    senate = p.filter(F.col("origem") != "CD").drop("nota_bruta")
    both = collect.both_houses(p.filter(F.col("origem") == "CD"), senate)
    assert both.count() == p.count() and both.filter(F.col("nota_bruta").isNull()).count() == senate.count()


def test_kpis_with_nulls_and_summary_of_nothing(spark):
    base = spark.createDataFrame(
        [("CD", "PL", 2001, "PT", "Ana", True, "Promulgada"), ("SF", "SUG", 2001, "Popular; Comissão", None, False, None),
         ("CD", "MPV", None, "PT", None, True, "Arquivada"), (None, None, 2002, None, "Bia", False, "Arquivada")],
        "origem string, tipo string, ano_int int, tipo_autor string, parlamentar string, e_parlamentar boolean, situacao_norm string")
    k = mart.kpis(base).first()
    assert (k["total"], k["media_ano"], k["pct_cd"], k["pct_sf"], k["pct_cn"]) == (4, 2.0, 50.0, 25.0, 0.0)
    assert (k["n_parlamentares"], k["por_parlamentar"], k["pct_promulgada"]) == (1, 2.0, 25.0)
    assert (k["pct_popular"], k["pct_mpv"]) == (25.0, 25.0)
    none = spark.createDataFrame([], "situacao_norm string, llm_decisao string, llm_categoria string, espectro string, "
                                     "score_lr double, llm_nota double")
    assert _rows(mart.stage_summary(none)) == [("avaliacao", "com_nota", 0), ("cobertura", "com_score", 0)]
