"""Registered queries: name -> callable(spark, data_dir) -> DataFrame.

Each query reads the driver tables (through the bridge views) and runs one
operator or job of the pipeline over whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions import authors, text
from plenaria.operators import ordered, term_index, term_match, token_index
from plenaria.operators.capture import two_route_capture
from plenaria.operators.dedup import first_per_key
from plenaria.operators.filters import FacetSpec, exclude_pattern, exclude_values, facet_filter
from plenaria.operators.rollup import author_rollup, enrich_authors
from plenaria.plans import cells, collect, consolidate as c1, contexts, dashboard, ideology, mart, runner, scoring, status
from plenaria.sources import bridge, families, landing, ledger, stages
from plenaria.streaming import merge

# Search terms used on the driver's document texts (the configured Portuguese
# terms do not occur in them); the same list feeds the oracle.
DOCUMENT_TERMS = ["license", "the on", "que", "und", "réa", "étr"]
CAPTURE_DOC_TYPES = ["Projeto de Resolução", "Mensagem"]

FACETS = FacetSpec(
    origem=["Câmara dos Deputados", "Senado Federal", "Congresso Nacional"],
    grupo=["Projetos de Lei", "Emendas Constitucionais", "Medidas Provisórias", "Outros"],
    tipo=[],
    legislatura=["49ª (1991-1995)", "50ª (1995-1999)", "51ª (1999-2003)", "52ª (2003-2007)",
                 "53ª (2007-2011)", "54ª (2011-2015)", "55ª (2015-2019)"],
    autor=["Políticos", "Executivo"],
    espectro=["Esquerda", "Centro-Esquerda", "Centro", "Centro-Direita", "Direita"],
    partido=["PT", "PMDB/MDB", "PSDB", "DEM", "PFL", "PSOL", "PP", "PL", "PR"],
    politico=[],
    regiao=["Sudeste", "Nordeste", "Sul", "Norte", "Centro-Oeste"],
    uf=["SP", "RJ", "MG", "BA", "RS", "PR", "PE", "CE"],
    termo=[],
    ano=(1990, 2020),
)
FACETS_PEOPLE = FacetSpec(politico=["Ana e Souza-cruz", "João da Silva 7", "Maria das Dores 12"],
                          tipo=["Projeto de Lei", "Medida Provisória", "Proposta de Emenda Constitucional"],
                          termo=["pobreza", "extrema pobreza", "renda mínima"])


def _b(spark, d, view):
    return bridge.bridge(spark, d, view)


def proposals(spark, d):
    return _b(spark, d, "proposals")


def stage1(spark, d):
    return c1.consolidate(proposals(spark, d))


def scores_by_seq(spark, d):
    return scoring.first_scored(scoring.parse_attempts(_b(spark, d, "attempts")))


def survey_table(spark, d):
    return ideology.survey_scores(_b(spark, d, "survey"))


def scored(spark, d):
    return mart.scored_base(proposals(spark, d), scores_by_seq(spark, d), survey_table(spark, d))


def mart_table(spark: SparkSession, d: str) -> DataFrame:
    """The dashboard's base table (included proposals with derived columns)."""
    return mart.mart_base(scored(spark, d))


def attempts_by_id(spark, d):
    """Model responses under the proposals' internal ids."""
    ids = proposals(spark, d).select("seq", "id_interno")
    return _b(spark, d, "attempts").join(ids, "seq").select("id_interno", "attempt", "raw")


def final_mart(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain: both houses' records -> stages 1 to 4 -> the dashboard's base."""
    p = proposals(spark, d)
    raw = collect.both_houses(p.filter(F.col("origem") == "CD"), p.filter(F.col("origem") != "CD"))
    return mart.mart_base(runner.final_plan(raw, status_source(spark, d), attempts_by_id(spark, d),
                                            _b(spark, d, "survey")))


# ---------------------------------------------------------------- queries
def q_worklist(spark, d):
    return collect.pending_work(collect.worklist(spark), collect.done_units(proposals(spark, d)))


def q_term_match_first(spark, d):
    docs = bridge.table(spark, d, "documents")
    return term_match.with_first_term(docs.select("doc_id", "text"), "text", DOCUMENT_TERMS).select("doc_id", "termo")


def q_term_match_all(spark, d):
    docs = bridge.table(spark, d, "documents")
    return term_match.term_counts(docs, "text", DOCUMENT_TERMS, ["doc_id"])


def benchmark_terms(spark, d):
    """A large term list: every two and three words in a row of the benchmark's texts."""
    items = spark.read.parquet(f"{d}/benchmark.parquet")
    return term_index.runs(items, ["item_id"], "text", [2, 3]).select(F.col("run").alias("termo")).distinct()


def q_term_index_first(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return term_index.first_index_term(docs, benchmark_terms(spark, d), ["doc_id"], "text")


def q_term_index_all(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return term_index.index_term_counts(docs, benchmark_terms(spark, d), ["doc_id"], "text")


def q_two_route_capture(spark, d):
    out = two_route_capture(_b(spark, d, "captura"), _b(spark, d, "captura_detalhe"), DOCUMENT_TERMS,
                            doc_types=CAPTURE_DOC_TYPES, columns=["tipo_doc", "tipo_conteudo"])
    return out.select("cod", "tipo_doc", "tipo_conteudo", "termo_busca", "rota")


def q_dedup_first(spark, d):
    li = bridge.table(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    out = first_per_key(li, keys, [c for c in li.columns if c not in keys])
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def q_exclude_subject(spark, d):
    return exclude_values(proposals(spark, d), "assunto_especifico", vocab.EXCLUDED_SUBJECTS) \
        .select("seq", "assunto_especifico")


def q_exclude_regex(spark, d):
    return exclude_pattern(proposals(spark, d), "ementa", vocab.SUMMARY_EXCLUSION_PATTERN) \
        .select("seq", "ementa")


def q_exclude_regex_documents(spark, d):
    docs = bridge.table(spark, d, "documents")
    return exclude_pattern(docs, "text", term_match.alternation(DOCUMENT_TERMS)).select("doc_id", "lang")


def q_consolidate(spark, d):
    return stage1(spark, d)


def q_crosstab_margins(spark, d):
    return c1.house_crosstab(stage1(spark, d))


def status_source(spark, d):
    """Fetched status per internal id (first by sequence when an id repeats)."""
    p = proposals(spark, d).select("id_interno", "seq", "situacao")
    return first_per_key(p, ["id_interno"], ["seq"]).select("id_interno", "situacao")


def q_status_enrich(spark, d):
    return status.enrich_status(stage1(spark, d), status_source(spark, d))


def q_status_json(spark, d):
    return landing.senate_status(_b(spark, d, "status_raw"))


def q_status_table(spark, d):
    return status.status_table(_b(spark, d, "status_respostas"))


def q_status_enrich_raw(spark, d):
    """Stage 2 from the landed responses of both houses."""
    table = status.status_table(_b(spark, d, "status_respostas"))
    return status.enrich_status(stage1(spark, d), table).select("id_interno", "origem", "situacao", "situacao_norm")


def q_chamber_json(spark, d):
    return landing.chamber_records(_b(spark, d, "pagina_raw"), keep=("pagina",))


def q_detail_json(spark, d):
    return landing.senate_detail(_b(spark, d, "detalhe_raw"))


def lineitem_authors(spark, d):
    """Author lists: one author per line item, supplier as name, nation as state, brand as kind."""
    li = bridge.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice")
    sup = bridge.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = bridge.table(spark, d, "nation").select("n_nationkey", "n_name")
    part = bridge.table(spark, d, "part").select("p_partkey", "p_brand")
    a = (li.join(sup, li.l_suppkey == sup.s_suppkey)
         .join(F.broadcast(nat), F.col("s_nationkey") == nat.n_nationkey)   # 25 nations: fixed size
         .join(part, li.l_partkey == part.p_partkey))
    return a.select(F.col("l_orderkey").alias("seq"), "l_linenumber", "l_suppkey", "l_partkey",
                    "l_shipdate", "l_extendedprice", F.col("s_name").alias("nome"),
                    F.lit("").alias("partido"), F.col("n_name").alias("uf"), F.col("p_brand").alias("tipo"))


AUTHOR_ORDER = ["l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice"]


def q_author_rollup(spark, d):
    types = proposals(spark, d).select("seq", "tipo")
    return author_rollup(lineitem_authors(spark, d), "seq", AUTHOR_ORDER, types)


def q_author_enrich(spark, d):
    p = proposals(spark, d).select("seq", "origem", "tipo")
    return enrich_authors(p, q_author_rollup(spark, d), "seq")


def q_author_parse(spark, d):
    a = _b(spark, d, "autoria_bruta")
    parsed = a.select("seq", authors.senate_author("autoria", "tipo_doc").alias("_a"))
    return parsed.select("seq", "_a.parlamentar", "_a.tipo_autor", "_a.uf")


def q_party_extract(spark, d):
    p = proposals(spark, d)
    return (p.groupBy("tipo_autor", authors.party_of_author("tipo_autor").alias("partido_bls"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_author_category(spark, d):
    return mart.author_groups(proposals(spark, d))


def q_is_parliamentarian(spark, d):
    p = proposals(spark, d).withColumn("e_parlamentar", authors.is_member("tipo_autor"))
    return p.groupBy("e_parlamentar").agg(F.count(F.lit(1)).alias("n"),
                                           F.count_distinct("parlamentar").alias("n_autores"))


def q_survey_scores(spark, d):
    return survey_table(spark, d)


def q_ideology_asof(spark, d):
    p = proposals(spark, d).select("seq", "tipo_autor", "ano")
    out = ideology.enrich_ideology(p, survey_table(spark, d))
    return (out.groupBy("partido_bls", "ano", "score_lr", "espectro")
            .agg(F.count(F.lit(1)).alias("n")))


def prompt_contexts(spark, d):
    det = landing.senate_detail(_b(spark, d, "detalhe_raw"))
    return det.select("seq", F.col("indexacao").alias("keywords"),
                      F.col("assunto_especifico").alias("ementa_detalhada"),
                      F.coalesce(F.nullif("indexacao", F.lit("")), F.nullif("assunto_especifico", F.lit("")),
                                 F.lit("")).alias("indexacao"))


def q_prompt_table(spark, d):
    from plenaria.functions.labels import normalise_type
    p = proposals(spark, d).select("seq", "origem", normalise_type("tipo").alias("tipo"),
                                   text.proposal_number("numero").alias("numero"), "ano", "ementa")
    return scoring.prompt_table(p, prompt_contexts(spark, d), "seq")


def q_score_parse(spark, d):
    return scoring.parse_attempts(_b(spark, d, "attempts"))


def q_category_check(spark, d):
    return scores_by_seq(spark, d).select("seq", "llm_categoria", scoring.valid_category("llm_categoria").alias("categoria_valida"))


def q_score_resume(spark, d):
    parsed = scoring.parse_attempts(_b(spark, d, "attempts"))
    return scoring.scored_with_retries(proposals(spark, d).select("seq"), parsed, "seq")


def facet_rows(base: DataFrame) -> DataFrame:
    out = facet_filter(base, FACETS)
    return out.select("seq", "origem", "tipo", "ano_int", "uf", "tipo_autor", "espectro", "legislatura")


def facet_people_rows(base: DataFrame) -> DataFrame:
    return facet_filter(base, FACETS_PEOPLE).select("seq", "parlamentar", "tipo_extenso", "termo_busca")


def facet_indexed_rows(base: DataFrame, spec: FacetSpec, columns: list[str]) -> DataFrame:
    """A selection of the base whose token facets are answered by an inverted index of it."""
    held = stages.written(base.select(*INDEXED_COLUMNS), "indexed")
    path = stages.shared_path(base.sparkSession, "token-index")
    token_index.write_index(held, "seq", path)
    return token_index.select_rows(held, spec, "seq", path).select(*columns)


INDEXED_COLUMNS = ["seq", "origem", "origem_extenso", "tipo", "tipo_extenso", "ano_int", "legislatura", "regiao", "uf",
                   "termo_busca", "tipo_autor", "espectro", "parlamentar"]


def mart_counts(base: DataFrame) -> DataFrame:
    return (base.groupBy("origem_extenso", "tipo_extenso", "legislatura", "regiao", "e_parlamentar")
            .agg(F.count(F.lit(1)).alias("n")))


UNIT = ["origem", "ano"]


def collected_units(spark, d):
    """A table of house-year units on shared storage, from proposals: all years that 3 does not divide were collected,
    then the replacement of those that 5 divides broke off.  Returns its path and the whole work list."""
    rows = proposals(spark, d).select("seq", "id_interno", "tipo", *UNIT)
    houses = F.explode(F.array(*(F.lit(h) for h in ("CD", "SF", "CN"))))
    years = F.explode(F.sequence(F.lit(vocab.YEAR_START), F.lit(vocab.YEAR_END)).cast("array<string>"))
    work = spark.range(1).select(houses.alias("origem")).select("origem", years.alias("ano"))
    path = stages.shared_path(spark, "units")
    ledger.write_units(rows, work.where("CAST(ano AS INT) % 3 <> 0"), path, UNIT)
    ledger.begin_units(work.where("CAST(ano AS INT) % 5 = 0"), path, UNIT)
    return path, work, rows.schema


def q_units_pending(spark, d):
    path, work, _ = collected_units(spark, d)
    return ledger.pending_units(work, path, UNIT)


def q_units_read(spark, d):
    path, _, schema = collected_units(spark, d)
    return ledger.read_units(spark, path, UNIT, schema)


FAMILY_YEARS = (1995, 2010)


def q_year_families(spark, d):
    """The years 1995 to 2010 of the two families of year files; they differ in columns, the Senate's also by year."""
    base = stages.shared_path(spark, "families")
    p = proposals(spark, d)
    rows = p.select("seq", "id_interno", "tipo", "id_processo", "tramitando", "ano")
    families.write_family(rows.where(p["origem"] == "CD").drop("id_processo"), base, "camara")
    senate = rows.where(p["origem"] != "CD")
    families.write_family(senate.where("CAST(ano AS INT) < 2000").drop("tramitando"), base, "senado")
    families.write_family(senate.where("CAST(ano AS INT) >= 2000"), base, "senado")
    return families.read_families(spark, base, ["camara", "senado", "mista"], *FAMILY_YEARS)


def q_merge_batches(spark, d):
    """Pages landed in several files, merged over two runs of the stream: the second one finds the rest of the files."""
    landed, root = _b(spark, d, "paginas_por_termo"), stages.shared_path(spark, "merge")
    for run in (0, 1):
        landed.where((F.col("pagina") < "2") == (run == 0)).write.mode("append").partitionBy("pagina").parquet(f"{root}/landed")
        pages = spark.readStream.schema(landed.select("termo_busca", "raw", "pagina").schema).parquet(f"{root}/landed")
        records = landing.chamber_records(pages, keep=("termo_busca",)).select(*MERGED_COLUMNS)
        merge.merge_stream(records, f"{root}/out", f"{root}/checkpoint")
    return merge.merged(spark, f"{root}/out")


MERGED_COLUMNS = ["id_interno", "termo_busca", "tipo", "numero", "ano", "ementa"]


def q_context_table(spark, d):
    return contexts.context_table(_b(spark, d, "contexto_respostas"))


def q_context_texts(spark, d):
    p = stage1(spark, d).select("id_interno", "origem", "tipo", "numero", "ano", "ementa", "uri")
    return contexts.context_texts(p, contexts.context_table(_b(spark, d, "contexto_respostas")), "id_interno")


def q_consolidate_ordered(spark, d):
    return ordered.with_ordinal(stage1(spark, d).select("id_interno", *c1.SORT), [*c1.SORT, "id_interno"])


def q_collect_senate(spark, d):
    details = landing.senate_detail(_b(spark, d, "detalhe_raw")).withColumn(
        "id_processo", (F.col("seq") + bridge.PROCESS_ID_BASE).cast("string"))
    out = collect.collect_senate(_b(spark, d, "processos_raw"), details)
    return out.select("id_interno", "id_processo", "origem", "tipo", "numero", "ano", "data_apre", "ementa", "parlamentar",
                      "tipo_autor", "uf", "assunto_especifico", "termo_busca", "rota", "tramitando", "uri")


def q_pipeline_final(spark, d):
    return final_mart(spark, d).select(
        "id_interno", "origem", "origem_extenso", "tipo", "tipo_extenso", "numero", "ano_int", "data_apre", "uf", "regiao",
        "legislatura", "e_parlamentar", "situacao_norm", "llm_nota", "llm_categoria", "partido_bls", "score_lr", "espectro")


def q_dashboard_selected(spark, d):
    """Every chart table over a selection of the finished chain's base."""
    return dashboard.long_form(dashboard.selected_views(final_mart(spark, d), FACETS))


def q_stage_summary(spark, d):
    return mart.stage_summary(scored(spark, d))


#: The dashboard's views: name -> function of the base table.
VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "kpis": mart.kpis,
    "kpis_empty": lambda base: mart.kpis(base.filter(F.col("origem") == "nenhuma")),
    "kpis_filtered": lambda base: mart.kpis(facet_filter(base, FACETS)),
    "by_legislature": mart.by_legislature,
    "by_year_house": mart.by_year_house,
    "type_mix": mart.type_mix,
    "party_author_tree": mart.party_author_tree,
    "by_state": mart.by_state,
    "top_states": mart.top_states,
    "term_mix": mart.term_mix,
    "top_authors": mart.top_authors,
    "party_term_matrix": mart.party_term_matrix,
    "party_term_ordered": lambda base: ordered.matrix_order(
        mart.party_term_matrix(base), "p_plot", "termo_busca", "row_total", "col_total"),
    "category_counts_ordered": lambda base: ordered.value_counts(base, "llm_categoria"),
    "facet_options_ordered": lambda base: ordered.with_ordinal(mart.facet_options(base), ["faceta", "valor", "rotulo"]),
    "party_type_flow": mart.party_type_flow,
    "latest_rows": mart.latest_rows,
    "ideology_by_leg_group": mart.ideology_by_leg_group,
    "ideology_by_house": mart.ideology_by_house,
    "by_band": mart.by_band,
    "ideology_by_state": mart.ideology_by_state,
    "lowest_state_scores": mart.lowest_state_scores,
    "facet_options": mart.facet_options,
    "facet_filter": facet_rows,
    "facet_people": facet_people_rows,
    "by_state_split": lambda base: mart.by_state(base, explode_states=True),
    "ideology_by_state_split": lambda base: mart.ideology_by_state(base, explode_states=True),
    "fixed_orders": mart.fixed_orders,
    "kpis_cells": lambda base: cells.kpis_from_cells(cells.kpi_cells(base)),
    "kpis_cells_filtered": lambda base: cells.kpis_from_cells(cells.kpi_cells(base), FACETS),
    "members_by_level": lambda base: cells.members_by(cells.kpi_cells(base), ["legislatura", "origem", "tipo"]),
    "facet_filter_indexed": lambda base: facet_indexed_rows(
        base, FACETS, ["seq", "origem", "tipo", "ano_int", "uf", "tipo_autor", "espectro", "legislatura"]),
    "facet_people_indexed": lambda base: facet_indexed_rows(
        base, FACETS_PEOPLE, ["seq", "parlamentar", "tipo_extenso", "termo_busca"]),
    "mart_base": mart_counts,
}


def _on_mart(view):
    return lambda spark, d: view(mart_table(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "worklist_crossjoin": q_worklist,
    "term_match_first": q_term_match_first,
    "term_match_all": q_term_match_all,
    "term_index_first": q_term_index_first,
    "term_index_all": q_term_index_all,
    "two_route_capture": q_two_route_capture,
    "dedup_first": q_dedup_first,
    "exclude_subject": q_exclude_subject,
    "exclude_regex": q_exclude_regex,
    "exclude_regex_documents": q_exclude_regex_documents,
    "consolidate": q_consolidate,
    "crosstab_margins": q_crosstab_margins,
    "status_enrich": q_status_enrich,
    "status_json": q_status_json,
    "status_table": q_status_table,
    "status_enrich_raw": q_status_enrich_raw,
    "chamber_json": q_chamber_json,
    "detail_json": q_detail_json,
    "author_enrich": q_author_enrich,
    "author_rollup": q_author_rollup,
    "author_parse": q_author_parse,
    "party_extract": q_party_extract,
    "author_category": q_author_category,
    "is_parliamentarian": q_is_parliamentarian,
    "survey_scores": q_survey_scores,
    "ideology_asof": q_ideology_asof,
    "prompt_table": q_prompt_table,
    "score_parse": q_score_parse,
    "score_resume": q_score_resume,
    "category_check": q_category_check,
    "stage_summary": q_stage_summary,
    "units_pending": q_units_pending,
    "units_read": q_units_read,
    "year_families": q_year_families,
    "merge_batches": q_merge_batches,
    "context_table": q_context_table,
    "context_texts": q_context_texts,
    "consolidate_ordered": q_consolidate_ordered,
    "collect_senate": q_collect_senate,
    "pipeline_final": q_pipeline_final,
    "dashboard_selected": q_dashboard_selected,
} | {name: _on_mart(view) for name, view in VIEWS.items()}
