"""Data mart: base table, facet filter, KPIs and the aggregate views.

Every view is a DataFrame over the (facet-filtered) base table.  The base is
meant to be written once as a table and read by all views, as the dashboard
loads its base once; every view aggregates the base once and does its ranking
and labelling on that aggregate (written to the shared folder where it is read
more than once), so its output is bounded by the number of
categories, not by the number of rows (the top-500 table is the one exception).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions import authors, labels, text
from plenaria.functions.util import in_list, lit_array, lookup
from plenaria.operators import grouping, ranking
from plenaria.operators.filters import exclude_institutional, fill_missing
from plenaria.plans.consolidate import FILL
from plenaria.plans.ideology import enrich_ideology
from plenaria.plans.scoring import SCORE_COLUMNS
from plenaria.sources.stages import written

ROUND = 4


def scored_base(proposals: DataFrame, scores: DataFrame, survey_scores: DataFrame,
                key: str = "seq") -> DataFrame:
    """Proposals with type codes, status label, relevance score and ideology (all rows)."""
    df = (proposals.join(scores.select(key, *SCORE_COLUMNS), key, "left")
          .withColumns({"tipo": labels.normalise_type("tipo"),
                        "situacao_norm": labels.status_label("situacao")}))
    df = fill_missing(df, {k: v for k, v in FILL.items() if k in df.columns})
    return enrich_ideology(df, survey_scores)


def mart_base(scored: DataFrame) -> DataFrame:
    """Included proposals with the dashboard's derived columns."""
    df = scored.filter(F.col("llm_decisao") == vocab.DECISION_INCLUDE)
    ano_int = text.to_int("ano")
    return df.withColumns({
        "llm_nota": text.to_number(F.col("llm_nota").cast("string")),
        "origem_extenso": labels.house_label("origem"),
        "tipo_extenso": labels.type_label("tipo"),
        "ano_int": ano_int,
        "legislatura": labels.legislature(ano_int),
        "regiao": labels.region("uf"),
        "e_parlamentar": authors.is_member("tipo_autor"),
    })


def _pct(part: str) -> F.Column:
    """Share of the counted rows in percent; null over no rows, which the display shows as its placeholder."""
    return F.round(F.try_divide(F.lit(100.0) * F.sum(part), F.sum("n")), ROUND)


def kpis(d: DataFrame) -> DataFrame:
    """The eight headline numbers (one row).

    The base is first counted by year and member, without distinct counts; those run on that aggregate, so the rows of
    the base are not multiplied for them.
    """
    cells = (d.groupBy("ano_int", F.when(F.col("e_parlamentar"), F.col("parlamentar")).alias("membro"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("origem") == "CD").alias("cd"),
                  F.count_if(F.col("origem") == "SF").alias("sf"),
                  F.count_if(F.col("origem") == "CN").alias("cn"),
                  F.count_if(F.col("situacao_norm") == "Promulgada").alias("promulgada"),
                  F.count_if(F.col("e_parlamentar")).alias("de_membros"),
                  F.count_if((F.col("tipo") == "SUG") | text.contains_or_false("tipo_autor", "Popular")).alias("popular"),
                  F.count_if(F.col("tipo") == "MPV").alias("mpv")))
    total, n_parl = F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("membro")
    return cells.agg(
        total.alias("total"),
        F.round(total / F.greatest(F.count_distinct("ano_int"), F.lit(1)), ROUND).alias("media_ano"),
        _pct("cd").alias("pct_cd"), _pct("sf").alias("pct_sf"), _pct("cn").alias("pct_cn"),
        _pct("promulgada").alias("pct_promulgada"),
        n_parl.alias("n_parlamentares"),
        F.round(F.try_divide(F.sum("de_membros"), F.nullif(n_parl, F.lit(0))), ROUND).alias("por_parlamentar"),
        _pct("popular").alias("pct_popular"), _pct("mpv").alias("pct_mpv"),
    )


def legislature_dim(spark: SparkSession) -> DataFrame:
    """Fixed legislature sequence (label, position)."""
    rows = ", ".join(f"('{label}', {i})" for i, (_, label) in enumerate(vocab.LEGISLATURES))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(legislatura, ordem)")


def by_legislature(d: DataFrame) -> DataFrame:
    """Count per legislature over the fixed sequence, zero-filled."""
    counts = d.groupBy("legislatura").agg(F.count(F.lit(1)).alias("n"))
    return grouping.zero_fill(legislature_dim(d.sparkSession), counts, "legislatura")


def by_year_house(d: DataFrame) -> DataFrame:
    """D2."""
    return d.dropna(subset=["ano_int", "origem"]).groupBy("ano_int", "origem").agg(F.count(F.lit(1)).alias("n"))


def type_mix(d: DataFrame, k: int = 5) -> DataFrame:
    """D3: top-k types (others relabelled) per legislature, with percent within legislature.

    One aggregate over the base; the top-k and the relabelling run on it.
    """
    cells = written(d.dropna(subset=["legislatura", "tipo"]).groupBy("legislatura", "tipo").agg(F.count(F.lit(1)).alias("n")),
                    "type-mix")
    top = (cells.groupBy("tipo").agg(F.sum("n").alias("_t"))
           .orderBy(F.desc("_t"), F.asc("tipo")).limit(k).select(F.col("tipo").alias("_top")))
    tp = F.when(F.col("_top").isNotNull(), F.col("tipo")).otherwise(F.lit(vocab.OTHERS))
    relabelled = cells.join(F.broadcast(top), F.col("tipo") == F.col("_top"), "left")
    counts = relabelled.groupBy("legislatura", tp.alias("tp")).agg(F.sum("n").cast("bigint").alias("n"))
    return grouping.share_within(counts, ["legislatura"])


def author_groups(d: DataFrame) -> DataFrame:
    """Count per author group."""
    return d.groupBy(authors.author_group("tipo_autor").alias("categoria")).agg(F.count(F.lit(1)).alias("n"))


def members(d: DataFrame) -> DataFrame:
    return d.filter(F.col("e_parlamentar"))


def party_author_tree(d: DataFrame, n_groups: int = 10, n_items: int = 10) -> DataFrame:
    """Party -> author counts, top-N with a remainder on both levels."""
    raw = (members(d).dropna(subset=["parlamentar"]).groupBy(text.first_token("tipo_autor").alias("_tok"), "parlamentar")
           .agg(F.count(F.lit(1)).alias("n")))
    counts = (raw.withColumn("partido", authors.normalise_party("_tok", dashboard=True))
              .filter(F.col("partido").isNotNull())
              .groupBy("partido", "parlamentar").agg(F.sum("n").cast("bigint").alias("n")))
    counts = exclude_institutional(counts, "partido")
    counts = counts.withColumn("parlamentar", text.person_name("parlamentar", drop_parentheses=False))
    return ranking.tree_top_n(written(counts, "party-author"), "partido", "parlamentar", "n", n_groups, n_items)


def _states(d: DataFrame, explode_states: bool) -> DataFrame:
    """Rows with a state text; with ``explode_states`` a row for each state that the text names, once if it repeats."""
    if explode_states:
        d = d.withColumn("uf", F.explode(F.array_distinct(text.tokens("uf"))))
    return d.filter(text.is_present("uf"))


def by_state(d: DataFrame, explode_states: bool = False) -> DataFrame:
    """Count per state text; a multi-state text is its own key unless ``explode_states`` counts it for each state."""
    return _states(d, explode_states).groupBy("uf").agg(F.count(F.lit(1)).alias("n"))


def top_states(d: DataFrame, k: int = 15) -> DataFrame:
    """O6 (D6 without a map): the k states with most proposals."""
    return by_state(d).orderBy(F.desc("n"), F.asc("uf")).limit(k)


def term_mix(d: DataFrame) -> DataFrame:
    """Search-term share per legislature, terms title-cased."""
    counts = d.dropna(subset=["legislatura", "termo_busca"]).groupBy("legislatura", "termo_busca").agg(F.count(F.lit(1)).alias("n"))
    return (grouping.share_within(counts, ["legislatura"])
            .withColumn("termo_busca", text.title_term("termo_busca")))


def top_authors(d: DataFrame, k: int = 15) -> DataFrame:
    """Most frequent authors (upper-cased, stripped), display-normalised."""
    per_name = members(d).dropna(subset=["parlamentar"]).groupBy("parlamentar").agg(F.count(F.lit(1)).alias("n"))
    keyed = (per_name.groupBy(text.strip_ws(F.upper(F.col("parlamentar"))).alias("_k"))
             .agg(F.sum("n").cast("bigint").alias("n")))
    top = keyed.orderBy(F.desc("n"), F.asc("_k")).limit(k)
    return top.select(text.person_name("_k", drop_parentheses=False).alias("parlamentar"), "n")


def _author_cells(d: DataFrame, other: str) -> DataFrame:
    """Members' rows counted per (author text, ``other``): the one scan of the base."""
    return members(d).groupBy("tipo_autor", other).agg(F.count(F.lit(1)).alias("n"))


def party_term_matrix(d: DataFrame, k: int = 12) -> DataFrame:
    """First author token x search term counts for the top-k tokens (institutions removed after the cut).

    Long form over the terms present, zero-filled: (p_plot, termo_busca, n, row_total, col_total).  Token ranking
    counts every token of the author text; rows go to their first token.  Both come from one aggregate over the base.
    """
    cells = written(_author_cells(d, "termo_busca").dropna(subset=["termo_busca"]), "party-term")
    tok = (cells.select(F.explode(text.tokens("tipo_autor")).alias("_tok"), "n")
           .groupBy("_tok").agg(F.sum("n").alias("_t")))
    top = exclude_institutional(tok.orderBy(F.desc("_t"), F.asc("_tok")).limit(k), "_tok").select("_tok")
    counts = (cells.withColumn("p_plot", text.first_token("tipo_autor"))
              .join(F.broadcast(top), F.col("p_plot") == F.col("_tok"), "left_semi")
              .groupBy("p_plot", "termo_busca").agg(F.sum("n").cast("bigint").alias("n")))
    # one row per term: its kept parties (at most k) and, from the same aggregate, all kept parties' totals
    by_term = counts.groupBy("termo_busca").agg(F.sum("n").cast("bigint").alias("col_total"),
                                                F.map_from_entries(F.collect_list(F.struct("p_plot", "n"))).alias("_n"))
    by_party = counts.groupBy("p_plot").agg(F.sum("n").cast("bigint").alias("row_total"))
    parties = by_party.agg(F.collect_list(F.struct("p_plot", "row_total"))).scalar()     # at most k
    return (by_term.select("termo_busca", "col_total", "_n", F.explode(parties).alias("_p"))
            .select("_p.p_plot", "termo_busca",
                    F.coalesce(F.col("_n")[F.col("_p.p_plot")], F.lit(0)).cast("bigint").alias("n"),
                    "_p.row_total", "col_total"))


def party_type_flow(d: DataFrame, k_parties: int = 8, k_types: int = 6) -> DataFrame:
    """Party -> type edges among the top parties (institutions removed after the cut) and top types."""
    cells = written(_author_cells(d, "tipo").groupBy(text.first_token("tipo_autor").alias("p_sk"), "tipo")
                    .agg(F.sum("n").cast("bigint").alias("n")), "party-type")
    top_p = exclude_institutional(
        cells.groupBy("p_sk").agg(F.sum("n").alias("_t")).orderBy(F.desc("_t"), F.asc("p_sk")).limit(k_parties),
        "p_sk")
    top_p = top_p.select("p_sk", (F.row_number().over(Window.orderBy(F.desc("_t"), F.asc("p_sk"))) - 1)
                         .alias("source"))
    n_sources = top_p.select(F.count(F.lit(1))).scalar()
    top_t = (cells.groupBy("tipo").agg(F.sum("n").alias("_t")).orderBy(F.desc("_t"), F.asc("tipo"))
             .limit(k_types))
    top_t = top_t.select("tipo", (F.row_number().over(Window.orderBy(F.desc("_t"), F.asc("tipo"))) - 1).alias("_r"))
    edges = cells.join(F.broadcast(top_p), "p_sk").join(F.broadcast(top_t), "tipo")
    return edges.select("p_sk", "tipo", labels.type_label("tipo").alias("tipo_label"), "n", "source",
                        (F.col("_r") + n_sources).cast("int").alias("target"))


LATEST_COLUMNS = ["ano", "tipo", "numero", "parlamentar", "ementa", "llm_categoria"]


def latest_rows(d: DataFrame, k: int = 500, tie_break: str = "seq") -> DataFrame:
    """The k most recent rows, missing values shown as the placeholder."""
    top = d.orderBy(F.desc("ano"), F.asc(tie_break)).limit(k)
    return top.select(*[F.coalesce(F.col(c).cast("string"), F.lit(vocab.PLACEHOLDER)).alias(c)
                        for c in LATEST_COLUMNS])


def _with_score(d: DataFrame) -> DataFrame:
    return d.filter(F.col("score_lr").isNotNull())


def ideology_by_leg_group(d: DataFrame) -> DataFrame:
    """Mean ideology per legislature, total and per type group."""
    d12 = _with_score(d).withColumn("grupo", F.coalesce(labels.type_group("tipo"), F.lit(vocab.OTHERS)))
    out = grouping.mean_with_total(d12, "legislatura", "grupo", "score_lr", digits=ROUND)
    return out.withColumn("ordem", labels.legislature_order("legislatura"))


def ideology_by_house(d: DataFrame) -> DataFrame:
    """Mean ideology per legislature x chamber (Congress folded into Senate)."""
    d13 = _with_score(d).withColumn("casa", lookup(vocab.HOUSE_CHAMBER, "origem"))
    return (d13.groupBy("legislatura", "casa")
            .agg(F.round(grouping.exact_mean("score_lr"), ROUND).alias("score_lr")))


def by_band(d: DataFrame) -> DataFrame:
    """Count per ideology band."""
    band = F.coalesce(F.col("espectro"), F.lit(vocab.IDEOLOGY_UNKNOWN)).alias("espectro")
    return d.groupBy(band).agg(F.count(F.lit(1)).alias("n"))


def fixed_orders(d: DataFrame) -> DataFrame:
    """Counts of band, region and type group (dimensao, valor, n, ordem) with each value's place in its fixed order.

    One pass; a value that the fixed order does not list comes after it (ordem null), a value without rows has none.
    """
    dims = {"espectro": (F.coalesce("espectro", F.lit(vocab.IDEOLOGY_UNKNOWN)), vocab.IDEOLOGY_BAND_ORDER),
            "regiao": (F.col("regiao"), vocab.REGION_ORDER),
            "grupo": (F.coalesce(labels.type_group("tipo"), F.lit(vocab.OTHERS)), vocab.TYPE_GROUP_ORDER)}
    pairs = F.array(*(F.struct(F.lit(name).alias("dimensao"), value.alias("valor")) for name, (value, _) in dims.items()))
    counts = d.select(F.inline(pairs)).groupBy("dimensao", "valor").agg(F.count(F.lit(1)).alias("n"))
    place = F.coalesce(*(F.when(F.col("dimensao") == name, F.nullif(F.array_position(lit_array(order), F.col("valor")), F.lit(0)))
                         for name, (_, order) in dims.items()))
    return counts.withColumn("ordem", place.cast("int"))


def ideology_by_state(d: DataFrame, explode_states: bool = False) -> DataFrame:
    """Mean ideology per state text, or per state that the texts name."""
    return (_states(_with_score(d), explode_states).groupBy("uf")
            .agg(F.round(grouping.exact_mean("score_lr"), ROUND).alias("score_lr")))


def lowest_state_scores(d: DataFrame, k: int = 15) -> DataFrame:
    """O6 (D15 without a map): the k states with the lowest mean ideology score."""
    return ideology_by_state(d).orderBy(F.asc("score_lr"), F.asc("uf")).limit(k)


def facet_options(d: DataFrame) -> DataFrame:
    """Sorted distinct option lists of every facet, in long form (faceta, valor, rotulo).

    One pass emits the raw option values of every facet; they are de-duplicated
    (partial aggregation) before any normalisation, which then runs on distinct
    values only.
    """
    def opt(name, value):
        return F.struct(F.lit(name).alias("faceta"), value.cast("string").alias("raw"))

    def each(name, arr):
        return F.coalesce(F.transform(arr, lambda t: opt(name, t)),
                          F.array().cast("array<struct<faceta:string,raw:string>>"))

    options = F.concat(
        F.array(opt("ano", F.col("ano_int")), opt("origem", F.col("origem_extenso")),
                opt("tipo", F.col("tipo_extenso")), opt("termo", F.col("termo_busca"))),
        each("uf", F.split("uf", ";")),
        each("partido", F.split("tipo_autor", ";")),
        each("politico", F.split("parlamentar", "[;,]")))
    raw = d.select(F.explode(options).alias("o")).select("o.faceta", "o.raw").distinct()
    f, r = F.col("faceta"), F.col("raw")
    valor = (F.when(f == "uf", F.when(~in_list(text.strip_ws(r), ["", vocab.PLACEHOLDER])
                                      & (F.length(text.strip_ws(r)) == 2), text.strip_ws(r)))
             .when(f == "partido", authors.normalise_party(r, dashboard=True))
             .when(f == "politico", F.when(text.is_present(text.strip_ws(r)), text.person_name(r)))
             .otherwise(r))
    rotulo = F.when(f == "termo", text.title_term(r)).otherwise(F.col("valor"))
    out = raw.withColumn("valor", valor).withColumn("rotulo", rotulo)
    out = out.filter(F.col("valor").isNotNull() & ((f != "politico") | (F.length("valor") > 2)))
    return out.select("faceta", "valor", "rotulo").distinct()


def stage_summary(scored: DataFrame) -> DataFrame:
    """Stage summaries in long form (resumo, chave, n).

    Value counts of status label, decision, category and band and the score coverage in one pass (explode of
    (summary, key, count) triples, partial aggregation); no rows give two coverage rows of 0.
    """
    def counted(name, key, n=F.lit(1)):
        return F.struct(F.lit(name).alias("resumo"), key.alias("chave"), n.cast("bigint").alias("n"))

    def value(c):
        return counted(c, F.coalesce(F.col(c).cast("string"), F.lit("")))

    triples = F.array(value("situacao_norm"), value("llm_decisao"), value("llm_categoria"), value("espectro"),
                      counted("cobertura", F.lit("com_score"), F.col("score_lr").isNotNull()),
                      counted("avaliacao", F.lit("com_nota"), F.col("llm_nota").isNotNull()))
    none = scored.sparkSession.sql("SELECT * FROM VALUES ('cobertura', 'com_score', 0L), ('avaliacao', 'com_nota', 0L) "
                                   "AS t(resumo, chave, n)")
    return (scored.select(F.inline(triples)).unionByName(none)
            .groupBy("resumo", "chave").agg(F.sum("n").alias("n")))
