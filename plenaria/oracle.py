"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code as plain SQL over the same bridge
views (inlined as CTEs), so a mismatch points at a semantic difference.
Notes on portability: DuckDB's RE2 has no ``\\w`` beyond ASCII, so letters are
spelled ``[\\p{L}\\p{N}_]``; sums are cast back to BIGINT (DuckDB widens them).
"""

from __future__ import annotations

from plenaria import vocab
from plenaria.functions.text import WHITESPACE
from plenaria.catalog import CAPTURE_DOC_TYPES, DOCUMENT_TERMS, FACETS, FACETS_PEOPLE, FAMILY_YEARS
from plenaria.operators.term_match import alternation
from plenaria.plans.dashboard import VIEWS as DASHBOARD_VIEWS
from plenaria.plans.prompt_text import PROMPT_PARTS, PROMPT_SLOTS
from plenaria.sources.bridge import PROCESS_ID_BASE, duckdb_sql


# ---------------------------------------------------------------- SQL helpers
def q(s) -> str:
    if s is None:
        return "NULL"
    if isinstance(s, (int, float)):
        return str(s)
    return "'" + str(s).replace("'", "''") + "'"


def lst(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case_map(x: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {x} {whens} ELSE {default} END)"


def strip(x: str) -> str:
    return f"trim({x}, {q(WHITESPACE)})"


def any_contains(x: str, needles) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(n)})" for n in needles) + ")"


def type_code(x):
    return case_map(x, vocab.TYPE_NORMALISATION, x)


def type_label(x):
    return case_map(x, vocab.TYPE_LABEL, x)


def type_group(x):
    return case_map(x, vocab.TYPE_GROUP)


def house(x):
    return case_map(x, vocab.HOUSE_LABEL, x)


def region(x):
    return f"coalesce({case_map(x, vocab.STATE_REGION)}, {q(vocab.REGION_UNKNOWN)})"


def legislature(y):
    parts = [f"WHEN {y} IS NULL THEN NULL"]
    for last, label in vocab.LEGISLATURES:
        parts.append(f"WHEN {y} <= {last} THEN {q(label)}" if last is not None else f"ELSE {q(label)}")
    return "(CASE " + " ".join(parts) + " END)"


def legislature_order(x):
    return case_map(x, {lab: i for i, (_, lab) in enumerate(vocab.LEGISLATURES)})


def band(s):
    parts = [f"WHEN {s} IS NULL THEN {q(vocab.IDEOLOGY_UNKNOWN)}"]
    parts += [f"WHEN {s} <= {hi} THEN {q(lab)}" for hi, lab in vocab.IDEOLOGY_BANDS]
    return "(CASE " + " ".join(parts) + f" ELSE {q(vocab.IDEOLOGY_TOP_BAND)} END)"


def status(s):
    u = strip(f"upper({s})")
    parts = [f"WHEN {s} IS NULL OR {u} IN ('', 'NAN') THEN {q(vocab.STATUS_MISSING)}"]
    parts += [f"WHEN {any_contains(u, kws)} THEN {q(label)}" for label, kws in vocab.STATUS_RULES]
    return "(CASE " + " ".join(parts) + f" ELSE {q(vocab.STATUS_OTHER)} END)"


def party(p, dashboard=False):
    v = strip(f"replace({strip(p)}, '*', '')")
    no_party = vocab.NO_PARTY_ALIASES_DASHBOARD if dashboard else vocab.NO_PARTY_ALIASES
    popular = vocab.POPULAR_ALIASES_DASHBOARD if dashboard else vocab.POPULAR_ALIASES
    return (f"(CASE WHEN {p} IS NULL THEN NULL WHEN {v} = '' OR {v} IN {lst(vocab.INSTITUTIONAL)} THEN NULL "
            f"WHEN {v} IN {lst(no_party)} THEN {q(vocab.NO_PARTY_CODE)} "
            f"WHEN {v} IN {lst(popular)} THEN {q(vocab.POPULAR_CODE)} "
            f"WHEN {v} IN ('PODE', 'PODEMOS') THEN 'PODEMOS' WHEN {v} IN ('MDB', 'PMDB') THEN 'PMDB/MDB' "
            f"WHEN contains({v}, 'MISTA') OR contains({v}, 'CPI') THEN NULL "
            f"WHEN length({v}) > {vocab.MAX_PARTY_LEN} THEN NULL ELSE {v} END)")


def tokens(x):
    return f"list_transform(string_split({x}, ';'), lambda t: {strip('t')})"


def eligible(t):
    return f"({t} <> '' AND {t} NOT IN {lst(vocab.INSTITUTIONAL)} AND length({t}) <= {vocab.MAX_PARTY_LEN})"


def no_author(x):
    return f"({x} IS NULL OR {x} IN ('—', ''))"


def party_of_author(x):
    first = f"list_filter({tokens(x)}, lambda t: {eligible('t')})[1]"
    return f"(CASE WHEN {no_author(x)} THEN NULL ELSE {party(first)} END)"


def is_member(x):
    return f"(CASE WHEN {no_author(x)} THEN false ELSE len(list_filter({tokens(x)}, lambda t: {eligible('t')})) > 0 END)"


def author_group(x):
    cls = (f"CASE WHEN t IN ('', '—') THEN {q(vocab.IDEOLOGY_UNKNOWN)} "
           f"WHEN t IN {lst(vocab.INSTITUTIONAL)} THEN t WHEN length(t) <= {vocab.MAX_PARTY_LEN} THEN 'Políticos' END")
    first = f"list_filter(list_transform({tokens(x)}, lambda t: {cls}), lambda c: c IS NOT NULL)[1]"
    return f"(CASE WHEN {no_author(x)} THEN {q(vocab.IDEOLOGY_UNKNOWN)} ELSE coalesce({first}, {q(vocab.IDEOLOGY_UNKNOWN)}) END)"


def _cap(w):
    return f"(upper(substring({w}, 1, 1)) || lower(substring({w}, 2)))"


def words(x):
    return rf"list_filter(string_split_regex({strip(x)}, '\s+'), lambda w: w <> '')"


def person(x, parens=True):
    s = f"upper({strip(x)})"
    if parens:
        s = rf"regexp_replace({s}, '\([^)]*\)', '', 'g')"
    up = [p.upper() for p in vocab.LOWER_PARTICLES]
    body = f"array_to_string(list_transform({words(s)}, lambda w: CASE WHEN w IN {lst(up)} THEN lower(w) ELSE {_cap('w')} END), ' ')"
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE {body} END)"


def title(x):
    body = (f"array_to_string(list_transform({words(x)}, lambda w, i: CASE WHEN i = 1 OR lower(w) NOT IN "
            f"{lst(vocab.LOWER_PARTICLES)} THEN {_cap('w')} ELSE lower(w) END), ' ')")
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE {body} END)"


def round_exact(x, digits=2):
    """Python round(x, digits) on doubles (exact binary value), via an error-free product."""
    sc = f"CAST({10 ** digits} AS DOUBLE)"
    p = f"(({x}) * {sc})"
    t = f"(({x}) * CAST({2 ** 27 + 1} AS DOUBLE))"
    hi = f"({t} - ({t} - ({x})))"
    err = f"(({hi} * {sc} - {p}) + (({x}) - {hi}) * {sc})"
    half = f"({p} - floor({p}) = 0.5)"
    return (f"(CASE WHEN {half} AND {err} > 0 THEN ceil({p}) WHEN {half} AND {err} < 0 THEN floor({p}) "
            f"ELSE round_even({p}, 0) END / {sc})")


def first_tok(x):
    return strip(f"string_split({x}, ';')[1]")


def pat(terms) -> str:
    return "(?i)" + alternation(terms)


def views(*names) -> list[str]:
    return [f"{n} AS ({duckdb_sql(n)})" for n in names]


def sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------- shared CTEs
EXCL = "(?i)" + vocab.SUMMARY_EXCLUSION_PATTERN
CONTRACT = ["origem", "tipo", "numero", "ano", "data_apre", "parlamentar", "tipo_autor", "uf",
            "ementa", "termo_busca", "tramitando", "id_interno", "id_processo", "uri"]


def consolidated_ctes() -> list[str]:
    number = r"coalesce(nullif(regexp_extract(numero, '(\d+)/\d{4}$', 1), ''), numero)"
    rest = [c for c in CONTRACT if c not in ("origem", "ano", "tipo", "id_interno")]
    order = ", ".join(["origem", "ano", "tipo"] + [f"{c} NULLS LAST" for c in rest])
    return views("proposals") + [
        f"cons_a AS (SELECT origem, {type_code('tipo')} AS tipo, numero, ano, data_apre, parlamentar, tipo_autor, uf, "
        f"ementa, termo_busca, tramitando, id_interno, id_processo, uri FROM proposals "
        f"WHERE assunto_especifico IS NULL OR assunto_especifico NOT IN {lst(vocab.EXCLUDED_SUBJECTS)})",
        f"cons_b AS (SELECT * FROM cons_a WHERE NOT coalesce(regexp_matches(ementa, {q(EXCL)}), false))",
        f"cons_c AS (SELECT origem, tipo, {number} AS numero, ano, strftime(TRY_CAST(data_apre AS DATE), '%Y-%m-%d') AS data_apre, "
        f"parlamentar, tipo_autor, coalesce(uf, '—') AS uf, ementa, termo_busca, coalesce(tramitando, '—') AS tramitando, "
        f"id_interno, coalesce(id_processo, '—') AS id_processo, uri FROM cons_b)",
        f"cons AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_interno ORDER BY {order}) AS rn "
        f"FROM cons_c) WHERE rn = 1)",
    ]


def parsed_cte(name="parsed") -> str:
    obj = "CASE WHEN json_valid(raw) THEN json_type(raw) = 'OBJECT' ELSE false END"
    val = ("CASE WHEN list_contains(json_keys(raw), 'nota') THEN TRY_CAST(json_extract_string(raw, '$.nota') AS DOUBLE) "
           "ELSE CAST(0 AS DOUBLE) END")
    nota = ("CASE WHEN v IS NULL OR isnan(v) OR isinf(v) THEN NULL ELSE "
            "least(CAST(10 AS DOUBLE), greatest(CAST(0 AS DOUBLE), round_even(v * 4, 0) / 4)) END")
    return (f"{name} AS (SELECT seq, attempt, nota AS llm_nota, "
            f"CASE WHEN nota IS NULL THEN '' ELSE coalesce(json_extract_string(raw, '$.categoria'), '') END AS llm_categoria, "
            f"CASE WHEN nota IS NULL THEN '' WHEN nota >= {vocab.SCORE_CUTOFF} THEN 'incluir' ELSE 'excluir' END AS llm_decisao, "
            f"CASE WHEN nota IS NULL THEN '' ELSE coalesce(json_extract_string(raw, '$.justificativa'), '') END AS llm_justificativa "
            f"FROM (SELECT *, {nota} AS nota FROM (SELECT seq, attempt, raw, CASE WHEN ({obj}) THEN ({val}) END AS v FROM attempts)))")


def first_success_cte(name, src, where="attempt <= 3") -> str:
    return (f"{name} AS (SELECT seq, llm_nota, llm_categoria, llm_decisao, llm_justificativa FROM "
            f"(SELECT *, row_number() OVER (PARTITION BY seq ORDER BY (llm_nota IS NULL), attempt, llm_categoria, "
            f"llm_decisao, llm_justificativa) AS rn FROM {src} WHERE {where}) WHERE rn = 1)")


def survey_ctes() -> list[str]:
    present = ["lrpt", "lrpsdb", "lrpmdb", "lrmdb", "lrpfl", "lrdem", "lrpp_ppb", "lrpp", "lrpsl",
               "lrnovo", "lrpds", "lrpdt", "lrpl"]
    avgs = ", ".join(f"avg(nullif(CAST({c} AS DOUBLE), -999)) AS {c}" for c in present)
    mp = ", ".join(f"({q(c)}, {q(vocab.SURVEY_PARTY_COLUMNS[c])})" for c in present)
    return views("survey") + [
        f"sv_w AS (SELECT wave, {avgs} FROM survey WHERE wave IS NOT NULL GROUP BY wave)",
        f"sv_l AS (UNPIVOT sv_w ON {', '.join(present)} INTO NAME col VALUE v)",
        f"sv_m AS (SELECT * FROM (VALUES {mp}) t(col, partido))",
        "svs AS (SELECT wave, partido, round_even(avg(v) * 100, 0) / 100 AS score_lr FROM sv_l JOIN sv_m USING (col) "
        "WHERE v IS NOT NULL GROUP BY wave, partido)",
    ]


def proxies_cte() -> str:
    rows = []
    for k, v in vocab.PARTY_PROXIES.items():
        arr = "CAST(NULL AS VARCHAR[])" if v is None else "[" + ", ".join(q(x) for x in v) + "]"
        rows.append(f"({q(k)}, {arr})")
    return f"prox AS (SELECT * FROM (VALUES {', '.join(rows)}) t(partido, proxies))"


def asof_ctes(src: str) -> list[str]:
    """Nearest-wave scores for the distinct (partido_bls, ano_int) of ``src`` -> CTE ``sc``."""
    return [
        proxies_cte(),
        "waves AS (SELECT DISTINCT wave FROM svs)",
        f"req AS (SELECT DISTINCT partido_bls, ano_int FROM {src} WHERE partido_bls IS NOT NULL AND ano_int IS NOT NULL)",
        "gq AS (SELECT r.partido_bls, r.ano_int, min(abs(w.wave - r.ano_int)) AS g FROM req r CROSS JOIN waves w GROUP BY ALL)",
        "ex AS (SELECT gq.partido_bls, gq.ano_int, gq.g, unnest(CASE WHEN p.partido IS NULL THEN [gq.partido_bls] "
        "ELSE p.proxies END) AS proxy FROM gq LEFT JOIN prox p ON p.partido = gq.partido_bls "
        "WHERE p.partido IS NULL OR p.proxies IS NOT NULL)",
        "cand AS (SELECT ex.*, s.wave, s.score_lr, abs(s.wave - ex.ano_int) AS dist FROM ex JOIN svs s ON s.partido = ex.proxy)",
        "fl AS (SELECT *, max(CASE WHEN dist = g THEN 1 ELSE 0 END) OVER (PARTITION BY partido_bls, ano_int, proxy) AS has_near, "
        "row_number() OVER (PARTITION BY partido_bls, ano_int, proxy ORDER BY dist, wave) AS rn FROM cand)",
        f"sc AS (SELECT partido_bls, ano_int, {round_exact('avg(score_lr)')} AS score_lr FROM fl "
        "WHERE (has_near = 1 AND dist = g) OR (has_near = 0 AND rn = 1) GROUP BY ALL)",
    ]


def scored_ctes() -> list[str]:
    """CTE ``scored0`` with its ideology -> CTEs ``scored`` and ``mart``."""
    return asof_ctes("scored0") + [
        f"scored AS (SELECT scored0.*, sc.score_lr, {band('sc.score_lr')} AS espectro FROM scored0 "
        f"LEFT JOIN sc USING (partido_bls, ano_int))",
        f"mart AS (SELECT *, {house('origem')} AS origem_extenso, {type_label('tipo')} AS tipo_extenso, "
        f"{legislature('ano_int')} AS legislatura, {region('uf')} AS regiao, {is_member('tipo_autor')} AS e_parlamentar "
        f"FROM scored WHERE llm_decisao = 'incluir')",
    ]


def mart_ctes() -> list[str]:
    return views("proposals", "attempts") + [parsed_cte(), first_success_cte("scores", "parsed")] + survey_ctes() \
        + [
            f"scored0 AS (SELECT p.origem, {type_code('p.tipo')} AS tipo, p.numero, p.ano, p.data_apre, p.parlamentar, "
            f"p.tipo_autor, coalesce(p.uf, '—') AS uf, p.ementa, p.termo_busca, coalesce(p.tramitando, '—') AS tramitando, "
            f"p.id_interno, coalesce(p.id_processo, '—') AS id_processo, p.uri, p.assunto_especifico, p.situacao, p.seq, "
            f"p.nota_bruta, s.llm_nota, s.llm_categoria, s.llm_decisao, s.llm_justificativa, "
            f"{status('p.situacao')} AS situacao_norm, {party_of_author('p.tipo_autor')} AS partido_bls, "
            f"TRY_CAST(p.ano AS INTEGER) AS ano_int FROM proposals p LEFT JOIN scores s USING (seq))",
        ] + scored_ctes()


def senate_status_ctes(source: str, key: str) -> list[str]:
    """Senate status responses of ``source`` (key, raw) -> CTE ``senate_status``; objects or arrays at every level."""
    def records(j: str, path: str) -> str:
        return (f"CASE json_type({j}, '{path}') WHEN 'ARRAY' THEN json_extract({j}, '{path}[*]') "
                f"WHEN 'OBJECT' THEN [json_extract({j}, '{path}')] ELSE CAST([] AS JSON[]) END")

    def last(field: str) -> str:
        return (f"coalesce(list_filter(list_transform(sits, lambda y: json_extract_string(y, '$.{field}')), "
                "lambda z: z IS NOT NULL)[-1], '')")

    return [
        f"s0 AS (SELECT {key}, CASE WHEN json_valid(raw) THEN raw END AS j FROM {source})",
        f"s1 AS (SELECT {key}, ({records('j', '$.SituacaoAtualMateria.Materias.Materia')})[1] AS m FROM s0)",
        f"s2 AS (SELECT {key}, {records('m', '$.SituacaoAtual.Autuacoes.Autuacao')} AS auts FROM s1)",
        f"s3 AS (SELECT {key}, flatten(list_transform(auts, lambda x: {records('x', '$.Situacoes.Situacao')})) AS sits FROM s2)",
        f"senate_status AS (SELECT {key}, {last('DescricaoSituacao')} AS situacao, {last('DataSituacao')} AS data_situacao FROM s3)",
    ]


def status_ctes() -> list[str]:
    """Stages 1 and 2 -> CTE ``st``."""
    eligible_status = ("(cons.origem = 'CD' OR (cons.origem IN ('SF', 'CN') AND cons.id_processo IS NOT NULL "
                       "AND cons.id_processo NOT IN ('', '—')))")
    return consolidated_ctes() + [
        "ssrc AS (SELECT id_interno, situacao FROM (SELECT id_interno, situacao, row_number() OVER (PARTITION BY id_interno "
        "ORDER BY seq, situacao NULLS LAST) AS rn FROM proposals) WHERE rn = 1)",
        f"st AS (SELECT cons.*, CASE WHEN {eligible_status} THEN coalesce(s.situacao, '') ELSE '' END AS situacao "
        f"FROM cons LEFT JOIN ssrc s USING (id_interno))",
    ]


def final_ctes() -> list[str]:
    """The whole chain -> CTE ``mart``."""
    fields = "llm_nota, llm_categoria, llm_decisao, llm_justificativa"
    return status_ctes() + views("attempts") + [
        parsed_cte(),
        f"by_id AS (SELECT id_interno, {fields} FROM (SELECT p.id_interno, q.*, row_number() OVER (PARTITION BY p.id_interno "
        f"ORDER BY (llm_nota IS NULL), attempt, {fields}) AS rn FROM parsed q JOIN proposals p ON p.seq = q.seq "
        f"WHERE attempt <= {vocab.MAX_ATTEMPTS}) WHERE rn = 1)",
    ] + survey_ctes() + [
        f"scored0 AS (SELECT st.*, {status('st.situacao')} AS situacao_norm, {fields}, "
        f"{party_of_author('st.tipo_autor')} AS partido_bls, TRY_CAST(st.ano AS INTEGER) AS ano_int "
        f"FROM st LEFT JOIN by_id USING (id_interno))",
    ] + scored_ctes()


SENATOR = r"'^Senador[a]?\s+(.+?)\s+\(([\p{L}\p{N}_]+)/([\p{L}\p{N}_]+)\)$'"


def senate_author_columns(a: str, doc: str) -> str:
    """parlamentar, tipo_autor, uf of a Senate author text."""
    st, lo = strip(a), f"lower({a})"
    m = f"regexp_matches({st}, {SENATOR})"
    return (f"CASE WHEN {doc} = 'Sugestão' THEN {a} WHEN {m} THEN regexp_extract({st}, {SENATOR}, 1) ELSE {a} END AS parlamentar, "
            f"CASE WHEN {doc} = 'Sugestão' THEN 'Popular; Comissão' WHEN {m} THEN regexp_extract({st}, {SENATOR}, 2) "
            f"WHEN {any_contains(lo, vocab.EXECUTIVE_KEYWORDS)} THEN 'Executivo' "
            f"WHEN {any_contains(lo, vocab.COMMITTEE_KEYWORDS)} THEN 'Comissão' "
            f"WHEN {any_contains(a, vocab.COURT_ACRONYMS)} THEN 'Judiciário' "
            f"WHEN {any_contains(lo, vocab.PROSECUTION_KEYWORDS)} THEN 'MPU' "
            f"WHEN {any_contains(lo, vocab.LEGISLATURE_KEYWORDS)} THEN 'Legislativo' ELSE 'Comissão' END AS tipo_autor, "
            f"CASE WHEN {doc} IS DISTINCT FROM 'Sugestão' AND {m} THEN regexp_extract({st}, {SENATOR}, 3) ELSE '' END AS uf")


def on_mart(body: str) -> str:
    return sql(mart_ctes(), body)


def facet_where(spec) -> str:
    preds = []
    if spec.origem:
        preds.append(f"origem_extenso IN {lst(spec.origem)}")
    if spec.grupo:
        preds.append(f"coalesce({type_group('tipo')} IN {lst(spec.grupo)}, false)")
    if spec.tipo:
        preds.append(f"tipo_extenso IN {lst(spec.tipo)}")
    if spec.legislatura:
        preds.append(f"legislatura IN {lst(spec.legislatura)}")
    if spec.regiao:
        preds.append(f"regiao IN {lst(spec.regiao)}")
    if spec.uf:
        preds.append(f"coalesce(len(list_filter({tokens('uf')}, lambda u: u IN {lst(spec.uf)})) > 0, false)")
    if spec.termo:
        preds.append(f"termo_busca IN {lst(spec.termo)}")
    if spec.autor:
        preds.append(f"{author_group('tipo_autor')} IN {lst(spec.autor)}")
    if spec.espectro:
        preds.append(f"espectro IN {lst(spec.espectro)}")
    if spec.partido:
        preds.append(f"coalesce(len(list_filter(string_split(tipo_autor, ';'), lambda x: {party('x', True)} IN "
                     f"{lst(spec.partido)})) > 0, false)")
    if spec.politico:
        preds.append(f"coalesce(len(list_filter(string_split_regex(parlamentar, '[;,]'), lambda x: {person('x')} IN "
                     f"{lst(spec.politico)})) > 0, false)")
    if spec.ano:
        preds.append(f"ano_int BETWEEN {spec.ano[0]} AND {spec.ano[1]}")
    return " AND ".join(preds) if preds else "true"


def _bigint_sum(x):
    return f"CAST(sum({x}) AS BIGINT)"


# ---------------------------------------------------------------- queries
def build() -> dict[str, str]:
    o: dict[str, str] = {}
    terms_arr = "[" + ", ".join(q(t) for t in vocab.SEARCH_TERMS) + "]"
    types_arr = "[" + ", ".join(q(t) for t in vocab.CHAMBER_TYPES) + "]"
    o["worklist_crossjoin"] = sql(views("proposals") + [
        f"w AS (SELECT t.termo, tp.tipo, y.ano FROM (SELECT unnest({terms_arr}) AS termo) t, "
        f"(SELECT unnest({types_arr}) AS tipo) tp, "
        f"(SELECT CAST(range AS INTEGER) AS ano FROM range({vocab.YEAR_START}, {vocab.YEAR_END + 1})) y)",
        "done AS (SELECT DISTINCT termo_busca AS termo, tipo, TRY_CAST(ano AS INTEGER) AS ano FROM proposals WHERE origem = 'CD')",
    ], "SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.termo = w.termo AND d.tipo = w.tipo AND d.ano = w.ano)")

    dp = q(pat(DOCUMENT_TERMS))
    o["term_match_first"] = (f"SELECT doc_id, termo FROM (SELECT doc_id, lower(regexp_extract(text, {dp}, 0)) AS termo "
                             f"FROM documents) WHERE termo <> ''")
    o["term_match_all"] = (f"SELECT doc_id, lower(m) AS termo, count(*) AS n FROM (SELECT doc_id, "
                           f"unnest(regexp_extract_all(text, {dp}, 0)) AS m FROM documents) GROUP BY ALL")
    # words and runs of words with DuckDB's lists; matches that overlap an earlier one go in a fold over a text's matches
    words = "list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x))"
    index = (f"WITH d AS (SELECT doc_id, {words} AS w FROM documents), b AS (SELECT {words} AS w FROM benchmark), "
             "s AS (SELECT w, unnest([2, 3]) AS n FROM b), p AS (SELECT w, n, unnest(range(len(w) - n + 1)) AS i FROM s), "
             "t AS (SELECT DISTINCT n, list_slice(w, i + 1, i + n) AS g FROM p), "
             "ds AS (SELECT doc_id, w, unnest([2, 3]) AS n FROM d), dp AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM ds), "
             "h AS (SELECT doc_id, i, n, g FROM (SELECT doc_id, n, i, list_slice(w, i + 1, i + n) AS g FROM dp) JOIN t USING (n, g)), "
             "m AS (SELECT doc_id, i, max(n) AS n, arg_max(array_to_string(g, ' '), n) AS run FROM h GROUP BY doc_id, i) ")
    o["term_index_first"] = index + "SELECT doc_id, arg_min(run, i) AS termo FROM m GROUP BY doc_id"
    o["term_index_all"] = (index + ", f AS (SELECT doc_id, list_reduce(list({'free': i, 'kept': [run, CAST(n AS VARCHAR)]} ORDER BY i), "
                           "lambda a, x: CASE WHEN x.free >= a.free THEN {'free': x.free + CAST(x.kept[2] AS BIGINT), "
                           "'kept': list_append(a.kept, x.kept[1])} ELSE a END, {'free': CAST(0 AS BIGINT), 'kept': CAST([] AS VARCHAR[])}) "
                           "AS r FROM m GROUP BY doc_id) SELECT doc_id, termo, count(*) AS n FROM (SELECT doc_id, unnest(r.kept) AS termo "
                           "FROM f) GROUP BY ALL")
    o["two_route_capture"] = sql(views("captura", "captura_detalhe") + [
        f"c AS (SELECT *, nullif(lower(regexp_extract(ementa, {dp}, 0)), '') AS t1 FROM captura "
        f"WHERE tipo_doc IN {lst(CAPTURE_DOC_TYPES)} AND cod IS NOT NULL)",
        f"j AS (SELECT c.cod, c.tipo_doc, c.tipo_conteudo, c.t1, d.indexacao FROM c LEFT JOIN captura_detalhe d ON c.cod = d.cod "
        f"WHERE c.t1 IS NOT NULL OR c.tipo_conteudo IN {lst(vocab.SENATE_CONTENT_TYPES)})",
        f"r AS (SELECT cod, tipo_doc, tipo_conteudo, coalesce(t1, nullif(lower(regexp_extract(indexacao, {dp}, 0)), '')) "
        f"AS termo_busca, CASE WHEN t1 IS NOT NULL THEN 1 ELSE 2 END AS rota FROM j)",
    ], "SELECT cod, tipo_doc, tipo_conteudo, termo_busca, rota FROM (SELECT *, row_number() OVER (PARTITION BY cod "
       "ORDER BY rota, tipo_conteudo NULLS LAST, tipo_doc, termo_busca) AS rn FROM r WHERE termo_busca IS NOT NULL) WHERE rn = 1")

    li_rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus", "l_shipdate"]
    o["dedup_first"] = (
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' NULLS LAST' for c in li_rest)}) AS rn "
        "FROM lineitem) WHERE rn = 1")
    o["exclude_subject"] = sql(views("proposals"), "SELECT seq, assunto_especifico FROM proposals WHERE "
                               f"assunto_especifico IS NULL OR assunto_especifico NOT IN {lst(vocab.EXCLUDED_SUBJECTS)}")
    o["exclude_regex"] = sql(views("proposals"), "SELECT seq, ementa FROM proposals WHERE NOT "
                             f"coalesce(regexp_matches(ementa, {q(EXCL)}), false)")
    o["exclude_regex_documents"] = (f"SELECT doc_id, lang FROM documents WHERE NOT coalesce(regexp_matches(text, {dp}), false)")

    o["consolidate"] = sql(consolidated_ctes(), "SELECT * FROM cons")
    o["crosstab_margins"] = sql(consolidated_ctes(), (
        "SELECT CASE WHEN grouping(tipo) = 1 THEN 'Total' ELSE tipo END AS tipo, "
        "CASE WHEN grouping(origem) = 1 THEN 'Total' ELSE origem END AS origem, count(*) AS n "
        "FROM cons WHERE tipo IS NOT NULL AND origem IS NOT NULL GROUP BY CUBE (tipo, origem)"))
    o["status_enrich"] = sql(status_ctes(), f"SELECT *, {status('situacao')} AS situacao_norm FROM st")
    o["pipeline_final"] = sql(final_ctes(), (
        "SELECT id_interno, origem, origem_extenso, tipo, tipo_extenso, numero, ano_int, data_apre, uf, regiao, legislatura, "
        "e_parlamentar, situacao_norm, llm_nota, llm_categoria, partido_bls, score_lr, espectro FROM mart"))

    o["status_json"] = sql(views("status_raw") + senate_status_ctes("status_raw", "seq"), "SELECT * FROM senate_status")
    table = views("status_respostas") + ["sf AS (SELECT chave, raw FROM status_respostas WHERE casa <> 'CD')"] + senate_status_ctes(
        "sf", "chave") + [
        "cd AS (SELECT chave, CASE WHEN json_valid(raw) THEN raw END AS j FROM status_respostas WHERE casa = 'CD')",
        "stab AS (SELECT concat('SF-', chave) AS id_interno, situacao, data_situacao AS norma_data_pub, '' AS norma_url "
        "FROM senate_status UNION ALL SELECT chave, coalesce(json_extract_string(j, '$.dados.statusProposicao.descricaoSituacao'), ''), "
        "'', coalesce(json_extract_string(j, '$.dados.statusProposicao.url'), '') FROM cd)",
    ]
    o["status_table"] = sql(table, "SELECT * FROM stab")
    eligible = "(cons.origem = 'CD' OR (cons.origem IN ('SF', 'CN') AND coalesce(cons.id_processo, '') NOT IN ('', '—')))"
    o["status_enrich_raw"] = sql(table + consolidated_ctes() + [
        f"r AS (SELECT cons.id_interno, cons.origem, CASE WHEN {eligible} THEN coalesce(t.situacao, '') ELSE '' END AS situacao "
        "FROM cons LEFT JOIN stab t USING (id_interno))"], f"SELECT *, {status('situacao')} AS situacao_norm FROM r")
    o["chamber_json"] = sql(views("pagina_raw") + [
        "e AS (SELECT pagina, unnest(json_extract(raw, '$.dados[*]')) AS x FROM pagina_raw WHERE json_valid(raw))",
    ], "SELECT pagina, 'CD' AS origem, json_extract_string(x, '$.siglaTipo') AS tipo, "
       "coalesce(json_extract_string(x, '$.numero'), '') AS numero, json_extract_string(x, '$.ano') AS ano, "
       "coalesce(json_extract_string(x, '$.dataApresentacao'), '') AS data_apre, "
       "coalesce(json_extract_string(x, '$.ementa'), '') AS ementa, "
       "CAST(CAST(json_extract_string(x, '$.id') AS BIGINT) AS VARCHAR) AS id_interno, '' AS id_processo, "
       "coalesce(json_extract_string(x, '$.uri'), '') AS uri, '' AS tramitando, '' AS assunto_geral, "
       "'' AS assunto_especifico FROM e")
    detail_cols = (
        "seq, coalesce(CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.documento.indexacao') END, '') AS indexacao, "
        "coalesce(CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.conteudo.assuntoGeral') END, '') AS assunto_geral, "
        "coalesce(CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.conteudo.assuntoEspecifico') END, '') "
        "AS assunto_especifico")
    o["detail_json"] = sql(views("detalhe_raw"), f"SELECT {detail_cols} FROM detalhe_raw")

    rollup_ctes = views("proposals") + [
        "au AS (SELECT l.l_orderkey AS seq, l_linenumber, l_suppkey, l_partkey, l_shipdate, l_extendedprice, "
        "s.s_name AS nome, n.n_name AS uf, p.p_brand AS kind FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey "
        "JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey)",
        "ao AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY l_linenumber, l_suppkey, l_partkey, l_shipdate, "
        "l_extendedprice, nome, uf, kind) AS pos FROM au)",
        "ak AS (SELECT seq, kind, min(pos) AS first_pos FROM ao GROUP BY seq, kind)",
        "an AS (SELECT seq, string_agg(nome, '; ' ORDER BY pos) AS parlamentar, coalesce(string_agg(uf, '; ' ORDER BY pos) "
        "FILTER (WHERE uf <> ''), '') AS uf FROM ao GROUP BY seq)",
        "ank AS (SELECT seq, string_agg(kind, '; ' ORDER BY first_pos) AS tipo_autor FROM ak GROUP BY seq)",
        "roll AS (SELECT an.seq, an.parlamentar, an.uf, CASE WHEN p.tipo = 'SUG' THEN 'Popular; Comissão' "
        "ELSE ank.tipo_autor END AS tipo_autor FROM an JOIN ank USING (seq) LEFT JOIN proposals p ON p.seq = an.seq)",
    ]
    o["author_rollup"] = sql(rollup_ctes, "SELECT * FROM roll")
    o["author_enrich"] = sql(rollup_ctes, (
        "SELECT p.seq, p.origem, p.tipo, coalesce(r.parlamentar, '') AS parlamentar, coalesce(r.uf, '') AS uf, "
        "coalesce(r.tipo_autor, '') AS tipo_autor FROM proposals p LEFT JOIN roll r USING (seq)"))

    o["author_parse"] = sql(views("autoria_bruta") + [
        "b AS (SELECT seq, coalesce(autoria, '') AS a, tipo_doc FROM autoria_bruta)",
    ], f"SELECT seq, {senate_author_columns('a', 'tipo_doc')} FROM b")
    pt = q(pat(vocab.SEARCH_TERMS))
    years = (f"work AS (SELECT h AS origem, CAST(y AS VARCHAR) AS ano FROM (SELECT unnest(['CD', 'SF', 'CN']) AS h), "
             f"(SELECT unnest(range({vocab.YEAR_START}, {vocab.YEAR_END} + 1)) AS y))")
    o["units_pending"] = sql([years], "SELECT origem, ano, CASE WHEN CAST(ano AS INTEGER) % 5 = 0 THEN 'begun' END AS state FROM work "
                             "WHERE CAST(ano AS INTEGER) % 3 = 0 OR CAST(ano AS INTEGER) % 5 = 0")
    first, last = FAMILY_YEARS
    o["year_families"] = sql(views("proposals"), (
        "SELECT seq, id_interno, tipo, CASE WHEN origem <> 'CD' THEN id_processo END AS id_processo, "
        "CASE WHEN origem = 'CD' OR CAST(ano AS INTEGER) >= 2000 THEN tramitando END AS tramitando, ano, CAST(ano AS INTEGER) AS ano_coleta, "
        "CASE WHEN origem = 'CD' THEN 'camara' ELSE 'senado' END AS familia FROM proposals "
        f"WHERE CAST(ano AS INTEGER) BETWEEN {first} AND {last}"))
    position = case_map("termo_busca", {t: i for i, t in enumerate(vocab.SEARCH_TERMS)}, str(len(vocab.SEARCH_TERMS)))
    o["merge_batches"] = sql(views("paginas_por_termo") + [
        "x AS (SELECT termo_busca, unnest(json_extract(raw, '$.dados[*]')) AS x FROM paginas_por_termo WHERE json_valid(raw))",
        "r AS (SELECT json_extract_string(x, '$.id') AS id_interno, termo_busca, json_extract_string(x, '$.siglaTipo') AS tipo, "
        "coalesce(json_extract_string(x, '$.numero'), '') AS numero, json_extract_string(x, '$.ano') AS ano, "
        "coalesce(json_extract_string(x, '$.ementa'), '') AS ementa FROM x)",
    ], (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_interno ORDER BY {position}, termo_busca, "
        "tipo NULLS LAST, numero, ano NULLS LAST, ementa) AS rn FROM r) WHERE rn = 1"))
    j = "CASE WHEN json_valid(raw) THEN raw END"

    def page(path):
        return f"coalesce(json_extract_string({j}, '$.{path}'), '')"

    materia = "DetalheMateria.Materia"
    indexing = (f"CASE WHEN {page(materia + '.IndexacaoMateria')} <> '' THEN {page(materia + '.IndexacaoMateria')} "
                f"ELSE {page(materia + '.EmentaMateria')} END")
    contexts = views("contexto_respostas") + [
        f"ctx AS (SELECT uri, origem = 'CD' AS casa_cd, CASE WHEN origem = 'CD' THEN {page('dados.keywords')} END AS keywords, "
        f"CASE WHEN origem = 'CD' THEN {page('dados.ementaDetalhada')} END AS ementa_detalhada, "
        f"CASE WHEN origem <> 'CD' THEN {indexing} END AS indexacao FROM contexto_respostas)"]
    o["context_table"] = sql(contexts, "SELECT * FROM ctx")

    def line(label, c):
        return f"CASE WHEN coalesce({c}, '') <> '' THEN {q(label)} || {c} END"

    o["context_texts"] = sql(contexts + consolidated_ctes(), (
        "SELECT id_interno, concat_ws(chr(10), 'Casa:      ' || coalesce(origem, ''), 'Proposta:  ' || coalesce(tipo, '') || ' ' || "
        "coalesce(numero, '') || '/' || coalesce(ano, ''), 'Ementa:    ' || coalesce(ementa, ''), "
        f"{line('Indexação: ', 'keywords')}, {line('Ementa detalhada: ', 'ementa_detalhada')}, {line('Indexação: ', 'indexacao')}) "
        "AS contexto FROM cons LEFT JOIN ctx ON cons.uri = ctx.uri AND (cons.origem = 'CD') = ctx.casa_cd"))
    o["consolidate_ordered"] = sql(consolidated_ctes(), (
        "SELECT id_interno, origem, ano, tipo, row_number() OVER (ORDER BY origem NULLS FIRST, ano NULLS FIRST, "
        "tipo NULLS FIRST, id_interno) AS ordem FROM cons"))
    o["units_read"] = sql(views("proposals") + [years], "SELECT seq, id_interno, tipo, p.origem, p.ano FROM proposals p "
                          "SEMI JOIN work USING (origem, ano) WHERE CAST(ano AS INTEGER) % 3 <> 0 AND CAST(ano AS INTEGER) % 5 <> 0")
    o["collect_senate"] = sql(views("processos_raw", "detalhe_raw") + [
        "pe AS (SELECT unnest(CASE json_type(raw) WHEN 'ARRAY' THEN json_extract(raw, '$[*]') "
        "WHEN 'OBJECT' THEN [CAST(raw AS JSON)] END) AS x FROM processos_raw WHERE json_valid(raw))",
        "pr AS (SELECT json_extract_string(x, '$.codigoMateria') AS cod, json_extract_string(x, '$.id') AS id_processo, "
        "json_extract_string(x, '$.tipoDocumento') AS tipo, json_extract_string(x, '$.tipoConteudo') AS conteudo, "
        "coalesce(json_extract_string(x, '$.casaIdentificadora'), 'SF') AS origem, json_extract_string(x, '$.identificacao') AS numero, "
        "substring(json_extract_string(x, '$.dataApresentacao'), 1, 4) AS ano, json_extract_string(x, '$.dataApresentacao') AS data_apre, "
        f"{strip("json_extract_string(x, '$.ementa')")} AS ementa, "
        "json_extract_string(x, '$.autoria') AS autoria FROM pe)",
        f"pd AS (SELECT CAST(seq + {PROCESS_ID_BASE} AS VARCHAR) AS id_processo, indexacao, assunto_especifico FROM "
        f"(SELECT {detail_cols} FROM detalhe_raw))",
        f"t AS (SELECT pr.*, coalesce(pd.indexacao, '') AS indexacao, pd.assunto_especifico, "
        f"nullif(lower(regexp_extract(ementa, {pt}, 0)), '') AS t1 FROM pr LEFT JOIN pd USING (id_processo) "
        f"WHERE tipo IN {lst(vocab.SENATE_TYPES)} AND cod IS NOT NULL)",
        f"u AS (SELECT *, coalesce(t1, CASE WHEN conteudo IN {lst(vocab.SENATE_CONTENT_TYPES)} "
        f"THEN nullif(lower(regexp_extract(indexacao, {pt}, 0)), '') END) AS termo_busca, CASE WHEN t1 IS NULL THEN 2 ELSE 1 END AS rota FROM t)",
        "w AS (SELECT *, row_number() OVER (PARTITION BY cod ORDER BY rota, ementa) AS rn FROM u WHERE termo_busca IS NOT NULL)",
    ], f"SELECT 'SF-' || cod AS id_interno, id_processo, origem, tipo, numero, ano, data_apre, ementa, "
       f"{senate_author_columns('autoria', 'tipo')}, assunto_especifico, termo_busca, rota, '' AS tramitando, "
       "'http://legis.senado.leg.br/dadosabertos/materia/' || cod AS uri FROM w WHERE rn = 1")

    o["party_extract"] = sql(views("proposals"), f"SELECT tipo_autor, {party_of_author('tipo_autor')} AS partido_bls, "
                             "count(*) AS n FROM proposals GROUP BY ALL")
    o["author_category"] = sql(views("proposals"), f"SELECT {author_group('tipo_autor')} AS categoria, count(*) AS n "
                               "FROM proposals GROUP BY ALL")
    o["is_parliamentarian"] = sql(views("proposals"), f"SELECT {is_member('tipo_autor')} AS e_parlamentar, count(*) AS n, "
                                  "count(DISTINCT parlamentar) AS n_autores FROM proposals GROUP BY ALL")
    o["survey_scores"] = sql(survey_ctes(), "SELECT * FROM svs")
    o["ideology_asof"] = sql(views("proposals") + survey_ctes() + [
        f"rw AS (SELECT seq, tipo_autor, ano, {party_of_author('tipo_autor')} AS partido_bls, "
        f"TRY_CAST(ano AS INTEGER) AS ano_int FROM proposals)",
    ] + asof_ctes("rw"), (
        f"SELECT rw.partido_bls, rw.ano, sc.score_lr, {band('sc.score_lr')} AS espectro, count(*) AS n FROM rw "
        "LEFT JOIN sc ON rw.partido_bls = sc.partido_bls AND rw.ano_int = sc.ano_int GROUP BY ALL"))

    # prompt table
    nl = "chr(10)"

    def opt(label, c):
        return f"CASE WHEN coalesce({c}, '') <> '' THEN {q(label)} || {c} END"

    ctx = (f"concat_ws({nl}, 'Casa:      ' || coalesce(origem, ''), 'Proposta:  ' || coalesce(tipo, '') || ' ' || "
           f"coalesce(numero, '') || '/' || coalesce(ano, ''), 'Ementa:    ' || coalesce(ementa, ''), "
           f"{opt('Indexação: ', 'kw')}, {opt('Ementa detalhada: ', 'ed')}, {opt('Indexação: ', 'ix')})")
    slot = {"ctx": ctx,
            "cats": q("\n".join(f"  - {c}" for c in vocab.CATEGORIES)),
            "inc": q("\n".join(f"  - {c}" for c in vocab.INCLUSION_CRITERIA)),
            "exc": q("\n".join(f"  - {c}" for c in vocab.EXCLUSION_CRITERIA)),
            "siglas_fmt": q("\n".join(f"  - {k} ({v})" for k, v in vocab.ACRONYMS.items()))}
    pieces = []
    for piece, name in zip(PROMPT_PARTS, PROMPT_SLOTS):
        pieces += [q(piece), slot[name]]
    pieces.append(q(PROMPT_PARTS[-1]))
    number = r"coalesce(nullif(regexp_extract(numero, '(\d+)/\d{4}$', 1), ''), numero)"
    o["prompt_table"] = sql(views("proposals", "detalhe_raw") + [
        f"det AS (SELECT {detail_cols} FROM detalhe_raw)",
        "ctx AS (SELECT seq, indexacao AS keywords, assunto_especifico AS ementa_detalhada, "
        "coalesce(nullif(indexacao, ''), nullif(assunto_especifico, ''), '') AS indexacao FROM det)",
        f"pp AS (SELECT p.seq, p.origem, {type_code('p.tipo')} AS tipo, {number} AS numero, p.ano, p.ementa, "
        "CASE WHEN p.origem = 'CD' THEN c.keywords END AS kw, CASE WHEN p.origem = 'CD' THEN c.ementa_detalhada END AS ed, "
        "CASE WHEN p.origem <> 'CD' THEN c.indexacao END AS ix FROM proposals p LEFT JOIN ctx c USING (seq))",
    ], f"SELECT seq, {' || '.join(pieces)} AS prompt FROM pp")

    o["score_parse"] = sql(views("attempts") + [parsed_cte()], "SELECT * FROM parsed")
    o["category_check"] = sql(views("attempts") + [parsed_cte(), first_success_cte("first3", "parsed", "attempt <= 3")],
                              "SELECT seq, llm_categoria, CASE WHEN llm_categoria <> '' THEN llm_categoria IN "
                              f"{lst([*vocab.CATEGORIES, vocab.CATEGORY_REVIEW])} END AS categoria_valida FROM first3")
    o["score_resume"] = sql(views("proposals", "attempts") + [
        parsed_cte(), first_success_cte("first1", "parsed", "attempt = 1"),
        "prev AS (SELECT p.seq, f.llm_nota, f.llm_categoria, f.llm_decisao, f.llm_justificativa FROM proposals p "
        "LEFT JOIN first1 f USING (seq))",
        first_success_cte("fresh", "parsed", "attempt <= 3 AND seq IN (SELECT seq FROM prev WHERE llm_nota IS NULL)"),
    ], ("SELECT prev.seq, " + ", ".join(
        f"CASE WHEN prev.llm_nota IS NULL AND fresh.llm_nota IS NOT NULL THEN fresh.{c} ELSE prev.{c} END AS {c}"
        for c in ["llm_nota", "llm_categoria", "llm_decisao", "llm_justificativa"])
        + ", prev.llm_nota IS NULL AS retomado FROM prev LEFT JOIN fresh USING (seq)"))

    o["facet_filter"] = on_mart(f"SELECT seq, origem, tipo, ano_int, uf, tipo_autor, espectro, legislatura FROM mart "
                                f"WHERE {facet_where(FACETS)}")
    o["facet_people"] = on_mart(f"SELECT seq, parlamentar, tipo_extenso, termo_busca FROM mart "
                                f"WHERE {facet_where(FACETS_PEOPLE)}")
    o["facet_filter_indexed"], o["facet_people_indexed"] = o["facet_filter"], o["facet_people"]
    o["mart_base"] = on_mart("SELECT origem_extenso, tipo_extenso, legislatura, regiao, e_parlamentar, count(*) AS n "
                             "FROM mart GROUP BY ALL")

    def pct(cond):
        return f"round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE {cond}) / nullif(count(*), 0), 4)"

    n_parl = "count(DISTINCT CASE WHEN e_parlamentar THEN parlamentar END)"
    kpi_cols = (
        f"count(*) AS total, round(count(*) / greatest(count(DISTINCT ano_int), 1), 4) AS media_ano, "
        f"{pct(chr(39) + 'CD' + chr(39) + ' = origem')} AS pct_cd, {pct('origem = ' + q('SF'))} AS pct_sf, "
        f"{pct('origem = ' + q('CN'))} AS pct_cn, {pct('situacao_norm = ' + q('Promulgada'))} AS pct_promulgada, "
        f"{n_parl} AS n_parlamentares, round(count(*) FILTER (WHERE e_parlamentar) / nullif({n_parl}, 0), 4) "
        f"AS por_parlamentar, {pct('tipo = ' + q('SUG') + ' OR coalesce(contains(tipo_autor, ' + q('Popular') + '), false)')} "
        f"AS pct_popular, {pct('tipo = ' + q('MPV'))} AS pct_mpv")
    o["kpis"] = on_mart(f"SELECT {kpi_cols} FROM mart")
    o["kpis_empty"] = on_mart(f"SELECT {kpi_cols} FROM mart WHERE origem = 'nenhuma'")
    o["kpis_filtered"] = on_mart(f"SELECT {kpi_cols} FROM mart WHERE {facet_where(FACETS)}")
    o["kpis_cells"], o["kpis_cells_filtered"] = o["kpis"], o["kpis_filtered"]
    o["members_by_level"] = on_mart(
        "SELECT CAST(3 - grouping(legislatura) - grouping(origem) - grouping(tipo) AS INTEGER) AS nivel, legislatura, origem, tipo, "
        f"count(*) AS n, {n_parl} AS n_parlamentares FROM mart GROUP BY ROLLUP (legislatura, origem, tipo)")
    leg_rows = ", ".join(f"({q(lab)}, {i})" for i, (_, lab) in enumerate(vocab.LEGISLATURES))
    o["by_legislature"] = on_mart(
        f"SELECT dim.legislatura, dim.ordem, coalesce(c.n, 0) AS n FROM (SELECT * FROM (VALUES {leg_rows}) t(legislatura, ordem)) dim "
        "LEFT JOIN (SELECT legislatura, count(*) AS n FROM mart GROUP BY 1) c USING (legislatura)")
    o["by_year_house"] = on_mart("SELECT ano_int, origem, count(*) AS n FROM mart WHERE ano_int IS NOT NULL AND origem IS NOT NULL GROUP BY ALL")
    o["type_mix"] = on_mart(
        "SELECT legislatura, tp, n, round(CAST(100 AS DOUBLE) * n / sum(n) OVER (PARTITION BY legislatura), 4) AS pct FROM "
        "(SELECT legislatura, CASE WHEN tipo IN (SELECT tipo FROM mart WHERE tipo IS NOT NULL AND legislatura IS NOT NULL GROUP BY tipo ORDER BY count(*) DESC, tipo LIMIT 5) "
        "THEN tipo ELSE 'Outros' END AS tp, count(*) AS n FROM mart WHERE tipo IS NOT NULL AND legislatura IS NOT NULL GROUP BY ALL)")
    o["party_author_tree"] = sql(mart_ctes() + [
        f"pc AS (SELECT {party(first_tok('tipo_autor'), True)} AS partido, parlamentar, count(*) AS n FROM mart "
        "WHERE e_parlamentar GROUP BY ALL)",
        f"pc2 AS (SELECT partido, {person('parlamentar', False)} AS parlamentar, n FROM pc "
        f"WHERE partido IS NOT NULL AND partido NOT IN {lst(vocab.INSTITUTIONAL)})",
        f"tot AS (SELECT partido, {_bigint_sum('n')} AS total FROM pc2 GROUP BY partido)",
        "topg AS (SELECT partido, total FROM tot ORDER BY total DESC, partido LIMIT 10)",
        "rk AS (SELECT *, row_number() OVER (PARTITION BY partido ORDER BY n DESC, parlamentar) AS rn FROM pc2 "
        "WHERE partido IN (SELECT partido FROM topg))",
    ], ("SELECT partido, parlamentar, n FROM rk WHERE rn <= 10 "
        f"UNION ALL SELECT partido, 'Outros' AS parlamentar, {_bigint_sum('n')} AS n FROM rk WHERE rn > 10 GROUP BY partido "
        f"UNION ALL SELECT 'Outros' AS partido, '—' AS parlamentar, {_bigint_sum('total')} AS n FROM tot "
        "WHERE partido NOT IN (SELECT partido FROM topg) HAVING sum(total) > 0"))
    o["by_state"] = on_mart("SELECT uf, count(*) AS n FROM mart WHERE uf IS NOT NULL AND uf NOT IN ('', '—') GROUP BY uf")
    each_state = ("(SELECT DISTINCT seq, score_lr, t AS uf FROM (SELECT seq, score_lr, " + strip("t0") + " AS t FROM (SELECT seq, "
                  "score_lr, unnest(string_split(uf, ';')) AS t0 FROM mart)) WHERE t NOT IN ('', '—'))")
    o["by_state_split"] = on_mart(f"SELECT uf, count(*) AS n FROM {each_state} GROUP BY uf")
    o["ideology_by_state_split"] = on_mart(
        "SELECT uf, round(CAST(sum(CAST(score_lr AS DECIMAL(38,2))) AS DOUBLE) / count(score_lr), 4) AS score_lr "
        f"FROM {each_state} WHERE score_lr IS NOT NULL GROUP BY uf")

    def places(column, order):
        return f"CASE {column} " + " ".join(f"WHEN {q(v)} THEN {i}" for i, v in enumerate(order, 1)) + " END"

    o["fixed_orders"] = on_mart(" UNION ALL ".join(
        f"SELECT {q(name)} AS dimensao, v AS valor, count(*) AS n, CAST({places('v', order)} AS INTEGER) AS ordem "
        f"FROM (SELECT {value} AS v FROM mart) GROUP BY v" for name, value, order in (
            ("espectro", f"coalesce(espectro, {q(vocab.IDEOLOGY_UNKNOWN)})", vocab.IDEOLOGY_BAND_ORDER),
            ("regiao", "regiao", vocab.REGION_ORDER),
            ("grupo", f"coalesce({type_group('tipo')}, 'Outros')", vocab.TYPE_GROUP_ORDER))))
    o["top_states"] = on_mart("SELECT uf, count(*) AS n FROM mart WHERE uf IS NOT NULL AND uf NOT IN ('', '—') "
                              "GROUP BY uf ORDER BY n DESC, uf LIMIT 15")
    o["term_mix"] = on_mart(
        f"SELECT legislatura, {title('termo_busca')} AS termo_busca, n, round(CAST(100 AS DOUBLE) * n / sum(n) OVER "
        "(PARTITION BY legislatura), 4) AS pct FROM (SELECT legislatura, termo_busca, count(*) AS n FROM mart WHERE legislatura IS NOT NULL AND termo_busca IS NOT NULL GROUP BY ALL)")
    o["top_authors"] = on_mart(
        f"SELECT {person('k', False)} AS parlamentar, n FROM (SELECT {strip('upper(parlamentar)')} AS k, count(*) AS n "
        "FROM mart WHERE e_parlamentar AND parlamentar IS NOT NULL GROUP BY 1 ORDER BY n DESC, k LIMIT 15)")
    o["party_term_matrix"] = sql(mart_ctes() + [
        "dm AS (SELECT * FROM mart WHERE e_parlamentar AND termo_busca IS NOT NULL)",
        f"tk AS (SELECT {strip('t0')} AS t FROM (SELECT unnest(string_split(tipo_autor, ';')) AS t0 FROM dm))",
        f"topt AS (SELECT t FROM (SELECT t, count(*) AS n FROM tk GROUP BY t ORDER BY n DESC, t LIMIT 12) "
        f"WHERE t NOT IN {lst(vocab.INSTITUTIONAL)})",
        f"d9 AS (SELECT {first_tok('tipo_autor')} AS p_plot, termo_busca FROM dm)",
        "kept AS (SELECT p_plot, termo_busca, count(*) AS n FROM d9 WHERE p_plot IN (SELECT t FROM topt) GROUP BY ALL)",
        "pp AS (SELECT p_plot, CAST(sum(n) AS BIGINT) AS row_total FROM kept GROUP BY ALL)",
        "tt AS (SELECT termo_busca, CAST(sum(n) AS BIGINT) AS col_total FROM kept GROUP BY ALL)",
    ], ("SELECT p_plot, termo_busca, coalesce(n, 0) AS n, row_total, col_total "
        "FROM pp CROSS JOIN tt LEFT JOIN kept USING (p_plot, termo_busca)"))
    o["party_type_flow"] = sql(mart_ctes() + [
        f"dm AS (SELECT *, {first_tok('tipo_autor')} AS p_sk FROM mart WHERE e_parlamentar)",
        f"tp AS (SELECT p_sk, n FROM (SELECT p_sk, count(*) AS n FROM dm GROUP BY p_sk ORDER BY n DESC, p_sk LIMIT 8) "
        f"WHERE p_sk NOT IN {lst(vocab.INSTITUTIONAL)})",
        "tp2 AS (SELECT p_sk, CAST(row_number() OVER (ORDER BY n DESC, p_sk) - 1 AS INTEGER) AS source FROM tp)",
        "tt AS (SELECT tipo, CAST(row_number() OVER (ORDER BY n DESC, tipo) - 1 AS INTEGER) AS r FROM "
        "(SELECT tipo, count(*) AS n FROM dm GROUP BY tipo ORDER BY n DESC, tipo LIMIT 6))",
        "ns AS (SELECT CAST(count(*) AS INTEGER) AS k FROM tp2)",
    ], (f"SELECT dm.p_sk, dm.tipo, {type_label('dm.tipo')} AS tipo_label, count(*) AS n, tp2.source, "
        "CAST(tt.r + ns.k AS INTEGER) AS target FROM dm JOIN tp2 USING (p_sk) JOIN tt USING (tipo) CROSS JOIN ns GROUP BY ALL"))
    latest = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '—') AS {c}"
                       for c in ["ano", "tipo", "numero", "parlamentar", "ementa", "llm_categoria"])
    o["latest_rows"] = on_mart(f"SELECT {latest} FROM (SELECT * FROM mart ORDER BY ano DESC, seq LIMIT 500)")
    o["ideology_by_leg_group"] = on_mart(
        f"SELECT legislatura, CASE WHEN grouping(grupo) = 1 THEN 'Total' ELSE grupo END AS grupo, "
        f"round(CAST(sum(CAST(score_lr AS DECIMAL(38,2))) AS DOUBLE) / count(score_lr), 4) AS score_lr, {legislature_order('legislatura')} AS ordem FROM "
        f"(SELECT legislatura, coalesce({type_group('tipo')}, 'Outros') AS grupo, score_lr FROM mart WHERE score_lr IS NOT NULL) "
        "GROUP BY GROUPING SETS ((legislatura), (legislatura, grupo))")
    o["ideology_by_house"] = on_mart(
        f"SELECT legislatura, {case_map('origem', vocab.HOUSE_CHAMBER)} AS casa, round(CAST(sum(CAST(score_lr AS DECIMAL(38,2))) AS DOUBLE) / count(score_lr), 4) AS score_lr "
        "FROM mart WHERE score_lr IS NOT NULL GROUP BY ALL")
    o["by_band"] = on_mart(f"SELECT coalesce(espectro, {q(vocab.IDEOLOGY_UNKNOWN)}) AS espectro, count(*) AS n FROM mart GROUP BY 1")
    o["ideology_by_state"] = on_mart(
        "SELECT uf, round(CAST(sum(CAST(score_lr AS DECIMAL(38,2))) AS DOUBLE) / count(score_lr), 4) AS score_lr FROM mart WHERE score_lr IS NOT NULL AND uf IS NOT NULL "
        "AND uf NOT IN ('', '—') GROUP BY uf")
    o["lowest_state_scores"] = on_mart(
        "SELECT uf, round(CAST(sum(CAST(score_lr AS DECIMAL(38,2))) AS DOUBLE) / count(score_lr), 4) AS score_lr FROM mart WHERE score_lr IS NOT NULL AND uf IS NOT NULL "
        "AND uf NOT IN ('', '—') GROUP BY uf ORDER BY score_lr, uf LIMIT 15")
    o["facet_options"] = on_mart(
        "SELECT DISTINCT * FROM ("
        "SELECT 'ano' AS faceta, CAST(ano_int AS VARCHAR) AS valor, CAST(ano_int AS VARCHAR) AS rotulo FROM mart "
        "UNION ALL SELECT 'origem', origem_extenso, origem_extenso FROM mart "
        "UNION ALL SELECT 'tipo', tipo_extenso, tipo_extenso FROM mart "
        f"UNION ALL SELECT 'uf', t, t FROM (SELECT {strip('t0')} AS t FROM (SELECT unnest(string_split(uf, ';')) AS t0 FROM mart)) "
        "WHERE t NOT IN ('', '—') AND length(t) = 2 "
        f"UNION ALL SELECT 'partido', {party('t', True)}, {party('t', True)} FROM "
        "(SELECT unnest(string_split(tipo_autor, ';')) AS t FROM mart) "
        f"UNION ALL SELECT 'politico', v, v FROM (SELECT {person('t')} AS v FROM (SELECT unnest(string_split_regex("
        f"parlamentar, '[;,]')) AS t FROM mart) WHERE t IS NOT NULL AND {strip('t')} NOT IN ('', '—')) WHERE length(v) > 2 "
        f"UNION ALL SELECT 'termo', termo_busca, {title('termo_busca')} FROM mart) WHERE valor IS NOT NULL")

    def counts(name, c):
        return (f"SELECT {q(name)} AS resumo, coalesce(CAST({c} AS VARCHAR), '') AS chave, count(*) AS n "
                f"FROM scored GROUP BY 2")

    o["stage_summary"] = sql(mart_ctes(), " UNION ALL ".join([
        counts("situacao_norm", "situacao_norm"), counts("llm_decisao", "llm_decisao"),
        counts("llm_categoria", "llm_categoria"), counts("espectro", "espectro"),
        "SELECT 'cobertura' AS resumo, 'com_score' AS chave, count(score_lr) AS n FROM scored",
        "SELECT 'avaliacao' AS resumo, 'com_nota' AS chave, count(llm_nota) AS n FROM scored"]))
    # the views' SQL again, over a selection of the finished chain's base instead of the base of raw proposals
    prefix = sql(mart_ctes(), "")[:-1]
    bodies = {name: o[name].removeprefix(prefix) for name in DASHBOARD_VIEWS if name != "author_groups"}
    bodies["author_groups"] = f"SELECT {author_group('tipo_autor')} AS categoria, count(*) AS n FROM mart GROUP BY 1"
    chain = final_ctes()
    chain[-1] = "all_" + chain[-1]
    cells = []
    for name, (_, keys, count, value) in DASHBOARD_VIEWS.items():
        body = "WITH " + bodies[name][2:] if bodies[name].startswith(",\n") else bodies[name]
        k1, k2 = (*(f"CAST({k} AS VARCHAR)" for k in keys), "CAST(NULL AS VARCHAR)")[:2]
        cells.append(f"SELECT {q(name)} AS visao, {k1} AS chave1, {k2} AS chave2, CAST({count or 'NULL'} AS BIGINT) AS n, "
                     f"CAST({value or 'NULL'} AS DOUBLE) AS valor FROM ({body})")
    o["dashboard_selected"] = sql([*chain, f"mart AS (SELECT * FROM all_mart WHERE {facet_where(FACETS)})"], " UNION ALL ".join(cells))

    o["party_term_ordered"] = (
        "SELECT *, dense_rank() OVER (ORDER BY row_total DESC, p_plot) AS linha, dense_rank() OVER (ORDER BY col_total DESC, "
        f"termo_busca) AS coluna FROM ({o['party_term_matrix']})")
    o["category_counts_ordered"] = on_mart(
        "SELECT llm_categoria, n, row_number() OVER (ORDER BY n DESC, llm_categoria) AS ordem FROM (SELECT llm_categoria, "
        "count(*) AS n FROM mart WHERE llm_categoria IS NOT NULL GROUP BY 1)")
    o["facet_options_ordered"] = ("SELECT *, row_number() OVER (ORDER BY faceta, valor, rotulo NULLS FIRST) AS ordem "
                                  f"FROM ({o['facet_options']})")
    return o


ORACLE_SQL = build()
