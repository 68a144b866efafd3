"""Bridge views: the domain tables expressed over the driver's Parquet tables.

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB, so the
Spark jobs and the DuckDB oracle read exactly the same rows.  Table references
are written ``@@name``; :func:`render` resolves them to Spark temp views (one set
per data directory) or to DuckDB's plain view names.
"""

from __future__ import annotations

import hashlib
import re
import threading
import weakref

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_TYPES = ("PL#PLP#PEC#MPV#PDL#PDC#PLV#PLS#PLC#PLN#PRC#PRN#MSC#MSG#PFC#SUG#"
          "Medida Provisória#Sugestão#XYZ")
_AUTHOR_TYPES = ("PT#PMDB#MDB#PSDB#DEM#PFL#PL#PR#UNIÃO#PODE#PP; PT#Executivo#Comissão#"
                 "Popular; Comissão#Sem partido#—##S. PART.#CPI MISTA; PT#SOLIDARIEDADE#"
                 "NOVO*#Executivo; PSOL#AVANTE#MISSÃO")
_STATES = "SP#RJ#MG#BA#RS#PR#PE#CE#PA#AM#DF#GO#SC#ES#SP; RJ#—#"
_TERMS = ("erradicação da pobreza#extrema pobreza#pobreza#vulnerabilidade social#"
          "transferência de renda#desigualdade social#proteção social#assistência social#"
          "inclusão social#bolsa família#benefício de prestação continuada#renda mínima")
_STATUS = ("Transformado em Norma Jurídica#Arquivada#Aguardando Parecer#Vetada totalmente#"
           "Tramitação em conjunto#Aprovado o Substitutivo#Devolvida ao Relator#XPTO##"
           "Retirada pelo autor")

PROPOSALS = f"""
SELECT
  CASE o_orderstatus WHEN 'P' THEN 'CD' WHEN 'F' THEN 'SF' ELSE 'CN' END AS origem,
  split_part('{_TYPES}', '#', CAST(1 + o_orderkey % 19 AS INT)) AS tipo,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS STRING)
       ELSE concat('PL ', CAST(o_orderkey AS STRING), '/', CAST(1988 + o_orderkey % 38 AS STRING)) END AS numero,
  CAST(1988 + o_orderkey % 38 AS STRING) AS ano,
  CASE o_orderkey % 10 WHEN 0 THEN 'sem data' WHEN 1 THEN NULL WHEN 2 THEN ''
       WHEN 3 THEN concat(CAST(1988 + o_orderkey % 38 AS STRING), '-03-15T10:30')
       ELSE concat(CAST(1988 + o_orderkey % 38 AS STRING), '-03-15') END AS data_apre,
  CASE c_custkey % 3 WHEN 0 THEN concat('MARIA DAS DORES (licenciada) ', CAST(c_custkey % 300 AS STRING))
       WHEN 1 THEN concat('João da Silva ', CAST(c_custkey % 300 AS STRING))
       ELSE concat('ANA E SOUZA-CRUZ; José ', CAST(c_custkey % 50 AS STRING)) END AS parlamentar,
  split_part('{_AUTHOR_TYPES}', '#', CAST(1 + o_custkey % 24 AS INT)) AS tipo_autor,
  CASE WHEN c_custkey % 18 = 17 THEN NULL
       ELSE split_part('{_STATES}', '#', CAST(1 + c_custkey % 18 AS INT)) END AS uf,
  CASE o_orderkey % 25 WHEN 0 THEN 'Abre crédito suplementar em favor do fundo'
       WHEN 1 THEN 'Concede a MEDALHA do mérito'
       WHEN 2 THEN NULL
       ELSE concat('Dispõe sobre ', split_part('{_TERMS}', '#', CAST(1 + o_orderkey % 12 AS INT)), ' e dá outras providências') END AS ementa,
  split_part('{_TERMS}', '#', CAST(1 + o_orderkey % 12 AS INT)) AS termo_busca,
  CASE o_orderkey % 4 WHEN 0 THEN 'Sim' WHEN 1 THEN 'Não' WHEN 2 THEN '' ELSE NULL END AS tramitando,
  concat(CASE o_orderstatus WHEN 'P' THEN '' ELSE 'SF-' END,
         CAST(o_orderkey - CASE WHEN o_orderkey % 10 = 9 THEN 1 ELSE 0 END AS STRING)) AS id_interno,
  CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderkey % 7 = 0 THEN '—' WHEN o_orderkey % 7 = 1 THEN NULL
       ELSE CAST(700000 + o_orderkey AS STRING) END AS id_processo,
  concat('http://example.org/', CAST(o_orderkey AS STRING)) AS uri,
  CASE o_orderkey % 11 WHEN 0 THEN 'Data comemorativa' WHEN 1 THEN 'Comunicações' WHEN 2 THEN NULL ELSE 'Renda' END AS assunto_especifico,
  split_part('{_STATUS}', '#', CAST(1 + o_custkey % 10 AS INT)) AS situacao,
  o_orderkey AS seq,
  o_totalprice AS nota_bruta
FROM @@orders JOIN @@customer ON o_custkey = c_custkey
"""

SURVEY = """
SELECT wave,
  CASE WHEN k % 11 = 10 THEN -999 ELSE k % 10 + 1 END AS lrpt,
  CASE WHEN k % 11 = 9 THEN -999 ELSE (k * 3) % 10 + 1 END AS lrpsdb,
  CASE WHEN wave > 2013 OR k % 11 = 8 THEN -999 ELSE (k * 7) % 10 + 1 END AS lrpmdb,
  CASE WHEN wave < 2013 OR k % 4 <> 0 THEN -999 ELSE k % 3 + 1 END AS lrmdb,
  CASE WHEN wave > 2005 THEN -999 ELSE (k * 9) % 10 + 1 END AS lrpfl,
  CASE WHEN wave < 2009 THEN -999 ELSE (k * 9 + 1) % 10 + 1 END AS lrdem,
  CASE WHEN wave > 2001 THEN -999 ELSE (k + 5) % 10 + 1 END AS lrpp_ppb,
  CASE WHEN wave < 2001 OR k % 4 <> 1 THEN -999 ELSE k % 3 + 7 END AS lrpp,
  CASE WHEN wave < 2017 THEN -999 ELSE (k + 7) % 10 + 1 END AS lrpsl,
  CASE WHEN wave <> 2021 THEN -999 ELSE (k + 8) % 10 + 1 END AS lrnovo,
  CASE WHEN wave > 1997 THEN -999 ELSE (k + 4) % 10 + 1 END AS lrpds,
  CASE WHEN wave = 1993 THEN -999 ELSE (k + 3) % 10 + 1 END AS lrpdt,
  CASE WHEN k % 13 = 1 THEN -999 ELSE (k + 2) % 10 + 1 END AS lrpl
FROM (SELECT c_custkey AS k,
        CAST(split_part('1990#1993#1997#2001#2005#2009#2013#2017#2021', '#', CAST(1 + c_custkey % 9 AS INT)) AS INT) AS wave
      FROM @@customer) t
"""

ATTEMPTS = """
SELECT o_orderkey AS seq, attempt,
  CASE (o_orderkey + attempt) % 6
    WHEN 0 THEN concat('{"nota": ', CAST(CAST(o_custkey % 97 AS DOUBLE) / 8 AS STRING), ', "categoria": "Pobreza", "justificativa": "a"}')
    WHEN 1 THEN concat('{"nota": "', CAST(o_custkey % 13 AS STRING), '.625", "categoria": "Renda Mínima"}')
    WHEN 2 THEN 'not json'
    WHEN 3 THEN '{"nota": null, "categoria": "x"}'
    WHEN 4 THEN '{"categoria": "Pobreza"}'
    ELSE '{"nota": "alta"}' END AS raw
FROM @@orders CROSS JOIN (SELECT 1 AS attempt UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) a
"""

# Spark form of the same view: the four attempts come from a generator on each
# order row instead of a join with a constant table (same rows, no join).
ATTEMPTS_SPARK = ATTEMPTS.replace(
    "FROM @@orders CROSS JOIN (SELECT 1 AS attempt UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) a",
    "FROM @@orders LATERAL VIEW explode(array(1, 2, 3, 4)) a AS attempt")
assert ATTEMPTS_SPARK != ATTEMPTS

def _senate_status(key: str) -> str:
    """The Senate's status payload in the shapes that the service gives, by ``key``."""
    one = '{"SituacaoAtualMateria":{"Materias":{"Materia":'
    return f"""CASE {key} % 8
    WHEN 0 THEN '{one}{{"SituacaoAtual":{{"Autuacoes":{{"Autuacao":{{"Situacoes":{{"Situacao":{{"DescricaoSituacao":"Arquivada","DataSituacao":"2001-01-01"}}}}}}}}}}}}}}}}}}'
    WHEN 1 THEN '{one}[{{"SituacaoAtual":{{"Autuacoes":{{"Autuacao":[{{"Situacoes":{{"Situacao":[{{"DescricaoSituacao":"Aguardando Parecer","DataSituacao":"2001-01-01"}},{{"DataSituacao":"2002-02-02"}}]}}}},{{"Situacoes":{{"Situacao":{{"DescricaoSituacao":"Norma"}}}}}}]}}}}}}]}}}}}}'
    WHEN 2 THEN '{one}[]}}}}}}'
    WHEN 3 THEN '{{"broken":'
    WHEN 4 THEN '{one}[{{"SituacaoAtual":{{"Autuacoes":{{"Autuacao":[{{"Situacoes":{{"Situacao":{{"DescricaoSituacao":"Retirada pelo Autor","DataSituacao":"2010-10-10"}}}}}},{{"Numero":2}},{{"Situacoes":{{"Situacao":[]}}}}]}}}}}},{{"SituacaoAtual":{{"Autuacoes":{{"Autuacao":{{"Situacoes":{{"Situacao":{{"DescricaoSituacao":"Outra"}}}}}}}}}}}}]}}}}}}'
    WHEN 5 THEN '{one}{{"Identificacao":"PLS 1/2001"}}}}}}}}'
    WHEN 6 THEN '{{"SituacaoAtualMateria":{{"Materias":{{}}}}}}'
    ELSE '{{}}' END"""


STATUS_RAW = f"""
SELECT o_orderkey AS seq, {_senate_status("o_orderkey")} AS raw
FROM @@orders
"""

# Both houses' status responses as they land: the Chamber's proposal detail by id, the Senate's status by matter code.
STATUS_RESPONSES = f"""
SELECT 'CD' AS casa, CAST(o_orderkey AS STRING) AS chave,
  CASE o_orderkey % 5
    WHEN 0 THEN '{{"dados":{{"statusProposicao":{{"descricaoSituacao":"Transformado em Norma Jurídica","url":"http://example.org/n"}}}}}}'
    WHEN 1 THEN '{{"dados":{{"statusProposicao":{{"descricaoSituacao":"Pronta para Pauta","url":null}}}}}}'
    WHEN 2 THEN '{{"dados":{{"statusProposicao":{{}}}}}}'
    WHEN 3 THEN 'timeout'
    ELSE '{{"dados":{{"statusProposicao":{{"descricaoSituacao":"Arquivada"}}}}}}' END AS raw
FROM @@orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT 'SF' AS casa, CAST(o_orderkey AS STRING) AS chave, {_senate_status("o_orderkey")} AS raw
FROM @@orders WHERE o_orderstatus <> 'P'
"""

AUTHOR_TEXT = """
SELECT o_orderkey AS seq,
  split_part('Senador Zé da Silva (UNIÃO/SP)#Senadora Ana (PT/BA)#Presidência da República#Comissão de Assuntos Sociais#STF#stf#Ministério Público da União#Câmara dos Deputados#Senador Fulano#Fulano##Senador João (MDB/PA)', '#', CAST(1 + o_orderkey % 12 AS INT)) AS autoria,
  CASE WHEN o_orderkey % 10 = 0 THEN 'Sugestão' ELSE 'Projeto de Lei Ordinária' END AS tipo_doc
FROM @@orders
"""

# Two-route capture input.  The summary is the whole document text; the detail
# text of the second route is the whole web page with the same id (no page ->
# no detail), so both routes read whole texts.
CAPTURE = """
SELECT d.doc_id AS cod, d.text AS ementa,
  CASE WHEN l.quality = 1 THEN 'Norma Geral' WHEN l.quality = 0 THEN 'Comunicações' ELSE NULL END AS tipo_conteudo,
  split_part('Projeto de Resolução#Mensagem#Requerimento', '#', CAST(1 + d.doc_id % 3 AS INT)) AS tipo_doc
FROM @@documents d LEFT JOIN @@labels l ON d.doc_id = l.doc_id
"""

CAPTURE_DETAIL = """
SELECT page_id AS cod, html AS indexacao FROM @@pages
"""

PAGE_RAW = """
SELECT o_orderkey AS pagina,
  CASE o_orderkey % 5 WHEN 0 THEN '{"dados":[]}' WHEN 1 THEN 'erro'
    ELSE concat('{"dados":[{"id":', CAST(o_orderkey * 2 AS STRING), ',"siglaTipo":"PL","numero":', CAST(o_custkey AS STRING),
                ',"ano":', CAST(1988 + o_orderkey % 38 AS STRING), ',"ementa":"Dispõe sobre renda"},{"id":',
                CAST(o_orderkey * 2 + 1 AS STRING), ',"siglaTipo":"PEC","ementa":null}]}') END AS raw
FROM @@orders
"""

# Pages as they land, with the term that found them: each term's search gives a proposal again, in other words.
LANDED_PAGES = f"""
SELECT split_part('{_TERMS}', '#', CAST(1 + o_custkey % 12 AS INT)) AS termo_busca,
  CAST(o_orderkey % 4 AS STRING) AS pagina,
  CASE WHEN o_orderkey % 9 = 0 THEN 'erro' ELSE concat('{{"dados":[{{"id":', CAST(o_custkey AS STRING), ',"siglaTipo":"PL","numero":',
    CAST(o_custkey AS STRING), ',"ano":2001,"ementa":"Dispõe sobre renda ', CAST(o_orderkey % 3 AS STRING), '"}},{{"id":',
    CAST(o_orderkey % 1000 AS STRING), ',"siglaTipo":"PEC","ementa":null}}]}}') END AS raw
FROM @@orders
"""

# The proposals' pages of both houses by uri, some fetched without result, some never.
CONTEXT_RESPONSES = """
SELECT concat('http://example.org/', CAST(o_orderkey AS STRING)) AS uri,
  CASE o_orderstatus WHEN 'P' THEN 'CD' WHEN 'F' THEN 'SF' ELSE 'CN' END AS origem,
  CASE WHEN o_orderkey % 6 = 0 THEN 'erro'
    WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 4
      WHEN 0 THEN '{"dados":{"keywords":"renda, pobreza","ementaDetalhada":null}}'
      WHEN 1 THEN concat('{"dados":{"keywords":"","ementaDetalhada":"Institui o programa ', CAST(o_custkey AS STRING), '"}}')
      WHEN 2 THEN '{"dados":{}}' ELSE '{"dados":{"keywords":"fome","ementaDetalhada":"Altera a lei"}}' END
    ELSE CASE o_orderkey % 4
      WHEN 0 THEN '{"DetalheMateria":{"Materia":{"IndexacaoMateria":"","EmentaMateria":"Ementa longa"}}}'
      WHEN 1 THEN concat('{"DetalheMateria":{"Materia":{"IndexacaoMateria":"INDEX ', CAST(o_custkey AS STRING), '"}}}')
      WHEN 2 THEN '{"DetalheMateria":{}}' ELSE '{}' END END AS raw
FROM @@orders WHERE o_orderkey % 5 <> 0
"""

#: A proposal's Senate process id is this plus its sequence number, as in the proposals view.
PROCESS_ID_BASE = 700000

# One Senate process list per order: an array of one or two processes, a bare object, or a malformed response.
_SENATE_DOCS = "Projeto de Lei Ordinária#Projeto de Lei do Senado#Requerimento#Sugestão#Medida Provisória"
_SENATE_CONTENT = "Norma Geral#Comunicações#Norma Jurídica"
_SENATE_AUTHORS = ("Senador Zé da Silva (UNIÃO/SP)#Senadora Ana (PT/BA)#Presidência da República#Comissão de Assuntos Sociais#"
                   "Câmara dos Deputados#STF")


def _process(key: str, summary: str) -> str:
    return f"""concat('{{"id":', CAST({PROCESS_ID_BASE} + {key} AS STRING), ',"codigoMateria":', CAST({key} AS STRING),
      ',"tipoDocumento":"', split_part('{_SENATE_DOCS}', '#', CAST(1 + o_orderkey % 5 AS INT)),
      '","tipoConteudo":"', split_part('{_SENATE_CONTENT}', '#', CAST(1 + o_custkey % 3 AS INT)),
      CASE WHEN o_orderkey % 4 = 0 THEN '","casaIdentificadora":"CN' ELSE '' END,
      '","identificacao":"PLS ', CAST({key} AS STRING), '/', CAST(1988 + o_orderkey % 38 AS STRING),
      '","dataApresentacao":"', CAST(1988 + o_orderkey % 38 AS STRING), '-03-15","ementa":"', {summary},
      '","autoria":"', split_part('{_SENATE_AUTHORS}', '#', CAST(1 + o_custkey % 6 AS INT)), '"}}')"""


_SUMMARY = f"""CASE o_custkey % 4 WHEN 0 THEN 'Outro tema' ELSE concat('  Dispõe sobre ',
      split_part('{_TERMS}', '#', CAST(1 + o_custkey % 12 AS INT)), ' ') END"""

PROCESSES_RAW = f"""
SELECT CASE o_orderkey % 7 WHEN 0 THEN 'erro' WHEN 1 THEN '[]'
    WHEN 2 THEN {_process("o_orderkey", _SUMMARY)}
    WHEN 3 THEN concat('[', {_process("o_orderkey", _SUMMARY)}, ',',
                       {_process("o_orderkey", "'Sobre a EXTREMA POBREZA'")}, ']')
    ELSE concat('[', {_process("o_orderkey", _SUMMARY)}, ']') END AS raw
FROM @@orders
"""

DETAIL_RAW = """
SELECT o_orderkey AS seq,
  CASE o_orderkey % 4 WHEN 0 THEN '{"conteudo":{"assuntoGeral":"Social","assuntoEspecifico":null},"documento":{"indexacao":"RENDA, POBREZA"}}'
    WHEN 1 THEN '{"conteudo":{"assuntoEspecifico":"Data comemorativa"}}'
    WHEN 2 THEN '{}' ELSE 'erro' END AS raw
FROM @@orders
"""

VIEWS = {
    "proposals": PROPOSALS,
    "survey": SURVEY,
    "attempts": ATTEMPTS,
    "status_raw": STATUS_RAW,
    "status_respostas": STATUS_RESPONSES,
    "autoria_bruta": AUTHOR_TEXT,
    "captura": CAPTURE,
    "captura_detalhe": CAPTURE_DETAIL,
    "pagina_raw": PAGE_RAW,
    "detalhe_raw": DETAIL_RAW,
    "paginas_por_termo": LANDED_PAGES,
    "contexto_respostas": CONTEXT_RESPONSES,
    "processos_raw": PROCESSES_RAW,
}

SPARK_VIEWS = {"attempts": ATTEMPTS_SPARK}

_MARK = re.compile(r"@@(\w+)")
_lock = threading.Lock()
_registered: dict = {}            # (session id, prefix) -> weak ref to that session


def render(sql: str, resolve=lambda name: name) -> str:
    """Replace every ``@@table`` marker with ``resolve(table)``."""
    return _MARK.sub(lambda m: resolve(m.group(1)), sql)


def duckdb_sql(view: str) -> str:
    """The view text for DuckDB, where the driver tables are plain views."""
    return render(VIEWS[view])


def _prefix(data_dir: str) -> str:
    return "plenaria_" + hashlib.sha1(data_dir.rstrip("/").encode()).hexdigest()[:10]


_tables: dict = {}                # (session id, path) -> scan DataFrame


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet); Catalyst prunes columns and pushes filters.

    The scan DataFrame is built once per session and path (a DataFrame is an
    immutable plan; reading it again re-reads the Parquet footers).
    """
    path = f"{data_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    if key not in _tables or _tables[key].sparkSession is not spark:
        _tables[key] = spark.read.parquet(path)
    return _tables[key]


def register_tables(spark: SparkSession, data_dir: str) -> str:
    """Register the driver tables of ``data_dir`` as temp views; returns the prefix."""
    prefix = _prefix(data_dir)
    with _lock:
        ref = _registered.get((id(spark), prefix))
        if ref is not None and ref() is spark:
            return prefix
        existing = {t.name for t in spark.catalog.listTables() if t.isTemporary}
        for name in DRIVER_TABLES:
            view = f"{prefix}_{name}"
            if view not in existing:
                table(spark, data_dir, name).createOrReplaceTempView(view)
        _registered[(id(spark), prefix)] = weakref.ref(spark)
    return prefix


def bridge(spark: SparkSession, data_dir: str, view: str) -> DataFrame:
    """A bridge view as a DataFrame (analysed now, executed lazily)."""
    prefix = register_tables(spark, data_dir)
    return spark.sql(render(SPARK_VIEWS.get(view, VIEWS[view]), lambda name: f"{prefix}_{name}"))
