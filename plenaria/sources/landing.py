"""Raw JSON landing data -> records.

The collection services' responses are read as JSON text (one response per
row, e.g. ``spark.read.text`` or a column of a landing table) and parsed with
``from_json`` / ``get_json_object`` in PERMISSIVE mode: a malformed response
gives empty fields, never a failed job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.functions.json_fields import field_or, status_fields
from plenaria.functions.text import strip_ws, year_prefix

CHAMBER_PAGE = ("struct<dados: array<struct<id: bigint, siglaTipo: string, numero: string, "
                "ano: string, dataApresentacao: string, ementa: string, uri: string>>>")
CHAMBER_AUTHORS = "struct<dados: array<struct<nome: string, siglaPartido: string, siglaUf: string, tipo: string, uri: string>>>"
MEMBER_PROFILE = "struct<dados: struct<ultimoStatus: struct<siglaPartido: string, siglaUf: string>>>"
CHAMBER_DETAIL = ("struct<dados: struct<keywords: string, ementaDetalhada: string, "
                  "statusProposicao: struct<descricaoSituacao: string, url: string>>>")
SENATE_DETAIL = ("struct<conteudo: struct<assuntoGeral: string, assuntoEspecifico: string>, "
                 "documento: struct<indexacao: string>>")
SENATE_CONTEXT = "struct<DetalheMateria: struct<Materia: struct<IndexacaoMateria: string, EmentaMateria: string>>>"
SENATE_PROCESS = ("struct<id: bigint, codigoMateria: bigint, tipoDocumento: string, tipoConteudo: string, "
                  "casaIdentificadora: string, identificacao: string, dataApresentacao: string, "
                  "ementa: string, autoria: string, tramitando: string>")


def read_landing(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """Landing files with one JSON response per line -> (key=file name, raw)."""
    return spark.read.text(path).select(F.input_file_name().alias(key), F.col("value").alias("raw"))


def chamber_records(pages: DataFrame, raw: str = "raw", keep=("pagina",),
                    default_type: str | None = None, default_year: str | None = None) -> DataFrame:
    """Chamber result pages -> one proposal record per element of ``dados``.

    Missing or null fields take their defaults; an empty or malformed page gives no rows.
    """
    parsed = pages.select(*keep, F.inline(F.from_json(F.col(raw), CHAMBER_PAGE)["dados"]))
    return parsed.select(
        *keep,
        F.lit("CD").alias("origem"),
        F.coalesce(F.col("siglaTipo"), F.lit(default_type)).alias("tipo"),
        field_or(F.col("numero")).alias("numero"),
        F.coalesce(F.col("ano"), F.lit(default_year)).alias("ano"),
        field_or(F.col("dataApresentacao")).alias("data_apre"),
        field_or(F.col("ementa")).alias("ementa"),
        F.col("id").cast("string").alias("id_interno"),
        F.lit("").alias("id_processo"),
        field_or(F.col("uri")).alias("uri"),
        F.lit("").alias("tramitando"),
        F.lit("").alias("assunto_geral"),
        F.lit("").alias("assunto_especifico"))


#: Paths of the Senate's status service (fixed values).
SENATE_STATUS = {"materia": "SituacaoAtualMateria.Materias.Materia", "autuacao": "SituacaoAtual.Autuacoes.Autuacao",
                 "situacao": "Situacoes.Situacao", "desc": "DescricaoSituacao", "date": "DataSituacao"}


def senate_detail(details: DataFrame, raw: str = "raw", keep=("seq",)) -> DataFrame:
    """Senate process detail -> (indexacao, assunto_geral, assunto_especifico), '' when missing."""
    d = F.from_json(F.col(raw), SENATE_DETAIL)
    return details.select(
        *keep,
        field_or(d["documento"]["indexacao"]).alias("indexacao"),
        field_or(d["conteudo"]["assuntoGeral"]).alias("assunto_geral"),
        field_or(d["conteudo"]["assuntoEspecifico"]).alias("assunto_especifico"))


def senate_status(responses: DataFrame, raw: str = "raw", keep=("seq",), **paths) -> DataFrame:
    """Senate status (object-or-array at each level) -> (situacao, data_situacao); ``paths`` other than the service's."""
    parsed = responses.select(*keep, status_fields(F.col(raw), **(SENATE_STATUS | paths)).alias("_s"))
    return parsed.select(*keep, "_s.situacao", "_s.data_situacao")


def chamber_status(responses: DataFrame, raw: str = "raw", keep=("id_interno",)) -> DataFrame:
    """Chamber proposal detail -> (situacao, norma_url)."""
    d = F.from_json(F.col(raw), CHAMBER_DETAIL)["dados"]
    return responses.select(*keep, field_or(d["statusProposicao"]["descricaoSituacao"]).alias("situacao"),
                            field_or(d["statusProposicao"]["url"]).alias("norma_url"))


def chamber_context(responses: DataFrame, raw: str = "raw", keep=("uri",)) -> DataFrame:
    """Chamber context -> (keywords, ementa_detalhada)."""
    d = F.from_json(F.col(raw), CHAMBER_DETAIL)["dados"]
    return responses.select(*keep, field_or(d["keywords"]).alias("keywords"),
                            field_or(d["ementaDetalhada"]).alias("ementa_detalhada"))


def senate_context(responses: DataFrame, raw: str = "raw", keep=("uri",)) -> DataFrame:
    """Senate context -> indexacao: indexing text, else the long summary, else ''."""
    m = F.from_json(F.col(raw), SENATE_CONTEXT)["DetalheMateria"]["Materia"]
    idx = F.coalesce(F.nullif(m["IndexacaoMateria"], F.lit("")), F.nullif(m["EmentaMateria"], F.lit("")),
                     F.lit(""))
    return responses.select(*keep, idx.alias("indexacao"))


def chamber_authors(responses: DataFrame, raw: str = "raw", key: str = "id_interno") -> DataFrame:
    """Chamber author lists -> one row per author with its position (pos)."""
    arr = F.from_json(F.col(raw), CHAMBER_AUTHORS)["dados"]
    exploded = responses.select(key, F.posexplode(arr).alias("pos", "a"))
    return exploded.select(key, "pos",
                           field_or(F.col("a.nome")).alias("nome"),
                           field_or(F.col("a.siglaPartido")).alias("partido"),
                           field_or(F.col("a.siglaUf")).alias("uf"),
                           field_or(F.col("a.tipo")).alias("tipo"),
                           F.col("a.uri").alias("uri"))


def member_profiles(responses: DataFrame, raw: str = "raw", key: str = "uri") -> DataFrame:
    """Member profile -> (uri, perfil_partido, perfil_uf)."""
    s = F.from_json(F.col(raw), MEMBER_PROFILE)["dados"]["ultimoStatus"]
    return responses.select(key, s["siglaPartido"].alias("perfil_partido"), s["siglaUf"].alias("perfil_uf"))


def senate_processes(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """Senate process list (root array or object) -> one process record per element."""
    arr = F.from_json(F.col(raw), f"array<{SENATE_PROCESS}>")
    p = responses.select(F.inline(arr))
    return p.select(
        F.col("codigoMateria").cast("string").alias("cod"),
        F.col("id").cast("string").alias("id_processo"),
        field_or(F.col("tipoDocumento")).alias("tipo_doc"),
        F.col("tipoConteudo").alias("tipo_conteudo"),
        F.coalesce(F.col("casaIdentificadora"), F.lit("SF")).alias("origem"),
        field_or(F.col("identificacao")).alias("numero"),
        year_prefix(F.col("dataApresentacao")).alias("ano"),
        field_or(F.col("dataApresentacao")).alias("data_apre"),
        strip_ws(field_or(F.col("ementa"))).alias("ementa"),
        field_or(F.col("autoria")).alias("autoria"),
        field_or(F.col("tramitando")).alias("tramitando"))
