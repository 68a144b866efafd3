"""Stage 1: consolidate the collected proposals.

Order matters and follows the original job: subject filter -> contract
projection -> type map -> summary-pattern filter -> fill -> sort -> date ->
number -> keep first per id.  Everything up to the dedup is map-side; the dedup
is one shuffle on the id with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions import labels, text
from plenaria.operators.dedup import first_per_key
from plenaria.operators.filters import exclude_pattern, exclude_values, fill_missing

CONTRACT = ["origem", "tipo", "numero", "ano", "data_apre", "parlamentar", "tipo_autor", "uf",
            "ementa", "termo_busca", "tramitando", "id_interno", "id_processo", "uri"]
# FIXED VALUES: display names of the stage-1 output contract, in contract order.
DISPLAY_NAMES = {
    "origem": "Origem",
    "tipo": "Tipo de Proposta",
    "numero": "Número",
    "ano": "Ano",
    "data_apre": "Data de Apresentação",
    "parlamentar": "Parlamentar",
    "tipo_autor": "Tipo/Partido Autor",
    "uf": "UF",
    "ementa": "Ementa",
    "termo_busca": "Termo de Busca",
    "tramitando": "Tramitando",
    "id_interno": "ID Interno",
    "id_processo": "ID Processo",
    "uri": "URI",
}
FILL = {"id_processo": vocab.PLACEHOLDER, "tramitando": vocab.PLACEHOLDER, "uf": vocab.PLACEHOLDER}
SORT = ["origem", "ano", "tipo"]
KEY = "id_interno"


def consolidate(raw: DataFrame,
                excluded_subjects=vocab.EXCLUDED_SUBJECTS,
                exclusion_pattern: str = vocab.SUMMARY_EXCLUSION_PATTERN,
                type_map: dict = vocab.TYPE_NORMALISATION) -> DataFrame:
    """Raw proposals of both houses -> the stage-1 table (one row per internal id)."""
    df = raw
    if "assunto_especifico" in df.columns:
        df = exclude_values(df, "assunto_especifico", excluded_subjects)
    df = df.select(*[c for c in CONTRACT if c in df.columns])
    df = df.withColumn("tipo", labels.normalise_type("tipo", type_map))
    df = exclude_pattern(df, "ementa", exclusion_pattern)
    df = fill_missing(df, {k: v for k, v in FILL.items() if k in df.columns})
    df = (df.withColumn("data_apre", text.date_text("data_apre"))
          .withColumn("numero", text.proposal_number("numero")))
    df = first_per_key(df, [KEY], SORT)
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def to_display(stage1: DataFrame) -> DataFrame:
    """Rename to the display contract (at the edge only; the engine keeps snake case)."""
    return stage1.withColumnsRenamed({k: v for k, v in DISPLAY_NAMES.items() if k in stage1.columns})


def house_crosstab(stage1: DataFrame) -> DataFrame:
    """Type x house counts with margins over the houses present (stage-1 summary)."""
    from plenaria.operators.grouping import crosstab_margins
    return crosstab_margins(stage1, "tipo", "origem")
