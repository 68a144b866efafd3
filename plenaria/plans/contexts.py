"""Contexts by uri (J6, S12): the proposals' pages of both houses, each with its own payload, in one table.

A response says by ``origem`` which service gave it: the Chamber's has keywords and a detailed summary, the Senate's the
indexing text (or the long summary).  Both are parsed in one pass over the responses; fields of the other house are null,
those that a payload lacks, or a payload that cannot be read, are ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenaria.operators.dedup import first_per_key
from plenaria.plans.scoring import context_block
from plenaria.sources import landing

CONTEXT_COLUMNS = ["keywords", "ementa_detalhada", "indexacao"]


def _is_chamber() -> Column:
    return F.coalesce(F.col("origem") == "CD", F.lit(False))


def context_table(responses: DataFrame, key: str = "uri") -> DataFrame:
    """(uri, casa_cd, keywords, ementa_detalhada, indexacao): one row per uri and service; rows without a uri are left out.

    ``responses``: (uri, origem, raw).  A uri fetched twice keeps the smallest context (any run picks the same).
    """
    tagged = (responses.where(F.col(key).isNotNull())
              .select(key, _is_chamber().alias("casa_cd"), F.when(_is_chamber(), F.col("raw")).alias("_cd"),
                      F.when(~_is_chamber(), F.col("raw")).alias("_sf")))
    both = landing.senate_context(landing.chamber_context(tagged, "_cd", (key, "casa_cd", "_sf")), "_sf",
                                  (key, "casa_cd", "keywords", "ementa_detalhada"))
    cd = F.col("casa_cd")
    shaped = both.select(key, "casa_cd", *(F.when(cd if c != "indexacao" else ~cd, F.col(c)).alias(c) for c in CONTEXT_COLUMNS))
    return first_per_key(shaped, [key, "casa_cd"], CONTEXT_COLUMNS)


def with_context(stage: DataFrame, contexts: DataFrame, key: str = "uri") -> DataFrame:
    """``stage`` with the context of its own house by ``key`` (nulls where none was fetched).

    Rows without a uri have no context and do not take part in the join, where they would meet in one task.
    """
    none = [F.lit(None).cast("string").alias(c) for c in CONTEXT_COLUMNS]
    tagged = contexts.select(F.col(key).alias("_uri"), "casa_cd", *CONTEXT_COLUMNS)
    found = (stage.where(F.col(key).isNotNull())
             .join(tagged, (F.col(key) == F.col("_uri")) & (_is_chamber() == F.col("casa_cd")), "left")
             .select(*stage.columns, *CONTEXT_COLUMNS))
    return found.unionByName(stage.where(F.col(key).isNull()).select(*stage.columns, *none))


def context_texts(stage: DataFrame, contexts: DataFrame, row_id: str, key: str = "uri") -> DataFrame:
    """(row_id, contexto): the proposal's lines of the prompt, with the lines of its context (L1)."""
    return with_context(stage, contexts, key).select(row_id, context_block().alias("contexto"))
