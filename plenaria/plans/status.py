"""Stage 2: legislative status (C4: F8, F9, J4, X7, F12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenaria.functions import labels
from plenaria.functions.json_fields import status_fields
from plenaria.functions.util import col, in_list, let
from plenaria.operators.filters import valid_id
from plenaria.sources import landing


#: Prefix of a Senate matter's internal id (fixed value); Chamber ids have none.
SENATE_PREFIX = "SF-"


def matter_code(id_interno) -> Column:
    """The id under which a house's service knows a proposal: the internal id without the Senate's prefix."""
    return F.regexp_replace(col(id_interno), f"^{SENATE_PREFIX}", "")


def internal_id(house, code) -> Column:
    """The internal id of a service's id."""
    return F.when(col(house) == "CD", col(code)).otherwise(F.concat(F.lit(SENATE_PREFIX), col(code)))


def status_table(responses: DataFrame, raw: str = "raw", house: str = "casa", code: str = "chave") -> DataFrame:
    """(id_interno, situacao, norma_data_pub, norma_url) from both houses' landed responses, one row per id (C4).

    Each house has its own payload; a row is parsed by its house's rule only, so no response is parsed twice and the two
    schemas meet in one table without a join.  A response that cannot be read gives ''.  Of an id that landed more
    than once a response with a situation wins, then the largest (situacao, norma_data_pub, norma_url).
    """
    chamber = F.from_json(F.col(raw), landing.CHAMBER_DETAIL)["dados"]["statusProposicao"]
    empty = F.lit("")
    fields = F.when(F.col(house) == "CD", F.struct(
        F.coalesce(chamber["descricaoSituacao"], empty).alias("situacao"), empty.alias("norma_data_pub"),
        F.coalesce(chamber["url"], empty).alias("norma_url")))
    senate = status_fields(F.col(raw), **landing.SENATE_STATUS)
    fields = fields.otherwise(let(senate, lambda s: F.struct(
        s["situacao"].alias("situacao"), s["data_situacao"].alias("norma_data_pub"), empty.alias("norma_url"))))
    rows = responses.select(internal_id(house, code).alias("id_interno"), fields.alias("f")).where(F.col("id_interno").isNotNull())
    return rows.groupBy("id_interno").agg(F.max("f").alias("f")).select("id_interno", "f.*")


def enrich_status(stage1: DataFrame, status: DataFrame, key: str = "id_interno") -> DataFrame:
    """Attach ``situacao`` and its harmonised label.

    ``status``: (key, situacao), one row per id, the fetched status of each
    proposal.  Chamber rows always look theirs up; Senate/Congress rows only with a
    valid process id; every other row gets ''.  Equi-join on the id.
    """
    eligible = ((F.col("origem") == "CD")
                | (in_list(F.col("origem"), ["SF", "CN"]) & valid_id("id_processo")))
    src = status.select(F.col(key), F.col("situacao").alias("_sit"))
    out = (stage1.join(src, key, "left")
           .withColumn("situacao", F.when(eligible, F.coalesce(F.col("_sit"), F.lit(""))).otherwise(F.lit("")))
           .drop("_sit"))
    return out.withColumn("situacao_norm", labels.status_label("situacao"))
