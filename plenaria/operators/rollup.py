"""Author roll-up per proposal (A12, N5, J5) and its enrichment join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.authors import author_kind
from plenaria.functions.util import in_list


def apply_profiles(authors: DataFrame, profiles: DataFrame) -> DataFrame:
    """Member-profile fallback: only for a member author with no party and a profile uri.

    ``profiles``: (uri, perfil_partido, perfil_uf), one row per uri.  The profile's
    party replaces the empty party; its state, when present, replaces the state.
    """
    need = ((F.coalesce(F.col("partido"), F.lit("")) == "")
            & (F.coalesce(F.col("uri"), F.lit("")) != "")
            & in_list(F.col("tipo"), vocab.MEMBER_TYPES))
    found = F.col("perfil_partido").isNotNull() | F.col("perfil_uf").isNotNull()
    joined = authors.join(profiles, "uri", "left").withColumn("_use", need & found)
    return (joined
            .withColumn("partido", F.when(F.col("_use"), F.coalesce(F.col("perfil_partido"), F.lit("")))
                        .otherwise(F.col("partido")))
            .withColumn("uf", F.when(F.col("_use"), F.coalesce(F.col("perfil_uf"), F.col("uf")))
                        .otherwise(F.col("uf")))
            .drop("perfil_partido", "perfil_uf", "_use"))


def author_rollup(authors: DataFrame, key: str, order: list[str],
                  proposal_types: DataFrame | None = None,
                  suggestion_type: str = "SUG") -> DataFrame:
    """One row per proposal: names in author order, non-empty states, distinct author kinds.

    ``authors``: one row per (proposal, author) with ``nome, partido, uf, tipo``
    and the ``order`` columns.  Author kinds keep first-seen order.  A proposal of
    ``suggestion_type`` (from ``proposal_types``: key, tipo) gets the popular
    author label instead.  One aggregate, with the per-proposal list sorted
    inside the group; the row width is the proposal's own author list.
    """
    kind = author_kind(F.col("partido"), F.col("tipo"))
    entry = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                     F.coalesce(F.col("nome"), F.lit("")).alias("nome"),
                     F.col("uf").alias("uf"), kind.alias("kind"))
    grouped = authors.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_a"))
    out = grouped.select(
        key,
        F.array_join(F.transform("_a", lambda x: x["nome"]), "; ").alias("parlamentar"),
        F.array_join(F.filter(F.transform("_a", lambda x: x["uf"]),
                              lambda u: u.isNotNull() & (u != "")), "; ").alias("uf"),
        F.array_join(F.array_distinct(F.transform("_a", lambda x: x["kind"])), "; ").alias("tipo_autor"))
    if proposal_types is None:
        return out
    t = proposal_types.select(F.col(proposal_types.columns[0]).alias(key), F.col("tipo").alias("_tipo"))
    return (out.join(t, key, "left")
            .withColumn("tipo_autor", F.when(F.col("_tipo") == suggestion_type, F.lit(vocab.POPULAR_AUTHOR))
                        .otherwise(F.col("tipo_autor")))
            .drop("_tipo"))


def enrich_authors(proposals: DataFrame, rollup: DataFrame, key: str) -> DataFrame:
    """Attach the roll-up by proposal id; proposals without authors get ''."""
    cols = ["parlamentar", "uf", "tipo_autor"]
    base = proposals.drop(*[c for c in cols if c in proposals.columns])
    joined = base.join(rollup, key, "left")
    return joined.select(*base.columns, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])
