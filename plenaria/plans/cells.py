"""KPIs of any selection from one pre-aggregated table (K1-K8, A4, A18 under F11).

``kpi_cells`` counts the base once per combination of the columns that facets read.  The members of a combination are kept as
words of a bitmap (``operators.distinct_words``), so rows of the table add up: a selection filters its rows, and totals, shares
and exact distinct members come from what is left, without the base.  The table has at most one row per combination and word
that occurs, and never more rows than the base.

The facet on persons (F11k) reads the names themselves, which are no column of the table: ``kpis_from_cells`` refuses it, and
``operators.token_index`` answers it on the base.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenaria.functions import text
from plenaria.operators.distinct_words import dense_ids, distinct_count, merged_bits, with_words
from plenaria.operators.filters import FacetSpec, facet_filter
from plenaria.plans.mart import ROUND
from plenaria.sources.stages import written

#: What facets read, but the persons' names; several follow from others and add no combinations.
KEYS = ["ano_int", "origem", "origem_extenso", "tipo", "tipo_extenso", "legislatura", "regiao", "uf", "termo_busca", "tipo_autor",
        "espectro"]
COUNTS = ["n", "promulgada", "de_membros", "popular"]


def kpi_cells(base: DataFrame) -> DataFrame:
    """KEYS, palavra, COUNTS, bits: the table all selections read.  Null keys are values like any other.  Starts jobs."""
    rows = written(base.select(*KEYS, F.col("e_parlamentar"), (F.col("situacao_norm") == "Promulgada").alias("_promulgada"),
                               F.when(F.col("e_parlamentar"), F.col("parlamentar")).alias("membro")), "cell-rows")
    ids = dense_ids(rows, "membro")
    popular = (F.col("tipo") == "SUG") | text.contains_or_false("tipo_autor", "Popular")
    cells = (with_words(rows, "membro", ids).groupBy(*KEYS, "palavra")
             .agg(F.count(F.lit(1)).alias("n"), F.count_if("_promulgada").alias("promulgada"),
                  F.count_if("e_parlamentar").alias("de_membros"), F.count_if(popular).alias("popular"),
                  merged_bits().alias("bits")))
    return written(cells, "cells")


def kpis_from_cells(cells: DataFrame, spec: FacetSpec = FacetSpec()) -> DataFrame:
    """The eight headline numbers of a selection (one row, as ``mart.kpis`` gives them)."""
    if spec.politico:
        raise ValueError("cells do not hold persons' names; select persons on the base")
    chosen = facet_filter(cells, spec)
    by_house = {c: F.sum(F.when(F.col("origem") == h, F.col("n"))) for c, h in (("cd", "CD"), ("sf", "SF"), ("cn", "CN"))}
    sums = [*COUNTS, *by_house, "mpv"]
    parts = chosen.groupBy("ano_int", "palavra").agg(
        *(F.sum(c).alias(c) for c in COUNTS), *(s.alias(c) for c, s in by_house.items()),
        F.sum(F.when(F.col("tipo") == "MPV", F.col("n"))).alias("mpv"), merged_bits().alias("bits"))
    # years once and words once: both are few by now
    sides = (parts.groupingSets([["ano_int"], ["palavra"]], "ano_int", "palavra")
             .agg(F.grouping("ano_int").alias("de_palavra"), *(F.sum(c).alias(c) for c in sums), merged_bits().alias("bits")))
    of_word, of_year = F.col("de_palavra") == 1, F.col("de_palavra") == 0
    whole = sides.agg(*(F.sum(F.when(of_word, F.col(c))).alias(c) for c in sums),
                      F.count_if(of_year & F.col("ano_int").isNotNull()).alias("anos"),
                      F.coalesce(F.sum(F.when(of_word, F.bit_count(F.col("bits")).cast("long"))), F.lit(0).cast("long"))
                      .alias("n_parlamentares"))
    total = F.coalesce(F.col("n"), F.lit(0).cast("long"))

    def pct(c):
        return F.when(total > 0, F.round(F.lit(100.0) * F.coalesce(F.col(c), F.lit(0)) / total, ROUND))

    return whole.select(
        total.alias("total"), F.round(total / F.greatest(F.col("anos"), F.lit(1)), ROUND).alias("media_ano"),
        pct("cd").alias("pct_cd"), pct("sf").alias("pct_sf"), pct("cn").alias("pct_cn"), pct("promulgada").alias("pct_promulgada"),
        "n_parlamentares",
        F.round(F.try_divide(F.col("de_membros"), F.nullif("n_parlamentares", F.lit(0))), ROUND).alias("por_parlamentar"),
        pct("popular").alias("pct_popular"), pct("mpv").alias("pct_mpv"))


def members_by(cells: DataFrame, levels: list[str]) -> DataFrame:
    """Proposals and distinct members for every prefix of ``levels`` (the whole first: all null), ``nivel`` = its length.

    One pass over the table gives the finest level by word; the coarser ones are its rows combined."""
    finest = cells.groupBy(*levels, "palavra").agg(F.sum("n").alias("n"), merged_bits().alias("bits"))
    prefixes = [[*levels[:i], "palavra"] for i in range(len(levels) + 1)]
    nivel = sum((F.lit(1) - F.grouping(c) for c in levels), F.lit(0)).cast("int")
    words = (finest.groupingSets(prefixes, *levels, "palavra")
             .agg(nivel.alias("nivel"), F.sum("n").alias("n"), merged_bits().alias("bits")))
    return words.groupBy("nivel", *levels).agg(F.sum("n").cast("bigint").alias("n"), distinct_count().alias("n_parlamentares"))
