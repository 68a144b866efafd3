"""All chart tables of the dashboard for one selection (C9 on C8): the base is filtered and written once, every view reads that.

The selection keeps only the columns that the views use, so the table that they share is narrow, and each view's scan reads
its own columns of it.  A view aggregates before it ranks, so what the views hold after their first aggregate is bounded by
categories and not by rows.  ``long_form`` puts views into one table, one row per cell.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenaria.operators.filters import FacetSpec, facet_filter
from plenaria.plans import mart
from plenaria.sources.stages import written

#: Columns of the base that the views below read.
BASE_COLUMNS = ["ano_int", "origem", "tipo", "legislatura", "tipo_autor", "parlamentar", "uf", "termo_busca", "score_lr",
                "espectro", "e_parlamentar"]

#: view -> (function of the base, its key columns, its count column, its value column)
VIEWS: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str], str | None, str | None]] = {
    "by_legislature": (mart.by_legislature, ["legislatura", "ordem"], "n", None),
    "by_year_house": (mart.by_year_house, ["ano_int", "origem"], "n", None),
    "type_mix": (mart.type_mix, ["legislatura", "tp"], "n", "pct"),
    "author_groups": (mart.author_groups, ["categoria"], "n", None),
    "party_author_tree": (mart.party_author_tree, ["partido", "parlamentar"], "n", None),
    "by_state": (mart.by_state, ["uf"], "n", None),
    "top_states": (mart.top_states, ["uf"], "n", None),
    "term_mix": (mart.term_mix, ["legislatura", "termo_busca"], "n", "pct"),
    "top_authors": (mart.top_authors, ["parlamentar"], "n", None),
    "party_term_matrix": (mart.party_term_matrix, ["p_plot", "termo_busca"], "n", None),
    "party_type_flow": (mart.party_type_flow, ["p_sk", "tipo"], "n", None),
    "ideology_by_leg_group": (mart.ideology_by_leg_group, ["legislatura", "grupo"], None, "score_lr"),
    "ideology_by_house": (mart.ideology_by_house, ["legislatura", "casa"], None, "score_lr"),
    "by_band": (mart.by_band, ["espectro"], "n", None),
    "ideology_by_state": (mart.ideology_by_state, ["uf"], None, "score_lr"),
    "lowest_state_scores": (mart.lowest_state_scores, ["uf"], None, "score_lr"),
}


def selected_views(base: DataFrame, spec: FacetSpec, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The views ``names`` (all by default) over the rows of ``base`` that ``spec`` selects.  Starts jobs."""
    held = written(facet_filter(base, spec).select(*BASE_COLUMNS), "dashboard")
    return {name: VIEWS[name][0](held) for name in (VIEWS if names is None else names)}


def long_form(views: dict[str, DataFrame]) -> DataFrame:
    """(visao, chave1, chave2, n, valor): the cells of all ``views``; what a view does not have is null."""
    def cells(name: str, df: DataFrame) -> DataFrame:
        _, keys, count, value = VIEWS[name]
        key = [F.col(c).cast("string") for c in keys] + [F.lit(None).cast("string")] * (2 - len(keys))
        return df.select(F.lit(name).alias("visao"), key[0].alias("chave1"), key[1].alias("chave2"),
                         (F.col(count) if count else F.lit(None)).cast("bigint").alias("n"),
                         (F.col(value) if value else F.lit(None)).cast("double").alias("valor"))

    return reduce(DataFrame.unionByName, [cells(name, df) for name, df in views.items()])
