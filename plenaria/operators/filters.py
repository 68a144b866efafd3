"""Null-safe filters and the dashboard facet filter."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions import authors, labels, text
from plenaria.functions.util import col, in_list


def exclude_values(df: DataFrame, c: str, values) -> DataFrame:
    """Drop rows whose value is in ``values``; nulls are kept (plain ``~isin`` drops them)."""
    return df.filter(F.coalesce(~in_list(F.col(c), values), F.lit(True)))


def exclude_pattern(df: DataFrame, c: str, pattern: str) -> DataFrame:
    """Drop rows whose text matches ``pattern`` case-insensitively; nulls are kept."""
    return df.filter(~F.coalesce(F.col(c).rlike("(?iU)" + pattern), F.lit(False)))


def require_key(df: DataFrame, c: str) -> DataFrame:
    """Drop rows without a key (null or empty text)."""
    return df.filter(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))


def valid_id(c) -> Column:
    """Not null, not '' and not the placeholder."""
    return text.is_present(c)


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls only ('' stays '')."""
    return df.na.fill(values)


@dataclass
class FacetSpec:
    """Optional dashboard facets; an empty list means no filter."""
    origem: list = field(default_factory=list)        # house labels
    grupo: list = field(default_factory=list)         # type groups
    tipo: list = field(default_factory=list)          # type labels
    legislatura: list = field(default_factory=list)
    autor: list = field(default_factory=list)         # author groups
    espectro: list = field(default_factory=list)
    partido: list = field(default_factory=list)       # normalised parties
    politico: list = field(default_factory=list)      # normalised person names
    regiao: list = field(default_factory=list)
    uf: list = field(default_factory=list)
    termo: list = field(default_factory=list)
    ano: tuple | None = None                          # inclusive (first, last)


def facet_predicate(spec: FacetSpec) -> Column:
    """Conjunction of the active facets over the data-mart columns."""
    preds = []
    if spec.origem:
        preds.append(in_list(F.col("origem_extenso"), spec.origem))
    if spec.grupo:
        preds.append(F.coalesce(in_list(labels.type_group("tipo"), spec.grupo), F.lit(False)))
    if spec.tipo:
        preds.append(in_list(F.col("tipo_extenso"), spec.tipo))
    if spec.legislatura:
        preds.append(in_list(F.col("legislatura"), spec.legislatura))
    if spec.regiao:
        preds.append(in_list(F.col("regiao"), spec.regiao))
    if spec.uf:
        preds.append(F.coalesce(F.exists(text.tokens("uf"), lambda t: in_list(t, spec.uf)), F.lit(False)))
    if spec.termo:
        preds.append(in_list(F.col("termo_busca"), spec.termo))
    if spec.autor:
        preds.append(in_list(authors.author_group("tipo_autor"), spec.autor))
    if spec.espectro:
        preds.append(in_list(F.col("espectro"), spec.espectro))
    if spec.partido:
        preds.append(F.coalesce(F.exists(
            text.tokens("tipo_autor"),
            lambda t: in_list(authors.normalise_party(t, dashboard=True), spec.partido)), F.lit(False)))
    if spec.politico:
        preds.append(F.coalesce(F.exists(
            F.split(F.col("parlamentar"), "[;,]"),
            lambda n: in_list(text.person_name(n), spec.politico)), F.lit(False)))
    if spec.ano:
        preds.append(F.col("ano_int").between(spec.ano[0], spec.ano[1]))
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def facet_filter(df: DataFrame, spec: FacetSpec) -> DataFrame:
    return df.filter(facet_predicate(spec))


def exclude_institutional(df: DataFrame, c: str, names=vocab.INSTITUTIONAL) -> DataFrame:
    return df.filter(F.coalesce(~in_list(col(c), names), F.lit(True)))
