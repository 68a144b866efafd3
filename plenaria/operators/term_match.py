"""Text-contains-term matching.

A small term list compiles into one case-insensitive alternation that runs as a
map-side expression over whole texts; Java's alternation is leftmost-first, so
the earliest position wins and, at one position, the earlier term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenaria.functions.util import col

_SPECIAL = set("\\.^$|?*+()[]{}")


def escape(term: str) -> str:
    """Escape regex metacharacters (portable to Java and RE2)."""
    return "".join("\\" + ch if ch in _SPECIAL else ch for ch in term)


def alternation(terms) -> str:
    return "(" + "|".join(escape(t) for t in terms) + ")"


def term_pattern(terms) -> str:
    """Case- and accent-case-insensitive pattern for Java (``(?iu)``)."""
    return "(?iu)" + alternation(terms)


def first_term(text, terms) -> Column:
    """Leftmost matching term, lower-cased; null when nothing matches."""
    found = F.regexp_extract(col(text), term_pattern(terms), 0)
    return F.nullif(F.lower(found), F.lit(""))


def with_first_term(df: DataFrame, text: str, terms, out: str = "termo") -> DataFrame:
    """The rows that match a term, with their first one.

    A filter on a projected match is pushed below the projection and searches every text again; a generator's
    output cannot be, so each text is searched once.
    """
    found = F.array(F.lower(F.regexp_extract(col(text), term_pattern(terms), 0)))
    return df.withColumn(out, F.explode(found)).filter(F.col(out) != "")


def all_terms(df: DataFrame, text: str, terms, keep: list[str], out: str = "termo") -> DataFrame:
    """One row per (row, term occurrence): every non-overlapping match, lower-cased."""
    hits = F.regexp_extract_all(col(text), F.lit(term_pattern(terms)), 0)
    return df.select(*keep, F.explode(hits).alias(out)).withColumn(out, F.lower(F.col(out)))


def term_counts(df: DataFrame, text: str, terms, key: list[str], out: str = "termo") -> DataFrame:
    """Occurrences per (key, term), counted where the matches are produced."""
    return (all_terms(df, text, terms, key, out)
            .groupBy(*key, out).agg(F.count(F.lit(1)).alias("n")))
