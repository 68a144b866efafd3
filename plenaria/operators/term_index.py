"""Whole-word matching of a large term list (J7): an index of word n-grams joined by equality.

A short list is one alternation over each text (``term_match``); its cost grows with terms times characters.  Here texts and
terms are cut into words once, every run of as many words as some term has becomes a row (place, number of words, run), and
the rows meet the terms in an equi-join, so the cost does not depend on the number of terms.  A term list is broadcast
only after its rows were counted; beyond ``BROADCAST_ROWS`` the join shuffles on the run, which AQE splits where a run is common.

At one place the longest term wins, and matches do not overlap: what an alternation finds whose terms are ordered by
length, between word boundaries.  Words are runs of letters and digits, compared in lower case, so any white space and marks may
stand between a term's words.  Null and empty texts match nothing; terms without words are ignored; terms that are equal word by
word are one.  Every text row needs a unique ``key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenaria.functions.util import col

WORD = r"[\p{L}\p{N}]+"
BROADCAST_ROWS = 200_000


def words(text) -> Column:
    """The words of a text, in lower case."""
    return F.transform(F.regexp_extract_all(col(text), F.lit(WORD), 0), F.lower)


def term_table(terms: DataFrame, term: str = "termo") -> DataFrame:
    """run, n: the distinct terms as their words, joined by blanks, and how many these are."""
    return (terms.select(words(term).alias("w")).where(F.size("w") > 0)
            .select(F.array_join("w", " ").alias("run"), F.size("w").alias("n")).distinct())


def runs(texts: DataFrame, key: list[str], text: str, lengths: list[int]) -> DataFrame:
    """key, place, n, run: every run of ``lengths`` words of every text."""
    def of(n: int) -> Column:
        last = F.size("w") - n
        return F.when(last >= 0, F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(i.alias("place"), F.lit(n).alias("n"), F.array_join(F.slice("w", i + 1, n), " ").alias("run"))))

    none = F.array().cast("array<struct<place:int,n:int,run:string>>")
    cut = texts.select(*key, words(text).alias("w"))
    return cut.select(*key, F.explode(F.concat(*(F.coalesce(of(n), none) for n in lengths))).alias("r")).select(*key, "r.*")


def hits(texts: DataFrame, terms: DataFrame, key: list[str], text: str, term: str = "termo") -> DataFrame:
    """key, place, n, run for every place at which a term stands, overlapping ones included."""
    index = term_table(terms, term)
    # one small row per number of words: as many as the longest term has at most
    sizes = index.groupBy("n").count().collect()
    if not sizes:
        return texts.select(*key).limit(0).selectExpr("*", "0 AS place", "0 AS n", "'' AS run")
    if sum(r["count"] for r in sizes) <= BROADCAST_ROWS:
        index = F.broadcast(index)
    found = runs(texts, key, text, sorted(r["n"] for r in sizes))
    return found.join(index.withColumnRenamed("n", "term_n"), "run").where(F.col("n") == F.col("term_n")).drop("term_n")


def first_index_term(texts: DataFrame, terms: DataFrame, key: list[str], text: str, term: str = "termo") -> DataFrame:
    """key and the leftmost term, the longest one there, for the texts that hold one."""
    best = F.min(F.struct("place", (-F.col("n")).alias("less"), "run")).alias("m")
    return hits(texts, terms, key, text, term).groupBy(*key).agg(best).select(*key, F.col("m.run").alias(term))


def index_term_counts(texts: DataFrame, terms: DataFrame, key: list[str], text: str, term: str = "termo") -> DataFrame:
    """key, term, n: matches that do not overlap, leftmost and longest first, counted by term."""
    longest = (hits(texts, terms, key, text, term).groupBy(*key, "place").agg(F.max(F.struct("n", "run")).alias("m")))
    # a text's matches in order, at most one a word; a match counts if it starts where the last one that counts has ended
    placed = longest.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("place", "m.n", "m.run"))).alias("found"))
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<string>").alias("kept"))
    kept = F.aggregate("found", start, lambda s, x: F.when(
        x["place"] >= s["free"], F.struct((x["place"] + x["n"]).alias("free"), F.concat(s["kept"], F.array(x["run"])).alias("kept"))
    ).otherwise(s), lambda s: s["kept"])
    return placed.select(*key, F.explode(kept).alias(term)).groupBy(*key, term).agg(F.count(F.lit(1)).alias("n"))
