r"""Line dedup by a tree of log templates.

Lines are parsed by a tree of fixed depth (after Drain, He et al. 2017): the first level is the number of tokens, the
next LEAD levels the leading tokens, tokens with digits being variable from the start (``<*>``).  Within a leaf a
token stays constant at its position if lines of MIN_DOCS documents or more have it there, else the position is
variable for the line; what results is the line's template.  A template counts if SIMILARITY of its tokens are
constant.  A template has the texts of its own lines and of the recurring lines of its leaf that have its constant
tokens.  Lines whose template recurs in MIN_DOCS documents or more (equal texts count as one document) are dropped from
all of them.  A line of more than LONG_WORDS words is no chance repetition: it is dropped from LONG_DOCS
documents on.

The original grows its templates line by line; here all levels are grouped counts, so the result does not
depend on the order of the lines and no leaf meets in one task.  Most lines are settled by one narrow row each (leaf and
line hashes); tokens are looked at only in leaves that recur and hold a line that does not, once for each distinct line.

Edge cases: null and empty texts have no lines to drop and stay as they are; blank lines are kept; lines differing only in
white space or in tokens with digits are one line; rows equal in id and text have the same result; an
empty table gives an empty result; extra columns are ignored; very long lines are lines like others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm.common import BROADCAST_ROWS, broadcast_if_small, in_slices, ship, table, written

MIN_DOCS = 10
LONG_WORDS, LONG_DOCS = 50, 2    # a line of more words recurs from so many documents on
LEAD = 3
SIMILARITY = 0.7


_digit = re.compile("[0-9]")


def parsed(line: str) -> list[str]:
    """Tokens of a line, those with digits made variable; empty for a blank line."""
    tokens = line.split()
    return ["<*>" if _digit.search(t) else t for t in tokens] if _digit.search(line) else tokens


def line_hash(tokens: list[str]) -> int:
    value = xxhash.xxh3_64_intdigest(" ".join(tokens).encode())
    return value - (value >> 63 << 64)


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, place, leaf, line (hashes), words for every line that is not blank."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_slices(batches):
            at, places, leaves, found, sizes = [], [], [], [], []
            for row, text in enumerate(b["text"]):
                for place, line in enumerate(text.split("\n") if text else ()):
                    tokens = parsed(line)
                    if tokens:
                        at.append(row)
                        places.append(place)
                        sizes.append(len(tokens))
                        leaves.append(xxhash.xxh3_64_intdigest(f"{len(tokens)} {' '.join(tokens[:LEAD])}".encode()))
                        found.append(line_hash(tokens))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").iloc[at].to_numpy() if at else [],
                                "text_hash": b["text_hash"].iloc[at].to_numpy(), "place": places,
                                "leaf": np.array(leaves, dtype=np.uint64).view(np.int64),
                                "line": np.array(found, dtype=np.int64),
                                "words": sizes}).astype({"doc_id": "Int64", "place": "int32", "words": "int32"})

    return rows.mapInPandas(keys, "doc_id long, text_hash long, place int, leaf long, line long, words int")


def tokens_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """leaf, line, docs, tokens of wanted lines, each from the one document that ``wanted`` (doc_id, text_hash,
    wanted array<struct<leaf, line, docs>>) names."""
    rows = docs.select(F.col(id_col).alias("s_id"), F.xxhash64(text_col).alias("s_hash"), F.col(text_col).alias("text"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_slices(batches):
            found = []
            for text, lines_ in zip(b["text"], b["wanted"]):
                left = {w["line"]: w for w in lines_}
                for line in text.split("\n"):
                    if tokens := parsed(line):
                        w = left.pop(line_hash(tokens), None)
                        if w:
                            found.append((w["leaf"], w["line"], w["docs"], tokens))
            yield pd.DataFrame(found, columns=["leaf", "line", "docs", "tokens"])

    joined = rows.join(wanted, F.col("s_id").eqNullSafe(F.col("doc_id")) & (F.col("s_hash") == F.col("text_hash")))
    return (joined.select("text", "wanted").mapInPandas(read, "leaf long, line long, docs long, tokens array<string>")
            .dropDuplicates(["line"]))


def spread(once: DataFrame, templates: DataFrame, min_docs: int) -> DataFrame:
    """The templates that recur: with a line of ``min_docs`` texts or more in their leaf that has their constant tokens,
    or with so many texts in all.  ``once`` (line, text_hash) may repeat; ``templates`` is leaf, line, docs, t, template."""
    often, rare = templates.where(F.col("docs") >= min_docs), templates.where(F.col("docs") < min_docs)
    # a recurring line has the constant tokens of a template if it becomes it under its wildcards
    masks = rare.select("leaf", F.transform("t", lambda x: x == "<*>").alias("mask")).distinct()
    under = F.transform("t", lambda x, i: F.when(F.get("mask", i), "<*>").otherwise(x))
    matched = written(often.select("leaf", "t").distinct().join(masks, "leaf")
                      .select(F.xxhash64("leaf", under).alias("template")).distinct(), "line-matched")
    rare = rare.join(matched, "template", "left_anti")
    enough = rare.groupBy("template").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs).select("template")
    wanted = written(rare.join(enough, "template", "left_semi").select("line", "template"), "line-wanted-texts")
    texts = once.join(broadcast_if_small(wanted), "line").select("template", "text_hash").distinct()
    return matched.unionAll(texts.groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("template"))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, id_col: str = "doc_id",
              text_col: str = "text", long_words: int = LONG_WORDS, long_docs: int = LONG_DOCS) -> DataFrame:
    """doc_id, text_hash, places: the lines to drop, by row."""
    keys = written(lines(docs, id_col, text_col), "line-keys")
    once = keys.select("leaf", "line", "words", "text_hash").distinct()
    counted = written(once.groupBy("leaf", "line", "words").agg(F.count("*").alias("docs"), F.min("text_hash").alias("in_text")),
                      "line-counts")
    long = (F.col("words") > long_words) & (F.col("docs") >= long_docs)
    often = counted.where((F.col("docs") >= min_docs) | long).select("line")

    # all lines of the leaves that have enough of them and hold one that does not recur itself
    leaves = (counted.groupBy("leaf").agg(F.sum("docs").alias("n"), F.count("*").alias("lines"),
                                          F.bool_or((F.col("docs") < min_docs) & ~long).alias("open"))
              .where((F.col("n") >= min_docs) & (F.col("lines") > 1) & F.col("open")).select("leaf"))
    firsts = docs.groupBy(F.xxhash64(text_col).alias("text_hash")).agg(F.min(id_col).alias("doc_id"))
    wanted = (counted.join(leaves, "leaf", "left_semi").groupBy(F.col("in_text").alias("text_hash"))
              .agg(F.collect_list(F.struct("leaf", "line", "docs")).alias("wanted")).join(firsts, "text_hash"))
    wanted = written(wanted, "line-wanted")
    if (wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0) <= BROADCAST_ROWS:      # else the texts would be shuffled
        wanted = F.broadcast(wanted)
    tokens = written(tokens_of(docs, wanted, id_col, text_col), "line-tokens")
    placed = tokens.select("leaf", "line", "docs", F.posexplode("tokens").alias("pos", "token"))
    constant = (placed.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
                .where(F.col("token") != "<*>").select("leaf", "pos", "token", F.lit(True).alias("fixed")))
    templates = (placed.join(constant, ["leaf", "pos", "token"], "left")
                 .groupBy("leaf", "line", "docs")
                 .agg(F.sort_array(F.collect_list(F.struct("pos", F.when(F.col("fixed"), F.col("token")).otherwise("<*>").alias("token")))).alias("t"),
                      F.avg(F.coalesce(F.col("fixed").cast("int"), F.lit(0))).alias("share"))
                 .where(F.col("share") >= similarity)
                 .select("leaf", "line", "docs", F.transform("t", lambda x: x["token"]).alias("t"))
                 .withColumn("template", F.xxhash64("leaf", "t")))
    templates = written(templates, "line-templates")
    general = templates.join(spread(keys.select("line", "text_hash"), templates, min_docs), "template", "left_semi").select("line")
    gone = written(often.unionAll(general).distinct(), "line-gone")
    return (keys.join(broadcast_if_small(gone), "line", "left_semi")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places")))


def cleaned(docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, text (without the dropped lines) for every row."""
    places = (recurring(docs, min_docs, similarity, id_col, text_col)
              .withColumnsRenamed({"doc_id": "r_id", "text_hash": "r_hash"}))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = rows.join(places, rows["doc_id"].eqNullSafe(F.col("r_id")) & (F.xxhash64(rows["text"]) == F.col("r_hash")), "left")
    kept: Column = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("places", i))
    return joined.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"),
                         F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).alias("n_dropped"),
                         F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(table(spark, sf_dir, "documents"))
