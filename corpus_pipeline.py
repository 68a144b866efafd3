"""From documents to sharded training data: language, near-duplicates, decontamination, mixture, shards.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and reread as the next one's docs.  All but the last return the columns of documents, whatever
they are; the last adds the shard and puts the rows of a shard in the order of the mixture.  ``run`` also returns
each row's slot and seq in the mixture.  Rows are known by id and text, so null and repeated ids are safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm import decontaminate, jaccard_join, language, mixing, sharding
from plenaria.llm.common import drop_rows, free_name, table, written

#: Near-duplicates: shingles of five words, Jaccard similarity 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be told."""
    found = language.identify(language.document_records(docs))
    return drop_rows(docs, found.where(~F.col("accepted")).withColumnRenamed("id", "doc_id"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays, once.  Rows without words are no one's copies
    and all stay, repeated ones too."""
    groups = jaccard_join.joined(docs, NEAR_WORDS, NEAR_PERCENT)
    rest = written(groups.where(F.col("n_shingles") > 0), "pipeline-groups")
    # a component's first row: smallest id, then smallest text hash; documents without words are no one's copies
    first = rest.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
                                          .alias("first"))
    first = first.select("component", F.col("first.doc_id").alias("f_id"), F.col("first.text_hash").alias("f_hash"))
    gone = (rest.join(first, "component")
            .where(~F.col("doc_id").eqNullSafe(F.col("f_id")) | (F.col("text_hash") != F.col("f_hash"))))
    again = (rest.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where(F.col("n") > 1).limit(1).count() > 0)
    kept = drop_rows(docs, gone.select("doc_id", "text_hash"))
    if not again:
        return kept
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.where(worded).dropDuplicates(["doc_id", "text"]).unionAll(kept.where(~worded))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_rows(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def in_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixing.mixed_order(docs, *mixing.source_shares(docs, mixing.SHARES, mixing.OTHER_SHARE))


def placed(docs: DataFrame) -> DataFrame:
    """All documents with their shard and their slot and seq in the mixture, ordered by these three."""
    shard, slot, seq = (free_name(docs, name) for name in ("shard", "slot", "seq"))
    shares = mixing.source_shares(docs, mixing.SHARES, mixing.OTHER_SHARE)
    rows = mixing.with_place(sharding.assigned(docs, shard_col=shard), *shares, slot, seq)
    return rows.repartitionByRange(shard, slot, seq).sortWithinPartitions(shard, slot, seq)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard, the rows of a shard in the order of the mixture."""
    return placed(docs).select(*docs.columns, free_name(docs, "shard"))


STAGES = [
    ("language", in_known_language),
    ("near-copies", without_near_copies),
    ("decontamination", decontaminated),
    ("mixture", in_mixture),
    ("shards", in_shards),
]

#: Language models, edit distances and connected components are beyond SQL; the stages have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are left, with shard, slot and seq: ordered by slot and seq, a shard follows the mixture.  The
    order of files is not one that a reader must keep, so the places are columns here."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return written(placed(docs), "pipeline-shards")
