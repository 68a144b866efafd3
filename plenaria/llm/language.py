"""Language identification by Bayesian evidence fusion.

For every record and language the posterior combines

* the text: character trigrams under per-language models, the log-likelihood scaled down to that of at most
  ``EFFECTIVE`` independent trigrams (neighbouring trigrams are not independent),
* the declared markup language: P(declared | language) from counts of declared values by language as read from
  the text alone, over all records,
* the address suffix: P(suffix | language), counted the same way,
* the host: P(language | host), smoothed towards its parent, the parent towards the whole collection (each with
  KAPPA records' weight), a record's own text taken out of its host's and parent's counts.

The counts are grouped sums over all records.  Only the trigram models are fitted on a sample, at most SAMPLE labelled
records per language, taken in order of a hash of the id; they have 2^16 hashed trigrams per language.

A record is rejected ('und') if its text has no letters, if its trigrams are less likely under the best
language than under no language at all (all hashed trigrams alike), or if the best posterior is under MIN_POSTERIOR.

Edge cases: null, empty and letterless texts are rejected; null or unlisted declared languages, suffixes and hosts are
values like any other (null: no evidence, except that records without a host share the collection's prior); repeated
rows are counted as rows; ties go to the language listed first; an empty table gives an empty result; without
labelled records all models are flat and the other evidence decides; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenaria.llm.common import in_slices, ship, table, written

LANGUAGES = ("en", "de", "fr", "es")
SAMPLE = 300
BUCKETS = 1 << 16
EFFECTIVE = 40
KAPPA = 20.0
MIN_POSTERIOR = 0.5


def trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of the lower-case text, everything but letters being one blank; empty without letters."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype=np.uint32)
    letter = ((code >= 97) & (code <= 122)) | ((code >= 0xAA) & (code != 0xD7) & (code != 0xF7) & (code < 0x2000)) | (code >= 0x2C00)
    if not letter.any():
        return np.zeros(0, dtype=np.int64)
    code = np.where(letter, code, 32).astype(np.uint64)
    keep = np.append(True, letter[1:] | letter[:-1])
    code = np.concatenate([[np.uint64(32)], code[keep], [np.uint64(32)]])
    h = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1] * np.uint64(0x85EBCA77) + code[2:] * np.uint64(0xC2B2AE3D))
    return ((h ^ (h >> np.uint64(15))) % np.uint64(BUCKETS)).astype(np.int64)


def fit(labelled: DataFrame, languages: tuple = LANGUAGES, sample: int = SAMPLE) -> np.ndarray:
    """Log-probabilities [trigram, language] from at most ``sample`` records (id, text, declared) per language."""
    ship(labelled.sparkSession)
    order = Window.partitionBy("declared").orderBy(F.xxhash64("id"), "id")
    picked = (labelled.where(F.col("declared").isin(*languages)).select("id", "declared")
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample)
              .select(F.col("id").alias("p_id")).distinct())
    texts = (labelled.join(F.broadcast(picked), F.col("id") == F.col("p_id"), "left_semi")   # at most sample * languages ids
             .where(F.col("declared").isin(*languages)).select("declared", "text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, part in b.groupby("declared"):
                total = np.zeros(BUCKETS, dtype=np.int64)
                for text in part["text"]:
                    total += np.bincount(trigrams(text), minlength=BUCKETS)
                has = np.flatnonzero(total)
                yield pd.DataFrame({"declared": lang, "trigram": has, "n": total[has]})

    counts = np.full((BUCKETS, len(languages)), 0.5)
    sums = texts.mapInPandas(count, "declared string, trigram long, n long").groupBy("declared", "trigram").agg(F.sum("n").alias("n"))
    for r in sums.toLocalIterator():     # at most 2^16 rows per language
        counts[r["trigram"], languages.index(r["declared"])] += r["n"]
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def text_evidence(records: DataFrame, model: np.ndarray, languages: tuple = LANGUAGES) -> DataFrame:
    """The records without their texts, with the scaled log-likelihood t_<language> and known (language-like text)."""
    ship(records.sparkSession)
    sent = records.sparkSession.sparkContext.broadcast(model)     # 2^16 numbers per language
    names = [f"t_{x}" for x in languages]
    floor = -float(np.log(BUCKETS))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table_ = sent.value
        for b in in_slices(batches):
            rows, known = np.zeros((len(b), len(languages))), np.zeros(len(b), dtype=bool)
            for i, text in enumerate(b["text"]):
                grams = trigrams(text)
                if len(grams):
                    total = table_[grams].sum(axis=0, dtype=np.float64)
                    known[i] = total.max() / len(grams) > floor
                    rows[i] = (total - total.max()) * min(1.0, EFFECTIVE / len(grams))
            out = b.drop(columns="text").assign(known=known, **{n: rows[:, i] for i, n in enumerate(names)})
            yield out.assign(id=out["id"].astype("Int64"))

    return records.mapInPandas(score, "id long, text_hash long, declared string, suffix string, host string, parent string, "
                                      "known boolean, " + ", ".join(f"{n} double" for n in names))


def fuse(scored: DataFrame, languages: tuple = LANGUAGES) -> DataFrame:
    """id, text_hash, lang, posterior, accepted for scored records."""
    p = [f"p_{x}" for x in languages]
    whole = sum((F.exp(f"t_{x}") for x in languages[1:]), F.exp(f"t_{languages[0]}"))
    # what the text alone says; texts without letters say nothing
    rows = scored.select("*", *(F.when(F.col("known"), F.exp(f"t_{x}") / whole).otherwise(F.lit(0.0)).alias(c)
                                for x, c in zip(languages, p)))

    def sums(key: str, prefix: str) -> DataFrame:
        return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.sum(c).alias(f"{prefix}{c}") for c in p))

    every = written(rows.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in p)), "language-all").first()
    total = [every[c] + 1.0 for c in p]
    for key, prefix in (("declared", "d_"), ("suffix", "s_"), ("host", "h_"), ("parent", "q_")):
        rows = rows.join(written(sums(key, prefix), f"language-{key}"), key, "left")

    def outside(prefix: str, c: str):
        return F.greatest(F.coalesce(f"{prefix}{c}", F.lit(0.0)) - F.col(c), F.lit(0.0))

    parent_n = sum((outside("q_", c) for c in p[1:]), outside("q_", p[0]))
    host_n = sum((outside("h_", c) for c in p[1:]), outside("h_", p[0]))
    logs = []
    for x, c, n in zip(languages, p, total):
        prior = (outside("q_", c) + KAPPA * n / sum(total)) / (parent_n + KAPPA)
        prior = (outside("h_", c) + KAPPA * prior) / (host_n + KAPPA)
        log = F.col(f"t_{x}") + F.log(prior)
        for key, prefix in (("declared", "d_"), ("suffix", "s_")):
            log = log + F.when(F.col(key).isNull(), 0.0).otherwise(F.log((outside(prefix, c) + 0.5) / (n + 1.0)))
        logs.append(log)
    rows = rows.select("id", "text_hash", "known", F.array(*logs).alias("logs"))
    best = F.array_max("logs")
    posterior = 1 / F.aggregate("logs", F.lit(0.0), lambda a, v: a + F.exp(v - best))
    names = F.array(*map(F.lit, languages))
    accepted = F.col("known") & (F.col("posterior") >= MIN_POSTERIOR)
    return (rows.withColumn("posterior", posterior)
            .withColumn("best", names[F.array_position("logs", best).cast("int") - 1])
            .select("id", "text_hash", F.when(accepted, F.col("best")).otherwise("und").alias("lang"),
                    "posterior", accepted.alias("accepted")))


def document_records(docs: DataFrame) -> DataFrame:
    """Documents as records: ``lang`` is what they declare, ``source`` is their host."""
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text",
                       F.lower("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
                       F.col("source").alias("host"), F.lit(None).cast("string").alias("parent"))


def page_records(pages: DataFrame) -> DataFrame:
    """Web pages as records: markup language, top-level domain with the path's language folder, host, its domain."""
    host = F.lower(F.regexp_extract("url", "^[a-zA-Z]+://([^/:?#]+)", 1))
    folder = F.regexp_extract("url", "^[a-zA-Z]+://[^/?#]+/([a-z]{2})(?:[/?#]|$)", 1)
    declared = F.lower(F.regexp_extract("html", "<html[^>]*?\\slang=[\"']?([A-Za-z]{2})", 1))
    plain = F.regexp_replace("html", "(?s)<(script|style)[^>]*+>.*?</\\1>|<!--.*?-->|<[^>]*+>|&#?[a-zA-Z0-9]++;", " ")

    def given(c):
        return F.when(c != "", c)

    return (pages.select(F.col("page_id").cast("long").alias("id"), F.xxhash64("html").alias("text_hash"), plain.alias("text"),
                         given(declared).alias("declared"), given(host).alias("host"), folder.alias("folder"))
            .select("id", "text_hash", "text", "declared",
                    F.concat_ws("/", F.element_at(F.split("host", "\\."), -1), "folder").alias("suffix"),
                    "host", F.substring_index("host", ".", -2).alias("parent")))


def identify(records: DataFrame, languages: tuple = LANGUAGES, labelled: DataFrame | None = None) -> DataFrame:
    """id, text_hash, lang, posterior, accepted for records (id, text_hash, text, declared, suffix, host, parent); the
    models are fitted on ``labelled`` (the records themselves by default)."""
    model = fit(records if labelled is None else labelled, languages)
    return fuse(written(text_evidence(records, model, languages), "language-text"), languages)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(document_records(table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), "lang", F.round("posterior", 6).alias("posterior"), "accepted")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for web pages, with markup, address and host evidence; the text models come from the documents."""
    labelled = document_records(table(spark, sf_dir, "documents"))
    found = identify(page_records(table(spark, sf_dir, "pages")), labelled=labelled)
    return found.select(F.col("id").alias("page_id"), "lang", F.round("posterior", 6).alias("posterior"), "accepted")
