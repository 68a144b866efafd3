"""Incremental ingestion of landed responses (the reference's "skip what is done").

The original job re-runs year by year and skips year files that already exist.
The Spark form is a Structured Streaming file source with an ``availableNow``
trigger: every landed file is processed exactly once (the checkpoint records
which files were read), a re-run only picks up new files, and a lost executor
is recovered from the checkpoint.  Checkpoints and outputs belong on shared
storage (the folder named by ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.util import lookup
from plenaria.sources.landing import chamber_records


def plain(term: str) -> str:
    """A term as a file name spells it: lower case, without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", term.lower()) if not unicodedata.combining(c))


#: File names have no accents; the term a page was found by does.
TERM_OF_SLUG = {plain(t): t for t in vocab.SEARCH_TERMS}


def landed_pages(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of landed page files: one JSON response per line -> (pagina, termo_busca, raw).

    Landing files are named ``<term>__<anything>.json``; the term is recovered from
    the file name, accents included, so that a page keeps the search term that found it; a name that spells no
    known term is kept as it is.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landing_dir)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    slug = F.regexp_replace(F.regexp_extract(name, r"^(.*?)__", 1), "_", " ")
    return lines.select(F.col("_metadata.file_path").alias("pagina"),
                        lookup(TERM_OF_SLUG, F.lower(slug), slug).alias("termo_busca"),
                        F.col("value").alias("raw"))


def ingest_pages(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str) -> int:
    """Parse every not-yet-seen landed page into proposal records appended under ``out_dir``.

    Runs until the files present at start are processed, then stops; returns the
    number of micro-batches run.
    """
    records = chamber_records(landed_pages(spark, landing_dir), keep=("pagina", "termo_busca"))
    query = (records.writeStream.format("parquet")
             .option("checkpointLocation", checkpoint)
             .outputMode("append")
             .trigger(availableNow=True)
             .start(out_dir))
    query.awaitTermination()
    return len(query.recentProgress)
