"""First-wins merge across ingest batches (J13 with J10): an id that lands again keeps the lowest term position.

Batches are merged by keyed state.  For each id the stream keeps the best record so far, and appends a record to the table
only when it beats that one; the state and the files seen are in the checkpoint, so a run that is started again goes on
where the last one ended and a lost executor repeats its micro-batch from there.  The table therefore holds an id's winner
and the few records that once were (each beats the one before); ``merged`` reads the winners as one aggregate that combines
map-side.  Any division of the same files into batches and runs gives the same winners, because records are compared by
all their columns: term position first, then the others in order, nulls last.

The state is a streaming aggregate, the minimum of the records and of the time of the micro-batch that brought them: an id
that held a record before keeps that one's time, so the rows with the present time are those that beat what was held.  Each
micro-batch writes its rows to its own partition ``lote_merge`` of the table; one that is repeated has the same time (the offset
log keeps it) and replaces its partition.

An id may hold a large share of the rows: a map task sends one row of it.  With more than one of ``lanes``, an id's records are
also dealt by their hash: the state is keyed by id and lane, and each lane keeps its own best.  Records with a null id are one id.  The state has
one record per id and lane that has rows; a session that runs this at scale sets the RocksDB state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from plenaria import vocab
from plenaria.functions.util import lookup
from plenaria.operators.dedup import first_per_key, ordered_struct

POSITION = "termo_pos"
LANE = "faixa"
SINCE = "desde"
BATCH = "lote_merge"


def improvements(records: DataFrame, key: str = "id_interno", terms=vocab.SEARCH_TERMS, lanes: int = 1) -> DataFrame:
    """Streaming rows of ``records`` (text columns) that beat what their id and lane had, with ``termo_pos``; for output mode
    ``update``."""
    columns = records.columns
    if any(f.dataType != StringType() for f in records.schema.fields):
        raise ValueError("records must have text columns only")
    position = lookup({t: i for i, t in enumerate(terms)}, "termo_busca", len(terms)).cast("int")
    keyed = (records.withColumn(POSITION, position)
             .withColumn(LANE, F.pmod(F.xxhash64(*columns), F.lit(lanes)).cast("int"))
             .withColumn(SINCE, F.current_timestamp()))
    order = [POSITION, *(c for c in columns if c != key), SINCE]
    best = keyed.groupBy(key, LANE).agg(F.min(ordered_struct(order)).alias("_best"))
    picked = best.select(key, *(F.col("_best")[f"v{i}"].alias(c) for i, c in enumerate(order)))
    return picked.where(F.col(SINCE) == F.current_timestamp()).select(*columns, POSITION)


def merge_stream(records: DataFrame, out_dir: str, checkpoint: str, key: str = "id_interno",
                 terms=vocab.SEARCH_TERMS, lanes: int = 1) -> None:
    """Merge what has landed since the last run into the table ``out_dir``, then stop.

    ``records``: a streaming DataFrame with ``key`` and ``termo_busca``.  ``out_dir`` and ``checkpoint`` belong together, on
    shared storage; ``key``, ``terms`` and ``lanes`` must stay the same from run to run.
    """
    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/{BATCH}={number}")

    query = (improvements(records, key, terms, lanes).writeStream.foreachBatch(append)
             .option("checkpointLocation", checkpoint).outputMode("update")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def merged(spark: SparkSession, out_dir: str, key: str = "id_interno") -> DataFrame:
    """One record per id: the winner over all batches so far (without ``termo_pos``)."""
    return first_per_key(spark.read.parquet(out_dir).drop(BATCH), [key], [POSITION]).drop(POSITION)
