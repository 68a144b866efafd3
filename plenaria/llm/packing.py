"""Best-fit packing of documents into sequences by sums of squares (Csirik, Johnson, Kenyon, Orlin, Shor, Weber).

A piece goes into an open sequence of residual gap g, or a new one, such that the sum over all gaps of the squared number
of open sequences with that gap becomes smallest: gaps stay evenly supplied, so that later pieces find one that fits.

Documents are cut into pieces in the map stage; full pieces are sequences of their own, and the others are dealt to
groups of about GROUP pieces by a hash of their place in the written table, so that copies, repeated rows and a hot
source spread over all groups.  A group is packed in one task from its (place, length) pairs, longest first, on the
squared counts of the at most ``size`` gaps; it leaves about as many sequences part empty as one short list of pieces does, so the loss
does not grow with the table.  Only places and lengths are shuffled for it, never token ids.

Edge cases: a null or empty text is a document of one token, the end token; a null doc_id is kept; repeated rows are
documents of their own; an empty table gives an empty result; other columns are not read, whatever their names; the longest
text is one row of a task and gives as many pieces as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm.common import ship, table, written
from plenaria.llm.word_tokens import default_path, encoder, slices

SIZE = 4096        # tokens of a sequence
END_ID = 1
GROUP = 50_000     # pieces packed together


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids: every document's token ids and ``end_id``, cut every ``size`` tokens.  ids are
    little-endian unsigned 32-bit numbers."""
    path = path or default_path()
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for low, high in slices(batch["text"]):
                ids, count = encode(batch["text"].slice(low, high - low))
                ids = np.insert(ids, np.cumsum(count), end_id)      # after each document
                count = count + 1
                parts = -(-count // size)
                doc = np.repeat(np.arange(high - low), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * size
                length = np.minimum(size, count[doc] - start)
                end = np.cumsum(length) * 4
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [
                    None, pa.py_buffer(np.concatenate([[0], end]).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(low, high - low).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), data.cast(pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary"))


def sum_of_squares(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each of ``lengths`` (1 to ``size``), placed longest first."""
    twice = np.zeros(size + 1, dtype=np.int64)       # twice the open sequences of a gap: what a change of the sum needs
    twice[0] = -1                                    # a full sequence leaves the sum and adds nothing to it
    open_: list[list[int]] = [[] for _ in range(size)]
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    used, closed = 0, np.int64(1) << 40
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        gap = size
        if n < size:
            # with N sequences of gap g and M of gap g - n, the sum changes by 2 M - 2 N + 2 (1 - 2 N if g = n)
            change = twice[:size - n] - twice[n:size]
            change[twice[n:size] == 0] = closed
            at = int(change.argmin())
            if change[at] + 2 <= twice[size - n] + 1:
                gap = at + n
        if gap == size:
            sequence[i], used = used, used + 1
        else:
            sequence[i] = open_[gap].pop()
            twice[gap] -= 2
        offset[i] = size - gap
        if gap > n:
            twice[gap - n] += 2
            open_[gap - n].append(int(sequence[i]))
    return sequence, offset


def packed(parts: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """``parts``, any rows with a column ``length`` of 1 to ``size``, and their sequence_id and offset in it."""
    spark = parts.sparkSession
    ship(spark)
    held = written(parts.withColumn("piece_uid", F.monotonically_increasing_id()), "packing-pieces")
    short = held.where(F.col("length") < size)
    groups = max(1, -(-short.count() // group))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), size)
        return pd.DataFrame({"uid": rows["uid"], "sequence_id": (sequence << 24) + key[0], "offset": offset})

    placed = (short.select(F.pmod(F.xxhash64("piece_uid"), F.lit(groups)).alias("part"), F.col("piece_uid").alias("uid"), "length")
              .groupBy("part").applyInPandas(place, "uid long, sequence_id long, offset long"))
    rows = held.join(placed, F.col("piece_uid") == F.col("uid"), "left")
    # a full piece is a sequence of its own, known by its place: negative numbers are theirs
    return (rows.withColumn("sequence_id", F.coalesce("sequence_id", -1 - F.col("piece_uid")))
            .withColumn("offset", F.coalesce("offset", F.lit(0).cast("long"))).drop("piece_uid", "uid"))


def sequences(parts: DataFrame) -> DataFrame:
    """sequence_id, ids, docs (doc_id, piece, offset, length by offset): the packed sequences of ``packed(pieces(...))``."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return (parts.groupBy("sequence_id").agg(rows.alias("rows"))
            .select("sequence_id", F.expr("aggregate(rows, cast('' as binary), (a, r) -> concat(a, r.ids))").alias("ids"),
                    F.transform("rows", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["piece"].alias("piece"),
                                                           r["offset"].alias("offset"), r["length"].alias("length"))).alias("docs")))


def op13_square_sum_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(cut)
