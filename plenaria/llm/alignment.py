"""Cross-tokenizer alignment with external spill counting of linked id pairs.

Every text is encoded by two tokenizers; bytes where tokens of both end cut them into groups, and every A token of a group
is linked with every B token of it.  A pair of ids counts the documents that hold it linked.

A map task aligns slices of about SLICE_BYTES of text.  The slice's (pair, document, times) records are sorted by pair, A id
first, radix-partitioned by the A id and kept as zstd runs on shared storage: the pairs with their numbers of documents apart
from the documents, so that counting moves neither documents nor texts, and a pair that every document has is one number a
slice.  The runs of a radix meet in one task in a k-way heap merge, which reads them in blocks.  The order is A id major, so an
A id's highest count is known when its last pair has passed; the counts then stream back to every run, in its own order.  With
more than FAN_IN runs a radix, groups of runs are first merged into runs of sums, and counts stream back through the same
merge.  Last, each run's records take their counts and are summed by document.

Edge cases: texts that are null, empty or not given back by their tokens have no tokens, zeros and an empty groups text;
special tokens' strings are plain text; a text is one row of a task, and its widest group is linked by distinct ids; null
and repeated ids and repeated rows are documents of their own; an empty table gives an empty result; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm.aligner import B_BITS, Words, aligner, default_paths, summed
from plenaria.llm.common import ship, table, written
from plenaria.llm.word_tokens import gather, slices

SLICE_BYTES = 6 << 20
RADIX = 16         # partitions of the A ids
FAN_IN = 512       # runs merged at once
BLOCK = 4096       # entries of a run decompressed at once

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
RUN = "slice long, radix int, pairs binary, sizes binary, records binary"


def packed(x: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, dtype=kind).tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def blocks(data: bytes, kind: str) -> Iterator[list[int]]:
    """The numbers of a run, BLOCK at a time."""
    with zstandard.ZstdDecompressor().stream_reader(data) as reader:
        size = BLOCK * np.dtype(kind).itemsize
        while part := reader.read(size):
            yield np.frombuffer(part, dtype=kind).tolist()


class Spill:
    """A run being written, BLOCK numbers at a time."""

    def __init__(self, kind: str):
        self.kind, self.held, self.out = kind, [], []
        self.coder = zstandard.ZstdCompressor(level=1).compressobj()

    def add(self, value: int) -> None:
        self.held.append(value)
        if len(self.held) == BLOCK:
            self.flush()

    def flush(self) -> None:
        self.out.append(self.coder.compress(np.array(self.held, dtype=self.kind).tobytes()))
        self.held = []

    def close(self) -> bytes:
        self.flush()
        return b"".join(self.out) + self.coder.flush()


def linked_slices(docs: DataFrame, paths: tuple[str, str], digest: bool, id_col: str, text_col: str) -> DataFrame:
    """One row of documents (radix -1) and one run per radix for every slice of ``docs``."""
    ship(docs.sparkSession)

    def runs(pairs, sizes, records):
        of = (pairs >> B_BITS) % RADIX
        by_record = np.repeat(of, sizes)
        for r in range(RADIX):
            mine = of == r
            if mine.any():
                yield r, packed(pairs[mine], "<u4"), packed(sizes[mine], "<u4"), b"".join(
                    [len(d := packed(records[0][by_record == r], "<u4")).to_bytes(8, "little"), d,
                     packed(records[1][by_record == r], "<u8")])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, number = aligner(*paths).align, itertools.count(TaskContext.get().partitionId() << 24)
        doc_type = pa.struct([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DOC.split(", ")])
        for batch in batches:
            for low, high in slices(batch["text"], SLICE_BYTES):
                words, index, count = align(batch["text"].slice(low, high - low))
                rows, pairs, sizes, records = align_rows(words, index, count, digest)
                ids = batch["doc_id"].slice(low, high - low)
                found = list(runs(pairs, sizes, records))
                docs_row = pa.StructArray.from_arrays([ids, *(pa.array(x) for x in rows)], fields=list(doc_type))
                n, k = len(ids), len(found) + 1
                lists = pa.ListArray.from_arrays(pa.array([0, n] + [n] * len(found), pa.int32()), docs_row)
                columns = list(zip(*found)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([next(number)] * k, pa.int64()), pa.array([-1, *columns[0]], pa.int32()),
                     *(pa.array([None, *c], pa.binary()) for c in columns[1:]), lists],
                    names=["slice", "radix", "pairs", "sizes", "records", "docs"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(link, f"{RUN}, docs array<struct<{DOC.replace(' long', ':long').replace(' string', ':string')}>>"))


def align_rows(words: Words, index: np.ndarray, count: np.ndarray, digest: bool):
    """Documents' columns and the slice's records: distinct pairs, documents of each, and (document, times) in their order."""
    n = len(count)
    ends = np.cumsum(count)
    doc_of = np.repeat(np.arange(n), count)
    whole = np.logical_and.reduceat(words.given[index], ends - count) if n else np.zeros(0, dtype=bool)
    keep = whole[doc_of]
    numbers = [np.where(whole, np.add.reduceat(row[index], ends - count), 0) if n else row[:0] for row in words.numbers]
    groups, text_of = [], words.groups.__getitem__
    for start, end, given in zip((ends - count).tolist(), ends.tolist(), whole.tolist()):
        text = ";".join(map(text_of, index[start:end].tolist())) if given else ""
        groups.append(hashlib.sha256(text.encode()).hexdigest() if digest and given else text)
    at = index[keep]
    pair = gather(words.pairs, words.size, at).astype(np.int64)
    times = gather(words.times, words.size, at)
    key, times = summed((pair << 24) | np.repeat(doc_of[keep], words.size[at]), times)
    pair = key >> 24
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[:len(pair)])
    return (*numbers, groups), pair[first], np.diff(np.append(first, len(pair))), (key & 0xFFFFFF, times)


def merged(rows: pd.DataFrame) -> Iterator[tuple[int, int, list[int]]]:
    """(pair, sum of its sizes, runs that hold it) over all runs, ascending: a heap of one entry per run."""
    kind = "<u8" if rows["wide"].iloc[0] else "<u4"

    def entries(i, pairs, sizes):
        for p, s in zip(blocks(pairs, "<u4"), blocks(sizes, kind)):
            yield from zip(p, itertools.repeat(i), s)

    streams = [entries(i, p, s) for i, (p, s) in enumerate(zip(rows["pairs"], rows["sizes"]))]
    for pair, group in itertools.groupby(heapq.merge(*streams), key=lambda e: e[0]):
        held, total = [], 0
        for _, i, size in group:
            held.append(i)
            total += size
        yield pair, total, held


def merge_up(rows: pd.DataFrame) -> pd.DataFrame:
    """One run of sums for the runs of a group."""
    pairs, sizes = Spill("<u4"), Spill("<u8")
    for pair, total, _ in merged(rows):
        pairs.add(pair)
        sizes.add(total)
    return pd.DataFrame({"radix": rows["radix"].iloc[:1], "part": rows["part"].iloc[:1], "pairs": [pairs.close()],
                         "sizes": [sizes.close()]})


def merge_back(rows: pd.DataFrame) -> pd.DataFrame:
    """Each run's counts in its own order: twice the count, plus one where it is the A id's highest.

    The counts come from the merge itself, A id by A id, or from ``answers`` for the runs' sums, if these went on."""
    out = [Spill("<u8") for _ in range(len(rows))]
    given = rows["given"].iloc[0]
    if given is None or (isinstance(given, float) and np.isnan(given)):
        for _, group in itertools.groupby(merged(rows), key=lambda e: e[0] >> B_BITS):
            group = list(group)       # the pairs of one A id: as many as there are B ids at most
            highest = max(total for _, total, _ in group)
            for _, total, held in group:
                for i in held:
                    out[i].add(2 * total + (total == highest))
    else:
        answers = itertools.chain.from_iterable(blocks(given, "<u8"))
        for (_, _, held), answer in zip(merged(rows), answers):
            for i in held:
                out[i].add(answer)
    return pd.DataFrame({"radix": rows["radix"], "run": rows["run"], "answers": [x.close() for x in out]})


def counted(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """radix, run, answers for ``runs`` (radix, run, pairs, sizes)."""
    levels, here, wide = [], runs, False
    while True:
        most = here.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
        parts = -(-most // fan_in) if most > fan_in else 1
        part = F.pmod(F.xxhash64("run"), F.lit(parts)) if parts > 1 else F.lit(0).cast("long")
        here = here.withColumn("part", part).withColumn("wide", F.lit(wide))
        levels.append(here)
        if parts == 1:
            break
        here = written(here.groupBy("radix", "part").applyInPandas(
            lambda rows: merge_up(rows), "radix int, part long, pairs binary, sizes binary"), "alignment-sums")
        here, wide = here.withColumnRenamed("part", "run"), True
    answers = None
    for here in reversed(levels):
        if answers is None:
            here = here.withColumn("given", F.lit(None).cast("binary"))
        else:
            # a group's counts on one of its runs
            above = answers.select("radix", F.col("run").alias("part"), F.col("answers").alias("given"))
            first = here.groupBy("radix", "part").agg(F.min("run").alias("first"))
            above = above.join(first, ["radix", "part"])
            here = here.join(above.withColumnRenamed("first", "run"), ["radix", "part", "run"], "left")
        answers = written(here.groupBy("radix", "part").applyInPandas(
            lambda rows: merge_back(rows.sort_values("given", key=lambda x: x.isna(), kind="stable").reset_index(drop=True)),
            "radix int, run long, answers binary"), "alignment-counts")
    return answers


def contributions(runs: DataFrame) -> DataFrame:
    """slice, place, n_best, count_sum from runs with their records and answers; places are documents of the slice."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for number, sizes, records, answers in zip(b["slice"], b["sizes"], b["records"], b["answers"]):
                cut = 8 + int.from_bytes(records[:8], "little")
                docs, times = unpacked(records[8:cut], "<u4"), unpacked(records[cut:], "<u8").astype(np.int64)
                answer = np.repeat(unpacked_stream(answers), unpacked(sizes, "<u4"))
                place, count = summed(docs, times * (answer >> 1))
                _, best = summed(docs, times * (answer & 1))
                yield pd.DataFrame({"slice": number, "place": place.astype(np.int32), "n_best": best, "count_sum": count})

    return (runs.select("slice", "sizes", "records", "answers").mapInPandas(
                add, "slice long, place int, n_best long, count_sum long")
            .groupBy("slice", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))


def unpacked_stream(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(data), dtype="<u8").astype(np.int64)


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None, digest: bool = False, id_col: str = "doc_id",
            text_col: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``, or their SHA-256 where ``digest`` is set."""
    ship(docs.sparkSession)
    made = written(linked_slices(docs, paths or default_paths(), digest, id_col, text_col), "alignment-runs")
    runs = made.where(F.col("radix") >= 0)
    answers = counted(runs.select("radix", F.col("slice").alias("run"), "pairs", "sizes"), fan_in)
    sums = contributions(runs.join(answers.withColumnRenamed("run", "slice"), ["slice", "radix"]))
    rows = (made.where(F.col("radix") < 0).select("slice", F.posexplode("docs").alias("place", "d"))
            .select("slice", "place", "d.*"))
    return (rows.join(sums, ["slice", "place"], "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups"))


def op11_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
