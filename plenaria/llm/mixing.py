"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of about ``block_size`` units (bytes or rows).  With weight w, block j of a source
is released at slot floor(j / w) and due at slot ceil((j + 1) / w); earliest deadline first among the released
blocks fills one block per slot, so after any number of slots t each source has had less than one block more or
less than w * t.  Weights are shares of a whole number, so the schedule repeats after ``sum(shares)`` slots: that
one period is computed once, and the slot of any block follows from it by arithmetic.  Nothing that grows with
the data is scheduled on the driver.

When a source runs out, a new phase starts with the shares of the sources that are left; there are at most as many
phases as sources.  No row is dropped or repeated.

In ``mix``, sources without a share of their own form one more stream, with ``other_share`` (null sources too).
``source_shares`` gives every source of a table its own share, so that only null sources (and one named like the pool)
are pooled; the registered query and the pipeline use it.  The schedule on the driver takes at most as many steps as there are
blocks, and at most one period for each source.  It is broadcast up to a counted size and joined by stream and
chunk of blocks beyond.  Row order inside a stream follows a hash of the id (ties: id, text hash), by buckets of bounded size
whose running sums are added up in a grouped table; a bucket that many equal rows fill is split at random, as they are
interchangeable.

Edge cases: null texts count as one unit; a text longer than a block takes the slots of the blocks that it spans;
repeated rows are scheduled one by one; an empty table gives an empty result; extra columns are ignored; a share
must be a positive whole number.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenaria.llm.common import BROADCAST_ROWS, broadcast_if_small, free_name, table, written

OTHER = "*other*"
BLOCK_BYTES = 65_536
ROWS_PER_BUCKET = 20_000
CHUNKS = 1024                # a stream's blocks are looked up in so many chunks where the schedule is too long to broadcast

#: Shares of the mixture in the registered query: the crawl source is weighed down, three sources are weighed up.
SHARES = {"src0": 24, "src1": 12, "src2": 10, "src3": 8, "src4": 6, "src5": 6}
OTHER_SHARE = 54


def period(shares: dict[str, int]) -> Iterator[tuple[str, int]]:
    """One period of the schedule, slot by slot: (stream, its block within the period), earliest deadline first among the
    released blocks; ties go to the name that sorts first."""
    total = sum(shares.values())
    due = lambda s, j: (-(-(j + 1) * total // shares[s]), s, j)
    released, waiting = [], [(0, *due(s, 0)) for s in shares]
    heapq.heapify(waiting)
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            heapq.heappush(released, heapq.heappop(waiting)[1:])
        _, s, j = heapq.heappop(released)
        yield s, j
        if j + 1 < shares[s]:
            heapq.heappush(waiting, ((j + 1) * total // shares[s], *due(s, j + 1)))


def source_shares(docs: DataFrame, shares: dict[str, int], other_share: int, source_col: str = "source") -> tuple[dict[str, int], int]:
    """Shares for ``mix`` in which every source of the table has its own: the listed ones theirs, all others equal parts of
    ``other_share``, null sources one such part.  Returned with that part, as whole numbers in the same proportions."""
    found = [r[0] for r in docs.groupBy(source_col).count().collect()]      # a row per source
    others = sorted(s for s in found if s is not None and s not in shares and s != OTHER)
    parts = len(others) + (None in found or OTHER in found) or 1
    return {s: a * parts for s, a in shares.items()} | dict.fromkeys(others, other_share), other_share


def phases(blocks: dict[str, int], shares: dict[str, int]) -> list[dict]:
    """The phases of the schedule for streams of ``blocks`` blocks: per stream the first block and slot of the phase
    and its slots within a period.  At most one phase per stream; a phase is followed for one period, or until the first
    stream runs out if that is sooner, so all phases together never take more steps than there are blocks."""
    left = {s: n for s, n in blocks.items() if n > 0}
    first, slot, out = dict.fromkeys(left, 0), 0, []
    while left:
        active = {s: shares[s] for s in left}
        divisor = math.gcd(*active.values())
        active = {s: a // divisor for s, a in active.items()}
        total, places, end = sum(active.values()), {s: [] for s in active}, None
        for t, (s, j) in enumerate(period(active)):
            places[s].append(t)
            if j + 1 == left[s]:
                end = t + 1
                break
        if end is None:
            end = min((n - 1) // active[s] * total + places[s][(n - 1) % active[s]] + 1 for s, n in left.items())
        used = {s: end // total * active[s] + bisect.bisect_left(places[s], end % total) for s in active}
        out.append({"phase": len(out), "start": slot, "total": total, "shares": active, "places": places,
                    "first": {s: first[s] for s in left}, "used": used})
        slot += end
        for s, n in used.items():
            first[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n > 0}
    return out


def mix(docs: DataFrame, shares: dict[str, int], other_share: int, block_size: int = BLOCK_BYTES,
        unit: str = "bytes", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, text_hash, stream, size, block, phase, release, deadline, slot, seq for every row.  The mixture is the
    order of (slot, seq): one block of one stream per slot."""
    spark = docs.sparkSession
    if min([other_share, *shares.values()]) < 1:
        raise ValueError("shares are positive whole numbers")
    size = F.greatest(F.coalesce(F.octet_length(text_col), F.lit(1)), F.lit(1)) if unit == "bytes" else F.lit(1)
    listed = F.col(source_col).isin(*shares) if shares else F.lit(False)
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), size.cast("long").alias("size"),
        F.when(listed, F.col(source_col)).otherwise(F.lit(OTHER)).alias("stream"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt")), "mix-rows")
    buckets = max(1, math.ceil(rows.count() / ROWS_PER_BUCKET))
    rows = (rows.withColumn("key", F.xxhash64("doc_id", "text_hash"))
            .withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int")))
    full = written(rows.groupBy("stream", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * ROWS_PER_BUCKET)
                   .select("stream", "bucket", F.ceil(F.col("n") / ROWS_PER_BUCKET).alias("parts")), "mix-full")
    rows = (rows.join(broadcast_if_small(full), ["stream", "bucket"], "left")
            .withColumn("part", F.coalesce(F.pmod("salt", "parts"), F.lit(0)).cast("int")).drop("parts"))
    sums = written(rows.groupBy("stream", "bucket", "part").agg(F.sum("size").alias("units")), "mix-sums")
    whole = {**shares, OTHER: other_share}
    sizes = {r["stream"]: r["units"] for r in sums.groupBy("stream").agg(F.sum("units").alias("units")).collect()}
    blocks = {s: -(-n // block_size) for s, n in sizes.items()}
    plan = phases(blocks, whole)

    earlier = Window.partitionBy("stream").orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("stream", "bucket", "part", F.coalesce(F.sum("units").over(earlier), F.lit(0)).alias("offset"))
    order = Window.partitionBy("stream", "bucket", "part").orderBy("key", "doc_id", "text_hash")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("inside", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
              .join(offsets, ["stream", "bucket", "part"])
              .withColumn("at", F.col("offset") + F.col("inside"))
              .withColumn("block", F.floor(F.col("at") / F.lit(block_size)).cast("long")))

    steps = [(s, blocks[s], p["first"][s], p["first"][s] + n, p["phase"], p["start"], p["total"], p["shares"][s], p["places"][s])
             for p in plan for s, n in p["used"].items() if n]
    numbers = sum(len(places) for *_, places in steps) + len(steps)
    steps = spark.createDataFrame(steps, "p_stream string, p_blocks long, lo long, hi long, phase int, start long, total long, "
                                         "share long, places array<int>")
    found = (F.col("stream") == F.col("p_stream")) & (F.col("block") >= F.col("lo")) & (F.col("block") < F.col("hi"))
    if numbers <= BROADCAST_ROWS:
        timed = placed.join(F.broadcast(steps), found)
    else:                                       # too many slots for a broadcast: by stream and chunk of its blocks
        chunk = lambda block: F.expr(f"({block}) * {CHUNKS} div p_blocks")
        steps = written(steps, "mix-steps")
        ends = steps.select("p_stream", "p_blocks").distinct()
        steps = steps.withColumn("p_chunk", F.explode(F.sequence(chunk("lo"), chunk("hi - 1"))))
        timed = (placed.join(broadcast_if_small(ends), F.col("stream") == F.col("p_stream"))
                 .withColumn("chunk", chunk("block")).drop("p_stream", "p_blocks")
                 .join(steps, found & (F.col("chunk") == F.col("p_chunk"))))
    return (timed
            .select("doc_id", "text_hash", "stream", "size", "block", "phase",
                    F.expr("start + (block - lo) * total div share").alias("release"),
                    F.expr("start + ((block - lo + 1) * total + share - 1) div share").alias("deadline"),
                    (F.col("start") + F.expr("(block - lo) div share") * F.col("total")
                     + F.expr("places[int((block - lo) % share)]")).cast("long").alias("slot"),
                    (F.col("at") % F.lit(block_size)).cast("long").alias("seq")))


def with_place(docs: DataFrame, shares: dict[str, int], other_share: int, slot_col: str = "slot", seq_col: str = "seq",
               **options) -> DataFrame:
    """The rows as they are, with their slot and seq in the mixture after all other columns.  Equal rows have the first
    of their places."""
    p_id, p_hash, p_place = (free_name(docs, name) for name in ("mix_id", "mix_hash", "mix_place"))
    place = (mix(docs, shares, other_share, **options).groupBy("doc_id", "text_hash")
             .agg(F.min(F.struct("slot", "seq")).alias(p_place))
             .select(F.col("doc_id").alias(p_id), F.col("text_hash").alias(p_hash), p_place))
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    joined = docs.join(place, docs[id_col].eqNullSafe(F.col(p_id)) & (F.xxhash64(docs[text_col]) == F.col(p_hash)))
    return joined.select(*(docs[c] for c in docs.columns), F.col(f"{p_place}.slot").alias(slot_col),
                         F.col(f"{p_place}.seq").alias(seq_col))


def mixed_order(docs: DataFrame, shares: dict[str, int], other_share: int, **options) -> DataFrame:
    """The rows as they are, sorted into the order of the mixture: partition by partition, file by file when written.
    Equal rows stand together."""
    slot, seq = free_name(docs, "mix_slot"), free_name(docs, "mix_seq")
    return (with_place(docs, shares, other_share, slot, seq, **options)
            .repartitionByRange(slot, seq).sortWithinPartitions(slot, seq).drop(slot, seq))


def op1_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, *source_shares(docs, SHARES, OTHER_SHARE))
