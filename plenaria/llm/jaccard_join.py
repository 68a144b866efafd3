"""N-gram Jaccard join by partitioning the universe of shingles (Deng, Li, Wen, Feng 2015).

Two sets with |x & y| / |x | y| >= t differ in at most H = (|x| + |y|) (1 - t) / (1 + t) elements.  Sizes are
cut into bands; in a band every shingle hashes to one of m segments.  If segment k tolerates d_k = 0 or 1 differences
and the d_k + 1 sum to more than H, two similar sets agree in some segment within its tolerance (pigeonhole).  A
segment of tolerance 0 is indexed by its subset, one of tolerance 1 by its subset and the subset's one-deletion
neighbours.  ``allocation`` picks m and the tolerances of a band by cost (index entries per set), with spare units so
that empty subsets, which would match everything, are never indexed; a set with more empty segments than spare units
is indexed again under another hash among its like, and at last by all of its shingles.  A set joins its own
band's scheme, and the one below if a partner can be that small.

Candidates meet in a window over the entries' hash; every link is verified on the shingles themselves.  Copies of
a set are one class from the start.  Candidates meet under an entry's hash and must pass a bound that never errs: a
parity sketch of SKETCH bits per set, of which two sets that differ in d shingles differ in d bits at most.  Every
link is verified on the shingles themselves.  Links agree in more segments than one, as many as the scheme has above
the differences that the largest partner may have: a class that shares fewer entries than that (``least_shared``) with
classes of other components, as texts do that have only a common passage, has no link there and goes before its text or
its shingles are read again.  Only components are wanted, so two rounds first verify each class
against one leader (the one it shares most entries with).  In entries that more than CROWD classes of different
components still share, each class counts its own shingles, those of no other crowded class.  Classes with too many of
them to link with any other go: in a group of near copies that are no links to each other, whose pairs grow with the
square, this tells each apart by itself.  The rest are verified against the most central class, the one with the smallest
share of own shingles.  Near copies share many entries, so entries with the same classes become one.  Then the
pairs under an entry that are still in different components and that own shingles and sketches, wide ones of WIDE bits
too, allow are verified: a sketch of SKETCH bits is full long before the difference that large sets may have, and a group
without a centre has a pair only where the wide ones are within that difference.  Nothing emits the pairs inside a group of near
copies.

Words are maximal runs of other bytes than blank, tab, newline, vertical tab, form feed and return, after A-Z are
lower-cased.  A class is known by a 64-bit fingerprint of its shingle hashes.

Edge cases: null, empty or blank texts have an empty set and link with nothing; texts with fewer words than a
shingle have one shingle, the whole sequence; repeated rows are copies; a null doc_id never names a
component (a group of null ids only has a null component_id); an empty table gives an empty result; extra columns are
ignored; the longest text is one row of a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenaria.llm.common import broadcast_if_small, components, in_slices, ship, table, written

WORDS = 4
PERCENT = 85
BAND_RATIO = 1.4
SEEDS = 3
SKETCH = 512    # bits, a multiple of 64
WIDE = 4096     # bits of the sketches of classes that are left at the end, a multiple of 64
CROWD = 8       # open classes of an entry up to which all their pairs are formed at once
RARE = 0.01    # share of a band's sets that may need another hash

_BLANK = bytes([9, 10, 11, 12, 13, 32])
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(_BLANK)] = True
_BASE, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = np.ones(1, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        base = np.full(max(1024, 2 * n), _BASE, dtype=np.uint64)
        base[0] = 1
        _powers = np.cumprod(base)
    return _powers


@np.errstate(over="ignore")
def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the text's word shingles."""
    data = np.frombuffer((text or "").encode().lower().lstrip(_BLANK), dtype=np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))    # the text starts with a word
    held = inside[1:-1]
    value = np.zeros(len(data), dtype=np.uint64)
    value[held] = (data[held].astype(np.uint64) + np.uint64(1)) * _power_table(int(sizes.max()))[place[held]]
    word = mixed(np.add.reduceat(value, starts) + sizes.astype(np.uint64) * _MIX2)
    span = min(n, words)
    total = np.full(n - span + 1, n if n < words else 0, dtype=np.uint64)
    for i in range(span):
        total = mixed(total * _BASE + word[i:n - span + 1 + i])
    return np.unique(total)


def shingles(text: str, words: int = WORDS) -> set:
    """The same set, of the words themselves."""
    found = text.encode().lower().split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(words))))


@lru_cache(maxsize=None)
def band_edges(upto: int, ratio: float = BAND_RATIO) -> list[int]:
    """First sizes of the bands, one past ``upto`` included."""
    edges = [1]
    while edges[-1] <= upto:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * ratio)))
    return edges


def _tail(mean: float, at: int) -> float:
    """P(X > at) for a Poisson X."""
    term, total = math.exp(-mean), 0.0
    for i in range(at + 1):
        total += term
        term *= mean / (i + 1)
    return max(0.0, 1 - total)


@lru_cache(maxsize=None)
def allocation(low: int, high: int, percent: int) -> tuple[int, int, int]:
    """(exact segments, one-deletion segments, spare units) for the scheme of sizes low..high, by cost.

    Cost: index entries of a set of ``low`` shingles.  Spare units are as many as keep the share of sets that have
    more empty segments (which cannot be indexed) at RARE or less, by a Poisson tail."""
    largest = high + high * 100 // percent
    need = largest * (100 - percent) // (100 + percent) + 1
    best = None
    for one in range(min(need, 40) // 2 + 1 if need > 1 else 1):
        for spare in range(0, need + 2, max(1, need // 200)):
            exact = max(0, need + spare - 2 * one)
            m = exact + one
            empty = (1 - 1 / m) ** low
            single = low / m * (1 - 1 / m) ** (low - 1)
            mean = exact * empty + 2 * one * (empty + single)
            if _tail(mean, spare) <= RARE:
                cost = exact + one * (1 + low / m)
                if best is None or cost < best[0]:
                    best = (cost, exact, one, exact + 2 * one - need)
                break
    if best is None:
        return need, 0, 0
    return best[1:]


def schemes(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(band, low, high) of the schemes that a set of n > 0 shingles joins: the one below its own only if a partner can be
    that small; its own is the last."""
    edges = band_edges(1 << (n - 1).bit_length())
    band = next(i for i in range(len(edges)) if edges[i + 1] > n) if len(edges) > 1 else 0
    return [(b, edges[b], edges[b + 1] - 1)
            for b in ([band] if not band or -(-n * percent // 100) > edges[band] - 1 else [band - 1, band])]


@np.errstate(over="ignore")
def segments(hashes: np.ndarray, band: int, seed: int, m: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Segment and salted hash of every shingle, and the tag of band and seed."""
    tag = np.uint64((band * 8 + seed + 1) * 0x10001)
    salted = mixed(hashes + tag * _MIX2)
    return ((salted >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64), salted, tag


@np.errstate(over="ignore")
def entries(hashes: np.ndarray, percent: int) -> np.ndarray:
    """The index entries of a set."""
    n = len(hashes)
    if not n:
        return hashes
    out = []
    for b, low, high in schemes(n, percent):
        exact, one, spare = allocation(low, high, percent)
        for seed in range(SEEDS + 1):
            segment, salted, tag = segments(hashes, b, seed, exact + one)
            if seed == SEEDS:     # so many empty segments under every hash: all shingles
                out.append(mixed(hashes * _MIX1 + tag))
                break
            order = np.argsort(segment, kind="stable")
            segment, salted = segment[order], salted[order]
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sums, held = np.add.reduceat(salted, first), segment[first]
            count = np.diff(np.append(first, n))
            base = held.astype(np.uint64) * _BASE + tag
            out.append(mixed(sums + mixed(base)))
            if one:
                near = np.flatnonzero((segment < one) & (np.repeat(count, count) > 1))
                of = np.repeat(np.arange(len(held)), count)[near]
                out.append(mixed(sums[of] - salted[near] + mixed(base[of])))
            lost = (exact - int((held >= one).sum())) + 2 * (one - int(((held < one) & (count > 1)).sum()))
            if lost <= spare:
                break
    return np.unique(np.concatenate(out))


def least_shared(hashes: np.ndarray, percent: int) -> int:
    """A number of entries that the set shares with every set that it links with.

    Sets that differ in d shingles agree, within the tolerances, in segments of exact + 2 one - d units at least, of which
    only ``lost`` ones are not indexed; d is largest for the largest partner.  One if the first hash lost too many."""
    n, least = len(hashes), []
    for b, low, high in schemes(n, percent) if n else []:
        exact, one, spare = allocation(low, high, percent)
        count = np.bincount(segments(hashes, b, 0, exact + one)[0], minlength=exact + one)
        lost = int((count[one:] == 0).sum()) + 2 * int((count[:one] < 2).sum())
        apart = (n + (n * 100 // percent if n <= high else high)) * (100 - percent) // (100 + percent)
        units = exact + 2 * one - lost - apart if lost <= spare else 1
        least.append(units if not one else -(-units // 2))
    return max(1, min(least, default=1))


def fingerprint(hashes: np.ndarray) -> int | None:
    with np.errstate(over="ignore"):
        return int(mixed(mixed(hashes).sum(keepdims=True)).view(np.int64)[0]) if len(hashes) else None


def sketch(hashes: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """Parity of the number of shingles per bit, as longs."""
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


BITS = [f"bits{i}" for i in range(SKETCH // 64)]


def signed(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, min_shared (``least_shared``), fp (null for an empty set) and the sketch."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_slices(batches):
            found = [shingle_hashes(text, words) for text in b["text"]]
            bits = np.array([sketch(h) for h in found], dtype=np.int64).reshape(len(b), len(BITS))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "text_hash": b["text_hash"],
                                "n_shingles": [len(h) for h in found],
                                "min_shared": [least_shared(h, percent) for h in found],
                                "fp": pd.array([fingerprint(h) for h in found], dtype="Int64")}
                               | {c: bits[:, i] for i, c in enumerate(BITS)})

    return rows.mapInPandas(sign, "doc_id long, text_hash long, n_shingles long, min_shared long, fp long, "
                            + ", ".join(f"{c} long" for c in BITS))


def indexed(docs: DataFrame, words: int, percent: int, text_col: str) -> DataFrame:
    """fp, entry: the index entries of every set, of copies in one task only once (a task keeps the fingerprints of its
    rows), so that a large group of copies is as many rows of an entry as there are tasks at most.  They are hashed from the texts again rather than kept from
    ``signed``: on disk they would take more room than the texts."""
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for b in in_slices(batches):
            found = {}
            for text in b[text_col]:
                h = shingle_hashes(text, words)
                if len(h) and (fp := fingerprint(h)) not in seen:
                    seen.add(fp)
                    found[fp] = entries(h, percent).view(np.int64)
            if found:
                yield pd.DataFrame({"fp": list(found), "entries": list(found.values())})

    return (docs.select(text_col).mapInPandas(index, "fp long, entries array<long>")
            .select("fp", F.explode("entries").alias("entry")))


def near(x, y, percent: int):
    """Whether sizes and sketches allow a link; ``x`` and ``y`` give the column of a name.  Never false for a link."""
    apart = sum((F.bit_count(x(c).bitwiseXOR(y(c))) for c in BITS[1:]), F.bit_count(x(BITS[0]).bitwiseXOR(y(BITS[0]))))
    n, m = x("n_shingles"), y("n_shingles")
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (apart * (100 + percent) <= (n + m) * (100 - percent)))


def verified(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """a, b and the sizes of intersection and union for pairs (a, b) of classes."""
    left = texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, of = None, set()
        for p in in_slices(batches):
            common, union = [], []
            for a, ta, tb in zip(p["a"], p["text_a"], p["text_b"]):
                if a != last:
                    last, of = a, shingles(ta, words)
                other = shingles(tb, words)
                both = len(of & other)
                common.append(both)
                union.append(len(of) + len(other) - both)
            yield pd.DataFrame({"a": p["a"], "b": p["b"], "common": common, "union": union})

    return (pairs.join(right, "b").join(left, "a").select("a", "text_a", "b", "text_b")
            .mapInPandas(compare, "a long, b long, common long, union long"))


def open_rows(shared: DataFrame, parts: DataFrame, sketches: DataFrame) -> DataFrame:
    """entry, fp, part and the other columns of ``sketches`` for entries whose classes are in more than one component so
    far, of the classes that are in ``min_shared`` such entries or more: the others link with no other component.

    A class and any that it links with are in ``min_shared`` entries together, all of them open as long as the two are in
    different components, so ``shared`` must hold all the entries of such pairs."""
    by_entry = Window.partitionBy("entry")
    return (shared.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left")
            .select("entry", "fp", F.coalesce("component", "fp").alias("part"))
            .withColumn("low", F.min("part").over(by_entry)).withColumn("high", F.max("part").over(by_entry))
            .where(F.col("low") != F.col("high")).drop("low", "high")
            .join(sketches, "fp")
            .withColumn("n_open", F.count("*").over(Window.partitionBy("fp")))
            .where(F.col("n_open") >= F.col("min_shared")).drop("n_open", "min_shared"))


def favourites(led: DataFrame) -> DataFrame:
    """a, b: every class b with the leader a that it shares most entries with."""
    return (led.groupBy("fp", F.col("leader.fp").alias("leader")).agg(F.count("*").alias("n"))
            .groupBy(F.col("fp").alias("b")).agg(F.max(F.struct("n", "leader")).alias("m"))
            .select(F.col("m.leader").alias("a"), "b"))


def own_shingles(crowded: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """fp, own: how many shingles of each ``crowded`` class (fp) no other of them has."""
    ship(crowded.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_slices(batches):
            yield pd.DataFrame({"fp": b["fp"], "shingles": [shingle_hashes(t, words).view(np.int64) for t in b["text"]]})

    own = (texts.join(broadcast_if_small(crowded), "fp", "left_semi").mapInPandas(cut, "fp long, shingles array<long>")
           .select("fp", F.explode("shingles").alias("shingle"))
           .groupBy("shingle").agg(F.count("*").alias("n"), F.min("fp").alias("fp"))
           .where(F.col("n") == 1).groupBy("fp").agg(F.count("*").alias("own")))
    return crowded.join(own, "fp", "left").select("fp", F.coalesce("own", F.lit(0)).alias("own"))


def within(x, y, percent: int):
    """Whether own shingles allow a link: neither side's are common, and the others differ by their number at least.
    True if one class was in no crowded entry, so that its shingles were not counted (own is null)."""
    apart = x("own") + y("own") + F.abs(x("n_shingles") - x("own") - y("n_shingles") + y("own"))
    return F.coalesce(apart * (100 + percent) <= (x("n_shingles") + y("n_shingles")) * (100 - percent), F.lit(True))


def wide_sketches(some: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """fp, wide: the sketch of WIDE bits of each of ``some`` classes (fp)."""
    ship(some.sparkSession)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_slices(batches):
            yield pd.DataFrame({"fp": b["fp"], "wide": [sketch(shingle_hashes(t, words), WIDE) for t in b["text"]]})

    return texts.join(broadcast_if_small(some), "fp", "left_semi").mapInPandas(sign, "fp long, wide array<long>")


def near_widely(x, y, percent: int):
    """Whether wide sketches allow a link.  Never false for a link."""
    apart = F.aggregate(F.zip_with(x("wide"), y("wide"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, d: n + d)
    return apart * (100 + percent) <= (x("n_shingles") + y("n_shingles")) * (100 - percent)


def same_entries(rows: DataFrame) -> DataFrame:
    """``rows`` (entry, fp and more of the fp; an fp once per entry) with one entry, n and h, for those that have the same fps.

    Sets of fps are told apart by size and a sum of hashes; entries that these mistake for the same are united, so no pair
    is lost."""
    by_entry = Window.partitionBy("entry")
    return (rows.withColumn("n", F.count("*").over(by_entry))
            .withColumn("h", F.sum(F.xxhash64("fp").cast("decimal(20,0)")).over(by_entry))
            .drop("entry").dropDuplicates(["n", "h", "fp"]))


def joined(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, component for every row; component_id is the smallest doc_id reachable
    by links, component the smallest fingerprint (null for an empty set).  Only component tells groups apart: null and
    repeated ids can give several groups one component_id."""
    rows = written(signed(docs, words, percent, id_col, text_col), "jaccard-sets")
    some = rows.where(F.col("fp").isNotNull())
    classes = some.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("held"),
                                     *(F.min(c).alias(c) for c in ("n_shingles", "min_shared", *BITS)))
    classes = written(classes, "jaccard-classes")

    # entries that more than one class has; `prev` drops the copies of a class
    by_entry = Window.partitionBy("entry")
    shared = written(
        indexed(docs, words, percent, text_col)
        .withColumn("prev", F.lag("fp").over(by_entry.orderBy("fp")))
        .withColumn("first", F.min("fp").over(by_entry)).withColumn("last", F.max("fp").over(by_entry))
        .where((F.col("first") != F.col("last")) & (F.col("prev").isNull() | (F.col("prev") != F.col("fp"))))
        .select("entry", "fp"), "jaccard-shared")
    live = written(shared.groupBy("fp").agg(F.count("*").alias("n")).join(classes, "fp").where(F.col("n") >= F.col("min_shared"))
                   .select("fp", F.col("held.doc_id").alias("t_id"), F.col("held.text_hash").alias("t_hash")), "jaccard-live")
    shared = written(shared.join(live.select("fp"), "fp", "left_semi"), "jaccard-kept")
    source = docs.select(F.col(id_col).alias("s_id"), F.xxhash64(text_col).alias("s_hash"), F.col(text_col).alias("text"))
    texts = written(source.join(broadcast_if_small(live), F.col("s_id").eqNullSafe(F.col("t_id")) & (F.col("s_hash") == F.col("t_hash")))
                    .select("fp", "text").dropDuplicates(["fp"]), "jaccard-texts")

    is_link = 100 * F.col("common") >= percent * F.col("union")
    sketches = classes.select("fp", "n_shingles", "min_shared", *BITS)
    found, parts = None, sketches.select(F.col("fp").alias("node"), F.col("fp").alias("component"))
    for _ in range(2):
        led = (open_rows(shared, parts, sketches)
               .withColumn("leader", F.min(F.struct("part", "fp", "n_shingles", *BITS)).over(by_entry))
               .where((F.col("part") != F.col("leader.part"))
                      & near(F.col, lambda c: F.col(f"leader.{c}"), percent)))
        links = written(verified(favourites(led), texts, words).where(is_link).select("a", "b"), "jaccard-stars")
        found = links if found is None else found.unionAll(links)
        parts = written(components(found), "jaccard-parts")

    # crowded entries: classes that can link there, against the entry's most central one
    rest = written(open_rows(shared, parts, sketches).withColumn("crowd", F.count("*").over(by_entry)), "jaccard-open")
    crowded = written(rest.where(F.col("crowd") > CROWD).select("fp").distinct(), "jaccard-crowded")
    own = written(own_shingles(crowded, texts, words), "jaccard-own")
    sketches = sketches.join(own, "fp", "left")
    least = F.greatest(F.min("n_shingles").over(by_entry), F.col("n_shingles") * percent / 100)    # a partner's size
    rest = written(rest.join(own, "fp", "left").withColumn("least", least)
                   .where((F.col("crowd") <= CROWD) | ((100 + percent) * F.col("own")
                                                       <= 100 * F.col("n_shingles") - percent * F.col("least"))),
                   "jaccard-linkable")
    central = F.struct((F.col("own") / F.col("n_shingles")).alias("share"), "fp", "part", "n_shingles", "own", *BITS)
    led = (rest.where(F.col("crowd") > CROWD).withColumn("leader", F.min(central).over(by_entry))
           .where((F.col("part") != F.col("leader.part")) & near(F.col, lambda c: F.col(f"leader.{c}"), percent)
                  & within(F.col, lambda c: F.col(f"leader.{c}"), percent)))
    links = written(verified(favourites(led), texts, words).where(is_link).select("a", "b"), "jaccard-centres")
    found = found.unionAll(links)
    parts = written(components(found), "jaccard-parts")

    # what still shares an entry across components
    rest = written(same_entries(open_rows(rest.select("entry", "fp"), parts, sketches.select("fp", "min_shared"))), "jaccard-same")
    wide = wide_sketches(written(rest.select("fp").distinct(), "jaccard-left"), texts, words)
    rest = written(rest.join(sketches.join(wide, "fp"), "fp"), "jaccard-rest")
    x, y = (rest.select("n", "h", *(F.col(c).alias(f"{side}_{c}") for c in ("fp", "part", "n_shingles", "own", *BITS, "wide")))
            for side in "xy")
    pair = (lambda c: F.col(f"x_{c}")), (lambda c: F.col(f"y_{c}"))
    rest = (x.join(y, ["n", "h"])
            .where((F.col("x_part") < F.col("y_part")) & near(*pair, percent) & within(*pair, percent) & near_widely(*pair, percent))
            .select(F.col("x_fp").alias("a"), F.col("y_fp").alias("b")).distinct())
    more = written(verified(rest, texts, words).where(is_link).select("a", "b"), "jaccard-more")

    parts = components(found.unionAll(more))
    named = (classes.select("fp", "first_id").join(parts.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "first_id", F.coalesce("component", "fp").alias("component")))
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(lowest, "component").select(F.col("fp").alias("c_fp"), F.col("component_id").alias("c_id"), "component")
    return (rows.join(named, F.col("fp") == F.col("c_fp"), "left")
            .select("doc_id", "text_hash", "n_shingles",
                    F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("c_id")).alias("component_id"), "component"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
