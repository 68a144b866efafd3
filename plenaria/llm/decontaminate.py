r"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised (lower case, runs of anything but letters and digits become one blank).  A test item of n
characters may differ from a passage of a document by k = floor(n * rate) edits.  Cut into k + 1 pieces, at
least one piece must occur unchanged, so an Aho-Corasick automaton over all pieces finds every place worth a look,
and Myers' bit-parallel distance against the text around it decides.  Nothing else is compared.

The items are a query set: they are read in blocks whose size is a parameter, and each block's pieces go to
the executors with the task (bounded by ``block_chars``).  Documents never move.

Edge cases: null or empty texts match nothing; items shorter than ``min_chars`` after normalising must occur as
whole words and unchanged; items without letters or digits are ignored; ids repeat as the rows do; the best
(smallest) distance of an item in a document is given; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm.common import ship, table

EDIT_RATE = 0.05
MIN_CHARS = 32
BLOCK_CHARS = 2_000_000

_words = re.compile(r"[^\W_]+")


def normalised(text: str | None) -> str:
    return " ".join(_words.findall(text.lower())) if text else ""


def budget(item: str, rate: float = EDIT_RATE, min_chars: int = MIN_CHARS) -> int:
    return int(len(item) * rate) if len(item) >= min_chars else 0


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces whose lengths differ by one at most."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str, k: int, masks: dict[str, int] | None = None) -> int:
    """Smallest edit distance between ``item`` and any stretch of ``text``; k + 1 if it is over k (Myers 1999)."""
    n = len(item)
    if masks is None:
        masks = char_masks(item)
    full, high = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, best = full, 0, n, n
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best = score
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
    return min(best, k + 1)


def char_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    return masks


class Matcher:
    """The pieces of a block of items as one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_chars: int):
        import ahocorasick
        self.items = []
        where = defaultdict(list)
        for item_id, text in items:
            item = normalised(text)
            if not item:
                continue
            if len(item) < min_chars:
                item = f" {item} "
            k = budget(item, rate, min_chars)
            self.items.append((item_id, item, k, char_masks(item)))
            for offset, piece in pieces(item, k):
                where[piece].append((len(self.items) - 1, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int]]:
        """(item_id, distance) of the items within their budget in the text."""
        text = normalised(text)
        if not text or not self.items:
            return []
        text = f" {text} "
        spots: dict[int, set[int]] = defaultdict(set)
        for end, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                spots[i].add(end - size + 1 - offset)
        out = []
        for i, starts in spots.items():
            item_id, item, k, masks = self.items[i]
            best = 0 if item in text else k + 1
            if best and k:
                lo = hi = None   # neighbouring places are looked at together
                for s in [*sorted(starts), None]:
                    if s is not None and hi is not None and s - k <= hi:
                        hi = s + len(item) + k
                        continue
                    if hi is not None:
                        best = min(best, myers(item, text[max(0, lo):hi], k, masks))
                    if s is not None:
                        lo, hi = s - k, s + len(item) + k
            if best <= k:
                out.append((item_id, best))
        return out


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS, id_col: str = "item_id", text_col: str = "text"):
    """The items, block by block; a block holds ``block_chars`` characters or one item."""
    block, size = [], 0
    for r in items.select(F.col(id_col), F.col(text_col)).where(F.col(text_col).isNotNull()).toLocalIterator():
        if block and size + len(r[1]) > block_chars:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1])
    yield block


def contaminated(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE, min_chars: int = MIN_CHARS,
                 block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, distance: every item found in every document."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))

    def hits_of(block: list) -> DataFrame:
        def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = Matcher(block, rate, min_chars)
            for b in batches:
                found = [(d, h, i, n) for d, h, t in zip(b["doc_id"].astype("Int64"), b["text_hash"], b["text"])
                         for i, n in matcher.matches(t)]
                out = pd.DataFrame(found, columns=["doc_id", "text_hash", "item_id", "distance"])
                yield out.astype({"doc_id": "Int64", "text_hash": "int64", "item_id": "Int64", "distance": "int64"})
        return rows.mapInPandas(hits, "doc_id long, text_hash long, item_id long, distance long")

    return reduce(DataFrame.unionAll, [hits_of(b) for b in item_blocks(items, block_chars)])


def op3_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "distance")
