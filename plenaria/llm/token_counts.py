"""Edit-aware token counts.

A byte-level BPE first splits a text into pre-tokens by a pattern that looks ahead but never back, and counts
tokens per pre-token.  Every document keeps a segment tree over runs of about LEAF pre-tokens: the leaves' start
offsets and a heap of token sums (node i has children 2i and 2i + 1, the root is node 1).  An edit re-encodes from
the last leaf start that lies CONTEXT characters or more before it (a leaf starts only after a pre-token that ends in
something other than white space, so nothing before it can change) to the first old leaf start behind the edit
where the new pre-tokens end as well; from there on both texts split alike.  Only the changed leaves' paths to the
root are summed again.

Trees hold no text and are stored as a table; of the documents, only the edited ones are read and moved for an update.

Edge cases: null and empty texts have one empty leaf and 0 tokens; edits are (start, end, new) in code points,
sorted and non-overlapping; insertions have start = end; edits at either end are allowed; a null list changes nothing;
rows equal in id and text share their edits and appear once per row in the result; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm.chat import PATTERN, TOKENIZER, tokenizer
from plenaria.llm.common import in_slices, ship, table, written

LEAF = 64
CONTEXT = 4
CACHED = 500_000       # pre-tokens whose counts a worker remembers; it starts over beyond

#: Edits of the registered query: addresses and long numbers are masked.
MASKED = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[0-9]{6,}"
MASK = "[masked]"

_counts: dict[str, int] = {}
_split: list = []


def splitter():
    if not _split:
        import regex
        _split.append(regex.compile(PATTERN))
    return _split[0]


def tokens_in(pre_tokens: list[str], path: str = TOKENIZER) -> list[int]:
    """Token count of each pre-token."""
    if len(_counts) > CACHED:
        _counts.clear()
    try:
        return [_counts[p] for p in pre_tokens]
    except KeyError:
        encode = tokenizer(path).encode_ordinary
        for p in {p for p in pre_tokens if p not in _counts}:
            _counts[p] = len(encode(p))
        return [_counts[p] for p in pre_tokens]


def leaves(pre_tokens: list[str], counts: list[int], start: int, leaf: int, n_leaves: int | None = None) -> tuple[list, list]:
    """Start offsets and token sums of the leaves of a stretch of pre-tokens; exactly ``n_leaves`` if given."""
    starts, sums, at, since = [start], [0], start, 0
    for p, n in zip(pre_tokens, counts):
        at += len(p)
        sums[-1] += n
        since += 1
        if since >= leaf and not p[-1].isspace() and (n_leaves is None or len(starts) < n_leaves):
            starts.append(at)
            sums.append(0)
            since = 0
    if len(starts) > 1 and since == 0:
        starts.pop()
        sums.pop()
    while n_leaves is not None and len(starts) < n_leaves:    # fewer pre-tokens than leaves: empty ones at the end
        starts.append(at)
        sums.append(0)
    return starts, sums


def heap(sums: list[int]) -> list[int]:
    size = 1 << max(0, len(sums) - 1).bit_length()
    tree = [0] * size + sums + [0] * (size - len(sums))
    for i in range(size - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def build(text: str | None, leaf: int = LEAF, path: str = TOKENIZER) -> tuple[list[int], list[int]]:
    """(leaf starts, heap of sums) of a text."""
    pre = splitter().findall(text or "")
    starts, sums = leaves(pre, tokens_in(pre, path), 0, leaf)
    return starts, heap(sums)


def update(text: str, edits: list[tuple[int, int, str]], starts: list[int], tree: list[int], leaf: int = LEAF,
           path: str = TOKENIZER) -> tuple[str, list[int], list[int], int]:
    """The edited text, its leaf starts and heap, and the number of characters that were encoded again."""
    parts, at, shift = [], 0, 0
    placed = []      # (old start, old end, shift of the text behind the edit)
    for a, b, new in edits:
        parts += [text[at:a], new]
        at, shift = b, shift + len(new) - (b - a)
        placed.append((a, b, shift))
    changed = "".join([*parts, text[at:]])
    tree, size, n = list(tree), len(tree) // 2, len(starts)
    moved = list(starts)
    i, before, again, behind = 0, 0, 0, 0       # edit, shift so far, characters encoded, first leaf not yet moved
    while i < len(placed):
        a = max(behind, bisect_right(starts, placed[i][0] - CONTEXT) - 1, 0)
        for k in range(behind, a):
            moved[k] = starts[k] + before
        begin = starts[a] + before
        pre, end, b = [], begin, n
        for m in splitter().finditer(changed, begin):
            pre.append(m.group())
            end = m.end()
            while i + 1 < len(placed) and placed[i + 1][0] < end - placed[i][2] + CONTEXT:
                i += 1       # the next edit is reached before the texts meet again
            old = end - placed[i][2]
            if old >= placed[i][1] and not pre[-1][-1].isspace():
                at = bisect_left(starts, old)
                if a < at < n and starts[at] == old:
                    b = at
                    break
        again += end - begin
        counts = tokens_in(pre, path)
        fresh, sums = leaves(pre, counts, begin, max(1, -(-len(pre) // (b - a))), b - a)
        for k, (s, total) in enumerate(zip(fresh, sums), start=a):
            moved[k] = s
            node, delta = size + k, total - tree[size + k]
            while delta and node:
                tree[node] += delta
                node //= 2
        if b == n:
            i = len(placed) - 1
        before, behind = placed[i][2], b
        i += 1
    for k in range(behind, n):
        moved[k] = starts[k] + before
    return changed, moved, tree, again


def trees(docs: DataFrame, leaf: int = LEAF, path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_tokens, starts, sums: one tree per row."""
    ship(docs.sparkSession)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_slices(batches):
            built = [build(t, leaf, path) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "text_hash": b["text_hash"],
                                "n_tokens": [t[1][1] if len(t[1]) > 1 else 0 for t in built],
                                "starts": [t[0] for t in built], "sums": [t[1] for t in built]})

    return (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
            .mapInPandas(made, "doc_id long, text_hash long, n_tokens long, starts array<int>, sums array<int>"))


def updated(kept: DataFrame, edited: DataFrame, leaf: int = LEAF, path: str = TOKENIZER) -> DataFrame:
    """Trees after edits: ``edited`` has doc_id, text_hash, text, edits array<struct<start, end, new>> of edited rows.
    doc_id, text_hash, n_tokens_after, n_edits, chars_again, starts, sums."""
    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_slices(batches):
            done = [update(t, [(e["start"], e["end"], e["new"]) for e in es], list(s), list(x), leaf, path)
                    for t, es, s, x in zip(b["text"], b["edits"], b["starts"], b["sums"])]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "text_hash": b["text_hash"],
                                "n_tokens_after": [d[2][1] for d in done], "n_edits": [len(e) for e in b["edits"]],
                                "chars_again": [d[3] for d in done], "starts": [d[1] for d in done], "sums": [d[2] for d in done]})

    ids = ["doc_id", "text_hash"]
    left = edited.dropDuplicates(ids).alias("e")
    right = kept.select(*(F.col(c).alias(f"k_{c}") for c in ids), "starts", "sums").dropDuplicates([f"k_{c}" for c in ids])
    joined = left.join(right, F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & (F.col("text_hash") == F.col("k_text_hash")))
    return (joined.select(*ids, F.coalesce("text", F.lit("")).alias("text"), "edits", "starts", "sums")
            .mapInPandas(step, "doc_id long, text_hash long, n_tokens_after long, n_edits long, chars_again long, "
                               "starts array<int>, sums array<int>"))


def masking_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, text, edits for the rows in which something is to be masked."""
    pieces, hits = F.split("text", MASKED, -1), F.regexp_extract_all("text", F.lit(MASKED), 0)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,new:string>>").alias("out"))

    def step(acc, i):
        a = acc["at"] + F.length(F.get(F.col("pieces"), i))
        b = a + F.length(F.get(F.col("hits"), i))
        return F.struct(b.alias("at"), F.array_append(acc["out"], F.struct(a.alias("start"), b.alias("end"), F.lit(MASK).alias("new"))).alias("out"))

    return (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
            .where(F.col("text").rlike("@|[0-9]{6}"))
            .select("doc_id", "text_hash", "text", pieces.alias("pieces"), hits.alias("hits")).where(F.size("hits") > 0)
            .select("doc_id", "text_hash", "text",
                    F.aggregate(F.sequence(F.lit(0), F.size("hits") - 1), start, step, lambda acc: acc["out"]).alias("edits")))


def op5_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = written(trees(docs), "token-trees")
    after = written(updated(kept, masking_edits(docs)).drop("starts", "sums"), "token-trees-edited")
    after = after.withColumnsRenamed({"doc_id": "a_id", "text_hash": "a_hash"})
    return (kept.join(after, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_hash") == F.col("a_hash")), "left")
            .select("doc_id", "n_tokens", F.coalesce("n_edits", F.lit(0)).alias("n_edits"),
                    F.coalesce("n_tokens_after", "n_tokens").alias("n_tokens_after"),
                    F.coalesce("chars_again", F.lit(0)).alias("chars_again"), F.size("starts").alias("n_leaves")))
