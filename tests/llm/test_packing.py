"""Best-fit packing against the tokenizer, the packing rules and a lower bound."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plenaria.llm import packing, word_tokens

PARTS = ["a", "B", "é", "É", "İ", "ß", "Σ", "ς", " ", "  ", "\n", "\t", "\v", "\x1c", "\x85", "\xa0", "'s", "'RE", "1", "23",
         ".", ",", "!?", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "日本", "́", "ﬁ", "🙂", "word,", "Word. ", "naïve!! "]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(word_tokens.default_path())


def strange(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_the_tokenizers(whole, monkeypatch):
    texts = strange(1, 1500) + [None, ""]
    for words in (word_tokens.CACHE_WORDS, 50):    # the second cache starts anew again and again
        monkeypatch.setattr(word_tokens, "CACHE_WORDS", words)
        encode = word_tokens.WordEncoder(word_tokens.default_path()).encode
        for low in range(0, len(texts), 300):
            ids, count = encode(pa.array(texts[low:low + 300], pa.string()))
            at = np.concatenate([[0], np.cumsum(count)])
            for i, text in enumerate(texts[low:low + 300]):
                assert ids[at[i]:at[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def by_definition(lengths, size):
    """Sum of squares, every choice tried in full; the same ties: an open sequence first, the smallest gap first."""
    gaps, used = [], 0
    for n in sorted(lengths, reverse=True):
        best = None
        for g in [*sorted({x for x in gaps if x >= n}), size]:
            after = list(gaps)
            if g < size:
                after.remove(g)
            if g > n:
                after.append(g - n)
            total = sum(after.count(x) ** 2 for x in set(after))
            if best is None or total < best[0]:
                best = (total, g, after)
        used += best[1] == size
        gaps = best[2]
    return used, sorted(gaps)


def test_places_follow_the_definition():
    rng = random.Random(2)
    for size in (7, 16, 40):
        for _ in range(20):
            lengths = np.array([rng.randint(1, size) for _ in range(rng.randint(0, 60))], dtype=np.int64)
            sequence, offset = packing.sum_of_squares(lengths, size)
            filled = defaultdict(int)
            for n, s in zip(lengths.tolist(), sequence.tolist()):
                filled[s] += n
            assert (len(filled), sorted(size - x for x in filled.values() if x < size)) == by_definition(lengths.tolist(), size)


def check_rules(rows, size):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return len(held)


def test_packing_is_whole(spark, whole):
    texts = strange(3, 300) + [None, "", "same text twice", "same text twice", "long " * 10_000]
    docs = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("piece", "length", "uid", "piece_uid", "part", "ids", "sequence_id", "TEXT_")})
    size = 64
    parts = packing.packed(packing.pieces(df, size).withColumn("ids_crc32", F.crc32("ids")), size, 100)
    rows = parts.collect()
    used = check_rules(rows, size)
    assert used <= -(-sum(r["length"] for r in rows) // size) * 1.05 + 6
    # every document once: its pieces joined are its ids and the end
    got = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert r["start"] == r["piece"] * size and len(ids) == r["length"] and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        got[r["doc_id"]].append((r["piece"], ids.tolist()))
    for i, t in docs:
        if i is not None and texts.count(t) == 1 and i < len(texts):
            assert sum((x for _, x in sorted(got[i])), []) == whole.encode(t or "", add_special_tokens=False).ids + [1]
    assert sum(r["length"] for r in rows) == sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    # the packed sequences are their pieces in order
    of = defaultdict(list)
    for r in rows:
        of[r["sequence_id"]].append((r["offset"], bytes(r["ids"])))
    made = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(parts).collect()}
    assert len(made) == used and sorted(map(len, made.values())) == sorted(sum(len(x) for _, x in v) for v in of.values())


def test_packing_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(packing.pieces(none)).count() == 0


def test_packing_query(spark, whole, tmp_path):
    texts = [*strange(5, 60), None, "x " * 5000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = packing.op13_square_sum_packing(spark, str(tmp_path)).collect()
    assert set(rows[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    want = []
    for i, t in enumerate(texts):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for p, low in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[low:low + 4096], dtype="<u4")
            want.append((i, p, low, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    assert check_rules(rows, 4096) <= -(-sum(w[3] for w in want) // 4096) + 1
