"""Cross-tokenizer alignment against a brute-force alignment with the tokenizers themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plenaria.llm import aligner, alignment

PARTS = ["a", "the", " the", " of", "é", "İ", " ", "  ", "\n", "\n\n", "\t", "\v", "\x85", "\xa0", " ", "'s", "1", "234", ".", ",",
         " word,", "<|endoftext|>", "<s>", "</s>", "日本語", "🙂", "▁", "<0x41>", "\x1c", "naïve", " Weltanschauung", "xx", "​"]


@pytest.fixture(scope="module")
def brute():
    a_path, b_path = aligner.default_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    chars = aligner.byte_characters()

    def a_bytes(token):
        return bytes(chars[c] for c in token)

    def b_bytes(i):
        piece = b.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        enc = a.encode(" " + text, add_special_tokens=False)
        xs, ys = enc.ids, b.encode(text)
        xb, yb = [a_bytes(a.id_to_token(i)) for i in xs], [b_bytes(i) for i in ys]
        if not b"".join(xb) == b"".join(yb) == (" " + text).encode():
            return None

        def ends(parts):
            out, at = [], 0
            for p in parts:
                at += len(p)
                out.append(at)
            return out
        xe, ye = ends(xb), ends(yb)
        cuts = sorted(set(xe) & set(ye))
        groups, i, j = [], 0, 0
        for c in cuts:
            g, k = [], []
            while i < len(xe) and xe[i] <= c:
                g.append(xs[i])
                i += 1
            while j < len(ye) and ye[j] <= c:
                k.append(ys[j])
                j += 1
            groups.append((g, k))
        return groups

    def all_of(texts):
        found = [one(t) for t in texts]
        count, links = Counter(), []
        for groups in found:
            c = Counter()
            for g, k in groups or []:
                for x, m in Counter(g).items():
                    for y, n in Counter(k).items():
                        c[x, y] += m * n
            links.append(c)
            count.update(c.keys())
        top = defaultdict(int)
        for (x, _), n in count.items():
            top[x] = max(top[x], n)
        rows = []
        for groups, c in zip(found, links):
            text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, k))}" for g, k in groups or [])
            rows.append((sum(len(g) for g, _ in groups or []), sum(len(k) for _, k in groups or []), len(groups or []),
                         sum(c.values()), sum(n for p, n in c.items() if count[p] == top[p[0]]),
                         sum(n * count[p] for p, n in c.items()), text))
        return rows
    return all_of


def strange(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


TEXTS = strange(6, 500) + [None, "", " ", "x" * 20_000, "ab " * 3_000, "same text", "same text", "a  b", " a", "a ", "a\n b", "\na"]


@pytest.mark.parametrize("fan_in, size, radix, words", [(512, 1 << 20, 16, 250_000), (3, 300, 2, 40)])
def test_alignment_matches_brute_force(spark, brute, monkeypatch, fan_in, size, radix, words):
    """Once as it is, once with many small slices, merges in several passes and a cache that starts anew."""
    monkeypatch.setattr(alignment, "SLICE_BYTES", size)
    monkeypatch.setattr(alignment, "RADIX", radix)
    docs = [(i if i % 40 else None, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("slice", "radix", "place", "pairs", "run", "part", "docs", "n_a", "groups", "TEXT_")})
    got = alignment.aligned(df.repartition(7), fan_in=fan_in).collect()
    want = [(i, *r) for (i, _), r in zip(docs, brute(TEXTS))]
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(want, key=repr)


def test_words_align_like_whole_texts(brute, monkeypatch):
    monkeypatch.setattr(aligner, "CACHE_WORDS", 60)
    monkeypatch.setattr(aligner, "WIDE", 4)
    monkeypatch.setattr(aligner, "JOINED", 50)
    one = aligner.Aligner(*aligner.default_paths())
    texts = strange(7, 600)
    for low in range(0, 600, 100):
        rows, *_ = alignment.align_rows(*one.align(pa.array(texts[low:low + 100])), False)
        want = brute(texts[low:low + 100])
        assert [tuple(int(x[i]) for x in rows[:4]) for i in range(100)] == [w[:4] for w in want]
        assert rows[4] == [w[6] for w in want]
    assert np.array_equal(alignment.unpacked(alignment.packed(np.arange(9), "<u4"), "<u4"), np.arange(9))


def test_merges_in_passes_equal_one_merge(spark):
    rng, runs, total = random.Random(8), [], Counter()
    for r in range(23):
        held = {rng.randrange(40) << 16 | rng.randrange(30): rng.randint(1, 9) for _ in range(60)}
        total.update(held)
        pairs = sorted(held)
        runs.append((0, r, alignment.packed(np.array(pairs), "<u4"), alignment.packed(np.array([held[p] for p in pairs]), "<u4")))
    df = spark.createDataFrame([(a, b, bytearray(c), bytearray(d)) for a, b, c, d in runs], "radix int, run long, pairs binary, sizes binary")
    top = defaultdict(int)
    for p, n in total.items():
        top[p >> 16] = max(top[p >> 16], n)
    for fan_in in (2, 5, 100):
        got = {r["run"]: alignment.unpacked_stream(r["answers"]).tolist() for r in alignment.counted(df, fan_in).collect()}
        for _, run, pairs, _ in runs:
            want = [2 * total[p] + (total[p] == top[p >> 16]) for p in alignment.unpacked(pairs, "<u4").tolist()]
            assert got[run] == want


def test_alignment_query_and_nothing(spark, brute, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned(none).count() == 0
    texts = strange(9, 80) + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = alignment.op11_spill_alignment(spark, str(tmp_path)).collect()
    want = [(i, *r[:6], hashlib.sha256(r[6].encode()).hexdigest() if r[6] else "") for i, r in enumerate(brute(texts))]
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(tuple(r[c] for c in names) for r in got) == want
