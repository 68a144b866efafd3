"""The training-data operators against brute force, round trips and held-out accuracy, with the edge cases of their docstrings."""

import hashlib
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from plenaria.llm import (chat, decontaminate, embedding_dedup, jaccard_join, language, line_templates, mixing, pii,
                          sharding, token_counts)
from plenaria.llm.common import components

DOC = "doc_id long, text string, source string, lang string"
HOSTILE = [(1, None, None, None), (2, "", "a", "en"), (None, "no id here at all", "a", "xx"), (4, "  \n\t", "b", "en"),
           (5, "same row twice", "b", "en"), (5, "same row twice", "b", "en"), (6, "x" * 200_000, "c", "de"),
           (7, "1 " * 50_000, "c", "de")]


@pytest.fixture(scope="module")
def hostile(spark):
    """Nulls, empty, blank and very long texts, a repeated row, and columns whose names clash with the operators' own."""
    docs = spark.createDataFrame(HOSTILE, DOC)
    return docs.withColumns({c: F.lit("x") for c in ("shard", "slot", "text_hash", "fp", "block", "stream", "place", "spans", "id", "host")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


# -- op 1

def test_period_stays_within_one_block():
    for shares in ({"a": 1}, {"a": 3, "b": 5, "c": 2}, {"a": 1, "b": 1, "c": 37, "d": 11}):
        total, count = sum(shares.values()), Counter()
        for t, (s, j) in enumerate(mixing.period(shares)):
            assert j * total // shares[s] <= t < -(-(j + 1) * total // shares[s])
            count[s] += 1
            assert all(abs(count[x] * total - a * (t + 1)) < total for x, a in shares.items())
        assert count == Counter(shares)


@pytest.mark.parametrize("unit", ["rows", "bytes"])
def test_mixture_is_whole_and_near_its_weights(spark, unit):
    rng = random.Random(3)
    rows = [(i, "t" * rng.randint(1, 60), rng.choice(["a"] * 6 + ["b", "c", None]), "en") for i in range(900)]
    docs, shares, size = spark.createDataFrame(rows, DOC), {"a": 2, "b": 3}, 5 if unit == "rows" else 200
    got = mixing.mix(docs, shares, 1, size, unit).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(900))
    weight = {"a": 2, "b": 3, mixing.OTHER: 1}
    by_slot = defaultdict(set)
    for r in got:
        by_slot[r["slot"]].add((r["stream"], r["block"], r["phase"]))
        assert r["release"] <= r["slot"] < r["deadline"]
    assert all(len(x) == 1 for x in by_slot.values())
    if unit == "rows":
        first = [next(iter(by_slot[t])) for t in sorted(by_slot) if next(iter(by_slot[t]))[2] == 0]
        count = Counter()
        for t, (s, _, _) in enumerate(first, 1):
            count[s] += 1
            assert all(abs(count[x] - w / 6 * t) < 1 for x, w in weight.items())
        assert max(by_slot) + 1 == len(by_slot)      # no slot stays empty


def test_every_source_has_its_own_share(spark, none, tmp_path):
    rng = random.Random(31)
    names = ["src0", "src1", *(f"n{i}" for i in range(6)), None]
    rows = [(i, "t" * 50_000, rng.choice(["n0"] * 4 + names), "en") for i in range(600)]
    docs = spark.createDataFrame(rows, DOC)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    weight, other = mixing.source_shares(docs, {"src0": 6, "src1": 3}, 14)
    assert weight == {"src0": 42, "src1": 21} | {f"n{i}": 14 for i in range(6)} and other == 14
    weight[mixing.OTHER] = other
    got = mixing.mix(docs, {s: a for s, a in weight.items() if s != mixing.OTHER}, other, 1, "rows").collect()
    assert {(r["doc_id"], r["stream"]) for r in got} == {(i, s or mixing.OTHER) for i, _, s, _ in rows}
    count = Counter()
    for t, r in enumerate(sorted((r for r in got if r["phase"] == 0), key=lambda r: r["slot"]), 1):
        count[r["stream"]] += 1
        assert all(abs(count[s] * sum(weight.values()) - a * t) < sum(weight.values()) for s, a in weight.items())
    assert {r["stream"] for r in mixing.op1_pfair_mix(spark, str(tmp_path)).collect()} == {s or mixing.OTHER for s in names}
    assert mixing.mix(none, *mixing.source_shares(none, {"a": 1}, 1)).count() == 0


def edf(blocks, shares):
    """Slot by slot: the released block with the earliest deadline; a source that runs out starts a new phase."""
    left, done, out = {s: n for s, n in blocks.items() if n}, Counter(), []
    while left:
        total, placed, t = sum(shares[s] for s in left), Counter(), 0
        while all(placed[s] < n for s, n in left.items()):
            ready = [(-(-(placed[s] + 1) * total // shares[s]), s) for s in left if placed[s] * total // shares[s] <= t]
            s = min(ready)[1]
            out.append((s, done[s] + placed[s]))
            placed[s] += 1
            t += 1
        done += placed
        left = {s: n - placed[s] for s, n in left.items() if n > placed[s]}
    return out


def slots(plan):
    out = {}
    for p in plan:
        for s, n in p["used"].items():
            for k in range(n):
                a = p["shares"][s]
                out[p["start"] + k // a * p["total"] + p["places"][s][k % a]] = (s, p["first"][s] + k)
    return [out[t] for t in range(len(out))]


def test_phases_are_the_schedule_followed_slot_by_slot():
    rng = random.Random(17)
    for _ in range(300):
        names = [f"s{i}" for i in range(rng.randint(1, 9))]
        shares = {s: rng.choice([1, 1, 2, 6, 35]) for s in names}
        blocks = {s: rng.choice([0, 1, 2, 17, 90]) for s in names}
        assert slots(mixing.phases(blocks, shares)) == edf(blocks, shares)


def test_the_schedule_of_many_sources_is_no_longer_than_the_blocks():
    shares = {f"h{i}": 6 + i % 2 for i in range(1500)}
    blocks = {s: 1 + i % 3 for i, s in enumerate(shares)}
    plan = mixing.phases(blocks, shares)
    assert sum(len(p) for step in plan for p in step["places"].values()) <= sum(blocks.values())
    assert slots(plan) == edf(blocks, shares)


def test_long_schedules_are_joined_by_chunk(spark, monkeypatch):
    rng = random.Random(23)
    docs = spark.createDataFrame([(i, "t" * rng.randint(1, 40), f"n{min(rng.randint(0, 30), 12)}", "en") for i in range(700)], DOC)
    shares, other = mixing.source_shares(docs, {"n1": 5, "n2": 3}, 9)
    plain = {tuple(r) for r in mixing.mix(docs, shares, other, 50).collect()}
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(mixing, "CHUNKS", 7)
    assert {tuple(r) for r in mixing.mix(docs, shares, other, 50).collect()} == plain and len(plain) == 700


def test_equal_rows_do_not_fill_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 20)
    docs = spark.createDataFrame([(7, "same", "a", "en")] * 300 + [(i, f"text {i}", "ab"[i % 2], "en") for i in range(300)], DOC)
    got = mixing.mix(docs, {"a": 2}, 1, 3, "rows").collect()
    assert len(got) == 600 and len({(r["slot"], r["seq"]) for r in got}) == 600


def test_mixture_edge_cases(spark, hostile, none):
    assert mixing.mix(hostile, {"a": 1}, 1).count() == len(HOSTILE)
    assert mixing.mix(none, {"a": 1}, 1).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(none, {"a": 0}, 1)
    assert mixing.mixed_order(hostile, {"a": 1}, 1).columns == hostile.columns
    assert mixing.mixed_order(hostile, {"a": 1}, 1).count() == len(HOSTILE)


# -- op 2

def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + (0.05 if i % 3 else 0.2) * rng.standard_normal(16)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(30)]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] * 16), (405, [1.0, 2.0]),
             (406, [2.0, 4.0]), (407, [float("inf")] + [1.0] * 15)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1)).withColumn("key", F.lit(2))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(vectors, block_rows=16).collect()}
    made = {i: embedding_dedup.usable(v) for i, v in rows}
    links = defaultdict(set)
    for i, a in made.items():
        for j, b in made.items():
            if i < j and a is not None and b is not None and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                links[i].add(j)
                links[j].add(i)
    low = {i: i for i in made}
    for _ in made:
        low = {i: min([low[i], *(low[j] for j in links[i])]) for i in made}
    assert len(got) == len(rows)
    for i in made:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links[i]), low[i], low[i] == i), i


def test_embedding_repeats_and_empty(spark):
    twice = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0]), (9, [5.0, -1.0])],
                                  "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(twice).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (9, 0, 9)]
    assert embedding_dedup.near_duplicates(twice.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7)], "a long, b long")
    got = {(r["node"], r["component"]) for r in components(chain).collect()}
    assert got == {(i, 0) for i in range(61)} | {(i, 100) for i in (100, 101, 102)}


# -- op 3

def distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


def test_myers_matches_the_table():
    rng = random.Random(1)
    for _ in range(300):
        item, text = ("".join(rng.choice("abc") for _ in range(rng.randint(1, n))) for n in (12, 30))
        assert decontaminate.myers(item, text, 4) == min(distance_in(item, text), 5)


def test_contamination_matches_brute_force(spark):
    rng = random.Random(2)
    items = [(i, words(rng, rng.randint(3, 30))) for i in range(12)] + [(50, None), (51, ""), (52, "!?")]
    docs = []
    for i in range(60):
        text, held = words(rng, 40), items[rng.randrange(12)][1]
        if i % 3 == 0:
            cut = list(held)
            for _ in range(rng.randint(0, 8)):
                cut[rng.randrange(len(cut))] = rng.choice("xyz ")
            text = f"{text}, {''.join(cut).upper()}! {words(rng, 10)}"
        docs.append((i, text, "s", "en"))
    docs += [(100, None, "s", "en"), (101, "", "s", "en"), (102, docs[0][1], "s", "en")]
    want = set()
    for d, text, _, _ in docs:
        for i, item in items:
            t, n = decontaminate.normalised(text), decontaminate.normalised(item)
            if t and n:
                n = n if len(n) >= decontaminate.MIN_CHARS else f" {n} "
                k, found = decontaminate.budget(n), distance_in(n, f" {t} ")
                if found <= k:
                    want.add((d, i, found))
    frames = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 60):       # one block of items, and many
        got = decontaminate.contaminated(*frames, block_chars=block)
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got.collect()} == want
    assert {d for _, _, d in want} - {0}       # edited passages are among them


def test_contamination_edge_cases(spark, hostile, none):
    items = spark.createDataFrame([(1, "no id here at all"), (2, "same row twice")], "item_id long, text string")
    got = decontaminate.contaminated(hostile, items).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got) == [(0, 1), (5, 2), (5, 2)]
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(hostile, items.limit(0)).count() == 0


# -- op 4

def test_language_held_out(spark):
    """Models fitted on one half tell the other half's languages from the text alone, and against wrong declarations."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.length("text") > 100)
    records = language.document_records(docs)
    fitted, held = records.where(F.col("id") % 2 == 0), records.where(F.col("id") % 2 == 1)
    truth = {r["id"]: r["declared"] for r in held.collect()}
    wrong = held.withColumn("declared", F.lit("en")).withColumn("host", F.lit(None).cast("string"))
    for asked in (held.withColumn("declared", F.lit(None).cast("string")), wrong):
        got = language.identify(asked, labelled=fitted).collect()
        assert np.mean([truth[r["id"]] == r["lang"] for r in got]) > 0.99


def test_other_evidence_decides_where_the_text_does_not(spark):
    def scored(i, said, host, **t):
        return (i, 0, said, None, host, None, True, *(t.get(x, -30.0) for x in language.LANGUAGES))

    flat = dict.fromkeys(language.LANGUAGES, 0.0)
    rows = [scored(i, "en", "a", en=0.0) for i in range(100)] + [scored(100 + i, "de", "b", de=0.0) for i in range(100)]
    rows += [scored(300, "de", None, **flat), scored(301, None, "b", **flat), scored(302, None, "a", **flat),
             scored(303, "de", "b", en=0.0)]
    ddl = "id long, text_hash long, declared string, suffix string, host string, parent string, known boolean, "
    frame = spark.createDataFrame(rows, ddl + ", ".join(f"t_{x} double" for x in language.LANGUAGES))
    got = {r["id"]: r["lang"] for r in language.fuse(frame).collect()}
    assert [got[i] for i in (0, 100, 300, 301, 302, 303)] == ["en", "de", "de", "de", "en", "en"]


def test_language_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["lang"] for r in language.language_id_pages(spark, "/root/testdata/sf0.01").collect()}
    said = {r[0]: r[1] for r in pages.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1)).collect()}
    assert np.mean([got[i] == said[i] for i in said]) > 0.97
    odd = spark.createDataFrame([(1, None, None), (2, "not a url", "<p>"), (3, "http://h.de", "")], "page_id long, url string, html string")
    assert language.identify(language.page_records(odd)).count() == 3


def test_language_edge_cases(spark, hostile, none):
    got = language.identify(language.document_records(hostile)).collect()
    assert len(got) == len(HOSTILE)
    assert {r["id"] for r in got if r["id"] in (1, 2, 4, 7) and r["accepted"]} == set()
    assert language.identify(language.document_records(none)).count() == 0


# -- op 5

def test_edited_counts_equal_a_full_count():
    rng, letters = random.Random(4), "ab 'sre\n\t  12.,é[]　"
    encode = chat.tokenizer().encode_ordinary
    for _ in range(800):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        starts, tree = token_counts.build(text, 3)
        at = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(1, 3))))
        edits = [(at[i], at[i + 1], "".join(rng.choice(letters) for _ in range(rng.randint(0, 4)))) for i in range(0, len(at) - 1, 2)]
        new, starts, tree, _ = token_counts.update(text, edits, starts, tree, 3)
        want = text
        for a, b, x in reversed(edits):
            want = want[:a] + x + want[b:]
        assert new == want and tree[1] == len(encode(want)) == sum(tree[len(tree) // 2:])
        new2, _, tree2, _ = token_counts.update(new, [(0, 0, "Z ")], starts, tree, 3)     # edits can follow edits
        assert tree2[1] == len(encode(new2))


def test_few_characters_are_encoded_again():
    text = words(random.Random(1), 5000)
    starts, tree = token_counts.build(text)
    assert token_counts.update(text, [(9000, 9004, "x")], starts, tree)[3] < 2000


def test_token_counts_of_tables(spark, hostile, none, tmp_path):
    rows = [*HOSTILE, (8, "write to a.b@c.de or 1234567890, é twice a.b@c.de", "a", "en")]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    got = token_counts.op5_edit_aware_counts(spark, str(tmp_path)).collect()
    encode = chat.tokenizer().encode_ordinary
    want = sorted((i or 0, len(encode(t or "")), len(encode(re.sub(token_counts.MASKED, token_counts.MASK, t or "")))) for i, t, _, _ in rows)
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_tokens_after"]) for r in got) == want
    assert token_counts.trees(none).count() == 0 and token_counts.trees(hostile).count() == len(HOSTILE)


# -- op 6

def test_shards_are_near_equal_and_gapless(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, "é" * int(rng.paretovariate(2.5) * 20), "s", "en") for i in range(2000)], DOC)
    got = sharding.shard(docs, 7, 1024).collect()
    load, places = Counter(), defaultdict(list)
    for r in got:
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert max(load.values()) - min(load.values()) <= 64 and set(load) == set(range(7))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_rebalancing_moves_little():
    rng = random.Random(7)
    size = [rng.randint(50, 150) for _ in range(1000)]
    before = sharding.rebalanced(sharding.even_map(1000, 10), size, 10)
    grown = sharding.rebalanced(before, size, 11)
    assert sum(a != b for a, b in zip(before, grown)) < 150 and set(grown) == set(range(11))
    assert sharding.rebalanced(grown, size, 11) == grown


def test_sharding_edge_cases(spark, hostile, none):
    import zlib
    got = sharding.shard(hostile).collect()
    want = sorted((i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in HOSTILE)
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.shard(none).count() == 0
    assert sharding.assigned(hostile, shard_col="shard_").columns == [*hostile.columns, "shard_"]


# -- op 7

def test_line_templates_match_brute_force(spark, none):
    rng = random.Random(8)
    body = [words(rng, 12) for _ in range(40)]
    docs = []
    for i in range(120):
        text = [words(rng, 8), rng.choice(body), "", f"Page {i} of 99 printed on host{i}", f"log in now to read {words(rng, 1)} and more of it"]
        docs.append((i, "\n".join(rng.sample(text, 5)), "s", "en"))
    docs += [(200 + i, docs[0][1], "s", "en") for i in range(30)] + HOSTILE
    texts, leaf = defaultdict(set), {}
    for _, t, _, _ in docs:
        for line in (t or "").split("\n"):
            if k := tuple(line_templates.parsed(line)):
                texts[k].add(t)
                leaf[k] = (len(k), k[:line_templates.LEAD])
    low = line_templates.MIN_DOCS
    often = {k for k, v in texts.items() if len(v) >= low}
    template, spread = {}, defaultdict(set)
    for k in set(texts) - often:
        like = [x for x in set(texts) - often if leaf[x] == leaf[k]]
        count = Counter()
        for x in like:
            for j, token in enumerate(x):
                count[j, token] += len(texts[x])
        t = tuple(x if x != "<*>" and count[j, x] >= low else "<*>" for j, x in enumerate(k))
        if len(like) > 1 and sum(x != "<*>" for x in t) >= line_templates.SIMILARITY * len(t):
            template[k] = leaf[k], t
            spread[template[k]] |= texts[k]
    gone = often | {k for k, t in template.items() if len(spread[t]) >= low}
    assert any("log" in k for k in gone - often) and any("Page" in k for k in often)
    want = sorted((i or 0, t is None, "\n".join(x for x in (t or "").split("\n") if tuple(line_templates.parsed(x)) not in gone))
                  for i, t, _, _ in docs)
    got = sorted((r["doc_id"] or 0, r["text"] is None, r["text"] or "") for r in line_templates.cleaned(spark.createDataFrame(docs, DOC)).collect())
    assert got == want
    assert line_templates.cleaned(none).count() == 0


def test_long_lines_recur_from_two_texts_on(spark):
    rng = random.Random(21)
    passage, at_most = words(rng, line_templates.LONG_WORDS + 1), words(rng, line_templates.LONG_WORDS)
    docs = [(1, f"{passage}\none here"), (2, f"and two here\n{passage}\n{at_most}"), (3, f"three now\n{at_most}"),
            (4, words(rng, 60)), (5, twice := words(rng, 60)), (6, twice)]        # exact copies are one text
    got = {r["doc_id"]: (r["n_dropped"], r["text"]) for r in line_templates.cleaned(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (1, "one here"), 2: (1, f"and two here\n{at_most}")} | {i: (0, t) for i, t in docs[2:]}


def test_templates_count_over_all_lines_of_a_leaf(spark):
    rng = random.Random(22)
    footer = "all rights are kept by the house of one press and print".split()
    docs = []

    def add(line):
        docs.append((len(docs), f"{words(rng, 7)} {len(docs)}\n{' '.join(line)}"))

    for _ in range(30):
        add(footer)
    for i in range(9):                                         # one other word, the same in all: 39 texts have the template
        add([*footer[:8], "two", *footer[9:]])
    for i in range(3):                                         # two other words
        add([*footer[:7], f"x{'abc'[i]}", "of", *footer[9:]])
    for i in range(4):                                         # too few constant tokens
        add([*footer[:3], *words(rng, 8).split(), footer[-1]])
    for i in range(6):                                         # leaf of 12 texts in which nothing recurs by itself
        add("see also the pages on red".split())
        add("see also the pages on blue".split())
    for i in range(3):                                         # and one of 9 texts
        for colour in ("red", "blue", "green"):
            add(f"look up all pages on {colour}".split())
    for _ in range(150):
        add([rng.choice("pq"), "a", "b", *(rng.choice("cccccccde") + rng.choice("fffg") for _ in range(5))])
    low, texts = line_templates.MIN_DOCS, defaultdict(set)
    for _, t in docs:
        for line in t.split("\n"):
            texts[tuple(line_templates.parsed(line))].add(t)
    often = {k for k, v in texts.items() if len(v) >= low}
    gone, template, spread = set(often), {}, defaultdict(set)
    for k in texts:
        like = [x for x in texts if (len(x), x[:line_templates.LEAD]) == (len(k), k[:line_templates.LEAD])]
        fixed = [j for j, x in enumerate(k) if x != "<*>" and sum(len(texts[y]) for y in like if y[j] == x) >= low]
        if len(like) > 1 and len(fixed) >= line_templates.SIMILARITY * len(k):
            template[k] = len(k), k[:line_templates.LEAD], tuple((j, k[j]) for j in fixed)
            for y in like:
                if y == k or y in often and all(y[j] == k[j] for j in fixed):
                    spread[template[k]] |= texts[y]
    gone |= {k for k, t in template.items() if len(spread[t]) >= low}
    assert (*footer[:8], "two", *footer[9:]) in gone and tuple("see also the pages on red".split()) in gone
    assert tuple("look up all pages on red".split()) not in gone
    assert len(gone) < len(texts) - len(docs)                  # the first lines and others stay
    want = {i: "\n".join(x for x in t.split("\n") if tuple(line_templates.parsed(x)) not in gone) for i, t in docs}
    got = line_templates.cleaned(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want


# -- op 8

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def passes(kind, hit):
        number = re.sub("[^0-9]", "", hit)
        if kind == "ip":
            return all(int(x) <= 255 for x in hit.split("."))
        if kind == "card":
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(number)))
            return 12 <= len(number) <= 19 and luhn % 10 == 0
        return kind == "email" or 9 <= len(number) <= 15

    return sorted((m.start(), j, m.end(), k) for j, k in enumerate(PATTERNS) for m in re.finditer(PATTERNS[k], text) if passes(k, m.group()))


def test_personal_data_base_spans(spark, none, tmp_path):
    rng = random.Random(9)
    bits = ["a.b@c.d", "@", "x@y", "_q@r.st-u.v", ".", "1.2.3.4", "10.0.0.256", "+1 (555) 123-4567", "4111 1111 1111 1111",
            "4111111111111111", "-", " ", "é", "😀", "+", "007.1.2.3.4.5.6.7", "12345678901234567890", "(", "5", "\n", "a@b.c@d.e"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += ["1 " * 30_000, "a" * 100_000, "1." * 30_000, "+1" * 20_000, "a.b@c.d " * 300, None, "", texts[0]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in pii.op8_weak_supervision_pii(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        spans = base_spans(text or "")
        listed = [f"{k}:{a}:{b}" for a, _, b, k in spans]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(s[3] == k for s in spans) for k in PATTERNS]
        assert set(listed) <= set(got[i]["spans"].split(",")) | {""}
    assert pii.find(none).count() == 0


def test_personal_data_added_spans(spark, hostile):
    rows = [(i, f"call me: +1 415 555 {1000 + i}, mail to jo{i}@mail.com", "s", "en") for i in range(200)]
    rows += [(300, "please call 415-555-1234 today", "s", "en"), (301, "write an e-mail to jo (at) mail (dot) com please", "s", "en")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, DOC)).collect()}
    assert [(s["kind"], s["base"]) for s in got[300]] == [("phone", False)]
    assert [(s["kind"], s["base"]) for s in got[301]] == [("email", False)]
    assert pii.find(hostile).count() == len(HOSTILE)


def test_reliabilities_find_the_bad_labeler():
    rng, counts = random.Random(10), Counter()
    for _ in range(5000):
        true = rng.random() < 0.4
        said = [(1 if true else -1) * (1 if rng.random() < right else -1) for right in (0.95, 0.9, 0.85, 0.8, 0.5)]
        counts["phone", *said] += 1
    belief = pii.reliabilities([(*k, n) for k, n in counts.items()])
    assert belief["phone", 1, 1, 1, 1, -1] > 0.95 and belief["phone", -1, -1, -1, -1, 1] < 0.05


# -- op 9

def test_chat_round_trip(spark):
    rng = random.Random(11)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "é", "\n", " ok ", "<", "[", "<<s>>"]
    rows = [(c, t, rng.choice(["user", "assistant", "sys</s>", None]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) or None)
            for c in range(40) for t in range(rng.randint(1, 5))]
    rows += [(50, 0, "user", "b"), (50, 0, "user", "a"), (50, 0, "user", "a"), (None, None, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, said in by.items():
        said = [x[1:] for x in sorted(said)]
        ids, mask = np.array(got[c]["ids"]), np.array(got[c]["loss_mask"])
        assert chat.read_back(ids) == said
        assert chat.loss_text(ids, mask) == "".join(x for role, x in said if role == "assistant")
        plain = chat.rendered(ids)
        assert plain.count("</s>") == len(said) == plain.count("[INST]") and plain.count("<s>") == 1
        assert [(chat.unescape(a), chat.unescape(b)) for a, b in re.findall(r"\[INST\](.*?)\[/INST\](.*?)</s>", plain, re.S)] == said
    assert chat.digests(chat.format_chats(turns.limit(0))).count() == 0


def test_chat_query_equals_its_sql(spark):
    import duckdb
    conversations = duckdb.read_parquet("/root/testdata/sf0.01/conversations.parquet")  # noqa: F841
    want = duckdb.sql(chat.OP9_SQL).df().sort_values("conv_id").reset_index(drop=True)
    got = chat.op9_chat_tokens(spark, "/root/testdata/sf0.01").toPandas().sort_values("conv_id").reset_index(drop=True)
    assert (got[list(want.columns)].astype(str) == want.astype(str)).all().all()


# -- op 10

def brute_components(docs, n, percent):
    sets = {i: jaccard_join.shingles(t or "", n) for i, t in docs}
    low = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    for _ in sets:
        before = dict(low)
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
        if low == before:
            break
    return {i: (len(s), low[i]) for i, s in sets.items()}


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_jaccard_join_matches_brute_force(spark, n, percent):
    rng, docs = random.Random(12), []
    for g in range(25):
        base = words(rng, rng.choice([1, 3, 5, 8, 12, 20, 40, 90, 200, 400])).split()
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randint(0, 2)] = [words(rng, 1)]
            docs.append((len(docs), rng.choice([" ", "\n", "\t "]).join(copy).replace("a", rng.choice("aA"))))
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, "é b"), (1004, docs[0][1])]
    got = jaccard_join.joined(spark.createDataFrame(docs, "doc_id long, text string"), n, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(docs, n, percent)


def test_leading_white_space_does_not_count():
    code = ("from plenaria.llm.jaccard_join import shingle_hashes as h\n"
            "for t in (' 9', '\\n' * 10_000 + 'a b c d e f', ' a b c d e f ', '\\t\\v x'):\n"
            "    assert list(h(t)) == list(h(t.strip())) and len(h(t)), t\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(jaccard_join.__file__).parents[2])    # a fresh worker


def test_jaccard_join_of_leading_blanks(spark):
    base = "the quick brown fox jumps over the lazy dog"
    docs = [(1, base), (2, " " + base), (3, "\n" * 10_000 + base), (4, " " * 2_000 + base + " again"), (5, " 9"), (6, "9 ")]
    got = jaccard_join.joined(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(docs, 4, 85)


@pytest.mark.parametrize("centre", [True, False])
def test_crowded_entries_match_brute_force(spark, centre):
    """Near copies round one text, on both sides of the threshold, with and without the text itself."""
    rng, base = random.Random(41), words(random.Random(40), 300).split()
    docs = [(0, " ".join(base))] if centre else []
    while len(docs) < 90:
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.randint(2, 18)):
            copy[at] = rng.choice(["same", words(rng, 1)])
        docs.append((len(docs) + 1, " ".join(copy)))
    for n, percent in ((4, 85), (5, 80)):
        got = jaccard_join.joined(spark.createDataFrame(docs, "doc_id long, text string"), n, percent)
        want = brute_components(docs, n, percent)
        assert len({c for _, c in want.values()}) > 5
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


def test_group_without_centre_verifies_only_pairs_near_the_threshold(spark, monkeypatch):
    """Large near copies that share their changes, so that none has many own shingles and small sketches are full."""
    rng, base = random.Random(42), words(random.Random(43), 1500).split()
    docs = []
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(250), 22):
            copy[6 * at] = f"changed{at}"
        docs.append((i, " ".join(copy)))
    compared, verified = [], jaccard_join.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "verified", counted)
    got = jaccard_join.joined(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(docs, 5, 80)
    assert compared[-1] < 60 * 59 / 2 / 4


def test_entries_of_the_same_classes_are_one(spark):
    rows = [(e, fp, fp % 2) for e, fps in ((1, [5, 6, 7]), (2, [5, 6, 7]), (3, [5, 6]), (4, [6, 7])) for fp in fps]
    got = jaccard_join.same_entries(spark.createDataFrame(rows, "entry long, fp long, part long")).collect()
    sets = {}
    for r in got:
        sets.setdefault((r["n"], r["h"]), []).append(r["fp"])
    assert sorted(sorted(s) for s in sets.values()) == [[5, 6], [5, 6, 7], [6, 7]]


def test_entries_never_miss_a_pair():
    rng = np.random.default_rng(13)
    for size in (1, 2, 3, 4, 5, 6, 7, 9, 11, 12, 15, 19, 25, 40, 70, 100, 130, 180, 300, 500, 900):
        for _ in range(20):
            x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            drop = int(len(x) * rng.uniform(0, 0.15))
            for percent in (85, 80):
                for add in {0, drop // 2, drop}:
                    y = np.unique(np.concatenate([x[drop - add:], rng.integers(0, 2**63, add).astype(np.uint64)]))
                    both = len(np.intersect1d(x, y))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        assert len(np.intersect1d(jaccard_join.entries(x, percent), jaccard_join.entries(y, percent)))


def test_links_share_as_many_entries_as_promised():
    rng, linked, bounds = np.random.default_rng(14), 0, []
    for size in (1, 2, 3, 5, 8, 12, 19, 30, 55, 90, 140, 200, 310, 500, 900, 2000):
        for _ in range(20):
            x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            drop = int(len(x) * rng.uniform(0, 0.2))
            for percent in (85, 80):
                for add in {0, drop // 2, drop}:
                    y = np.unique(np.concatenate([x[drop - add:], rng.integers(0, 2**63, add).astype(np.uint64)]))
                    both = len(np.intersect1d(x, y))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        shared = np.intersect1d(jaccard_join.entries(x, percent), jaccard_join.entries(y, percent))
                        bounds.append(max(jaccard_join.least_shared(s, percent) for s in (x, y)))
                        assert len(shared) >= bounds[-1] >= 1
                        linked += 1
    assert linked > 500 and np.mean(np.array(bounds) > 3) > 0.3


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_texts_with_a_common_passage_are_not_taken_apart(spark, monkeypatch, n, percent):
    """Unrelated texts that share a passage, and thus a few entries, beside near copies: only these are looked at again."""
    rng = random.Random(44)
    passage, base = words(rng, 60), words(rng, 300).split()
    docs = [(i, f"{words(rng, 150)} {passage} {words(rng, 150)}") for i in range(40)]
    for i in range(40, 52):
        copy = list(base)
        for at in rng.sample(range(len(copy)), 8):
            copy[at] = words(rng, 1)
        docs.append((i, " ".join(copy)))
    crowded, own_shingles = [], jaccard_join.own_shingles

    def counted(some, *rest):
        crowded.append(some.count())
        return own_shingles(some, *rest)

    monkeypatch.setattr(jaccard_join, "own_shingles", counted)
    got = jaccard_join.joined(spark.createDataFrame(docs, "doc_id long, text string"), n, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(docs, n, percent)
    assert len(crowded) == 1 and crowded[0] <= 12


def test_jaccard_edge_cases(spark, hostile, none):
    got = jaccard_join.joined(hostile).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in got) == [
        (0, 2, 0), (1, 0, 1), (2, 0, 2), (4, 0, 4), (5, 1, 5), (5, 1, 5), (6, 1, 6), (7, 1, 7)]
    assert jaccard_join.joined(none).count() == 0
