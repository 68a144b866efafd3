"""The corpus pipeline on a small corpus: every stage's decision takes effect, and odd rows do no harm."""

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from plenaria.llm import mixing
from plenaria.llm.common import written


def words(rng, n):
    return " ".join(rng.choice(["thering", "andly", "ofthe", "streat", "onward", "ness", "hand", "whether", "lone", "fore"]) + rng.choice("abcdefgh") for _ in range(n))


def test_pipeline(spark, tmp_path):
    rng = random.Random(1)
    item = words(rng, 30)
    clean = [(i, words(rng, 80), "en", rng.choice(["src0", "src1", "z", None]), 0) for i in range(60)]
    copies = [(100 + i, clean[0][1] + " extra", "en", "z", 0) for i in range(5)]
    leaks = [(200, f"{words(rng, 20)} {item.upper()} {words(rng, 20)}", "en", "z", 0)]
    odd = [(300, None, "en", "z", 0), (301, "*** 123", None, None, None), (None, words(rng, 50), "en", "z", 0),
           (302, "one two", "en", "z", 0), (302, "one two", "en", "z", 0)]
    docs = spark.createDataFrame(clean + copies + leaks + odd, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("Shard", F.lit("own")).withColumns({c: F.lit(1) for c in (
        "text_hash", "SLOT", "seq", "gone_id", "__gone_id", "__id", "__hash", "__slot", "MAP_SLOT", "mix_id", "mix_place", "Mix_Slot")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    ids, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, str(tmp_path)), "test-pipeline")
        ids[name] = Counter(r["doc_id"] for r in now.collect())
        if name != "shards":
            assert now.columns == docs.columns
    everything = Counter(r[0] for r in clean + copies + leaks + odd)
    assert ids["language"] == everything - Counter([300, 301])
    assert ids["near-copies"] == ids["language"] - Counter([100, 101, 102, 103, 104, 302])
    assert ids["decontamination"] == ids["near-copies"] - Counter([200])
    assert ids["mixture"] == ids["shards"] == ids["decontamination"]
    assert now.columns == [*docs.columns, "shard_"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


def test_repeated_rows_without_words_stay(spark, tmp_path):
    """Whether or not a row with words repeats too."""
    blank = [(1, " \n", "en"), (1, " \n", "en"), (2, None, "en"), (2, None, "en"), (3, "one two three", "en")]
    for rows in (blank, [*blank, blank[-1]]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        left = corpus_pipeline.without_near_copies(spark, docs, str(tmp_path)).collect()
        assert Counter(r["doc_id"] for r in left) == {1: 2, 2: 2, 3: 1}


def test_mixture_order_is_the_schedule(spark, tmp_path):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "x" * rng.randint(1, 2000), rng.choice("ab")) for i in range(500)], "doc_id long, text string, source string")
    place = {r["doc_id"]: (r["slot"], r["seq"]) for r in mixing.mix(docs, {"a": 1}, 1, 4096).collect()}
    mixing.mixed_order(docs, {"a": 1}, 1, block_size=4096).write.parquet(str(tmp_path / "mixed"))
    files = sorted(p for p in (tmp_path / "mixed").iterdir() if p.suffix == ".parquet")
    import pyarrow.parquet as pq
    order = [i for f in files for i in pq.read_table(f)["doc_id"].to_pylist()]
    assert [place[i] for i in order] == sorted(place.values())


def test_stages_take_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_with_null_and_repeated_ids(spark):
    rng = random.Random(3)
    texts = [words(rng, 60) for _ in range(12)]
    rows = [(None, t) for t in texts[:6]]                            # unrelated, none with an id
    rows += [(7, texts[6]), (7, texts[7])]                           # unrelated, one id
    rows += [(8, texts[8]), (8, texts[9])]                           # two groups whose smallest id is the same
    copies = [(9, texts[8] + " more"), (None, texts[9] + " more"), (None, texts[0])]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string")
    kept = corpus_pipeline.without_near_copies(spark, docs, "")
    assert Counter(tuple(r) for r in kept.collect()) == Counter(rows)


def test_mixture_reaches_the_result(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    docs = [(i, words(rng, rng.randint(20, 60)), "en", rng.choice(["src0", "src0", "src1", "z"]), 0) for i in range(240)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").withColumn("slot", F.lit("own"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    monkeypatch.setattr(mixing.mix, "__defaults__", (1000, *mixing.mix.__defaults__[1:]))     # small blocks for a small corpus
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*docs.columns, "shard", "slot_", "seq"]
    rows = got.collect()
    plan = {r["doc_id"]: (r["slot"], r["seq"]) for r in mixing.mix(got.select(docs.columns), *mixing.source_shares(got, mixing.SHARES, mixing.OTHER_SHARE)).collect()}
    assert len(rows) == 240 and {r["doc_id"]: (r["slot_"], r["seq"]) for r in rows} == plan
    assert len({r["slot_"] for r in rows}) > 20

    # the last stage has no column for it: there the files hold each shard's rows in that order
    corpus_pipeline.in_shards(spark, got.select(docs.columns), "").write.parquet(str(tmp_path / "out"))
    import pyarrow.parquet as pq
    files = [pq.read_table(f) for f in sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".parquet")]
    order = [(s, *plan[i]) for f in files for s, i in zip(f["shard"].to_pylist(), f["doc_id"].to_pylist())]
    assert len(order) == 240 and order == sorted(order)
