"""The term index against an alternation, and its plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from plenaria.operators import term_index

WORDS = ["renda", "mínima", "bolsa", "família", "pobreza", "extrema", "social", "ação", "X1", "da", "e"]


def alternation(terms):
    """Longest first, between word boundaries; any marks and white space between the words of a term."""
    cut = {tuple(w.lower() for w in re.findall(r"[^\W_]+", t)) for t in terms}
    parts = sorted((c for c in cut if c), key=lambda c: (-len(c), c))
    return re.compile("(?<![^\\W_])(?:" + "|".join("[\\W_]+".join(map(re.escape, c)) for c in parts) + ")(?![^\\W_])", re.I)


def norm(found):
    return " ".join(w.lower() for w in re.findall(r"[^\W_]+", found))


@pytest.mark.parametrize("seed", [1, 2])
def test_index_equals_alternation(spark, seed):
    rng = random.Random(seed)
    terms = ["renda mínima", "renda", "Bolsa Família", "extrema pobreza", "pobreza", "ação social e renda", "e", "da", "e", "--"]
    terms += [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 4))) for _ in range(12)]
    texts = ["".join(rng.choice(WORDS) + rng.choice([" ", ", ", "-", "\n", "_", "  ", "."]) for _ in range(rng.randint(0, 25)))
             .replace("renda", rng.choice(["renda", "RENDA", "rendas"])) for _ in range(120)]
    texts += ["", None, "nada", "renda", "renda mínima " * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    tt = spark.createDataFrame([(t,) for t in terms], "termo string")
    pattern = alternation(terms)
    want = {}
    for i, t in enumerate(texts):
        for m in pattern.findall(t or ""):
            want[i, norm(m)] = want.get((i, norm(m)), 0) + 1
    got = term_index.index_term_counts(df, tt, ["id"], "t").collect()
    assert {(r["id"], r["termo"]): r["n"] for r in got} == want
    first = {r["id"]: r["termo"] for r in term_index.first_index_term(df, tt, ["id"], "t").collect()}
    assert first == {i: norm(m.group()) for i, t in enumerate(texts) if (m := pattern.search(t or ""))}


def test_ten_thousand_terms(spark):
    """No pattern of the terms in the plan, and the same result through a shuffled join."""
    rng = random.Random(3)
    terms = sorted({" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randint(1, 3))) for _ in range(10_500)})[:10_000]
    texts = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(200))) for i in range(40)]
    df = spark.createDataFrame(texts, "id long, t string")
    tt = spark.createDataFrame([(t,) for t in terms], "termo string")
    out = term_index.index_term_counts(df, tt, ["id"], "t")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert terms[0] not in plan and "Join Inner" in plan and "Cartesian" not in plan
    got = sorted(tuple(r) for r in out.collect())
    pattern = alternation(terms)
    want = {}
    for i, t in texts:
        for m in pattern.findall(t):
            want[i, norm(m)] = want.get((i, norm(m)), 0) + 1
    assert got == sorted((i, t, n) for (i, t), n in want.items())
    few, term_index.BROADCAST_ROWS = term_index.BROADCAST_ROWS, 10
    try:
        assert sorted(tuple(r) for r in term_index.index_term_counts(df, tt, ["id"], "t").collect()) == got
    finally:
        term_index.BROADCAST_ROWS = few


def test_no_terms_and_no_texts(spark):
    df = spark.createDataFrame([(1, "renda")], "id long, t string")
    none = spark.createDataFrame([], "termo string")
    assert term_index.first_index_term(df, none, ["id"], "t").count() == 0
    assert term_index.index_term_counts(df, none, ["id"], "t").count() == 0
    some = spark.createDataFrame([("renda",)], "termo string")
    assert term_index.index_term_counts(df.where(F.lit(False)), some, ["id"], "t").count() == 0
