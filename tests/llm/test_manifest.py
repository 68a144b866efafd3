"""The Merkle manifest against a recursive build, its SQL, and a verifier."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from plenaria.llm import manifest

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def climb(tree, i):
    """(siblings to the left, to the right) per level."""
    for level in tree[:-1]:
        low = i - i % 3
        yield level[low:i], level[i + 1:low + 3]
        i //= 3


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        t = r["text"]
        bad = t is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        by[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, t), leaf(r, t.replace("\n", "") if bad else t),
                                r["doc_id"]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:4])]) for s in names}
    over = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, x in enumerate(sorted(by[s], key=lambda x: x[:4])):
            steps = [*climb(trees[s], i), *climb(over, k)]
            fold = x[3]
            for before, after in steps:
                fold = h("".join(before) + fold + "".join(after))
            root = over[-1][0]
            out.append((x[4], x[2], trees[s][-1][0], root, h("".join("".join(b + a) for b, a in steps)), fold, fold == root))
    return sorted(out, key=repr)


def documents(seed, sources, n):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(sources)]
    rows = [(i if rng.random() < 0.97 else None, rng.choice(["a\nb", "c", "", None, "é\n", "x " * 30]),
             rng.choice([None, *names] + names[:1] * sources), rng.choice(["en", None]), rng.choice([None, i]))
            for i in range(n)]
    return rows + rows[:5]      # repeated rows


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("sources, n, levels_", [(3, 40, 2), (11, 400, 2), (1, 700, 5), (40, 300, 1)])
def test_manifest_matches_a_recursive_build(spark, tmp_path, monkeypatch, sources, n, levels_):
    monkeypatch.setattr(manifest, "LEVELS", levels_)
    df = spark.createDataFrame(documents(n, sources, n), SCHEMA)
    df = df.withColumns({c: F.lit("x") for c in ("rank", "n", "tree", "part", "level", "low", "path", "task", "hash", "leaf", "LEAF_")})
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = manifest.op12_interval_manifest(spark, str(tmp_path))
    assert tuple(got.columns) == COLUMNS
    want = brute([r.asDict() for r in df.collect()])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(manifest.OP12_SQL).fetchall(), key=repr) == want


@pytest.mark.parametrize("rows", [[], [(1, "a", None, "en", 1)], [(1, "a", "s", "en", 1), (2, None, "s", "en", None)],
                                  [(1, "a\n", "s", "en", 1), (1, "a\n", None, "en", 1), (None, None, None, None, None)]])
def test_small_manifests(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in manifest.op12_interval_manifest(spark, str(tmp_path)).collect()), key=repr)
    assert got == (brute([dict(zip(("doc_id", "text", "source", "lang", "n_chars"), r)) for r in rows]) if rows else [])


def test_other_tampering_is_seen(spark):
    """A changed, a swapped and an unchanged leaf against one manifest."""
    rows = spark.createDataFrame([(i, f"{i % 4}", h(str(i))) for i in range(100)], "id long, source string, leaf string")
    got = manifest.manifest(rows, "source", [F.col("id")]).withColumn("other", F.lit(h("else")))
    got = got.select("id", "root", manifest.folded(F.col("leaf"), F.col("path")).alias("same"),
                     manifest.folded(F.col("other"), F.col("path")).alias("changed")).collect()
    assert len({r["root"] for r in got}) == 1 and all(r["same"] == r["root"] != r["changed"] for r in got)
