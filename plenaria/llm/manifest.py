"""Merkle manifest of a dataset, with nodes labelled by the intervals of leaf ranks that they cover.

Every row is a leaf; per source the leaves ascend by id, and runs of RUN consecutive nodes become their parent until one is
left, the subroot; subroots, by source, likewise give the root.  ``ranked`` numbers leaves by a range sort, so that a hot
source spreads over all tasks.  ``tree`` builds the nodes in buckets of LEVELS levels: the at most RUN ** LEVELS nodes that
one node of the bucket's top covers meet in one row, whatever the size of the tree, and the tops are the leaves of the next
bucket.  A node is (level, low, high, hash, children with their own intervals).  ``proofs`` goes the same buckets top down: a
node joins the bucket's nodes by bucket and containment of its interval, which attaches its ancestors, and the children of
each ancestor whose intervals do not cover it are its siblings.  A path is a list of steps, the hashes left and right of the
node in its run; it holds what a verifier needs to fold a leaf up to the root.

Edge cases: a null field is `-` in the leaf, so null and empty texts differ; a null source is a source, the first; null ids
come first; rows of one id and source are ordered by their leaf, and equal rows by their tampered leaf, so that ties have
one order; a source of one row has its leaf as subroot; one source alone has its subroot as root; an empty table gives an
empty result; further columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenaria.llm.common import broadcast_if_small, table, written

RUN = 3
LEVELS = 5      # levels of a bucket: its top covers 243 of its leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """Length-prefixed text of a value, `-` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(c) for c in fields)), 256)


def tampered_text(text: Column, doc_id: Column) -> Column:
    """The text without its line feeds where 2 divides the CRC-32 of the decimal id."""
    return F.when(F.crc32(doc_id.cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)


def ranked(rows: DataFrame, tree: str, order: list) -> DataFrame:
    """``rows`` with their ``rank`` from 0 among the rows of equal ``tree`` by ``order``, and the tree's ``n`` rows.

    One range sort; a task's place among all tasks comes from their row counts, one number a task."""
    keys = [F.col(tree).asc_nulls_first(), *order]
    held = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    held = written(held.withColumn("task", F.shiftright("at", 33)).withColumn("at", F.col("at") - F.shiftleft("task", 33)),
                   "manifest-sorted")
    counts = held.groupBy("task", F.col(tree).alias("t")).agg(F.count("*").alias("k"), F.min("at").alias("first"))
    # rows of the tree in earlier tasks: a tree of many tasks has one number in each
    earlier = Window.partitionBy("t").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("k").over(earlier), F.lit(0)))
                     .withColumn("n", F.sum("k").over(Window.partitionBy("t"))).withColumnRenamed("task", "t_task"),
                     "manifest-counts")
    return (held.join(broadcast_if_small(counts), (F.col("task") == F.col("t_task")) & F.col(tree).eqNullSafe(F.col("t")))
            .withColumn("rank", F.col("at") - F.col("first") + F.col("before"))
            .drop("task", "at", "t", "t_task", "k", "first", "before"))


def depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: the smallest h with RUN ** h >= n."""
    powers = F.array(*(F.lit(RUN ** h) for h in range(40)))      # 3 ** 39 is the last that a long holds
    return F.size(F.filter(powers, lambda p: p < n))


def parents(nodes: Column) -> Column:
    """The level above ``nodes`` (low, high, hash): runs of RUN, each with its children."""
    def parent(i: Column) -> Column:
        run = F.slice(nodes, i * RUN + 1, RUN)
        return F.struct(F.element_at(run, 1)["low"].alias("low"), F.element_at(run, -1)["high"].alias("high"),
                        F.sha2(F.concat_ws("", F.transform(run, lambda c: c["hash"])), 256).alias("hash"),
                        F.transform(run, lambda c: F.struct(c["low"].alias("low"), c["high"].alias("high"),
                                                            c["hash"].alias("hash"))).alias("children"))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / RUN).cast("int")), parent)


def bucket(leaves: DataFrame) -> DataFrame:
    """tree, part, n, level, low, high, hash, children: the nodes of one bucket of levels over ``leaves`` (tree, rank, n, hash).
    ``low`` and ``high`` are ranks of these leaves, high exclusive.  A tree stops where one node is left."""
    part = F.floor(F.col("rank") / RUN ** LEVELS)
    rows = (leaves.groupBy("tree", part.alias("part"), "n")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("low"), (F.col("rank") + 1).alias("high"), "hash")))
                 .alias("l0")))
    for level in range(1, LEVELS + 1):
        rows = rows.withColumn(f"l{level}", F.when(depth(F.col("n")) >= level, parents(F.col(f"l{level - 1}"))))
    levels = F.array(*(F.struct(F.lit(h).alias("level"), F.col(f"l{h}").alias("nodes")) for h in range(1, LEVELS + 1)))
    return (rows.select("tree", "part", "n", F.explode(levels).alias("l")).where(F.col("l.nodes").isNotNull())
            .select("tree", "part", "n", "l.level", F.explode("l.nodes").alias("node"))
            .select("tree", "part", "n", "level", "node.*"))


def steps(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """tree, part, rank, path: each leaf's siblings in the bucket's ``nodes``, level by level.

    The join is on the bucket; a node is an ancestor if its interval contains the leaf's rank."""
    x = leaves.select("tree", "rank", F.floor(F.col("rank") / RUN ** LEVELS).alias("part"))
    y = nodes.select(F.col("tree").alias("y_tree"), F.col("part").alias("y_part"), "level", "low", "high", "children")
    rank = F.col("rank")

    def beside(of):
        others = F.filter("children", of)
        return F.concat_ws("", F.transform(others, lambda c: c["hash"]))

    pairs = (x.join(y, F.col("tree").eqNullSafe(F.col("y_tree")) & (F.col("part") == F.col("y_part"))
                    & (F.col("low") <= rank) & (rank < F.col("high")))
             .select("tree", "part", "rank", F.struct("level", beside(lambda c: c["high"] <= rank).alias("before"),
                                                      beside(lambda c: c["low"] > rank).alias("after")).alias("step")))
    return (pairs.groupBy("tree", "part", "rank").agg(F.array_sort(F.collect_list("step")).alias("path"))
            .select("tree", "part", "rank", F.transform("path", lambda s: F.struct(s["before"].alias("before"),
                                                                                   s["after"].alias("after"))).alias("path")))


def with_paths(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, rank, path to the tree's top; tree, top) for ``leaves`` (tree, rank, n, hash)."""
    levels, here = [], leaves
    while True:
        nodes = written(bucket(here), "manifest-nodes")
        levels.append((here, nodes))
        # the next bucket's leaves: tops of trees that go on
        here = (nodes.where((F.col("level") == LEVELS) & (F.col("n") > RUN ** LEVELS))
                .select("tree", F.col("part").alias("rank"), F.ceil(F.col("n") / RUN ** LEVELS).alias("n"), "hash"))
        if here.isEmpty():
            break
    tops, paths = None, None
    for here, nodes in reversed(levels):
        found = here.where(F.col("n") == 1).select("tree", F.col("hash").alias("top"))
        found = found.unionAll(nodes.where((F.col("level") == depth(F.col("n")))).select("tree", F.col("hash").alias("top")))
        tops = found if tops is None else tops.unionAll(found.join(tops.select(F.col("tree").alias("t")).distinct(),
                                                                   F.col("tree").eqNullSafe(F.col("t")), "left_anti"))
        own = steps(here, nodes)
        if paths is not None:
            above = paths.select(F.col("tree").alias("a_tree"), F.col("rank").alias("a_part"), F.col("path").alias("a_path"))
            own = (own.join(above, F.col("tree").eqNullSafe(F.col("a_tree")) & (F.col("part") == F.col("a_part")), "left")
                   .select("tree", "part", "rank", F.when(F.col("a_path").isNull(), F.col("path"))
                           .otherwise(F.concat("path", "a_path")).alias("path")))
        paths = own.select("tree", "rank", "path")
    return paths, tops


def manifest(leaves: DataFrame, tree: str = "source", order: list | None = None) -> DataFrame:
    """``leaves`` (``tree``, leaf and any other columns) with rank, subroot, root and ``path``, the steps from leaf to root."""
    rows = written(ranked(leaves, tree, order or [F.col("leaf")]), "manifest-leaves")
    paths, tops = with_paths(rows.select(F.col(tree).alias("tree"), "rank", "n", F.col("leaf").alias("hash")))
    tops = written(tops, "manifest-tops")
    # the tree of trees: its leaves are the subroots by name
    over = written(ranked(tops.withColumn("all", F.lit(0)), "all", [F.col("tree").asc_nulls_first()])
                   .select("tree", "top", "rank", "n"), "manifest-subroots")
    up, root = with_paths(over.select(F.lit(0).alias("tree"), "rank", "n", F.col("top").alias("hash")))
    up = up.select(F.col("rank").alias("u_rank"), F.col("path").alias("u_path"))
    over = (over.join(up, F.col("rank") == F.col("u_rank"), "left")
            .select(F.col("tree").alias("o_tree"), F.col("top").alias("subroot"), "u_path"))
    over = written(over.withColumn("root", F.lit(next((r["top"] for r in root.take(1)), None)).cast("string")),
                   "manifest-over")
    paths = paths.select(F.col("tree").alias("p_tree"), F.col("rank").alias("p_rank"), F.col("path").alias("p_path"))
    no_steps = F.array().cast("array<struct<before:string,after:string>>")
    return (rows.join(paths, F.col(tree).eqNullSafe(F.col("p_tree")) & (F.col("rank") == F.col("p_rank")), "left")
            .join(broadcast_if_small(over), F.col(tree).eqNullSafe(F.col("o_tree")))
            .withColumn("path", F.concat(F.coalesce("p_path", no_steps), F.coalesce("u_path", no_steps)))
            .drop("p_tree", "p_rank", "p_path", "o_tree", "u_path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def op12_interval_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    own = [F.col(c) for c in FIELDS]
    changed = leaf_hash([*own[:-1], tampered_text(own[-1], own[0])])
    leaves = docs.select("doc_id", "source", leaf_hash(own).alias("leaf"), changed.alias("tampered"))
    rows = manifest(leaves, "source", [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("tampered")])
    proof = F.sha2(F.concat_ws("", F.transform("path", lambda s: F.concat(s["before"], s["after"]))), 256)
    return (rows.withColumn("proof_sha256", proof).withColumn("folded_root", folded(F.col("tampered"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


# DuckDB has no crc32; its lowest bit is that of the bitwise remainder over the digits of the id.
OP12_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, lang, n_chars, text,
         CASE WHEN doc_id IS NOT NULL AND (list_reduce(list_concat([4294967295::BIGINT],
                list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda crc, byte:
                list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, b:
                  CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) % 2) = 1
              THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents
), leaves AS (
  SELECT doc_id, source, head, sha256(head || COALESCE(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || COALESCE(strlen(changed) || ':' || changed, '-')) AS tampered
  FROM (SELECT *, COALESCE(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-')
               || COALESCE(strlen(lang) || ':' || lang, '-') || COALESCE(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
        FROM docs)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, tampered) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), nodes AS (
  SELECT source, 0 AS level, rank AS i, leaf AS hash, n FROM placed
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(hash, '' ORDER BY i)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, level, i // 3, n
), subroots AS (
  SELECT source, hash AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, place AS i, subroot AS hash, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(hash, '' ORDER BY i)), (n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY level, i // 3, n
), folds AS (
  SELECT p.source, p.rank, 0 AS phase, 0 AS level, p.rank AS i, p.n, p.tampered AS hash, '' AS proof FROM placed p
  UNION ALL
  SELECT source, rank, phase, level, i, n, sha256(before || hash || after), proof || before || after
  FROM (
    SELECT f.source, f.rank, 0 AS phase, f.level + 1 AS level, f.i // 3 AS i, (f.n + 2) // 3 AS n, f.hash, f.proof,
           COALESCE(string_agg(s.hash, '' ORDER BY s.i) FILTER (s.i < f.i), '') AS before,
           COALESCE(string_agg(s.hash, '' ORDER BY s.i) FILTER (s.i > f.i), '') AS after
    FROM folds f JOIN nodes s ON f.phase = 0 AND f.n > 1 AND s.source IS NOT DISTINCT FROM f.source AND s.level = f.level
                 AND s.i // 3 = f.i // 3
    GROUP BY f.source, f.rank, f.level, f.i, f.n, f.hash, f.proof
    UNION ALL
    SELECT f.source, f.rank, 1, CASE WHEN f.phase = 0 THEN 1 ELSE f.level + 1 END,
           CASE WHEN f.phase = 0 THEN r.place ELSE f.i END // 3,
           (CASE WHEN f.phase = 0 THEN r.n ELSE f.n END + 2) // 3, f.hash, f.proof,
           COALESCE(string_agg(s.hash, '' ORDER BY s.i) FILTER (s.i < CASE WHEN f.phase = 0 THEN r.place ELSE f.i END), ''),
           COALESCE(string_agg(s.hash, '' ORDER BY s.i) FILTER (s.i > CASE WHEN f.phase = 0 THEN r.place ELSE f.i END), '')
    FROM folds f JOIN subroots r ON r.source IS NOT DISTINCT FROM f.source
    JOIN tops s ON s.level = CASE WHEN f.phase = 0 THEN 0 ELSE f.level END
               AND s.i // 3 = CASE WHEN f.phase = 0 THEN r.place ELSE f.i END // 3
    WHERE (f.phase = 0 AND f.n = 1 AND r.n > 1) OR (f.phase = 1 AND f.n > 1)
    GROUP BY f.source, f.rank, f.phase, f.level, f.i, f.n, f.hash, f.proof, r.place, r.n
  )
), ends AS (
  SELECT f.source, f.rank, f.hash AS folded_root, sha256(f.proof) AS proof_sha256
  FROM folds f, (SELECT DISTINCT n FROM subroots) r
  WHERE f.n = 1 AND f.phase = CASE WHEN r.n > 1 THEN 1 ELSE 0 END
)
SELECT p.doc_id, p.leaf, s.subroot, t.hash AS root, e.proof_sha256, e.folded_root, e.folded_root = t.hash AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
JOIN ends e ON e.source IS NOT DISTINCT FROM p.source AND e.rank = p.rank
JOIN tops t ON t.n = 1
"""
