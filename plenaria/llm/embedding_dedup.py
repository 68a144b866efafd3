"""Embedding near-duplicates: random-hyperplane signs in several tables, exact cosines, distributed components.

Each of ``n_tables`` tables hashes a vector to the signs of its products with ``n_bits`` random directions.  Two
vectors at angle a fall into the same bucket of a table with probability (1 - a / pi) ** n_bits, so a pair at cosine
0.95 is missed by 56 tables of 16 bits with probability 0.00001 (the number of bits should grow with the
logarithm of the rows, the tables with it).  Within a bucket
all cosines are computed exactly (double precision, matrix products); a pair that shares several buckets is
counted in the first one only.  A bucket over ``block_rows`` vectors is split into blocks, and the
pairs of blocks are separate work, so no bucket meets in one task whole.

Equal vectors are one class that enters with its number of rows.  A bucket gives back counts per vector and a
spanning forest of its links, never the pairs; components are joined by grouped minima.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing and
are returned with n_links 0; vectors of different lengths never link; repeated rows count as other vectors; a null
vec_id is never a representative unless its whole component has none; an empty table gives an empty result; labels
and extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm.common import components, ship, table, written

THRESHOLD = 0.95
N_TABLES = 56
N_BITS = 16
BLOCK_ROWS = 1024
SMALL_GROUP = 48     # groups up to so many rows are compared across the batch, larger ones by matrix products
SEED = 20_240

_planes: dict = {}


def planes(dim: int, n_tables: int, n_bits: int) -> np.ndarray:
    key = (dim, n_tables, n_bits)
    if key not in _planes:
        _planes[key] = np.random.default_rng(SEED + dim).standard_normal((dim, n_tables * n_bits))
    return _planes[key]


def usable(vector) -> np.ndarray | None:
    """The vector in double precision, None if it links with nothing."""
    if vector is None or not len(vector):
        return None
    v = np.array([np.nan if x is None else x for x in vector], dtype=np.float64)
    return v + 0.0 if np.isfinite(v).all() and v.any() else None


def signs(vectors: np.ndarray, n_tables: int, n_bits: int) -> np.ndarray:
    """Bucket numbers, one row per vector and one column per table."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    up = (unit @ planes(vectors.shape[1], n_tables, n_bits) >= 0).reshape(len(vectors), n_tables, n_bits)
    return up @ (1 << np.arange(n_bits))


def stored_as(vectors: DataFrame, vector_col: str) -> str:
    """Single precision if the vectors have no more, so that nothing is rounded; cosines are taken in double."""
    return "<f4" if "float" in dict(vectors.dtypes)[vector_col] else "<f8"


def signed(vectors: DataFrame, n_tables: int, n_bits: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vec (as bytes in the input's precision, null if unusable), buckets (unsigned shorts, high byte first)."""
    ship(vectors.sparkSession)
    if not 0 < n_bits <= 16:
        raise ValueError("bucket numbers have 16 bits at most")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    stored = stored_as(vectors, vector_col)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [usable(v) for v in b["vec"]]
            buckets: list = [None] * len(made)
            for dim in {len(v) for v in made if v is not None}:
                at = [i for i, v in enumerate(made) if v is not None and len(v) == dim]
                for i, s in zip(at, signs(np.stack([made[i] for i in at]), n_tables, n_bits)):
                    buckets[i] = s.astype(">u2").tobytes()
            yield pd.DataFrame({"vec_id": b["vec_id"].astype("Int64"),
                                "vec": [None if v is None else v.astype(stored).tobytes() for v in made], "buckets": buckets})

    return rows.mapInPandas(sign, "vec_id long, vec binary, buckets binary")


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable index per index, for links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_of(rows: pd.DataFrame, starts: np.ndarray, ends: np.ndarray, threshold: float, stored: str) -> tuple:
    """Links (i, j) by row place within the groups starts..ends that no earlier table has."""
    vec = np.frombuffer(b"".join(rows["vec"]), dtype=stored).astype(np.float64).reshape(len(rows), -1)
    buckets = np.frombuffer(b"".join(rows["buckets"]), dtype=">u2").reshape(len(rows), -1)
    unit = vec / np.abs(vec).max(axis=1, keepdims=True)
    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    block, bi, bj, tab = (rows[c].to_numpy() for c in ("block", "bi", "bj", "tab"))
    size = ends - starts
    found = []
    end_of = np.repeat(np.where((size <= SMALL_GROUP) & (bi[starts] == bj[starts]), ends, 0), size)
    left = np.arange(len(rows))
    for lag in range(1, SMALL_GROUP):
        left = left[left + lag < end_of[left]]
        if not len(left):
            break
        close = (unit[left] * unit[left + lag]).sum(axis=1) >= threshold
        found.append((left[close], left[close] + lag))
    for lo, hi in zip(starts[(size > 1) & (end_of[starts] == 0)], ends[(size > 1) & (end_of[starts] == 0)]):
        x = lo + np.flatnonzero(block[lo:hi] == bi[lo])
        y = lo + np.flatnonzero(block[lo:hi] == bj[lo])
        i, j = np.nonzero(unit[x] @ unit[y].T >= threshold)
        i, j = x[i], y[j]
        once = i < j if bi[lo] == bj[lo] else np.ones(len(i), dtype=bool)
        found.append((i[once], j[once]))
    i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, dtype=np.int64) for k in (0, 1))
    earlier = np.arange(buckets.shape[1])[None, :] < tab[i][:, None]
    once = ~((buckets[i] == buckets[j]) & earlier).any(axis=1)
    return i[once], j[once]


def bucket_links(rows: DataFrame, threshold: float, stored: str) -> DataFrame:
    """rep, n, other: per bucket work and vector the number of links and one linked vector's class."""
    keys = ["dim", "tab", "bucket", "bi", "bj"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for _, part in rows.groupby("dim"):
                key = part[keys].to_numpy()
                cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
                i, j = links_of(part, np.append(0, cut), np.append(cut, len(key)), threshold, stored)
                if len(i):
                    size, rep = part["size"].to_numpy(), part["rep"].to_numpy()
                    count = np.zeros(len(part), dtype=np.int64)
                    np.add.at(count, i, size[j])
                    np.add.at(count, j, size[i])
                    has, root = np.flatnonzero(count), forest(len(part), i, j)
                    yield pd.DataFrame({"rep": rep[has], "n": count[has], "other": rep[root[has]]})

        kept: pd.DataFrame | None = None
        for b in batches:
            b = b if kept is None else pd.concat([kept, b], ignore_index=True)
            key = b[keys].to_numpy()
            if not len(key):
                continue
            same = (key == key[-1]).all(axis=1)
            last = 0 if same.all() else len(key) - int(np.argmin(same[::-1]))
            kept = b.iloc[last:]      # the last group may go on in the next batch
            yield from done(b.iloc[:last])
        if kept is not None:
            yield from done(kept)

    return rows.mapInPandas(work, "rep long, n long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, n_tables: int = N_TABLES, n_bits: int = N_BITS,
                    block_rows: int = BLOCK_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = written(signed(vectors, n_tables, n_bits, id_col, vector_col).withColumn("key", F.sha2("vec", 256)), "vectors")
    # a class is named by its number, not by its vec_id: ids may be null or repeat
    some = rows.where(F.col("vec").isNotNull())
    classes = written(some.groupBy("key").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("size"),
                                              F.min("vec").alias("vec"), F.min("buckets").alias("buckets"))
                      .withColumn("rep", F.xxhash64("key")), "vector-classes")

    # where vectors meet is found on narrow rows; the vectors themselves move once, to buckets that two share
    places = (classes.select("rep", F.octet_length("vec").alias("dim"), "buckets",
                             F.explode(F.sequence(F.lit(0), F.lit(n_tables - 1))).alias("tab"))
              .select("rep", "dim", "tab",
                      F.conv(F.hex(F.expr("substring(buckets, 2 * tab + 1, 2)")), 16, 10).cast("int").alias("bucket")))
    met = (places.groupBy("dim", "tab", "bucket").agg(F.count("*").alias("rows_in")).where(F.col("rows_in") > 1)
           .select("dim", "tab", "bucket", F.ceil(F.col("rows_in") / block_rows).cast("int").alias("blocks")))
    met = (places.join(met, ["dim", "tab", "bucket"]).groupBy("rep")
           .agg(F.collect_list(F.struct("tab", "bucket", "blocks")).alias("places")))
    dealt = (classes.select("rep", "size", "vec", "buckets").join(met, "rep")
             .select("rep", "size", "vec", "buckets", F.octet_length("vec").alias("dim"), F.explode("places").alias("p"))
             .select("rep", "size", "vec", "buckets", "dim", "p.tab", "p.bucket", "p.blocks")
             .withColumn("block", F.pmod("rep", F.col("blocks")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("dim", "tab", "bucket", F.least("block", "with").alias("bi"), F.greatest("block", "with").alias("bj"),
                     "block", "rep", "size", "vec", "buckets")
             .repartition("dim", "tab", "bucket", "bi", "bj")
             .sortWithinPartitions("dim", "tab", "bucket", "bi", "bj", "rep"))
    links = written(bucket_links(dealt, threshold, stored_as(vectors, vector_col)), "vector-links")
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = components(links.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = (classes.select("key", "rep", "first_id", "size").join(counts, "rep", "left")
             .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
             .select("key", "first_id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(lowest, "component").select("key", "n_links", "component_id")
    out = rows.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op2_hyperplane_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
