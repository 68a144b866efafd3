"""Inverted token index for the facets on lists of tokens: states, parties and persons (F11f, F11j, F11k).

A facet on tokens scans all rows and splits and normalises the text of each.  ``write_index`` does that once: it keeps
(facet, bucket, token, key) with the facet and a hash bucket of the token as partitions.  ``select_rows`` computes the buckets
of the tokens asked for, so that only those partitions are read, and keeps the rows whose key the index lists by a semi-join;
the plain facets stay predicates on the rows.  Pruning pays for selective facets; the result is that of ``facet_filter`` always.

The key must name a row: rows that share one are selected together.  Rows with a null key are in no index and never selected by
a token.  Null texts and null tokens have no entry; a token that a row repeats has one.  The rows are brought together by bucket
with a rebalance hint, so that adaptive execution splits the bucket of a token that many rows hold.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.functions import authors, text
from plenaria.operators.filters import FacetSpec, facet_filter

BUCKETS = 64
FACETS = ("uf", "partido", "politico")
SCHEMA = "token string, chave {key}, faceta string, balde int"


def token_lists() -> dict[str, Column]:
    """facet -> array of the tokens it compares, as ``filters.facet_predicate`` reads them."""
    return {"uf": text.tokens("uf"),
            "partido": F.transform(text.tokens("tipo_autor"), lambda t: authors.normalise_party(t, dashboard=True)),
            "politico": F.transform(F.split(F.col("parlamentar"), "[;,]"), lambda n: text.person_name(n))}


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def write_index(rows: DataFrame, key: str, path: str, buckets: int = BUCKETS) -> None:
    """Write the index of ``rows`` (columns uf, tipo_autor, parlamentar and ``key``); replaces what is at ``path``."""
    def entries_of(facet: str, tokens: Column) -> Column:
        pairs = F.transform(tokens, lambda t: F.struct(F.lit(facet).alias("faceta"), t.alias("token")))
        return F.coalesce(pairs, F.expr("CAST(array() AS array<struct<faceta:string,token:string>>)"))

    lists = F.concat(*(entries_of(facet, tokens) for facet, tokens in token_lists().items()))
    entries = (rows.where(F.col(key).isNotNull()).select(F.col(key).alias("chave"), F.explode(F.array_distinct(lists)).alias("e"))
               .select("e.token", "chave", "e.faceta").where(F.col("token").isNotNull())
               .withColumn("balde", _bucket(F.col("token"), buckets)))
    (entries.hint("rebalance", "faceta", "balde").sortWithinPartitions("faceta", "balde", "token")
     .write.mode("overwrite").partitionBy("faceta", "balde").parquet(path))


def keys_of(spark: SparkSession, path: str, facet: str, values: list[str], key_type: str = "bigint",
            buckets: int = BUCKETS) -> DataFrame:
    """(chave): keys of the rows that hold one of ``values``, once for each that they hold; reads the buckets of the values only."""
    wanted = spark.range(1).select(F.explode(F.array(*(F.lit(v) for v in values))).alias("v"))
    at = sorted({r[0] for r in wanted.select(_bucket(F.col("v"), buckets)).collect()})        # one row per value asked for
    index = spark.read.schema(SCHEMA.format(key=key_type)).parquet(path)
    return index.where((F.col("faceta") == facet) & F.col("balde").isin(at) & F.col("token").isin(*values)).select("chave")


def select_rows(rows: DataFrame, spec: FacetSpec, key: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows that ``facet_filter`` selects, the token facets answered by the index at ``path``."""
    out = facet_filter(rows, replace(spec, **{f: [] for f in FACETS}))
    for facet in FACETS:
        values = getattr(spec, facet)
        if values:
            found = keys_of(rows.sparkSession, path, facet, values, rows.schema[key].dataType.simpleString(), buckets)
            out = out.join(found, out[key] == found["chave"], "left_semi")
    return out
