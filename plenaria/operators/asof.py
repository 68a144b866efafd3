"""Nearest-wave as-of join with ties averaged, proxies and per-proxy fallback.

Rule, for one (party, year): expand the party into its stand-ins (a party with an
explicit empty entry gets no score).  ``g`` is the smallest distance from the
year to any survey wave.  Each stand-in contributes every score it has at
distance ``g`` (two when two waves tie); with none, the score of its nearest
wave with data, the earlier wave on a distance tie.  The result is the plain
mean of all contributions, rounded like Python's ``round(x, 2)``.

Spark plan: the rule runs on distinct requests only, never per row, and reads
them once; the wave list is a scalar subquery (one small array, no join); the
stand-in expansion (a fixed table) and the score lookup (bounded by waves x
parties) are equi-joins; per stand-in and per request there is one aggregate
each, no window.  Joining the scores back to the rows is an equi-join on the
request keys that AQE turns into a broadcast when the request table is small at
run time and splits when a key is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.text import round_exact


def proxy_table(spark, proxies: dict = vocab.PARTY_PROXIES) -> DataFrame:
    """Fixed stand-in table (party, proxies); a null list means 'never scored'."""
    rows = ", ".join(
        f"({_sql(k)}, {'CAST(NULL AS ARRAY<STRING>)' if v is None else 'array(' + ', '.join(_sql(x) for x in v) + ')'})"
        for k, v in proxies.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(partido, proxies)")


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def score_requests(requests: DataFrame, scores: DataFrame, proxies: DataFrame,
                   party: str = "partido_bls", year: str = "ano_int",
                   keys: list[str] | None = None) -> DataFrame:
    """Score every row of ``requests`` (one row per distinct ``keys``) in one pass.

    ``keys`` identify a request (default: ``party`` and ``year``); finer keys, such as
    the author text the party was derived from, let a caller score its own
    distinct pairs directly instead of deriving (party, year) requests and joining
    back.  Every request row comes out once with ``keys``, ``party`` and
    ``score_lr`` (null when the party is null, has no stand-ins or no scores), so
    ``requests`` is read once: stand-ins are exploded with ``explode_outer`` and the
    scores are left-joined, keeping unscored requests in the same aggregates.
    """
    keys = list(keys or [party, year])
    carried = list(dict.fromkeys(keys + [party, year]))
    waves = scores.select(F.array_sort(F.collect_set("wave"))).scalar()
    req = (requests.select(*carried)
           .withColumn("_waves", waves)
           .withColumn("_g", F.array_min(F.transform("_waves", lambda w: F.abs(w - F.col(year)))))
           .drop("_waves"))
    # Stand-ins: listed parties use their list; a listed party with no list gets none.
    valid = F.col(party).isNotNull() & F.col(year).isNotNull()
    stand_ins = (F.when(~valid, F.lit(None))
                 .when(F.col("_p").isNull(), F.array(F.col(party)))
                 .otherwise(F.col("proxies")))
    expanded = (req.join(proxies.withColumnRenamed("partido", "_p"),
                         F.col(party) == F.col("_p"), "left")
                .select(*carried, "_g", F.explode_outer(stand_ins).alias("_proxy")))
    s = scores.select(F.col("partido").alias("_proxy"), "wave", "score_lr")
    cand = (expanded.join(s, "_proxy", "left")
            .withColumn("_dist", F.abs(F.col("wave") - F.col(year)))
            .withColumn("_near", F.col("_dist") == F.col("_g")))
    per_proxy = (cand.groupBy(*carried, "_proxy")
                 .agg(F.sum(F.when(F.col("_near"), F.col("score_lr"))).alias("_near_sum"),
                      F.count(F.when(F.col("_near"), F.lit(1))).alias("_near_n"),
                      F.min_by("score_lr", F.struct("_dist", "wave")).alias("_fallback")))
    contrib_sum = F.when(F.col("_near_n") > 0, F.col("_near_sum")).otherwise(F.col("_fallback"))
    contrib_n = (F.when(F.col("_near_n") > 0, F.col("_near_n"))
                 .when(F.col("_fallback").isNotNull(), F.lit(1)).otherwise(F.lit(0)))
    return (per_proxy.groupBy(*carried)
            .agg(F.sum(contrib_sum).alias("_sum"), F.sum(contrib_n).alias("_n"))
            .select(*carried, F.when(F.col("_n") > 0, round_exact(F.col("_sum") / F.col("_n"), 2))
                    .alias("score_lr")))


def nearest_wave_scores(requests: DataFrame, scores: DataFrame, proxies: DataFrame,
                        party: str = "partido_bls", year: str = "ano_int") -> DataFrame:
    """Score every distinct (party, year) of ``requests``.

    ``scores``: (wave INT, partido STRING, score_lr DOUBLE), non-null scores only.
    Returns (party, year, score_lr) for every distinct non-null request.
    """
    req = (requests.select(party, year)
           .filter(F.col(party).isNotNull() & F.col(year).isNotNull())
           .distinct())
    return score_requests(req, scores, proxies, party, year).select(party, year, "score_lr")
