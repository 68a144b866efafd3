"""Stage 4: survey score table and the ideology as-of enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.authors import party_of_author
from plenaria.functions.labels import ideology_band
from plenaria.functions.text import round_half_even, to_int
from plenaria.functions.util import lookup
from plenaria.operators.asof import proxy_table, score_requests
from plenaria.operators.grouping import melt


def survey_scores(survey: DataFrame, party_columns: dict = vocab.SURVEY_PARTY_COLUMNS,
                  missing=vocab.SURVEY_MISSING) -> DataFrame:
    """Respondent table -> (wave, partido, score_lr).

    Per wave the mean of each placement column (sentinel -> null, nulls skipped);
    columns are then mapped to parties and a party fed by two columns gets the
    plain mean of the column means (not a pooled mean); rounded to 2 decimals.
    The wide table has one row per wave after the first aggregate, so the
    reshape and second aggregate are tiny.
    """
    cols = [c for c in party_columns if c in survey.columns]
    per_wave = (survey.filter(F.col("wave").isNotNull())
                .groupBy("wave")
                .agg(*[F.avg(F.nullif(F.col(c).cast("double"), F.lit(float(missing)))).alias(c)
                       for c in cols]))
    long = (melt(per_wave, ["wave"], cols, "col", "score_lr")
            .filter(F.col("score_lr").isNotNull())
            .withColumn("partido", lookup({c: party_columns[c] for c in cols}, "col")))
    return (long.groupBy("wave", "partido")
            .agg(round_half_even(F.avg("score_lr"), 2).alias("score_lr")))


def enrich_ideology(df: DataFrame, scores: DataFrame, proxies: DataFrame | None = None,
                    author: str = "tipo_autor", year: str = "ano") -> DataFrame:
    """Add partido_bls, score_lr and espectro to every row.

    Party extraction and the as-of rule run once per distinct (author text,
    year) pair, not per row, in one pass over the pairs (the input is read twice:
    for the pairs and for the rows); rows get their result through one equi-join
    on the pair (AQE broadcasts the pair table when it is small at run time, and
    splits skewed keys otherwise).
    """
    spark = df.sparkSession
    proxies = proxies if proxies is not None else proxy_table(spark)
    pairs = (df.select(author, year).distinct()
             .withColumn("partido_bls", party_of_author(author))
             .withColumn("_ano_int", to_int(year)))
    per_pair = (score_requests(pairs, scores, proxies, party="partido_bls", year="_ano_int",
                               keys=[author, year])
                .select(F.col(author).alias("_a"), F.col(year).alias("_y"), "partido_bls", "score_lr"))
    out = (df.join(per_pair, df[author].eqNullSafe(F.col("_a")) & df[year].eqNullSafe(F.col("_y")), "left")
           .drop("_a", "_y"))
    return out.withColumn("espectro", ideology_band("score_lr"))
