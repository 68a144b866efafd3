"""Stage runner: stage tables on shared storage, each written once.

Each stage reads the previous stage's Parquet table and writes its own; a
stage whose directory holds a finished write is skipped, so an interrupted run
resumes where it stopped and a second run changes nothing; a finished stage 3 is
reopened while rows without a score have new responses.  Writing the stage
tables also cuts the lineage between stages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.plans import consolidate, ideology, scoring, status
from plenaria.sources import stages


def final_plan(raw: DataFrame, status_source: DataFrame, attempts: DataFrame, survey: DataFrame,
               key: str = "id_interno") -> DataFrame:
    """The four stages of :func:`run` as one plan, without stage tables (for inputs that are scored at once)."""
    s2 = status.enrich_status(consolidate.consolidate(raw), status_source, key)
    scores = scoring.first_scored(scoring.parse_attempts(attempts, key=key), key=key)
    return ideology.enrich_ideology(s2.join(scores, key, "left"), ideology.survey_scores(survey))


@dataclass
class StageLayout:
    root: str

    def path(self, stage: str) -> str:
        return f"{self.root.rstrip('/')}/{stage}"


STAGES = ("stage1_proposals", "stage2_status", "stage3_scored", "stage4_final")


def run(spark: SparkSession, layout: StageLayout, raw: DataFrame, status_source: DataFrame,
        attempts: DataFrame, survey: DataFrame, key: str = "id_interno") -> dict[str, DataFrame]:
    """Run the four stages; returns the stage tables as read back from storage.

    ``raw``: collected proposals of both houses; ``status_source``: (key, situacao);
    ``attempts``: model responses (key, attempt, raw); ``survey``: respondent table.
    """
    done = {}

    def stage(name: str, build, again: bool = False):
        path = layout.path(name)
        if again or not stages.is_complete(spark, path):
            stages.write_stage(build(), path)
        done[name] = spark.read.parquet(path)
        return done[name]

    s1 = stage(STAGES[0], lambda: consolidate.consolidate(raw))
    s2 = stage(STAGES[1], lambda: status.enrich_status(s1, status_source, key))
    first = scoring.first_scored(scoring.parse_attempts(attempts, key=key), key=key)
    s3 = stage(STAGES[2], lambda: restored(spark, layout) or s2.join(first, key, "left"))
    resumed = resume_scores(spark, layout, s3, first, key)
    if resumed:
        done[STAGES[2]] = s3 = spark.read.parquet(layout.path(STAGES[2]))
    stage(STAGES[3], lambda: ideology.enrich_ideology(s3, ideology.survey_scores(survey)), again=resumed)
    return done


def _next(layout: StageLayout) -> str:
    return layout.path(STAGES[2]) + "__next"


def restored(spark: SparkSession, layout: StageLayout) -> DataFrame | None:
    """The merged scores of a resumption that stopped while replacing the stage table, if there is one."""
    return spark.read.parquet(_next(layout)) if stages.is_complete(spark, _next(layout)) else None


def resume_scores(spark: SparkSession, layout: StageLayout, stage3: DataFrame, fresh: DataFrame, key: str) -> bool:
    """Reopen a finished stage 3 that has pending rows for which ``fresh`` now has a score; whether it was rewritten.

    The merged table is written beside the stage first and then copied over it, so a run that stops in between loses
    no score.
    """
    news = fresh.filter(F.col("llm_nota").isNotNull())
    if not scoring.pending(stage3).join(news, key, "left_semi").limit(1).count():
        return False
    stages.write_stage(scoring.resume(stage3, news, key).drop("retomado"), _next(layout))
    stages.write_stage(spark.read.parquet(_next(layout)), layout.path(STAGES[2]))
    return True
