"""Stage 3 as data work: prompt table, response parsing, retries, resume (C5: L1-L4, W5).

The model call itself is not part of the library; prompts are produced as a
table and responses arrive as a table of attempts (key, attempt, raw JSON).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions import text
from plenaria.functions.json_fields import response_fields
from plenaria.functions.util import col, in_list
from plenaria.operators.dedup import first_success
from plenaria.plans.prompt_text import PROMPT_PARTS, PROMPT_SLOTS

SCORE_COLUMNS = ["llm_nota", "llm_categoria", "llm_decisao", "llm_justificativa"]


def context_block(origem="origem", tipo="tipo", numero="numero", ano="ano", ementa="ementa",
                  keywords="keywords", detailed="ementa_detalhada", indexing="indexacao") -> Column:
    """The proposal lines of the prompt; context lines only when non-empty."""
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    optional = lambda label, c: F.when(e(c) != "", F.concat(F.lit(label), F.col(c)))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Casa:      "), e(origem)),
        F.concat(F.lit("Proposta:  "), text.proposal_label(tipo, numero, ano)),
        F.concat(F.lit("Ementa:    "), e(ementa)),
        optional("Indexação: ", keywords),
        optional("Ementa detalhada: ", detailed),
        optional("Indexação: ", indexing))


def prompt_text(ctx: Column, categories=vocab.CATEGORIES, inclusion=vocab.INCLUSION_CRITERIA,
                exclusion=vocab.EXCLUSION_CRITERIA, acronyms=vocab.ACRONYMS, scale: dict | None = None) -> Column:
    """Full rubric prompt around a context block; list sections are constant-folded.

    ``scale`` (range -> meaning, highest first, as many as the rubric has) replaces the ranges and meanings of the rubric's own
    scale, whose examples stay; without it the rubric's wording stands.
    """
    slot = {"ctx": ctx, "cats": text.bullet_lines(categories), "inc": text.bullet_lines(inclusion),
            "exc": text.bullet_lines(exclusion), "siglas_fmt": text.keyed_lines(acronyms)}
    parts, pieces = [], PROMPT_PARTS if scale is None else with_scale(PROMPT_PARTS, scale)
    for piece, name in zip(pieces, PROMPT_SLOTS):
        parts += [F.lit(piece), slot[name]]
    parts.append(F.lit(pieces[-1]))
    return F.concat(*parts)


SCALE_LINE = re.compile(r"^\d+\.\d+–\d+\.\d+: .*(?= Exemplos:$)", re.M)


def with_scale(pieces: list[str], scale: dict) -> list[str]:
    """The prompt's pieces with the lines of its scale replaced in order."""
    if sum(len(SCALE_LINE.findall(p)) for p in pieces) != len(scale):
        raise ValueError("the scale must have a range for each one of the rubric")
    lines = iter(f"{between.replace('-', '–')}: {meaning}." for between, meaning in scale.items())
    return [SCALE_LINE.sub(lambda _: next(lines), p) for p in pieces]


def prompt_table(stage: DataFrame, contexts: DataFrame, key: str, scale: dict | None = None) -> DataFrame:
    """(key, prompt) for every proposal; ``contexts``: (key, keywords, ementa_detalhada, indexacao).

    Chamber rows use keywords and the detailed summary, the other houses the
    indexing text.  Left equi-join on the key.
    """
    ctx = contexts.select(key, "keywords", "ementa_detalhada", "indexacao")
    joined = stage.join(ctx, key, "left")
    is_cd = F.col("origem") == "CD"
    joined = (joined
              .withColumn("keywords", F.when(is_cd, F.col("keywords")))
              .withColumn("ementa_detalhada", F.when(is_cd, F.col("ementa_detalhada")))
              .withColumn("indexacao", F.when(~is_cd, F.col("indexacao"))))
    return joined.select(key, prompt_text(context_block(), scale=scale).alias("prompt"))


def parse_attempts(attempts: DataFrame, cutoff: float = vocab.SCORE_CUTOFF,
                   key: str = "seq", attempt: str = "attempt", raw: str = "raw") -> DataFrame:
    """One parsed result per (key, attempt)."""
    parsed = attempts.select(key, attempt, response_fields(raw, cutoff).alias("_r"))
    return parsed.select(key, attempt, *[F.col(f"_r.{c}").alias(c) for c in SCORE_COLUMNS])


def first_scored(parsed: DataFrame, key: str = "seq", attempt: str = "attempt",
                 max_attempts: int = vocab.MAX_ATTEMPTS) -> DataFrame:
    """Per key the first attempt with a score among the first ``max_attempts``."""
    ok = parsed.withColumn("_ok", F.col("llm_nota").isNotNull())
    return first_success(ok, key, attempt, "_ok", SCORE_COLUMNS, max_attempts).drop(attempt)


def resume(previous: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Merge fresh results into the rows still pending (null score) of a previous run.

    Rows that already had a score keep it; ``retomado`` marks the rows that were
    pending.
    """
    f = fresh.select(key, *[F.col(c).alias(f"_new_{c}") for c in SCORE_COLUMNS])
    out = previous.join(f, key, "left").withColumn("retomado", F.col("llm_nota").isNull())
    take = F.col("retomado") & F.col("_new_llm_nota").isNotNull()
    for c in SCORE_COLUMNS:
        out = out.withColumn(c, F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c)))
    return out.select(*previous.columns, "retomado")


def scored_with_retries(keys: DataFrame, parsed: DataFrame, key: str, attempt: str = "attempt",
                        max_attempts: int = vocab.MAX_ATTEMPTS) -> DataFrame:
    """``keys`` after a first run (attempt 1) and a resumed one (first success of all attempts): the result of
    :func:`resume` on both, with every response parsed once and one aggregate per key."""
    def best(cond):
        return F.min(F.when(cond, F.struct(F.col("llm_nota").isNull().alias("failed"), attempt, *SCORE_COLUMNS)))

    history = parsed.groupBy(key).agg(best(F.col(attempt) == 1).alias("_first"),
                                      best(F.col(attempt) <= max_attempts).alias("_best"))
    out = keys.join(history, key, "left").withColumn("retomado", F.col("_first.llm_nota").isNull())
    take = F.col("retomado") & F.col("_best.llm_nota").isNotNull()
    return out.select(*keys.columns, *[F.when(take, F.col(f"_best.{c}")).otherwise(F.col(f"_first.{c}")).alias(c)
                                       for c in SCORE_COLUMNS], "retomado")


def valid_category(c, categories=vocab.CATEGORIES) -> Column:
    """True for one of the categories or the one for human review, false for any other text; null for none ('' or null)."""
    given = F.nullif(col(c), F.lit(""))
    return F.when(given.isNotNull(), in_list(given, [*categories, vocab.CATEGORY_REVIEW]))


def pending(stage3: DataFrame) -> DataFrame:
    """Rows still to be scored (one definition of pending: null score)."""
    return stage3.filter(F.col("llm_nota").isNull())
