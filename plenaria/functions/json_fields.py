"""JSON field extraction: responses, object-or-array nesting, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.util import col, let


#: A whole number text; the cast alone would also take a type suffix ("7.3d").
NUMBER_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def quantise_score(x, step: float = vocab.SCORE_STEP,
                   lo: float = vocab.SCORE_MIN, hi: float = vocab.SCORE_MAX) -> Column:
    """Round to a multiple of ``step`` (half to even), clamp to [lo, hi]; NaN/inf -> null."""
    def rule(x: Column) -> Column:
        q = F.least(F.lit(hi), F.greatest(F.lit(lo), F.bround(x / F.lit(step), 0) * F.lit(step)))
        return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), q)

    return let(col(x), rule)


def response_fields(raw, cutoff: float = vocab.SCORE_CUTOFF) -> Column:
    """Model response JSON -> struct(llm_nota, llm_categoria, llm_decisao, llm_justificativa).

    Not a JSON object, a null or non-numeric score -> null score and empty texts;
    a missing score key counts as 0.  Numeric text ("7.3") is accepted.
    """
    # One parse: the top-level object as a map (null when not a JSON object;
    # a JSON null value stays a null entry; on a repeated key the last one wins).
    def fields(obj: Column) -> Column:
        said = F.trim(obj["nota"])
        number = (F.when(said == "true", F.lit(1.0)).when(said == "false", F.lit(0.0))
                  .when(said.rlike(NUMBER_TEXT), said.try_cast("double")))
        value = F.when(F.map_contains_key(obj, "nota"), number).otherwise(F.lit(0.0))
        return let(F.when(obj.isNotNull(), quantise_score(value)), lambda nota: _result(obj, nota, cutoff))

    # Wrapped in brackets, text after the object or a second object makes the array malformed or longer than one.
    wrapped = F.from_json(F.concat(F.lit("["), col(raw), F.lit("]")), "array<map<string,string>>",
                          {"allowSingleQuotes": "false"})
    return let(let(wrapped, lambda a: F.when(F.size(a) == 1, F.get(a, 0))), fields)


def _result(obj: Column, nota: Column, cutoff: float) -> Column:
    ok = nota.isNotNull()
    text = lambda key: F.when(ok, F.coalesce(obj[key], F.lit(""))).otherwise(F.lit(""))
    decision = (F.when(~ok, F.lit(""))
                .when(nota >= F.lit(cutoff), F.lit(vocab.DECISION_INCLUDE))
                .otherwise(F.lit(vocab.DECISION_EXCLUDE)))
    return F.struct(nota.alias("llm_nota"), text("categoria").alias("llm_categoria"),
                    decision.alias("llm_decisao"), text("justificativa").alias("llm_justificativa"))


def as_records(value: Column, path: str) -> Column:
    """Array of the records at a path of keys in a variant: those of an array, or a bare object as the only one; null if missing."""
    found = F.try_variant_get(value, f"$.{path}", "variant")
    return F.coalesce(F.try_variant_get(value, f"$.{path}", "array<variant>"), F.when(found.isNotNull(), F.array(found)))


def last_present(values: Column) -> Column:
    """Last non-null value of an array."""
    return F.get(F.reverse(F.filter(values, lambda v: v.isNotNull())), 0)


def status_fields(raw, materia: str = "m", autuacao: str = "a", situacao: str = "s",
                  desc: str = "d", date: str = "t") -> Column:
    """Nested status JSON -> struct(situacao, data_situacao).

    Each level is a path of keys ("SituacaoAtual.Autuacoes.Autuacao") to a bare object or an array; the first record
    of the top level is used, all records below it are scanned, and each field keeps its last non-missing
    value on its own.  Anything missing or malformed gives ''.  The text is parsed once, to a variant that all paths walk.
    """
    none = F.array().cast("array<variant>")

    def leaves(value: Column) -> Column:
        second = as_records(F.get(as_records(value, materia), 0), autuacao)
        return F.flatten(F.transform(second, lambda x: F.coalesce(as_records(x, situacao), none)))

    def fields(found: Column) -> Column:
        def last(path: str) -> Column:
            values = F.transform(found, lambda y: F.try_variant_get(y, f"$.{path}", "string"))
            return F.coalesce(last_present(values), F.lit(""))

        return F.struct(last(desc).alias("situacao"), last(date).alias("data_situacao"))

    return let(let(F.try_parse_json(col(raw)), leaves), fields)


def field_or(c: Column, default: str = "") -> Column:
    """Field with a default for missing and null values."""
    return F.coalesce(c, F.lit(default))
