"""Status, ideology-band, legislature and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.text import strip_ws
from plenaria.functions.util import any_contains, col, let, lookup


def status_label(c, rules=vocab.STATUS_RULES) -> Column:
    """Free status text -> one of five labels; rules are tested in order."""
    def classify(u: Column) -> Column:
        out = F.when(u.isNull() | (u == "") | (u == "NAN"), F.lit(vocab.STATUS_MISSING))
        for label, needles in rules:
            out = out.when(any_contains(u, needles), F.lit(label))
        return out.otherwise(F.lit(vocab.STATUS_OTHER))

    return let(strip_ws(F.upper(col(c))), classify)


def ideology_band(score) -> Column:
    """Right-closed cuts; null -> 'Não identificado'."""
    s = col(score)
    out = F.when(s.isNull(), F.lit(vocab.IDEOLOGY_UNKNOWN))
    for upper, label in vocab.IDEOLOGY_BANDS:
        out = out.when(s <= upper, F.lit(label))
    return out.otherwise(F.lit(vocab.IDEOLOGY_TOP_BAND))


def legislature(year) -> Column:
    """Calendar year (int) -> legislature label; open at both ends."""
    y = col(year)
    out = F.when(y.isNull(), F.lit(None).cast("string"))
    for last, label in vocab.LEGISLATURES:
        out = out.when(y <= last, F.lit(label)) if last is not None else out.otherwise(F.lit(label))
    return out


def legislature_order(label) -> Column:
    """Position of a legislature label in the fixed sequence (0-based)."""
    return lookup({lab: i for i, (_, lab) in enumerate(vocab.LEGISLATURES)}, label)


def region(uf) -> Column:
    return lookup(vocab.STATE_REGION, uf, vocab.REGION_UNKNOWN)


def house_label(origem) -> Column:
    return lookup(vocab.HOUSE_LABEL, origem, col(origem))


def type_label(tipo) -> Column:
    return lookup(vocab.TYPE_LABEL, tipo, col(tipo))


def type_group(tipo) -> Column:
    return lookup(vocab.TYPE_GROUP, tipo)


def normalise_type(tipo, mapping=vocab.TYPE_NORMALISATION) -> Column:
    return lookup(mapping, tipo, col(tipo))
