"""Small helpers shared by the Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def in_list(c: Column, values) -> Column:
    """``c IN (values)``; constant-folded into an InSet for long lists."""
    return col(c).isin(list(values))


def lit_map(mapping: dict) -> Column:
    """A literal map; lookups with :func:`lookup` never fail on a missing key."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def lookup(mapping: dict, key, default=None) -> Column:
    """``mapping[key]`` else ``default`` (a Column, a literal, or None)."""
    value = F.try_element_at(lit_map(mapping), col(key))
    if default is None:
        return value
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def any_contains(c: Column, needles) -> Column:
    """True when any needle is a substring of ``c``."""
    return reduce(lambda a, b: a | b, [col(c).contains(n) for n in needles])


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a Column -> Column function).

    Subexpression elimination does not reach into ``CASE WHEN`` branches, so a
    costly value tested by many branches would be recomputed per branch; binding
    it to a lambda variable computes it once per row.
    """
    return F.get(F.transform(F.array(value), body), 0)
