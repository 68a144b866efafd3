"""Exact distinct counts that add up (A4, A18, K5): bitmaps over dense ids, kept as words of 64 bits in ordinary columns.

A distinct count of one group says nothing about the distinct count of two groups together; the set of ids does.  ``with_words``
numbers the distinct values without gaps and gives each row the number of its word (id div 64) and its bit in that word.  An
aggregate over any keys and the word then combines bits by ``bit_or``: a plain long, so it is a hash aggregate with a map-side
part, and a sparse group takes one short row for 64 ids instead of a whole bitmap.  Coarser groups come from finer ones by
``bit_or`` again; the distinct count of a group is the sum of ``bit_count`` over its words.

Null values have no id: their word is null and their bits are 0, so that their rows still count in other measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenaria.operators.ordered import with_ordinal

WORD_BITS = 64


def dense_ids(df: DataFrame, column: str, name: str = "id") -> DataFrame:
    """(column, name): the distinct non-null values, numbered from 0 without gaps in ascending order.  Starts a job."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return with_ordinal(values, [column], name).withColumn(name, F.col(name) - 1)


def with_words(df: DataFrame, column: str, ids: DataFrame, word: str = "palavra", bits: str = "bits", name: str = "id") -> DataFrame:
    """``df`` with the word and the bit of each row's value; ``ids`` is a table of ``dense_ids``, which must know every value."""
    place = F.col(name)
    bit = F.expr(f"shiftleft(1L, CAST(`{name}` % {WORD_BITS} AS INT))")
    return (df.join(ids, column, "left")
            .withColumns({word: F.floor(place / WORD_BITS).cast("long"), bits: F.coalesce(bit, F.lit(0).cast("long"))})
            .select(*df.columns, word, bits))


def merged_bits(bits: str = "bits") -> Column:
    """Aggregate: the bits of several rows of one word."""
    return F.bit_or(bits)


def distinct_count(bits: str = "bits") -> Column:
    """Aggregate over a group's words, each of which must stand in one row: the number of distinct values."""
    return F.coalesce(F.sum(F.bit_count(F.col(bits)).cast("long")), F.lit(0).cast("long"))
