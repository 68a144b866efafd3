"""Text column expressions (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.util import col, in_list, lit_array
from plenaria.functions.util import let as util_let

# Every Unicode whitespace character (the set ``str.strip()`` removes), by rule.
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
_WS_RUN = r"(?U)\s+"


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` strips spaces only)."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def year_prefix(c) -> Column:
    """First four characters of a date text; null -> ''."""
    return F.substring(F.coalesce(col(c), F.lit("")), 1, 4)


def proposal_number(c) -> Column:
    """'PL 123/2004' -> '123'; anything without a trailing 'n/yyyy' stays as it is."""
    c = col(c)
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(\d+)/\d{4}$", 1), F.lit("")), c)


def words(c) -> Column:
    """Whitespace-separated words (empty text -> empty array)."""
    s = strip_ws(c)
    return F.filter(F.split(s, _WS_RUN), lambda w: w != "")


def capitalize(w: Column) -> Column:
    """First character upper-case, the rest lower-case."""
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))


def title_term(c, particles=vocab.LOWER_PARTICLES) -> Column:
    """Title case; particles lower-case except in first position."""
    parts = words(c)
    out = F.transform(
        parts,
        lambda w, i: F.when((i == 0) | ~in_list(F.lower(w), particles), capitalize(w))
        .otherwise(F.lower(w)),
    )
    return F.when(col(c).isNotNull(), F.array_join(out, " "))


def person_name(c, drop_parentheses: bool = True, particles=vocab.LOWER_PARTICLES) -> Column:
    """Upper-case, optionally drop '(...)', then title case with particles lower everywhere."""
    s = F.upper(strip_ws(c))
    if drop_parentheses:
        s = F.regexp_replace(s, r"\([^)]*\)", "")
    upper_particles = [p.upper() for p in particles]
    out = F.transform(
        words(s),
        lambda w: F.when(in_list(w, upper_particles), F.lower(w)).otherwise(capitalize(w)),
    )
    return F.when(col(c).isNotNull(), F.array_join(out, " "))


def tokens(c, sep: str = ";") -> Column:
    """Split a multi-valued text and strip each token."""
    return F.transform(F.split(col(c), sep), strip_ws)


def first_token(c, sep: str = ";") -> Column:
    """First token of a multi-valued text, stripped."""
    return strip_ws(F.get(F.split(col(c), sep), 0))


def date_text(c) -> Column:
    """Date text -> 'yyyy-MM-dd'; each value parsed on its own, bad -> null."""
    return F.date_format(col(c).try_cast("date"), "yyyy-MM-dd")


def to_number(c) -> Column:
    """Text -> double, bad -> null."""
    return col(c).try_cast("double")


def to_int(c) -> Column:
    return col(c).try_cast("int")


def contains_or_false(c, needle: str) -> Column:
    return F.coalesce(col(c).contains(needle), F.lit(False))


def round_half_even(c, digits: int = 2) -> Column:
    """numpy/Python rounding of a double: half-to-even on the binary value."""
    scale = float(10 ** digits)
    return F.bround(col(c) * F.lit(scale), 0) / F.lit(scale)


def round_exact(c, digits: int = 2) -> Column:
    """Python's ``round(x, digits)``: half-to-even on the exact binary value of ``x``.

    ``x * 10**digits`` is rounded to the nearest double, which can turn a value
    just below a midpoint (5.335 is stored as 5.33499...) into an exact .5.  The
    rounding error of that product is recovered exactly (Dekker's split), and
    only when the product lands exactly on .5 does its sign decide the direction.
    """
    scale = float(10 ** digits)
    split = float(2 ** 27 + 1)

    def rule(x: Column) -> Column:
        p = x * F.lit(scale)
        t = x * F.lit(split)
        hi = t - (t - x)
        err = (hi * F.lit(scale) - p) + (x - hi) * F.lit(scale)
        at_half = (p - F.floor(p)) == F.lit(0.5)
        r = (F.when(at_half & (err > 0), F.ceil(p).cast("double"))
             .when(at_half & (err < 0), F.floor(p).cast("double"))
             .otherwise(F.bround(p, 0)))
        return r / F.lit(scale)

    return util_let(col(c), rule)


def is_present(c, blanks=("", vocab.PLACEHOLDER)) -> Column:
    """Not null and not a blank/placeholder value."""
    c = col(c)
    return c.isNotNull() & ~in_list(c, list(blanks))


def proposal_label(tipo, numero, ano) -> Column:
    """'TYPE number/year'."""
    e = lambda x: F.coalesce(col(x), F.lit(""))
    return F.concat(e(tipo), F.lit(" "), e(numero), F.lit("/"), e(ano))


def bullet_lines(items, prefix: str = "  - ") -> Column:
    """List -> one '  - item' line per element."""
    arr = items if isinstance(items, Column) else lit_array(items)
    return F.array_join(F.transform(arr, lambda x: F.concat(F.lit(prefix), x)), "\n")


def keyed_lines(mapping: dict, prefix: str = "  - ") -> Column:
    """Map -> one '  - KEY (description)' line per entry, in map order."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.array_join(
        F.transform(F.map_entries(m),
                    lambda e: F.concat(F.lit(prefix), e["key"], F.lit(" ("), e["value"], F.lit(")"))),
        "\n")


def thousands_br(c) -> Column:
    """Integer display with '.' as thousands separator."""
    return F.translate(F.format_number(col(c), 0), ",", ".")


def decimal_br(c, digits: int = 1) -> Column:
    """Decimal display with ',' as decimal mark (no grouping)."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.translate(F.call_function("format_number", col(c), F.lit(pattern)), ".", ",")


def percent_text(c, digits: int = 1) -> Column:
    """Share in [0,1] -> 'xx.x%'."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.concat(F.call_function("format_number", col(c) * F.lit(100.0), F.lit(pattern)), F.lit("%"))
