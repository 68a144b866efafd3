"""Author, party and author-category expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.text import strip_ws, tokens
from plenaria.functions.util import any_contains, col, in_list, let, lookup

_MEMBER_RAW_TYPES = [k for k, v in vocab.AUTHOR_TYPE_MAP.items() if v is None]
_MAPPED_RAW_TYPES = {k: v for k, v in vocab.AUTHOR_TYPE_MAP.items() if v is not None}


def author_kind(party, raw_type) -> Column:
    """Party when present; 'Sem partido' for members; else the mapped body; else the raw type."""
    party, raw_type = col(party), col(raw_type)
    return (F.when(party.isNotNull() & (party != ""), party)
            .when(in_list(raw_type, _MEMBER_RAW_TYPES), F.lit(vocab.NO_PARTY_LABEL))
            .otherwise(lookup(_MAPPED_RAW_TYPES, raw_type, raw_type)))


def senate_author(autoria, tipo_doc) -> Column:
    """Senate author text -> struct(parlamentar, tipo_autor, uf).

    'Senador(a) Name (PARTY/UF)' is parsed by the pattern; otherwise ordered keyword
    tests choose the body; a popular-suggestion document short-circuits.
    """
    return let(F.struct(F.coalesce(col(autoria), F.lit("")).alias("raw"), col(tipo_doc).alias("doc")),
               lambda v: _senate_author(v["raw"], v["doc"]))


def _senate_author(raw: Column, tipo_doc: Column) -> Column:
    stripped = strip_ws(raw)
    pattern = "(?U)" + vocab.SENATE_AUTHOR_PATTERN
    matched = stripped.rlike(pattern)
    lower = F.lower(raw)
    body_raw = (F.when(any_contains(lower, vocab.EXECUTIVE_KEYWORDS), F.lit("Executivo"))
                .when(any_contains(lower, vocab.COMMITTEE_KEYWORDS), F.lit("Órgão"))
                .when(any_contains(raw, vocab.COURT_ACRONYMS), F.lit("Poder Judiciário"))
                .when(any_contains(lower, vocab.PROSECUTION_KEYWORDS), F.lit("Ministério Público"))
                .when(any_contains(lower, vocab.LEGISLATURE_KEYWORDS), F.lit("Senado Federal"))
                .otherwise(F.lit("Órgão")))
    is_suggestion = F.coalesce(tipo_doc == "Sugestão", F.lit(False))
    name = (F.when(is_suggestion, raw)
            .when(matched, F.regexp_extract(stripped, pattern, 1))
            .otherwise(raw))
    kind = (F.when(is_suggestion, F.lit(vocab.POPULAR_AUTHOR))
            .when(matched, author_kind(F.regexp_extract(stripped, pattern, 2), F.lit("Senador")))
            .otherwise(author_kind(F.lit(""), body_raw)))
    uf = F.when(~is_suggestion & matched, F.regexp_extract(stripped, pattern, 3)).otherwise(F.lit(""))
    return F.struct(name.alias("parlamentar"), kind.alias("tipo_autor"), uf.alias("uf"))


def normalise_party(c, dashboard: bool = False) -> Column:
    """Party text -> canonical party code, or null for institutions and non-parties."""
    no_party = vocab.NO_PARTY_ALIASES_DASHBOARD if dashboard else vocab.NO_PARTY_ALIASES
    popular = vocab.POPULAR_ALIASES_DASHBOARD if dashboard else vocab.POPULAR_ALIASES

    def rules(p: Column) -> Column:
        return (F.when((p == "") | in_list(p, vocab.INSTITUTIONAL), F.lit(None).cast("string"))
                .when(in_list(p, no_party), F.lit(vocab.NO_PARTY_CODE))
                .when(in_list(p, popular), F.lit(vocab.POPULAR_CODE))
                .when(in_list(p, list(vocab.PARTY_RENAMES)), lookup(vocab.PARTY_RENAMES, p))
                .when(any_contains(p, vocab.PARTY_DROP_MARKERS), F.lit(None).cast("string"))
                .when(F.length(p) > vocab.MAX_PARTY_LEN, F.lit(None).cast("string"))
                .otherwise(p))

    return let(strip_ws(F.replace(strip_ws(col(c)), F.lit("*"), F.lit(""))), rules)


def _eligible(t: Column) -> Column:
    return (t != "") & ~in_list(t, vocab.INSTITUTIONAL) & (F.length(t) <= vocab.MAX_PARTY_LEN)


def _has_author(c: Column) -> Column:
    return c.isNotNull() & ~in_list(c, [vocab.PLACEHOLDER, ""])


def party_of_author(tipo_autor) -> Column:
    """First eligible token, normalised (may be null; the next token is not tried)."""
    c = col(tipo_autor)
    first = F.get(F.filter(tokens(c), _eligible), 0)
    return F.when(_has_author(c), normalise_party(first))


def is_member(tipo_autor) -> Column:
    """True when any token looks like a party (a member of parliament wrote it)."""
    c = col(tipo_autor)
    return F.coalesce(F.when(_has_author(c), F.exists(tokens(c), _eligible)), F.lit(False))


def author_group(tipo_autor) -> Column:
    """First deciding token: an institution gives its own label, a short token 'Políticos'."""
    c = col(tipo_autor)

    def classify(t: Column) -> Column:
        return (F.when(in_list(t, ["", vocab.PLACEHOLDER]), F.lit(vocab.IDEOLOGY_UNKNOWN))
                .when(in_list(t, vocab.INSTITUTIONAL), t)
                .when(F.length(t) <= vocab.MAX_PARTY_LEN, F.lit("Políticos")))

    decided = F.get(F.filter(F.transform(tokens(c), classify), lambda x: x.isNotNull()), 0)
    return F.coalesce(F.when(_has_author(c), decided), F.lit(vocab.IDEOLOGY_UNKNOWN))
