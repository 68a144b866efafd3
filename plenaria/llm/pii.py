r"""Personal data by weak supervision, in DataFrame functions only.

Four base labelers find e-mail addresses, IP addresses, card and phone numbers by pattern and check; looser patterns
give further candidates (spelled-out addresses, phone numbers without a plus sign, numbers of a card's
length that miss the check).  On every candidate five labelers vote for, against or not at all: the check of its kind,
a gazetteer (top-level domains, card issuers' leading digits, country codes, reserved address ranges), words before it, the
characters around it, and its shape.  Expectation-maximisation over the counts of vote patterns (at most 3^5 per kind,
gathered by one grouped sum) estimates how reliable each labeler is on true and on false candidates
(Dawid and Skene 1979).  The posteriors then train the final span classifier, a naive Bayes
model over features of the span that the votes do not use alone; its weights come from a second grouped sum and enter
the last projection as literals.  Base spans are kept whatever it says; a looser candidate is added if the classifier
gives it 1/2 or more and it overlaps no base span and no added span before it.

Patterns start only where a run of their characters starts (or a match has just ended) and use possessive loops where
nothing follows, which changes no match but keeps the search linear and free of recursion on very long texts.
Offsets are code points, summed from the pieces between the matches.

Edge cases: null texts are empty; texts without candidates give empty lists; repeated rows give
repeated results; without candidates anywhere nothing is trained; an empty table gives an empty result; extra
columns are ignored; documents never move, one row's spans are one row's list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm.common import table, written

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[a-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[a-z0-9-]++)++",
    "ip": r"(?i)(?<![0-9a-f:.])[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){7}(?![0-9a-f:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
MARK = {"email": "@", "ip": ".", "card": "", "phone": "+"}     # texts without it have no base span
LOOSE_MARK = {"email": "[\\[(](?i:at)[\\])]", "ip": ":[0-9A-Fa-f]{1,4}:", "card": "[0-9]{4}[\\x20-][0-9]{4}", "phone": "[0-9]{3}[\\x20.-][0-9]{4}"}
OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

# Gazetteers and context words.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us", "ca")
ISSUERS = "^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
RESERVED = r"^0*(0|127|22[4-9]|2[3-5][0-9])\."
DIALLING = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
FOR = {"email": "e-?mail|mail|contact|write|courriel|correo|kontakt", "ip": "\\bip\\b|addr|host|server|serveur|servidor",
       "card": "card|carte|karte|tarjeta|visa|master|amex|credit", "phone": "tel|phone|call|mobile|fax|ruf|appel|llam"}
AGAINST = "order|invoice|version|isbn|issn|part no|serial|build|release|password|token|key|hash|id:"

VOTERS = ("check", "gazetteer", "context", "border", "shape")
ROUNDS = 25
RARE = 2.0      # candidates' worth of the kind's prior in every feature's odds
SPAN = "struct<kind:string,start:int,end:int,base:boolean,check:int,gazetteer:int,context:int,border:int,shape:int,features:array<string>>"


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    figures = F.split(F.reverse(number), "")
    worth = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d.cast("int"))
                        .otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)))
    return F.aggregate(worth, F.lit(0), lambda a, v: a + v) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    """The base labeler's test of a pattern match."""
    n = F.length(digits(hit))
    if kind == "ip":
        return hit.rlike(OCTETS)
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits(hit))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit, before, after>> of all matches, leftmost and non-overlapping."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string,before:string,after:string>>").alias("out"))

    def step(acc: Column, i: Column) -> Column:
        piece, hit, then = F.get(pieces, i), F.get(hits, i), F.get(pieces, i + 1)
        begin = acc["at"] + F.length(piece)
        end = begin + F.length(hit)
        one = F.struct(begin.alias("start"), end.alias("end"), hit.alias("hit"),
                       F.right(piece, F.lit(40)).alias("before"), F.left(then, F.lit(1)).alias("after"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

    every = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(every, start, step, lambda acc: acc["out"])


def votes(kind: str, m: Column, base: bool) -> list[Column]:
    """The five votes on a match: 1 for, -1 against, 0 none."""
    hit, number = m["hit"], digits(m["hit"])
    n = F.length(number)

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    if kind == "email":
        top = F.lower(F.regexp_extract(hit, "([A-Za-z0-9-]+)$", 1))
        listed = top.isin(*DOMAINS)
        gazetteer, shape = vote(listed, ~listed & ~top.rlike("^[a-z]{2,6}$")), vote(F.length(hit) <= 64, F.length(hit) > 254)
    elif kind == "ip":
        gazetteer = vote(~hit.rlike(RESERVED), hit.rlike(RESERVED))
        shape = vote(~hit.rlike(r"(^|\.)0[0-9]"), hit.rlike(r"(^|\.)0[0-9]"))
    elif kind == "card":
        gazetteer, shape = vote(number.rlike(ISSUERS), ~number.rlike(ISSUERS)), vote(n == 16, ~n.isin(13, 14, 15, 16, 19))
    else:
        gazetteer, shape = vote(number.rlike(DIALLING), ~number.rlike(DIALLING)), vote(n.between(10, 13), n > 13)
    check = F.lit(1) if base else vote(luhn(number), ~luhn(number)) if kind == "card" else F.lit(0)
    before = F.lower(m["before"])
    context = vote(before.rlike(FOR[kind]), before.rlike(AGAINST))
    glued = F.right(m["before"], F.lit(1)).rlike("[A-Za-z0-9_=]") | m["after"].rlike("[A-Za-z0-9_@]")
    return [c.alias(v) for v, c in zip(VOTERS, (check, gazetteer, context, vote(~glued, glued), shape))]


def features(kind: str, m: Column, base: bool) -> Column:
    """Features of a span for the classifier, each one of a bounded set of names."""
    def named(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{kind}:{name}="), value.cast("string"))

    last = F.right(m["before"], F.lit(1))
    edge = F.when(last == "", "none").when(last.rlike(r"\s"), "blank").when(last.rlike("[0-9A-Za-z]"), "word").otherwise("sign")
    then = F.when(m["after"] == "", "none").when(m["after"].rlike(r"\s"), "blank").when(m["after"].rlike("[0-9A-Za-z]"), "word").otherwise("sign")
    return F.array(F.lit(f"{kind}:base={base}"), named("digits", F.least(F.length(digits(m["hit"])), F.lit(20))),
                   named("length", F.least(F.floor(F.length(m["hit"]) / 4), F.lit(16))), named("edge", edge), named("then", then),
                   named("separated", m["hit"].rlike(r"[\x20().-]")))


def candidates(text: Column) -> Column:
    """All candidate spans of a text, base ones first."""
    found = []
    for kind in KINDS:
        empty = F.array().cast(f"array<{SPAN}>")

        def spans(pattern: str, base: bool, kind: str = kind) -> Column:
            hits = matches(text, pattern)
            if base:
                hits = F.filter(hits, lambda m: valid(kind, m["hit"]))
            return F.transform(hits, lambda m: F.struct(
                F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(base).alias("base"),
                *votes(kind, m, base), features(kind, m, base).alias("features"))).cast(f"array<{SPAN}>")

        likely = text.contains(MARK[kind]) if MARK[kind] else F.lit(True)
        if kind in ("ip", "card", "phone"):
            likely = likely & text.rlike({"ip": r"[0-9]\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": r"\+[0-9]"}[kind])
        found += [F.when(likely, spans(BASE[kind], True)).otherwise(empty),
                  F.when(text.rlike(LOOSE_MARK[kind]), spans(LOOSE[kind], False)).otherwise(empty)]
    return F.concat(*found)


def reliabilities(patterns: list[tuple]) -> dict[tuple, float]:
    """Posterior of being personal data per (kind, *votes), by expectation-maximisation over (kind, votes, count)."""
    belief = {p[:-1]: 0.9 if sum(p[1:-1]) > 0 else 0.1 for p in patterns}
    for _ in range(ROUNDS):
        prior, rate = {}, {}
        for kind in {p[0] for p in patterns}:
            own = [p for p in patterns if p[0] == kind]
            yes = sum(p[-1] * belief[p[:-1]] for p in own)
            total = sum(p[-1] for p in own)
            prior[kind] = (yes + 1) / (total + 2)
            for v in range(len(VOTERS)):
                for said in (-1, 0, 1):
                    a = sum(p[-1] * belief[p[:-1]] for p in own if p[1 + v] == said)
                    b = sum(p[-1] * (1 - belief[p[:-1]]) for p in own if p[1 + v] == said)
                    # a vote is taken to be right more often than not, which keeps the classes from swapping
                    rate[kind, v, said] = ((a + (2 if said > 0 else 1)) / (yes + 4), (b + (2 if said < 0 else 1)) / (total - yes + 4))
        for p in patterns:
            odds = math.log(prior[p[0]] / (1 - prior[p[0]]))
            odds += sum(math.log(rate[p[0], v, said][0] / rate[p[0], v, said][1]) for v, said in enumerate(p[1:-1]))
            belief[p[:-1]] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return belief


def literal_map(values: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv)) if values else F.lit(None).cast("map<string,double>")


def train(found: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of the span classifier: log-odds per feature and prior log-odds per kind."""
    spans = found.select(F.explode("spans").alias("s"))
    counted = spans.groupBy("s.kind", *(f"s.{v}" for v in VOTERS)).agg(F.count("*").alias("n")).collect()   # <= 4 * 3^5 rows
    if not counted:
        return {}, {}
    belief = reliabilities([tuple(r) for r in counted])
    beliefs = literal_map({":".join(map(str, k)): v for k, v in belief.items()})
    soft = spans.select("s.features", "s.kind", beliefs[F.concat_ws(":", "s.kind", *(f"s.{v}" for v in VOTERS))].alias("p"))
    sums = (soft.select("p", F.explode(F.array_append("features", F.concat(F.lit("kind="), F.col("kind")))).alias("f"))
            .groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect())   # a bounded set of names
    of_kind = {r["f"][5:]: (r["yes"], r["no"]) for r in sums if r["f"].startswith("kind=")}
    prior = {k: math.log((y + 1) / (n + 1)) for k, (y, n) in of_kind.items()}
    weights = {}
    for r in sums:
        kind = r["f"].split(":")[0]
        if kind in of_kind:
            # the odds given the feature, drawn to the kind's own odds where the feature is rare
            share = 1 / (1 + math.exp(-prior[kind]))
            weights[r["f"]] = math.log((r["yes"] + RARE * share) / (r["no"] + RARE * (1 - share))) - prior[kind]
    return weights, prior


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans array<struct<kind, start, end, base, probability>> in order, for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = written(docs.select(F.col(id_col).alias("doc_id"), candidates(text).alias("spans")), "pii-candidates")
    weights, prior = train(found)
    weight, start = literal_map(weights), literal_map(prior)

    def scored(s: Column) -> Column:
        odds = F.aggregate(s["features"], F.coalesce(start[s["kind"]], F.lit(0.0)),
                           lambda a, f: a + F.coalesce(weight[f], F.lit(0.0)))
        return F.struct(s["start"].alias("start"),
                        F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int").alias("rank"),
                        s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"),
                        (1 / (1 + F.exp(-odds))).alias("probability"))

    spans = F.transform("spans", scored)
    base = F.filter(spans, lambda s: s["base"])
    added = F.array_sort(F.filter(spans, lambda s: ~s["base"] & (s["probability"] >= 0.5)))
    kept = F.aggregate(added, base, lambda acc, s: F.when(
        F.exists(acc, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])), acc).otherwise(F.array_append(acc, s)))
    return found.select("doc_id", F.array_sort(kept).alias("spans"))


def op8_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
