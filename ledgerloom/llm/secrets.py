"""Secret scan with a trigram inverted index.

From each rule's regular expression a Boolean trigram query is derived: any of several sets
of trigrams that every match must contain. Postings (trigram, text key) are built for the
trigrams the rules ask for, joined with the queries and intersected per text and set; a
rule's expression then runs only over its candidates. A rule without mandatory trigrams
scans every text. Texts meet their candidates by key, so copies share postings.

Spans are code points, end exclusive, leftmost and non-overlapping per kind. Null text
counts as empty. Every input row is kept with all its columns, repeated ones too. The key is
a hash: two texts sharing one would only be searched for each other's rules. Texts of any
length are searched whole, each in one task. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_STRINGS = 64  # alternatives spelled out while deriving a query
SMALL_CLASS = 8  # characters of a class that are spelled out


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int  # whose length decides
    least: int  # characters of that group; shorter matches are dropped


# The base kinds, in their order.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # The same as runs of any length with the short ones dropped, found in one pass.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Kinds this scan adds.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
)
RULES = BASE + MORE


def _strings(node: tuple) -> set[str] | None:
    """All strings a part of an expression can match, lower-cased, if they are few."""
    op, value = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(value).lower()}
    if op == "IN":
        out: set[str] = set()
        for kind, chars in value:
            if str(kind) == "LITERAL":
                out.add(chr(chars).lower())
            elif str(kind) == "RANGE" and chars[1] - chars[0] < SMALL_CLASS:
                out |= {chr(c).lower() for c in range(chars[0], chars[1] + 1)}
            else:
                return None
        return out if len(out) <= SMALL_CLASS else None
    if op == "SUBPATTERN":
        return _sequence_strings(value[-1])
    if op == "BRANCH":
        parts = [_sequence_strings(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and int(value[1]) <= 1:
        inner = _sequence_strings(value[2])
        if inner is None:
            return None
        return inner if value[0] else inner | {""}
    return None


def _sequence_strings(nodes: Iterable[tuple]) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


Query = set[frozenset[str]]  # any of these sets of trigrams


def _grams(strings: set[str]) -> Query:
    return {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}


def _both(a: Query, b: Query) -> Query:
    joined = {x | y for x in a for y in b}
    # A set that contains another one says nothing more.
    return {x for x in joined if not any(y < x for y in joined)}


def _sequence_query(nodes: Iterable[tuple]) -> Query:
    out: Query = {frozenset()}
    run = {""}
    for node in nodes:
        more = _strings(node)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        out, run = _both(out, _grams(run)), {""}
        op, value = str(node[0]), node[1]
        if op == "SUBPATTERN":
            out = _both(out, _sequence_query(value[-1]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and value[0]:
            out = _both(out, _sequence_query(value[2]))
        elif op == "BRANCH":
            out = _both(out, set().union(*[_sequence_query(b) for b in value[1]]))
    return _both(out, _grams(run))


def trigram_query(pattern: str) -> Query | None:
    """Sets of lower-case trigrams of which a match holds one whole; None: no such set."""
    query = _sequence_query(re._parser.parse(pattern))
    return None if frozenset() in query else query


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def postings(texts: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index (trigram, key) of a ``text`` column, for the given trigrams."""
    lowered = texts.select(
        _key(F.col("text")).alias("key"), F.lower("text").alias("lowered")
    )
    found = F.array(*[F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in trigrams])
    return lowered.select("key", F.explode(F.array_compact(found)).alias("trigram"))


def candidates(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, kinds): texts that hold all trigrams of some set of a rule's query."""
    spark = texts.sparkSession
    terms = [
        (rule.kind, number, gram, 1 << bit, (1 << len(grams)) - 1)
        for rule in rules
        for number, grams in enumerate(sorted(map(sorted, trigram_query(rule.pattern) or ())))
        for bit, gram in enumerate(grams)
    ]
    schema = "kind string, part int, trigram string, bit long, full long"
    index = postings(texts, sorted({t[2] for t in terms}))
    return (
        index.join(spark.createDataFrame(terms, schema), "trigram")
        .groupBy("key", "kind", "part", "full")
        .agg(F.bit_or("bit").alias("bits"))
        .filter("bits = full")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule, from the texts before each match and the matches."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, 0)
    judged = F.regexp_extract_all(text, pattern, rule.group)
    lengths = F.arrays_zip(
        F.transform(gaps, F.length).alias("gap"),
        F.transform(matches, F.length).alias("own"),
        F.transform(judged, F.length).alias("judged"),
    )
    kind = "struct<start:int,place:int,end:int,kind:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(state: Column, one: Column) -> Column:
        begin = state["at"] + one["gap"]
        end = begin + one["own"]
        span = F.struct(
            begin.alias("start"), F.lit(order).alias("place"), end.alias("end"),
            F.lit(rule.kind).alias("kind"),
        ).cast(kind)
        return F.struct(
            end.alias("at"),
            F.when(one["judged"] >= rule.least, F.concat(state["out"], F.array(span)))
            .otherwise(state["out"])
            .alias("out"),
        )

    # The last gap has no match after it.
    return F.aggregate(F.slice(lengths, 1, F.size(matches)), start, step, lambda s: s["out"])


def find(docs: DataFrame, keep, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(row, spans): each input row as a struct, and its spans by start and rule order."""
    whole = [r.kind for r in rules if trigram_query(r.pattern) is None]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        _key(F.col("text")).alias("key"),
    )
    found = keep(candidates(docs, rules), "candidates")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    spans = [
        F.when(
            text.rlike(rule.pattern)
            if rule.kind in whole
            else F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)),
            _spans_of(text, rule, order),
        ).otherwise(none)
        for order, rule in enumerate(rules)
    ]
    return rows.join(found, "key", "left").select(
        "row", F.array_sort(F.concat(*spans)).alias("spans")
    )


def described(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(
                (span["start"] >= state["at"]) | (state["at"] == 0),
                F.concat(state["out"], F.array(gap, F.lit(mark))),
            ).otherwise(state["out"]).alias("out"),
        )

    def finish(state: Column) -> Column:
        return F.concat(
            F.array_join(state["out"], ""),
            F.substring(text, state["at"] + 1, F.length(text) - state["at"]),
        )

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
