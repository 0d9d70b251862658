"""Secrets in texts, found through a trigram inverted index; DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: alternatives of sets of trigrams
that every match must contain. The index has one posting (trigram, text) for each trigram that a rule asks for and a text holds, in
lower case. The postings of a query's trigrams are intersected, and only the candidates are searched with the rule. A rule
that has no mandatory trigram searches every text.

A text's key in the index is its 64-bit hash: two texts with one key only share candidates, which the search
verifies, so nothing is lost. The join of texts and candidates has a plain shuffle on both sides; adaptive execution broadcasts
the candidates when they are few and splits a text that holds many of the rows.

Offsets are code points, end exclusive, of leftmost non-overlapping matches of each rule; a match whose ``group`` is shorter than
``least`` is dropped after it has taken its place. Offsets are summed from the lengths of the matches and the pieces between.

Cases: a null text is empty. Texts of any length are searched whole; the work grows with their length and the number of their matches.
Repeated rows are searched one by one. Other columns are handed through; an existing column
with the name of the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from ..sinks.stage import stage


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the common syntax of Python and Java; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The kinds of secrets that the result counts.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds, which only add spans.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
)

#: A query: alternatives, each a set of trigrams that must all be there. ANY holds for every text.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset({frozenset()})
_MOST = 64


def _least(query: Query) -> Query:
    """Without alternatives that another one implies."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    return _least(frozenset(x | y for x in a for y in b)) if len(a) * len(b) <= _MOST else a


def _of_strings(strings: set[str]) -> Query:
    """One of the strings is in the text."""
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _walk(items) -> tuple[set[str] | None, Query]:
    """The strings that a part stands for, if few, and the query of what it contains for sure."""
    run, query, exact = {""}, ANY, True

    def cut() -> None:
        nonlocal run, query, exact
        query, run, exact = _both(query, _of_strings(run)), {""}, False

    def follow(strings: set[str] | None, inner: Query) -> None:
        nonlocal run, query
        if strings is not None and len(strings) * len(run) <= _MOST:
            run = {a + b for a in run for b in strings}
        else:
            cut()
            query = _both(query, inner if strings is None else _of_strings(strings))

    for kind, value in items:
        if kind is op.LITERAL:
            follow({chr(value).lower()}, ANY)
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            follow({chr(c).lower() for _, c in value}, ANY)
        elif kind is op.SUBPATTERN:
            follow(*_walk(value[3]))
        elif kind is op.BRANCH:
            parts = [_walk(p) for p in value[1]]
            strings = None if any(s is None for s, _ in parts) else set().union(*(s for s, _ in parts))
            follow(strings, _least(frozenset().union(*(_of_strings(s) if s is not None else q for s, q in parts))))
        elif kind is op.MAX_REPEAT:
            low, high, inner = value
            strings, within = _walk(inner)
            if (low, high) == (0, 1) and strings is not None:
                follow(strings | {""}, ANY)
            elif low == high and strings is not None and len(strings) == 1:
                follow({next(iter(strings)) * low}, ANY)
            else:
                cut()
                if low:
                    query = _both(query, within if strings is None else _of_strings(strings))
        else:  # a class, an anchor or something else: says nothing about the text around
            cut()
    return (run, query) if exact else (None, _both(query, _of_strings(run)))


def trigram_query(pattern: str) -> Query:
    """What trigrams, in lower case, a text must hold for ``pattern`` to match in it."""
    strings, query = _walk(parser.parse(pattern, re.NOFLAG))
    return _of_strings(strings) if strings is not None else query


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def postings(texts: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(trigram, key) for the asked ``trigrams`` that each text (column ``text``) holds."""
    low = F.lower("text")
    held = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("low"), t))
    rows = texts.select(_key(F.col("text")).alias("key"), low.alias("low"))
    return rows.select("key", F.explode(held).alias("trigram")).select("trigram", "key")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(key, rules): texts in the intersections of postings that a query asks for."""
    asked = sorted({t for q in queries.values() for c in q for t in c})
    name = {t: f"t{i}" for i, t in enumerate(asked)}
    held = index.groupBy("key").agg(*(F.bool_or(F.col("trigram") == t).alias(name[t]) for t in asked))
    hits = []
    for rule, query in queries.items():
        either = F.lit(False)
        for clause in query:
            every = F.lit(True)
            for t in sorted(clause):
                every = every & F.col(name[t])
            either = either | every
        hits.append(F.when(either, F.lit(rule)))
    return held.select("key", F.array_compact(F.array(*hits)).alias("rules")).where(F.size("rules") > 0)


_SPAN = "struct<start:int,place:int,kind:string,end:int>"


_CHUNK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; inside a function over an array it would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, most: bool = False) -> Column:
    """For each number of an array the sum of those before it, or with ``most`` the largest of them, 0 for the first.

    An array that grows by one element a step is copied in each, so this goes by chunks: inside them first, then over what they come to.
    """
    def ahead(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("all"), F.array().cast("array<int>").alias("out"))
        more = F.greatest if most else lambda a, b: a + b
        return F.aggregate(x, start, lambda done, v: F.struct(
            more(done["all"], v).alias("all"), F.concat(done["out"], F.array(done["all"])).alias("out"),
        ))

    def chunked(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(v) - 1, F.lit(_CHUNK))
        return F.when(F.size(v) > 0, F.transform(starts, lambda i: ahead(F.slice(v, i + 1, F.lit(_CHUNK)))))

    def joined(chunks: Column) -> Column:
        offsets = ahead(F.transform(chunks, lambda c: c["all"]))["out"]
        return F.flatten(F.zip_with(chunks, offsets, lambda c, o: F.transform(c["out"], lambda x: F.greatest(x, o) if most else x + o)))

    return F.coalesce(_let(_let(values, chunked), joined), F.array().cast("array<int>"))


def _matches(text: Column, rule: Rule, place: int) -> Column:
    """Spans of one rule, in order."""
    pattern = F.lit(rule.pattern)
    lengths = F.zip_with(
        F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, 0),
        lambda p, m: F.struct(F.length(p).alias("before"), F.length(m).alias("own")),
    )
    matched = F.filter(lengths, lambda x: x["own"].isNotNull())
    starts = _before(F.transform(matched, lambda x: x["before"] + x["own"]))
    found = F.zip_with(matched, starts, lambda x, s: F.struct(
        (s + x["before"]).alias("start"), (s + x["before"] + x["own"]).alias("end"),
    ))
    kept = F.transform(F.regexp_extract_all(text, pattern, rule.group), lambda g: F.length(g) >= rule.least)
    tagged = F.zip_with(found, kept, lambda s, k: F.when(k, F.struct(
        s["start"].alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), s["end"].alias("end"),
    )))
    return F.array_compact(tagged)


def find_secrets(
    docs: DataFrame, *, text: str = "text", rules: Sequence[Rule] = BASE + MORE, result: str = "secrets"
) -> DataFrame:
    """``docs`` with an array column of spans (start, place of the rule, kind, end), by start and rule."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ANY}
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = [c for c in docs.columns if c.lower() != result.lower()]
    rows = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), body.alias("text"))
    rows = rows.withColumn("key", _key(F.col("text")))
    if indexed:
        asked = sorted({t for q in indexed.values() for c in q for t in c})
        index = stage(postings(docs.select(body.alias("text")), asked), "trigram-postings")
        rows = rows.join(stage(candidates(index, indexed), "secret-candidates"), "key", "left")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<string>"))
    none = F.array().cast(f"array<{_SPAN}>")
    spans = []
    for place, rule in enumerate(rules):
        there = F.coalesce(F.array_contains("rules", rule.kind), F.lit(False)) if rule.kind in indexed else F.lit(True)
        there = there & F.col("text").rlike(rule.pattern)
        spans.append(F.when(there, _matches(F.col("text"), rule, place)).otherwise(none))
    found = F.array_sort(F.concat(*spans))
    return rows.select("row.*", found.alias(result))


#: Spans from which on a text is cut into its characters once, instead of counting to each span's place in it.
_MANY = 64


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``mark``."""
    reached = _before(F.transform(spans, lambda s: s["end"]), most=True)
    gaps = F.zip_with(spans, reached, lambda s, r: F.struct(r.alias("from"), (s["start"] - r).alias("n")))
    gaps = F.filter(gaps, lambda g: g["n"] >= 0)
    end = F.array_max(F.transform(spans, lambda s: s["end"]))

    def whole(piece, size: Column) -> Column:
        pieces = F.transform(gaps, lambda g: F.concat(piece(g["from"], g["n"]), F.lit(mark)))
        return F.concat(F.array_join(pieces, ""), piece(end, size - end))

    few = whole(lambda a, n: F.substring(text, a + 1, n), F.length(text))
    many = _let(F.split(text, "", -1), lambda x: whole(lambda a, n: F.array_join(F.slice(x, a + 1, n), ""), F.length(text)))
    return F.when(F.size(spans) > _MANY, many).when(F.size(spans) > 0, few).otherwise(text)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame, key: str = "doc_id", result: str = "secrets") -> DataFrame:
    """Counts of the base kinds, the hash of their spans and all spans as text."""
    spans = F.col(result)
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select(
        F.col(key), *(of(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"),
    )
