"""Verdicts on urls by pattern rules that are indexed by their rarest literal token; DataFrame functions only.

A token is a run of a-z and 0-9 (A-Z lower-cased). From a rule's regular expression follow the tokens that a url must hold for it to
match, for each of its alternatives. How many of the urls hold each of them is counted over the whole table, and a rule is filed
under the rarest, once for each alternative. The tokens of a url fetch the rules filed under them, and only those run their
regular expressions. Rules with an alternative that has no such token are fetched by every url.

A rule is matched against the host (A-Z lower-cased) followed by all that stands after it in the url. Of the rules that match, the one
with the greatest ``rank`` wins, then the longest name, then the name that sorts last, then ``block``. ``site`` makes the rule of a
host with its subdomains and a path prefix; it outranks plain patterns.

The urls are stored once with row numbers. Tokens are spread over rows of their own before the index is joined, by a join without hint:
Spark broadcasts a small index and splits a frequent token of a large one. The rules found for a row are reduced to one before rows
are joined back by number, so a host or url that holds a third of all rows is no key of an exchange.

Cases: a null url, or one without ``://``, has the host '' and the path '', no rule matches it, and the verdict is ``allow``, as for every
url that no rule matches. Repeated rows are judged one by one. Urls of any length are read whole. Other columns are handed through; columns
with the names of the results are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from ..sinks.stage import stage

RESULTS = ("host", "path", "rule", "verdict", "pattern")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = frozenset(_LOWER + "0123456789")
_ANY, _EDGE = "any", "edge"  # stand for unknown text, and for something that ends a token
_MOST = 64
#: Rules' tokens up to which they are broadcast to count them, some MB; beyond, all tokens of the urls are counted.
BROADCAST = 100_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the common syntax of Python and Java; without look-around and back references."""

    name: str
    pattern: str
    verdict: str
    rank: int = 0


def site(name: str, verdict: str) -> Rule:
    """The rule of a host, its subdomains and the paths that start as ``name`` goes on after the host."""
    return Rule(name, r"^(?:[^/?#]*\.)?" + re.escape(name), verdict, 1)


# The rules on sites.
SITES = (
    site("net/", "block"), site("example.net/en/", "allow"), site("example.com/de/", "block"), site("org/fr/", "allow"),
)
#: What kinds of pages are left out when no site rule tells: spam hosts, accounts, searches, files that are no text.
PATTERNS = (
    Rule("casino", r"^(?:[^/?#]*[.-])?casino[.-]", "block"),
    Rule("pills", r"^(?:[^/?#]*[.-])?pills?[.-]", "block"),
    Rule("poker", r"^(?:[^/?#]*[.-])?poker[.-]", "block"),
    Rule("adult", r"^(?:[^/?#]*[.-])?(?:porn|xxx|sex)[.-]", "block"),
    Rule("ad-server", r"^(?:ads?|adserver|adservice|tracker|tracking|click)\.", "block"),
    Rule("login", r"[/?&](?:login|logout|signin|signup|register)(?:[./?&=#]|$)", "block"),
    Rule("admin", r"/wp-admin/", "block"),
    Rule("cart", r"/(?:cart|checkout|basket)(?:[/?#]|$)", "block"),
    Rule("search", r"/search(?:[/?]|$)", "block"),
    Rule("reply", r"[?&]replytocom=[0-9]+", "block"),
    Rule("session", r"[?&;](?:phpsessid|jsessionid|sid)=", "block"),
    Rule("print", r"[?&]print=(?:1|true|yes)(?:[&#]|$)", "block"),
    Rule("file", r"\.(?:zip|gz|exe|jpe?g|png|gif|mp[34]|avi|css|js)(?:[?#]|$)", "block"),
    Rule("robots", r"^[^/?#]*/robots\.txt$", "allow"),
)
DEFAULT = SITES + PATTERNS


def _class(items) -> list[tuple[str, ...]]:
    """Symbols of a character class: its characters, or something that ends a token, or anything."""
    kinds = {k for k, _ in items}
    if kinds <= {op.LITERAL}:
        chars = list(dict.fromkeys(chr(c).lower() for _, c in items))
        return [(c,) for c in chars] if _TOKEN.intersection(chars) else [(_EDGE,)]
    if not kinds <= {op.LITERAL, op.RANGE, op.NEGATE}:
        return [(_ANY,)]
    spans = [(v, v) if k is op.LITERAL else v for k, v in items if k is not op.NEGATE]
    inside = {any(low <= ord(c) <= high for low, high in spans) for t in _TOKEN for c in {t, t.upper()}}
    return [(_EDGE,)] if inside == {op.NEGATE in kinds} else [(_ANY,)]


def _strings(items) -> list[tuple[str, ...]]:
    """The alternatives that a part stands for, as symbols: a character, ``_ANY`` or ``_EDGE``."""
    out: list[tuple[str, ...]] = [()]
    for kind, value in items:
        more: list[tuple[str, ...]] = [(_ANY,)]
        if kind is op.LITERAL:
            more = [(chr(value).lower(),)]
        elif kind is op.AT and value is not op.AT_NON_BOUNDARY:
            more = [(_EDGE,)]  # an end may stand before a last line feed, which ends a token as well
        elif kind is op.IN:
            more = _class(value)
        elif kind is op.SUBPATTERN:
            more = _strings(value[3])
        elif kind is op.BRANCH:
            more = [s for part in value[1] for s in _strings(part)]
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            within = _strings(inner)
            if (low, high) == (0, 1):
                more = [(), *within]
            elif low == high == 1:
                more = within
            elif low and len(within) ** 2 <= _MOST:  # once at the left, once at the right, whatever lies between
                more = [(*a, _ANY, *b) for a in within for b in within]
        if len(out) * len(more) > _MOST:
            more = [(_ANY,)]
        out = list(dict.fromkeys(a + b for a in out for b in more))
    return out


def _tokens(symbols: tuple[str, ...]) -> frozenset[str]:
    """Runs of token characters that something ends on both sides."""
    found, run, open_left = set(), "", True
    for s in (*symbols, _ANY):
        if s in _TOKEN:
            run += s
            continue
        if run and not open_left and s != _ANY:
            found.add(run)
        run, open_left = "", s == _ANY
    return frozenset(found)


def mandatory_tokens(pattern: str) -> list[frozenset[str]]:
    """The alternatives of ``pattern`` as sets: a url that it matches holds all tokens of one of them."""
    sets = set(map(_tokens, _strings(parser.parse(pattern, re.NOFLAG))))
    return sorted((a for a in sets if not any(b < a for b in sets)), key=sorted)


def _lower(x: Column) -> Column:
    return F.translate(x, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and the host with all that follows it; the last is null for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = _lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    target = F.concat(host, F.substring(rest, F.length(host) + 1, F.length(rest)))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), target


def tokens_of(target: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(_lower(target), "[^a-z0-9]+"), ""))


def rule_index(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(token, pattern, verdict, rank, name): each rule under the rarest of its tokens among ``urls`` (row, target), or under ''."""
    spark = urls.sparkSession
    table = [(i, r.name, r.pattern, r.verdict, r.rank) for i, r in enumerate(rules)]
    listed = spark.createDataFrame(table, "rule int, name string, pattern string, verdict string, rank int")
    sets = [(i, a, t) for i, r in enumerate(rules) for a, tokens in enumerate(mandatory_tokens(r.pattern)) for t in tokens or {""}]
    held = spark.createDataFrame(sets, "rule int, alternative int, token string")
    seen = urls.select(F.explode(tokens_of(F.col("target"))).alias("token"))
    asked, few = held.select("token").distinct(), len(sets) <= BROADCAST
    # without a broadcast the tokens are counted first: a frequent one is a few rows then
    kept = seen.join(F.broadcast(asked), "token", "left_semi") if few else seen
    counts = kept.groupBy("token").agg(F.count("*").alias("n"))
    counts = counts if few else counts.join(asked, "token", "left_semi")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least")
    filed = held.join(counts, "token", "left").groupBy("rule", "alternative").agg(rarest)
    filed = filed.select("rule", F.col("least.token").alias("token")).distinct()
    return stage(filed.join(listed, "rule").select("token", "pattern", "verdict", "rank", "name"), "url-rules")


def judge(pages: DataFrame, rules: Sequence[Rule] = DEFAULT, *, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (name of the site rule that decides, else null), verdict, and pattern (name of any deciding rule)."""
    names = [c for c in pages.columns if c.lower() not in RESULTS]
    host, path, target = host_and_path(pages[url].cast("string"))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*(pages[c] for c in names)).alias("own") if names else F.lit(None).alias("own"),
        host.alias("host"), path.alias("path"), target.alias("target"),
    )
    rows = stage(rows, "urls")
    index = rule_index(rows, rules)
    tokens = tokens_of(F.col("target"))
    if any(not a for r in rules for a in mandatory_tokens(r.pattern)):
        tokens = F.concat(F.array(F.lit("")), tokens)
    fetched = rows.select("row", "target", F.explode(tokens).alias("token")).join(index, "token")
    hits = fetched.where(F.regexp_like("target", F.col("pattern")))
    best = F.max(F.struct("rank", F.length("name").alias("length"), "name", "verdict")).alias("best")
    best = hits.groupBy("row").agg(best)
    judged = rows.join(best, "row", "left")
    return judged.select(
        *(["own.*"] if names else []), "host", "path", F.when(F.col("best.rank") >= 1, F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), F.col("best.name").alias("pattern"),
    )
