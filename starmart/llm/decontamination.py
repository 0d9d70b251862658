"""Passages of benchmark items in documents, found by one Aho-Corasick automaton.

The words of every item are cut into windows; all windows of a block of items make one
automaton, and each text is scanned once with it. Word positions of the hits are mapped back
to code points of the text as it was given.

The benchmark reaches the tasks in blocks of at most about ``block_bytes`` of text (or one item,
if that is longer), each scanned by a job of its own, so a task holds one automaton whatever the benchmark. With more than one block the rows
are stored with a number, each job stores the hits of its block, and these are joined with the rows at the end.

Cases: a null or empty text has no words and no hits. Items without words have no windows.
An item without an id contaminates documents but is in no list of items; rows that share an id are
one item. Repeated documents are scanned one by one. Other columns are handed through; an
existing column with the name of the result is replaced.
"""

from __future__ import annotations

import math
from functools import reduce

import ahocorasick
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from ..sinks.stage import stage
from .common import with_column

WINDOW = 10
BLOCK_BYTES = 8 << 20
_ROW, _FOUND = "__benchmark_row", "__benchmark_found"

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
#: A-Z to a-z, everything that is in no word to a space; bytes above 0x7F belong to words.
_WORDS = bytes(
    b + 32 if b in _UPPER else 0x20 if b in _SEPARATORS else b for b in range(256)
)

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("word_spans", _SPANS),  # [start, end) in words, disjoint and in order
    T.StructField("spans", _SPANS),  # the same in code points of the text
    T.StructField("items", T.ArrayType(T.StringType())),
])


def words_of(text: str | None) -> list[str]:
    return (text or "").encode().translate(_WORDS).decode().split(" ") if text else []


def plain_words(text: str | None) -> list[str]:
    return [w for w in words_of(text) if w]


def windows(words: list[str], size: int) -> list[tuple[str, ...]]:
    """All windows of ``size`` words; a shorter item, but not an empty one, is one window."""
    if len(words) < size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def automaton(items: list[tuple[str | None, str | None]], size: int) -> ahocorasick.Automaton | None:
    """One automaton over the windows of (id, text) pairs; a value is the length and the ids."""
    found: dict[tuple[str, ...], set] = {}
    for key, text in items:
        for window in windows(plain_words(text), size):
            found.setdefault(window, set()).add(key)
    if not found:
        return None
    machine = ahocorasick.Automaton()
    for window, keys in found.items():
        machine.add_word(f" {' '.join(window)} ", (len(window), sorted(k for k in keys if k is not None)))
    machine.make_automaton()
    return machine


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(hits):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _code_points(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word runs as code points of ``text``; the separators are ASCII, so bytes map one to one."""
    flags = text.encode().translate(_WORDS).decode()
    starts, ends, inside = [], [], False
    for i, c in enumerate(flags):
        if (c != " ") != inside:
            (ends if inside else starts).append(i)
            inside = not inside
    if inside:
        ends.append(len(flags))
    return [(starts[a], ends[b - 1]) for a, b in runs]


def _joined(text: str | None, found: list[dict] | None) -> tuple:
    """What :func:`scan` gives, from the results of the blocks that hit the text."""
    runs = _merged([(s["start"], s["end"]) for f in found or () for s in f["word_spans"]])
    items = {i for f in found or () for i in f["items"]}
    return len(plain_words(text)), runs, _code_points(text, runs) if runs else [], sorted(items)


def scan(machine: ahocorasick.Automaton | None, text: str | None) -> tuple:
    """n_words, word_spans, spans and items of one text."""
    words = plain_words(text)
    hits, items = [], set()
    if machine is not None and words:
        straw = f" {' '.join(words)} "
        ends: list[int] | None = None
        for at, (length, keys) in machine.iter(straw):
            if ends is None:  # place of the space after each word
                ends, place = {}, 0
                for i, w in enumerate(words):
                    place += len(w) + 1
                    ends[place] = i + 1
            hits.append((ends[at] - length, ends[at]))
            items.update(keys)
    runs = _merged(hits)
    return len(words), runs, _code_points(text, runs) if runs else [], sorted(items)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = WINDOW, block_bytes: int = BLOCK_BYTES, result: str = "benchmark",
) -> DataFrame:
    """``docs`` with a struct column ``result``: n_words, word_spans, spans, items (ids as strings)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("k"), F.col(item_text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("k", "t"), F.lit(blocks))

    def scanned(rows: DataFrame, b: int) -> tuple[DataFrame, Broadcast]:
        pairs = [tuple(r) for r in items.where(block == b).toLocalIterator()]
        shared = docs.sparkSession.sparkContext.broadcast(pairs)

        def make():
            machine = automaton(shared.value, size)
            return lambda texts: [scan(machine, t) for t in texts]

        return with_column(rows, result, _RESULT, make, text), shared

    if blocks == 1:
        return scanned(docs, 0)[0]
    rows = stage(docs.withColumn(_ROW, F.monotonically_increasing_id()), "benchmark-rows")
    texts, hits = rows.select(_ROW, text), []
    for b in range(blocks):
        found, shared = scanned(texts, b)
        hits.append(stage(found.where(F.size(f"{result}.word_spans") > 0).select(_ROW, result), "benchmark-hits"))
        shared.destroy()
    # at most one row a block for each document
    gathered = reduce(DataFrame.unionByName, hits).groupBy(_ROW).agg(F.collect_list(result).alias(_FOUND))
    both = rows.join(gathered, _ROW, "left")
    whole = with_column(
        both, result, _RESULT, lambda: lambda ts, found: [_joined(t, f) for t, f in zip(ts, found, strict=True)], text, _FOUND
    )
    return whole.drop(_ROW, _FOUND)


def digest(found: DataFrame, key: str = "doc_id", result: str = "benchmark") -> DataFrame:
    """Counts and the hash of the items of each document."""
    r = F.col(result)
    length = F.aggregate(r["word_spans"], F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))
    return found.select(
        F.col(key), r["n_words"].alias("n_words"), length.alias("n_hit"),
        F.size(r["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(r["items"], ","), 256).alias("items_sha256"), (length > 0).alias("contaminated"),
    )
