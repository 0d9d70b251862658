"""Alignment of two tokenizers on the same text: groups of tokens between common ends, and how often ids are linked.

Each side gives byte offsets at which its tokens end. The ends are intersected by galloping: the shorter list drives a search with doubling steps,
then by halves, into the longer one. The common ends cut both token lists into groups, and the differences of the ranks on either side give
how many tokens of each side a group holds; every pair of tokens of a group is a link. A text's links are held as distinct pairs of
ids with their numbers, so a group of p and q tokens costs at most as many pairs as its ids make.

Counts of pairs, by documents, are a grouped table. The ``HEAD`` most frequent pairs are broadcast (16 bytes each); what a text's other pairs count
comes from a join with the whole table, whose keys are all rarer than those, so no key of it is hot. The result does not depend
on ``HEAD``. A text whose groups make more than ``LINKS`` links is written as several rows of pairs, which are made distinct by an exchange before
they are counted. The highest count of an id of the first side is broadcast too: it has one row for each id of a vocabulary.

The first side is a byte-level BPE file without normaliser, encoded by its merge ranks; it has to number its tokens in the order of the merges. The
second is a sentencepiece model that adds a space in front. No piece of it goes on after a space sign, so a text is cut there, and words already
encoded are remembered, up to ``MEMO`` of them. Both are files of a few MB that do not grow with the data.

Cases: texts that are null or empty, or whose tokens' bytes on either side are not those of a space and the text, have no tokens: all numbers are 0 and
the hash is ''. Repeated rows are documents of their own; null keys are handed through. Ties for the highest count all count as best. Of other
columns, the key alone is returned. Texts of any length are aligned whole; a task holds the tokens of one text.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..sinks.stage import stage
from .bpe import byte_alphabet

HEAD, LINKS, MEMO = 200_000, 1 << 20, 300_000
#: Longer texts go to the slower of two encoders with equal ids: the fast one's stack ends at runs of about a million spaces.
LONG = 200_000
_ID = 1 << 32  # a pair is one number: first id * _ID + second id
_WORDS = re.compile(" *[^ ]+| +")
#: How a byte-level file cuts a text before merging; a fixed value of that kind of tokenizer.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """The first side; ``strings`` has the bytes of each id."""

    def __init__(self, spec: str) -> None:
        import tiktoken

        data = json.loads(spec)
        model, step = data["model"], data["pre_tokenizer"]
        vocab = model["vocab"]
        merged = [vocab[a + b] for a, b in model["merges"]]
        if data["normalizer"] or step["type"] != "ByteLevel" or step["add_prefix_space"] or not step["use_regex"] or merged != sorted(merged):
            raise ValueError("not a byte-level file without normaliser whose ids are in the order of the merges")
        value = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["content"] for t in data["added_tokens"]}
        ranks = {bytes(value[c] for c in s): i for s, i in vocab.items() if s not in special}
        self.strings = [b""] * (max(ranks.values()) + 1)
        for s, i in ranks.items():
            self.strings[i] = s
        self.short = tiktoken.Encoding("aligned", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.spec, self.long = spec, None

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG:
            return self.short(text)
        if self.long is None:
            import tokenizers

            self.long = tokenizers.Tokenizer.from_str(self.spec)
            self.long.encode_special_tokens = True
        return self.long.encode(text, add_special_tokens=False).ids


class Pieces:
    """The second side."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in s.lstrip("▁") for s in names):
            raise ValueError("a piece goes on after a space")
        self.strings = [
            bytes([int(s[3:5], 16)]) if self.model.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)
        ]
        self.space = self.model.piece_to_id("▁")
        self.memo: dict[str, list[int]] = {}

    def encode_all(self, texts: Sequence[str]) -> list[list[int]]:
        """Ids of texts that start with the space which the model would add."""
        memo = self.memo
        if len(memo) > MEMO:
            for word in list(memo)[: MEMO // 2]:
                del memo[word]
        words = [_WORDS.findall(t) for t in texts]
        new = list({w for x in words for w in x if w not in memo})
        # the model adds no space to an empty text
        ids = self.model.encode([w[1:] for w in new], num_threads=1) if new else []
        memo.update((w, x if w != " " else [self.space]) for w, x in zip(new, ids, strict=True))
        out = [list(chain.from_iterable([memo[w] for w in x])) for x in words]
        for w in new:
            if len(w) > 64:
                del memo[w]
        return out


def gallop(short: Sequence[int], long: Sequence[int]) -> tuple[list[int], list[int]]:
    """The places, in either list, of the numbers that both ascending lists have."""
    here, there, low, n = [], [], 0, len(long)
    for i, x in enumerate(short):
        if low == n:
            break
        if long[low] < x:
            step = 1
            while low + step < n and long[low + step] < x:
                low += step
                step += step
            low = bisect_left(long, x, low + 1, min(low + step, n))
            if low == n:
                break
        if long[low] == x:
            here.append(i)
            there.append(low)
            low += 1
    return here, there


def _outer(a: np.ndarray, b: np.ndarray):
    """The pairs of two sets of tokens, with the product of their numbers, in blocks."""
    (a, m), (b, n) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    step = max(1, LINKS // len(b))
    for i in range(0, len(a), step):
        x, k = a[i : i + step], m[i : i + step]
        yield np.repeat(x * _ID, len(b)) + np.tile(b, len(x)), np.repeat(k, len(b)) * np.tile(n, len(x))


def links(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray):
    """(pairs, numbers) in blocks of about ``LINKS``: distinct in a block, and in all if there is one.

    ``p`` and ``q`` tell how many ids of ``a`` and of ``b`` each group holds.
    """
    each, first, second = p * q, np.cumsum(p) - p, np.cumsum(q) - q
    for g in np.flatnonzero(each > 4096):
        yield from _outer(a[first[g] : first[g] + p[g]], b[second[g] : second[g] + q[g]])
    each = np.where(each > 4096, 0, each)
    ends = np.cumsum(each)
    start = 0
    while start < len(each):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + LINKS, side="right")))
        part = np.repeat(np.arange(start, stop), each[start:stop])
        at = np.arange(before, ends[stop - 1]) - (ends - each)[part]
        pairs, numbers = np.unique(a[first[part] + at // q[part]] * _ID + b[second[part] + at % q[part]], return_counts=True)
        if len(pairs):
            yield pairs, numbers
        start = stop


def _merged(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(blocks) == 1:
        return blocks[0]
    pairs, numbers = (np.concatenate(x) for x in zip(*blocks, strict=True))
    order = np.argsort(pairs, kind="stable")
    pairs, numbers = pairs[order], numbers[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return pairs[first], np.add.reduceat(numbers, first)


class Aligner:
    """Groups and links of texts under two tokenizers."""

    def __init__(self, first: str, second: bytes) -> None:
        self.first, self.second = ByteLevel(first), Pieces(second)
        self.sizes = [np.array(list(map(len, side.strings)), dtype=np.int64) for side in (self.first, self.second)]
        # how an id is written: inside and at the end of its side of a group
        n, m = (len(x) for x in self.sizes)
        self.n, self.m = n, m
        self.written = [f"{i}{end}" for count, ends in ((n, ",|"), (m, ",;")) for end in ends for i in range(count)]

    def groups(self, ids: list[int], others: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of either side as arrays, and how many of each a group holds."""
        a, b = np.array(ids, dtype=np.int64), np.array(others, dtype=np.int64)
        ends = np.cumsum(self.sizes[0][a]).tolist(), np.cumsum(self.sizes[1][b]).tolist()
        if len(ids) <= len(others):
            x, y = gallop(*ends)
        else:
            y, x = gallop(*ends[::-1])
        return a, b, np.diff(np.array(x), prepend=-1), np.diff(np.array(y), prepend=-1)

    def written_groups(self, a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray) -> str:
        after, behind = np.cumsum(p), np.cumsum(q)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[after - 1], last_b[behind - 1] = 1, 1
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        codes[np.arange(len(a)) + np.repeat(behind - q, p)] = a + last_a * self.n
        codes[np.arange(len(b)) + np.repeat(after, q)] = b + last_b * self.m + 2 * self.n
        return "".join(map(self.written.__getitem__, codes.tolist()))[:-1]

    def encoded(self, texts: Sequence[str | None]) -> list[tuple[list[int], list[int]] | None]:
        """Ids on either side; None for texts without tokens."""
        spaced = [" " + t for t in texts if t]
        found = iter(zip(spaced, map(self.first.encode, spaced), self.second.encode_all(spaced), strict=True))
        out: list[tuple[list[int], list[int]] | None] = []
        for t in texts:
            if not t:
                out.append(None)
                continue
            body, ids, others = next(found)
            raw = body.encode()
            same = b"".join(map(self.first.strings.__getitem__, ids)) == raw == b"".join(map(self.second.strings.__getitem__, others))
            out.append((ids, others) if same else None)
        return out


def _files(spark, first: str, second: str):
    with open(first, encoding="utf-8") as one, open(second, "rb") as two:
        return spark.sparkContext.broadcast((one.read(), two.read()))


_BASE = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, first: str, second: str, *, key: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """(row, key, n_a, n_b, n_groups, n_links, groups_sha256, whole, a, b, times): a text's numbers and its linked ids.

    A text has one row, or, if its links fill several blocks, more rows, which have no numbers and are not ``whole``. ``groups`` adds the
    groups as they are hashed.
    """
    files = _files(docs.sparkSession, first, second)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType([
        T.StructField("row", T.LongType()), rows.schema["key"], *(T.StructField(n, T.LongType()) for n in _BASE),
        T.StructField("groups_sha256", T.StringType()), T.StructField("whole", T.BooleanType()),
        T.StructField("a", ids), T.StructField("b", ids), T.StructField("times", T.ArrayType(T.LongType())),
        *([T.StructField("groups", T.StringType())] if groups else []),
    ])

    def run(batches):
        work = Aligner(*files.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                yield from out_of(work, part)

    def out_of(work, part):
        number, named, base, held, rest = part.column(0).to_pylist(), [], [], [], []
        row, size = [], 0

        def out():
            sizes = np.cumsum([0, *(len(p) for p, _ in held)])
            pairs, times = (np.concatenate(x) for x in zip(*held, strict=True))
            lists = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(x)) for x in ((pairs // _ID).astype(np.int32), (pairs % _ID).astype(np.int32), times)]
            numbers = [pa.array(x, pa.int64()) for x in zip(*(b[:4] for b in base), strict=True)]
            more = [pa.array([b[5] for b in base], pa.string())] if groups else []
            return pa.RecordBatch.from_arrays([
                pa.array(row, pa.int64()), part.column(1).take(pa.array(named, pa.int64())), *numbers, pa.array([b[4] for b in base], pa.string()), pa.array(rest), *lists, *more,
            ], names=schema.names)

        empty = np.empty(0, np.int64)
        for i, found in enumerate(work.encoded(part.column(2).to_pylist())):
            blocks, shown = [(empty, empty)], (0, 0, 0, 0, "", None)
            if found:
                a, b, p, q = work.groups(*found)
                written = work.written_groups(a, b, p, q)
                shown = (len(a), len(b), len(p), int((p * q).sum()), hashlib.sha256(written.encode()).hexdigest(), written)
                blocks = links(a, b, p, q)
            blocks = iter(blocks)
            mine, total = [], 0
            for block in blocks:
                mine.append(block)
                total += len(block[0])
                if total > LINKS:
                    break
            whole = total <= LINKS
            for block in [_merged(mine)] if whole else chain(mine, blocks):
                row.append(number[i])
                named.append(i)
                base.append(shown)
                held.append(block)
                rest.append(whole)
                size += len(block[0])
                shown = (None,) * 6
                if size > LINKS:
                    yield out()
                    for x in (row, named, base, held, rest):
                        x.clear()
                    size = 0
        if row:
            yield out()

    return rows.mapInArrow(run, schema)


def pair_counts(stored: DataFrame) -> DataFrame:
    """(a, b, n, best): in how many texts two ids are linked, and whether no other id is linked with ``a`` in more."""
    pairs = stored.select("row", "whole", F.explode(F.arrays_zip("a", "b")).alias("x")).select("row", "whole", "x.a", "x.b")
    split = pairs.where("not whole").select("row", "a", "b").distinct()
    counts = pairs.where("whole").select("a", "b").unionAll(split.select("a", "b")).groupBy("a", "b").agg(F.count("*").alias("n"))
    counts = stage(counts, "pair-counts")
    # one row for each id of a vocabulary
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_of_head(counts: DataFrame, head: int) -> int:
    """The smallest count such that at most ``head`` pairs have it or more; counts are gathered in steps of an eighth of a doubling."""
    step = F.floor(F.log2("n") * 8)
    seen = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    total, least = 0, 1 << 62
    for r in sorted(seen, key=lambda r: -r["step"]):
        total += r["pairs"]
        if total > head:
            break
        least = r["least"]
    return least


def align(
    docs: DataFrame, first: str, second: str, *, key: str = "doc_id", text: str = "text", head: int = HEAD
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``n_best``: links whose count is the highest of their first id; ``count_sum``: the sum of the counts of all links.
    """
    stored = stage(aligned(docs, first, second, key=key, text=text), "alignments")
    counts = stage(pair_counts(stored), "linked-ids")
    top = counts.where(F.col("n") >= _least_of_head(counts, head)).toArrow()  # at most ``head`` rows
    keys = top["a"].to_numpy().astype(np.int64) * _ID + top["b"].to_numpy()
    order = np.argsort(keys)
    sent = docs.sparkSession.sparkContext.broadcast((
        np.append(keys[order], 1 << 62), np.append(top["n"].to_numpy()[order], 0), np.append(top["best"].to_numpy()[order], False).astype(np.int64),
    ))
    kept = ["row", "key", *_BASE, "groups_sha256"]
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        *(stored.schema[c] for c in kept), *(T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")),
        *(T.StructField(c, longs) for c in ("pairs", "times")),
    ])

    def run(batches):
        keys, counted, best = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                lists = part.column("a")
                ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
                a, b, times = (part.column(c).flatten().to_numpy() for c in ("a", "b", "times"))
                pairs = a.astype(np.int64) * _ID + b
                at = np.searchsorted(keys, pairs)
                there = keys[at] == pairs
                sums = []
                for value in (best, counted):
                    run_up = np.append(0, np.cumsum(np.where(there, value[at] * times, 0)))
                    sums.append(pa.array(run_up[ends[1:]] - run_up[ends[:-1]]))
                left = np.append(0, np.cumsum(~there))[ends]
                other = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(x[~there])) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *sums, *other], names=schema.names)

    parts = stage(stored.mapInArrow(run, schema), "counted-links")
    other = parts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    pair = F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")
    rare = other.join(counts.select(pair.alias("pairs"), "n", "best"), "pairs").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    )
    nothing = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in kept[1:]]
    both = parts.select(*kept, "n_best", "count_sum").unionByName(rare.select("row", *nothing, "n_best", "count_sum"))
    # one row of a text has its numbers
    return both.groupBy("row").agg(
        F.max("key").alias(key), *(F.max(c).alias(c) for c in _BASE), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"),
        F.max("groups_sha256").alias("groups_sha256"),
    ).drop("row")
