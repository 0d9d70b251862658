"""Class-based bigram model of a corpus: Brown classes from exchange clustering.

Every word has one class, and P(w | v) = P(class(w) | class(v)) * P(w | class(w)). Every training word is clustered by its own contexts.

The ``head`` most frequent words have numbers, by rank. Training texts are stored once as streams of numbers, where the end of a text has a
number too and a word beyond the head that of its ending and length (``TAILS`` groups). A round counts in one pass over the streams how often
each number stands before and after each class, in tables that are summed by ranges of numbers, and then moves each number to the class under
which its counts are likeliest, up to ``STEPS`` times or until none moves. At first the ``units`` most frequent words are dealt to the classes by
rank and all other numbers by ending. There are at most ``rounds`` rounds; each table gives the likelihood of the classes it was counted with, and
a round that does not raise it is undone and is the last (``Model.likelihoods``). A word beyond the head then gets the class under which
its own contexts are likeliest; those words are a table of any size. What the driver holds is bounded by ``head``, ``TAILS`` and the classes.

Counts of words, words of a class and class pairs cover all training texts; where two words beyond the head stand side by side, the second is
counted under the class of its ending. P(class | class) is interpolated with the share
of the class, P(word | class) has add-alpha smoothing with one part for words never seen. The end of a text is a token of a class of its own,
which is also what stands before the first word.

Scoring reads each text once. The ``head`` most frequent words are broadcast with counts and classes (a size bounded by parameters); count
and class of a text's other words come from a join with the table of all words, and the sum of a text is put together by its row number.
A word never seen has the class that most training words of its ending and length have (``TAILS`` groups).

Cases: a null text is empty: it has the end token alone. Rows without a key are scored but not learned from. Repeated rows are
scored one by one. If there is nothing to learn from, all counts are 0. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sinks.stage import stage

UNITS, TAILS, CLASSES, ROUNDS, STEPS = 16_000, 1_024, 32, 3, 5
HEAD = 200_000
ALPHA, BETA = 0.5, 4.0
_FLUSH, _CHUNK, _MOST = 400_000, 4_096, 1 << 30


def tokens_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z), as bytes: case and white space of ASCII only."""
    return (text or "").encode().lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of one text column."""

    def run(batches):
        tally: Counter[bytes] = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(tally), pa.binary()).cast(pa.string()), pa.array(list(tally.values()), pa.int64())], names=["word", "c"]
            )

        for batch in batches:
            for t in batch.column(0):
                tally.update(tokens_of(t.as_py()))
                if len(tally) > _FLUSH:
                    yield out()
                    tally.clear()
        yield out()

    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def tail(word: bytes) -> int:
    """Number of the group of a word's ending and length."""
    number = 0
    for b in word[-2:]:
        number = number * 131 + b
    return (number * 31 + min(len(word), 12)) % TAILS


class Units:
    """Class of a word: broadcast for the most frequent, from the table for others, by ending for words never seen."""

    def __init__(self, known: dict[bytes, int], tails: np.ndarray, table: DataFrame) -> None:
        self.known, self.tails, self.table = known, tails, table
        self.met: dict[bytes, int] = {}

    def __call__(self, word: bytes) -> int:
        if word in self.known:
            return self.known[word]
        if word not in self.met:
            row = self.table.where(F.col("word") == word.decode()).select("g").first()
            self.met[word] = int(self.tails[tail(word)]) if row is None else row[0]
        return self.met[word]


class _Numbers(dict):
    """Number of a word: its rank, or beyond the head that of its ending and length."""

    def __missing__(self, word: bytes) -> int:
        return len(self) + 1 + tail(word)


def pack(values: np.ndarray, kind: str) -> bytes:
    """Whole numbers as compressed bytes, all lowest bytes first, then all second ones and so on."""
    return pa.compress(np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T), "zstd", asbytes=True)


def unpack(data: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data, n * width, "zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).ravel()


def streams(texts: DataFrame, ranked: list[bytes]) -> DataFrame:
    """(n, ids, rare): numbers of the words of some texts with the end before, between and after them; the words beyond the head in order."""
    sent = texts.sparkSession.sparkContext.broadcast(ranked)

    def run(batches):
        numbers = _Numbers(zip(sent.value, range(len(sent.value)), strict=True))
        end = len(numbers)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                parts, rare = [np.array([end])], []
                for t in batch.column(0).slice(start, 256):
                    words = tokens_of(t.as_py())
                    ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
                    rare += [words[i] for i in np.flatnonzero(ids > end)]
                    parts += [ids, parts[0]]
                ids = np.concatenate(parts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(ids)], pa.int64()), pa.array([pack(ids, "<i4")], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(rare)], pa.int32()), pa.array(rare, pa.binary()).cast(pa.string())),
                ], names=["n", "ids", "rare"])

    return stage(texts.mapInArrow(run, "n long, ids binary, rare array<string>"), "streams")


def _pieces(batches):
    """(ids, rare) of each stored stream."""
    for batch in batches:
        for n, data, rare in zip(*batch.columns, strict=True):
            yield unpack(data.as_py(), n.as_py(), "<i4").astype(np.int64), rare


def context_table(texts: DataFrame, classes: np.ndarray, size: int) -> np.ndarray:
    """Each number's counts by side and class of its neighbours: columns of what follows it, then of what precedes it."""
    width, units = 2 * (size + 1), len(classes)
    sent = texts.sparkSession.sparkContext.broadcast(classes)
    schema = "chunk int, n long, at binary, counts binary"

    def out(chunk: int, table: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(table)
        values = (chunk, len(at), pack(np.diff(at, prepend=0), "<i4"), pack(table[at], "<i8"))
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["chunk", "n", "at", "counts"])

    def parts_of(table: np.ndarray):
        for chunk in range(0, units, _CHUNK):
            part = table[chunk * width : (chunk + _CHUNK) * width]
            if part.any():
                yield out(chunk, part)

    def count(batches):
        of, one = sent.value, np.int32(1)
        table, seen = np.zeros(units * width, dtype=np.int32), 0
        for ids, _ in _pieces(batches):
            own, after = ids[:-1], ids[1:]
            seen += len(ids)
            if seen > _MOST:  # before a cell can overflow
                yield from parts_of(table)
                table[:], seen = 0, len(ids)
            np.add.at(table, own * width + of[after], one)
            np.add.at(table, after * width + (size + 1 + of[own]), one)
        yield from parts_of(table)

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, n, at, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                table = sums.setdefault(chunk, np.zeros(_CHUNK * width, dtype=np.int64))
                table[np.cumsum(unpack(at, n, "<i4"))] += unpack(counts, n, "<i8")
        for chunk, table in sums.items():
            yield out(chunk, table)

    parts = texts.mapInArrow(count, schema).repartition("chunk").mapInArrow(merge, schema)
    whole = np.zeros((units + _CHUNK) * width, dtype=np.int64)
    for r in parts.toArrow().to_pylist():  # one row for each range of numbers
        whole[r["chunk"] * width + np.cumsum(unpack(r["at"], r["n"], "<i4"))] = unpack(r["counts"], r["n"], "<i8")
    return whole[: units * width].reshape(units, width)


def _by_class(rows: np.ndarray, classes: np.ndarray, size: int) -> np.ndarray:
    return np.array([rows[classes == g].sum(0) for g in range(size + 1)])


def _logs(table: np.ndarray, size: int) -> np.ndarray:
    """Log probabilities of a word's following and preceding classes, by its class."""
    after, before = table[:, : size + 1], table[:, size + 1 :]
    share = (after.sum(0) + 1) / (after.sum() + size + 1)
    mass = (after.sum(1) + 1)[:size, None]
    return np.log(np.hstack([(after[:size] + share) / mass, (before[:size] + share) / mass]))


def likelihood(table: np.ndarray, size: int) -> float:
    """Log likelihood of the class pairs of a table of contexts by class, less what does not depend on the classes."""
    pairs = table[:, : size + 1].astype(np.float64)

    def total(n: np.ndarray) -> float:
        return float((n[n > 0] * np.log(n[n > 0])).sum())

    return total(pairs) - total(pairs.sum(0)) - total(pairs.sum(1))


def moves(rows: np.ndarray, classes: np.ndarray, size: int, steps: int = STEPS) -> np.ndarray:
    """Classes after up to ``steps`` moves of every number to the class that makes its contexts likeliest; the end keeps its own."""
    for _ in range(steps):
        logs = _logs(_by_class(rows, classes, size), size).T
        best = np.concatenate([np.zeros(0, dtype=np.int64), *((rows[i : i + _CHUNK] @ logs).argmax(1) for i in range(0, len(rows), _CHUNK))])
        now = np.where((classes == size) | ~rows.any(1), classes, best)
        if (now == classes).all():
            break
        classes = now
    return classes


def exchange(
    texts: DataFrame, classes: np.ndarray, size: int, rounds: int, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """The classes after the rounds that raised the likelihood, their table of contexts, and the likelihood at first and after each round kept."""
    rows = context_table(texts, classes, size)
    known = [likelihood(_by_class(rows, classes, size), size)]
    for _ in range(rounds):
        now = moves(rows, classes, size, steps)
        if (now == classes).all():
            break
        found = context_table(texts, now, size)
        reached = likelihood(_by_class(found, now, size), size)
        if reached <= known[-1]:
            break
        classes, rows = now, found
        known.append(reached)
    return classes, rows, known


def _rare_words(texts: DataFrame, classes: np.ndarray, size: int, end: int, logs: np.ndarray) -> DataFrame:
    """(word, c, g, codes, counts) of the words beyond the head: class, and how often they stand between which two neighbours.

    A neighbour is its class, plus ``size`` + 1 if it is beyond the head itself. The frequency of such a word is at most a share of
    one in ``head`` of all words, so that its rows are no hot spot.
    """
    sides = 2 * (size + 1)
    sent = texts.sparkSession.sparkContext.broadcast(np.where(np.arange(len(classes)) > end, classes + size + 1, classes))

    def places(batches):
        for ids, rare in _pieces(batches):
            at = np.flatnonzero(ids > end)
            codes = sent.value[ids[at - 1]] * sides + sent.value[ids[at + 1]]
            yield pa.RecordBatch.from_arrays([rare.values, pa.array(codes, pa.int32())], names=["word", "code"])

    def assign(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                codes, counts = part.column(1), part.column(2)
                rows = np.zeros((part.num_rows, sides))
                row = np.repeat(np.arange(part.num_rows), codes.value_lengths().to_numpy())
                before, after = divmod(codes.flatten().to_numpy(), sides)
                n = counts.flatten().to_numpy()
                np.add.at(rows, (row, after % (size + 1)), n)
                np.add.at(rows, (row, size + 1 + before % (size + 1)), n)
                c = np.bincount(row, weights=n, minlength=part.num_rows).astype(np.int64)
                g = (rows @ logs.T).argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(c), pa.array(g, pa.int32()), codes, counts], names=["word", "c", "g", "codes", "counts"]
                )

    # the rows of a word come together once and are counted there, by its neighbours and then as a whole
    found = texts.mapInArrow(places, "word string, code int").repartition("word").groupBy("word", "code").agg(F.count("*").alias("n"))
    found = found.groupBy("word").agg(F.collect_list(F.struct("code", "n")).alias("x"))  # at most sides * sides entries
    found = found.select("word", F.col("x.code").alias("codes"), F.col("x.n").alias("counts"))
    return stage(found.mapInArrow(assign, "word string, c long, g int, codes array<int>, counts array<long>"), "rare-words")


def _rare_sums(rare: DataFrame, classes: np.ndarray, size: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the classes of the words beyond the head change in the class pairs, their words by ending and class, their tokens by class."""
    side, sides = size + 1, 2 * (size + 1)
    sent = rare.sparkSession.sparkContext.broadcast(classes[end + 1 :])
    cells = side * side + TAILS * size + size

    def run(batches):
        pairs, types, mass = np.zeros((side, side), dtype=np.int64), np.zeros((TAILS, size), dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch in batches:
            ending = np.fromiter((tail(w.encode()) for w in batch.column(0).to_pylist()), dtype=np.int64, count=batch.num_rows)
            c, g, codes = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3)
            np.add.at(types, (ending, g), 1)
            np.add.at(mass, g, c)
            row = np.repeat(np.arange(batch.num_rows), codes.value_lengths().to_numpy())
            before, after = divmod(codes.flatten().to_numpy(), sides)
            n, old, new = batch.column(4).flatten().to_numpy(), sent.value[ending][row], g[row]
            np.subtract.at(pairs, (old, after % side), n)
            np.add.at(pairs, (new, after % side), n)
            head = before < side  # a pair of two words beyond the head is the first one's
            np.subtract.at(pairs, (before[head], old[head]), n[head])
            np.add.at(pairs, (before[head], new[head]), n[head])
        found = np.concatenate([pairs.ravel(), types.ravel(), mass])
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at], pa.int64())], names=["cell", "n"])

    # a fixed number of cells, whatever the number of words
    summed = rare.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(cells, dtype=np.int64)
    out[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    pairs, types, mass = np.split(out, [side * side, side * side + TAILS * size])
    return pairs.reshape(side, side), types.reshape(TAILS, size), mass


@dataclass
class Model:
    units: Units
    classes: np.ndarray
    size: int
    total: int  # N, with the ends
    distinct: int  # V, with the end
    ends: int  # training texts
    mass: np.ndarray  # tokens of each class
    types: np.ndarray  # distinct words of each class
    log_class: np.ndarray  # log10 P(next class | class)
    words: DataFrame  # (word, c, g)
    rare: DataFrame  # those beyond the head
    head: dict[bytes, int]
    likelihoods: list[float]


def train(texts: DataFrame, *, units: int = UNITS, head: int = HEAD, size: int = CLASSES, rounds: int = ROUNDS) -> Model:
    """The model of the one text column of ``texts``."""
    spark = texts.sparkSession
    words = stage(word_counts(texts), "word-counts")
    top = words.orderBy(F.col("c").desc(), "word").limit(head).toArrow()
    ranked = [w.encode() for w in top["word"].to_pylist()]
    counts, end = top["c"].to_numpy(), len(ranked)
    numbered = streams(texts, ranked)
    endings = np.array([tail(w) for w in ranked], dtype=np.int64)
    rank = np.arange(end)
    classes = np.concatenate([np.where(rank < units, rank, endings) % size, [size], np.arange(TAILS) % size])
    classes, rows, known = exchange(numbered, classes, size, rounds)
    table = _by_class(rows, classes, size)
    rare = _rare_words(numbered, classes, size, end, _logs(table, size))
    changed, types, mass = _rare_sums(rare, classes, size, end)
    followers = (table[:, : size + 1] + changed).astype(np.float64)
    prior = (followers.sum(0) + 1) / (followers.sum() + size + 1)
    smooth = (followers + BETA * prior) / (followers.sum(1) + BETA)[:, None]
    distinct = end + int(types.sum())
    of = classes[:end]
    np.add.at(types, (endings, of), 1)
    np.add.at(mass, of, counts)
    tails = np.where(types.any(1), types.argmax(1), types.sum(0).argmax())
    ends = int(followers[size].sum())
    rare = rare.select("word", "c", "g")
    all_words = spark.createDataFrame(
        pa.table({"word": top["word"], "c": top["c"], "g": pa.array(of, pa.int32())}), "word string, c long, g int"
    ).unionByName(rare)
    return Model(
        Units(dict(zip(ranked, of.tolist(), strict=True)), tails, rare), np.arange(size), size, int(mass.sum()) + ends, distinct + (ends > 0),
        ends, mass.astype(np.float64), types.sum(0).astype(np.float64), np.log10(smooth), all_words, rare,
        dict(zip(ranked, counts.tolist(), strict=True)), known,
    )


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    words, whole = model.rare, math.log10(model.total + model.distinct + 1)
    emission = -np.log10(model.mass + ALPHA * (model.types + 1))
    parts = {k: getattr(model, k) for k in ("size", "ends", "log_class", "head")}
    shared = spark.sparkContext.broadcast({**parts, "known": model.units.known, "tails": model.units.tails, "emit": emission})
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(text).alias("t"))
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("word", T.StringType()), T.StructField("at", T.LongType()),
        T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType()), T.StructField("unseen", T.IntegerType()),
        rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("own", T.DoubleType()),
    ])

    def run(batches):
        p = shared.value
        size, head, known, tails = p["size"], p["head"], p["known"], p["tails"]
        log_class, emit = p["log_class"], np.append(p["emit"], 0.0)
        ranks = {w: i for i, w in enumerate(head)}
        counts = np.fromiter(head.values(), dtype=np.float64, count=len(head))
        log_base, log_own = np.log10(counts + 1), np.log10(counts + ALPHA)
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                out = {n: [] for n in schema.names}
                for row, doc, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    words = tokens_of(t.as_py())
                    c = np.full(len(words) + 2, size)
                    c[1:-1] = [known.get(w, -1) for w in words]  # -1: the table of all words tells
                    tally = Counter(words)
                    r = np.array([ranks.get(w, -1) for w in tally], dtype=np.int64)
                    m = np.fromiter(tally.values(), dtype=np.float64, count=len(tally))
                    r, m = r[r >= 0], m[r >= 0]
                    rare = np.flatnonzero(c == -1)
                    both = (c[:-1] >= 0) & (c[1:] >= 0)
                    n, rest = len(words) + 1, [None] * len(rare)
                    own = log_class[c[:-1][both], c[1:][both]].sum() + emit[c[c >= 0]].sum() + m @ log_own[r]
                    base = math.log10(p["ends"] + 1) + m @ log_base[r] - n * whole
                    for name, value in (
                        ("doc_id", doc), ("n_tokens", n), ("n_known", int(m.sum()) + (p["ends"] > 0)),
                        ("base", float(base)), ("own", float(own)),
                    ):
                        out[name] += [*rest, value]
                    out["row"] += [row] * (len(rare) + 1)
                    # no word has a space in it: the text's own row meets no word and lies where its number puts it
                    out["word"] += [*(words[i - 1] for i in rare), b" %d" % row]
                    out["at"] += [*rare.tolist(), None]
                    out["before"] += [*c[rare - 1].tolist(), None]
                    out["after"] += [*c[rare + 1].tolist(), None]
                    out["unseen"] += [*(int(tails[tail(words[i - 1])]) for i in rare), None]
                columns = [
                    pa.array(out["row"], pa.int64()), pa.array(out["word"], pa.binary()).cast(pa.string()), pa.array(out["at"], pa.int64()),
                    *(pa.array(out[n], pa.int32()) for n in ("before", "after", "unseen")), pa.array(out["doc_id"], batch.column(1).type),
                ]
                columns += [pa.array(out[n], pa.int64()) for n in ("n_tokens", "n_known")]
                columns += [pa.array(out[n], pa.float64()) for n in ("base", "own")]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = rows.mapInArrow(run, schema).join(words, "word", "left")
    width = model.size + 1
    moves, emits = (F.lit([float(x) for x in values]) for values in (model.log_class.ravel(), emission))
    found = found.withColumn("g", F.when(F.col("at").isNotNull(), F.coalesce("g", "unseen")))
    # what stands before is known, or is the rare word one place earlier
    earlier = F.lag("g").over(Window.partitionBy("row").orderBy("at"))
    found = found.withColumn("before", F.when(F.col("before") >= 0, F.col("before")).otherwise(earlier))
    c = F.coalesce("c", F.lit(0))
    rare = F.col("at").isNotNull()
    steps = F.get(moves, F.col("before") * width + F.col("g")) + F.get(emits, F.col("g"))
    steps += F.when(F.col("after") >= 0, F.get(moves, F.col("g") * width + F.col("after"))).otherwise(0.0)

    def more(add: float) -> Column:
        return F.when(rare, F.log10(c + F.lit(add))).otherwise(0.0)

    summed = found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(rare & (c > 0), 1).otherwise(0))).alias("n_known"),
        (F.sum("base") + F.sum(more(1.0))).alias("base_score"), (F.sum("own") + F.sum(more(ALPHA) + F.when(rare, steps).otherwise(0.0))).alias("score"),
    )
    return summed.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
