"""Language of a text: words first, then shorter and shorter character n-grams.

A word seen in training is scored by its log frequency in each language. An unseen word falls back to its
character n-grams (word ends marked): the longest length of which any n-gram is known is used, its n-grams' log
frequencies averaged; a word without any known n-gram says nothing. The scores of all words are summed,
priors added, and the language with the highest sum is predicted (ties: the smaller name). The score is its
share among the languages, for a text of at most ``EVIDENCE`` words.

Learned from a sample of the labelled rows, counted in Spark. The bound of about ``rows`` is dealt to the languages: one with fewer rows
than its part is taken whole, the others share what is left, each at least ``LEAST``, so a rare language is learned however
many rows there are. Priors are from all labelled rows. The model keeps, for each language, the
``words`` most frequent words and the ``grams`` most frequent n-grams of each length, so what is broadcast is bounded by
parameters times the number of languages. Prediction reads every text to its end.

Cases: null texts, and texts without a letter, are ``und`` with score 0; so are all texts if nothing was learned. Rows without
text or language, and rows whose key is null, are not learned from. Repeated rows are predicted one by one. Other
columns are handed through, one with the name of the result is replaced.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sinks.stage import stage
from .common import with_column

ROWS = 20_000
LEAST = 500
WORDS = 50_000
GRAMS = 10_000
LONGEST = 4
EVIDENCE = 20
MEMO = 300_000
UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")
_RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word between end marks."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language, in the order of ``langs``."""

    def __init__(self, langs: list[str], docs: list[int], words: list, grams: list, totals: dict) -> None:
        self.langs = langs
        place = {g: i for i, g in enumerate(langs)}
        self.prior = np.log([n / sum(docs) for n in docs]) if docs else np.empty(0)
        self.words: dict[str, int] = {}
        self.grams: list[dict[str, list[float]]] = [{} for _ in range(LONGEST + 1)]
        rows: list[list[float]] = []
        base = [math.log(0.5 / (totals[g, 0] + 1)) for g in langs]
        for lang, word, n in words:
            at = self.words.setdefault(word, len(rows))
            if at == len(rows):
                rows.append(base.copy())
            rows[at][place[lang]] = math.log(n / (totals[lang, 0] + 1))
        self.table = np.array(rows).reshape(len(rows), len(langs))
        for lang, size, gram, n in grams:
            low = [math.log(0.5 / (totals.get((g, size), 0) + 1)) for g in langs]
            self.grams[size].setdefault(gram, low)[place[lang]] = math.log(n / (totals[lang, size] + 1))

    def backed_off(self, word: str) -> list[float] | None:
        """Scores of an unseen word by its longest known n-grams."""
        for n in range(LONGEST, 0, -1):
            get = self.grams[n].get
            known = [x for g in grams_of(word, n) if (x := get(g)) is not None]
            if known:
                return [x / len(known) for x in map(sum, zip(*known, strict=True))]
        return None


class Predictor:
    """A model with the words met so far; at most ``MEMO`` unseen ones are remembered."""

    def __init__(self, model: Model) -> None:
        self.model, self.memo = model, {}

    def __call__(self, text: str | None) -> tuple[str, float]:
        model, memo = self.model, self.memo
        counts = Counter(_LETTERS.findall(text.lower())) if text else {}
        if not counts or not model.langs:
            return UNKNOWN, 0.0
        get = model.words.get
        places = [get(w, -1) for w in counts]
        at, n = np.array(places), np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        seen = at >= 0
        total, words = n[seen] @ model.table[at[seen]], n[seen].sum()
        for w, p in zip(counts, places, strict=True):
            if p >= 0:
                continue
            got = memo.get(w, memo)
            if got is memo:
                if len(memo) >= MEMO:
                    memo.clear()
                got = model.backed_off(w)
                memo[w] = got = None if got is None else np.array(got)
            if got is not None:
                words += counts[w]
                total = total + counts[w] * got
        best = int((total + model.prior).argmax())  # the first of equals, and langs are sorted
        # the score alone is damped: the words of a text are no independent evidence
        sums = total * (min(1.0, EVIDENCE / words) if words else 0.0) + model.prior
        return model.langs[best], float(1 / np.exp(sums - sums[best]).sum())


def _pieces(marked: Column, size: int) -> Column:
    """(size, gram) of every n-gram of one length."""
    last = F.length(marked) - (size - 1)
    each = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct(F.lit(size).alias("size"), F.substring(marked, i, F.lit(size)).alias("gram")),
    )
    return F.when(last >= 1, each).otherwise(F.array().cast("array<struct<size:int,gram:string>>"))


def parts_of(counts: dict[str, int], rows: int, least: int = LEAST) -> dict[str, int]:
    """How many rows of each language are learned from: all of the small ones, equal parts of the rest for the others."""
    out, left = {}, rows
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(n, max(least, left // (len(counts) - i)))
        left = max(0, left - out[lang])
    return out


def _sample(usable: DataFrame, counts: dict[str, int], rows: int) -> DataFrame:
    """About as many rows of each language as its part, picked by a hash of the key; languages within it whole."""
    parts = parts_of(counts, rows)
    if parts == counts:
        return usable
    # one entry a language, as in the model itself
    below = F.create_map(*(F.lit(x) for g, n in parts.items() for x in (g, int((1 << 40) * n / counts[g]))))
    return usable.where(F.pmod(F.xxhash64("k"), F.lit(1 << 40)) < below[F.col("lang")])


def train(
    labelled: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
    rows: int = ROWS, words: int = WORDS, grams: int = GRAMS,
) -> Model:
    """Counts over about ``rows`` labelled rows, dealt to the languages and picked by a hash of the key."""
    usable = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("lang"))
    usable = usable.where("k is not null and t is not null and lang is not null")
    docs = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not docs:
        return Model([], [], [], [], {})
    counted = _sample(usable, docs, rows).select(
        "lang", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}+"), 0)).alias("word")
    ).groupBy("lang", "word").agg(F.count("*").alias("n"))
    counted = stage(counted, "langid-words")
    marked = F.concat(F.lit("<"), "word", F.lit(">"))
    pieces = [_pieces(marked, size) for size in range(1, LONGEST + 1)]
    split = counted.select("lang", "n", F.explode(F.concat(*pieces)).alias("g")).select("lang", "n", "g.size", "g.gram")
    split = split.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    split = stage(split, "langid-grams")
    totals = {(r[0], 0): r[1] for r in counted.groupBy("lang").agg(F.sum("n")).collect()}
    totals |= {(r[0], r[1]): r[2] for r in split.groupBy("lang", "size").agg(F.sum("n")).collect()}
    langs = sorted(g for g in docs if (g, 0) in totals)  # one without any word has nothing to be known by
    top = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    kept = counted.withColumn("r", F.row_number().over(top)).where(F.col("r") <= words)
    top = Window.partitionBy("lang", "size").orderBy(F.col("n").desc(), "gram")
    parts = split.withColumn("r", F.row_number().over(top)).where(F.col("r") <= grams)
    return Model(
        langs, [docs[g] for g in langs], [tuple(r) for r in kept.select("lang", "word", "n").collect()],
        [tuple(r) for r in parts.select("lang", "size", "gram", "n").collect()], totals,
    )


def predict(docs: DataFrame, model: Model, *, text: str = "text", result: str = "language") -> DataFrame:
    """``docs`` with a struct column: lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        one = Predictor(shared.value)
        return lambda texts: [one(t) for t in texts]

    return with_column(docs, result, _RESULT, make, text)
