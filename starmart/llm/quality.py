"""Quality score of a text: a sparse ensemble of rules read off trees.

Statistics of each text are measured over its whole length. A forest of shallow trees is fitted to them on a bounded sample of
labelled rows (``rows``); every path from a root to a node is a rule, a conjunction of comparisons. A lasso
logistic regression weighs the rules, and those it keeps are compiled into one Spark column expression over the statistics.

Labels meet texts by a broadcast of the sampled keys, at most about ``rows`` of them, so no text is shuffled to fit.

Cases: a null or empty text has statistics 0 and gets a score like any other. Labels that are null, of a null key, or of
a key without a text are not learned from; several labels of a key count as the largest. If the sample holds
one label only, or none, every score is the share of label 1 in it (0.5 without labels). Repeated rows are scored one by one.
Other columns are handed through; one with the name of the result is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sinks.stage import stage
from .common import at_most, with_column

ROWS = 20_000
TREES, DEPTH, LASSO = 24, 4, 1e-3

STATISTICS = (
    "n_bytes", "n_words", "n_lines", "upper", "digit", "space", "punctuation", "symbol", "bar", "exclamation",
    "word_length", "longest_word", "distinct_words", "top_word", "repeated_word", "loud_words", "marked_words",
    "capital_words", "distinct_lines", "top_line", "line_length", "worst_bar", "worst_loud", "worst_symbol", "worst_repeat",
)
_TYPE = T.StructType([T.StructField(n, T.DoubleType()) for n in STATISTICS])
_SYMBOLS = np.frombuffer(b"#$%&*+<=>@\\^_`{|}~", dtype=np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", dtype=np.uint8)
_NOISE = b"#$%&*"


def statistics(text: str | None) -> tuple[float, ...]:
    """The measures of one text, in the order of ``STATISTICS``; shares lie between 0 and 1."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return (float(len(raw)), *[0.0] * (len(STATISTICS) - 1))
    n, total = len(raw), len(words)
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    tally = Counter(words)
    again = sum(map(bytes.__eq__, words, words[1:]))
    loud = sum(k for w, k in tally.items() if len(w) > 2 and w.isupper())
    marked = sum(k for w, k in tally.items() if w[-1] in _NOISE)
    capital = sum(k for w, k in tally.items() if w[:1].isupper())
    seen: dict[bytes, int] = {}
    worst = [0.0] * 4
    for x in lines:
        seen[x] = seen.get(x, 0) + 1
        if seen[x] > 1:
            continue
        parts = x.split()
        if (m := len(parts)) < 4:
            continue
        here = (
            x.count(b" | ") / m, sum(map(bytes.isupper, parts)) / m, sum(w[-1] in _NOISE for w in parts) / m,
            1 - len(set(parts)) / m if m > 8 else 0.0,
        )
        worst = [max(a, b) for a, b in zip(worst, here, strict=True)]
    return (
        float(n), float(total), float(len(lines)), count[65:91].sum() / n, count[48:58].sum() / n,
        (count[32] + count[9:14].sum()) / n, count[_PUNCTUATION].sum() / n, count[_SYMBOLS].sum() / n, count[124] / n,
        count[33] / n, (n - total) / total, float(max(map(len, tally))), len(tally) / total, max(tally.values()) / total,
        again / total, loud / total, marked / total, capital / total, len(seen) / len(lines),
        max(seen.values()) / len(lines), total / len(lines), *worst,
    )


def measured(docs: DataFrame, text: str = "text", result: str = "statistics") -> DataFrame:
    return with_column(docs, result, _TYPE, lambda: lambda texts: [tuple(map(float, statistics(t))) for t in texts], text)


#: A comparison is (statistic, at most?, threshold); a rule is a set of them.
Comparison = tuple[str, bool, float]


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: tuple[tuple[frozenset[Comparison], float], ...]

    def column(self, stats: Column) -> Column:
        """The score as an expression over the struct of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: frozenset[Comparison], stats: Column) -> Column:
    parts = [stats[n] <= t if low else stats[n] > t for n, low, t in sorted(rule)]
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def _narrowed(path: list[Comparison]) -> frozenset[Comparison]:
    """Of several bounds of one statistic on one side, the tightest."""
    best: dict[tuple[str, bool], float] = {}
    for name, low, t in path:
        old = best.get((name, low))
        best[name, low] = t if old is None else min(old, t) if low else max(old, t)
    return frozenset((n, low, t) for (n, low), t in best.items())


def paths(tree: str) -> set[frozenset[Comparison]]:
    """The rules of a printed tree: one for every node below the root."""
    out, path, deep = set(), [], {}
    for line in tree.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)", line)
        if m:
            del path[deep.setdefault(len(m[1]), len(path)) :]
            deep = {k: v for k, v in deep.items() if k <= len(m[1])}
            path.append((STATISTICS[int(m[2])], m[3] == "<=", float(m[4])))
            out.add(_narrowed(path))
    return out


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    rows: int = ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO,
) -> Ensemble:
    """Rules and weights from at most about ``rows`` labelled keys, picked by a hash of the key."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy(F.col(key).alias("k")).agg(F.max(label).cast("double").alias("label"))
    chosen = stage(at_most(known, rows, "k"), "quality-labels")
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    sample = measured(texts.join(F.broadcast(chosen), "k"), "text", "s").select("label", "s.*")
    sample = stage(sample.withColumn("row", F.monotonically_increasing_id()), "quality-sample")
    # keys can stand in many rows
    sample = at_most(sample, 2 * rows, "row").drop("row").coalesce(8)
    share = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(share) < 2:
        ones = share.get(1.0, 0) / sum(share.values()) if share else 0.5
        bounded = min(max(ones, 1e-6), 1 - 1e-6)
        return Ensemble(float(np.log(bounded / (1 - bounded))), ())
    wide = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(sample).select("label", "x")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=5, seed=7
    ).fit(wide)
    rules = sorted(set().union(*(paths(t.toDebugString) for t in forest.trees)), key=sorted)
    if not rules:
        ones = share[1.0] / sum(share.values())
        return Ensemble(float(np.log(ones / (1 - ones))), ())
    stats = F.struct(*STATISTICS)
    flags = F.array(*(holds(r, F.col("s")).cast("double") for r in rules))
    from pyspark.ml.functions import array_to_vector

    table = sample.select("label", stats.alias("s")).select("label", array_to_vector(flags).alias("x"))
    table = stage(table, "quality-rules").coalesce(8)
    model = LogisticRegression(
        labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False
    ).fit(table)
    weights = model.coefficients.toArray()
    return Ensemble(float(model.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w))


def score(docs: DataFrame, model: Ensemble, *, text: str = "text", result: str = "quality_score") -> DataFrame:
    """``docs`` with the score of each text as a column."""
    rows = measured(docs.drop(result), text, "_statistics")
    return rows.withColumn(result, model.column(F.col("_statistics"))).drop("_statistics")
