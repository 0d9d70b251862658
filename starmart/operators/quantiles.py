"""Exact quantiles of a column of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.stage import stage
from .kept import Bracketing

# Counted values are cut until one task orders no more distinct ones than this.
ORDERED_VALUES = 100_000
_CUTS = 100


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = 10_000, known: Bracketing | None = None
) -> list[float | None]:
    """Linearly interpolated quantiles, exact, of the non-missing values of ``column``.

    The column is scanned twice. A sketch gives a bracket around each quantile; then
    the values inside the brackets are counted one by one and those between them all
    together. These counts prove which bracket holds which rank, so the result never
    rests on the sketch's error bound; a bracket that misses is moved and counted again.
    Only counts reach the driver, and no task orders more than ``ORDERED_VALUES`` values. With ``known``, kept
    from stored profiles of these rows (see :func:`~starmart.operators.bracketing`), the first scan is saved.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    if known is None:
        known = _sketched(values, probabilities, accuracy)
    if not known.n:
        return [None] * len(probabilities)
    bounds, margin = known.bounds, known.margin
    ranks, brackets = {}, {}
    for p in probabilities:
        position = (known.n - 1) * p
        ranks[p] = (math.floor(position), math.ceil(position))
        brackets[p] = (bounds.get(p - margin, known.low), bounds.get(p + margin, known.high))

    found: dict[float, tuple[float, float]] = {}
    while len(found) < len(ranks):
        open_ranks = {p: r for p, r in ranks.items() if p not in found}
        inside = _merged([brackets[p] for p in open_ranks])
        counted = stage(_count_segments(values, inside), "quantile")
        totals = {
            r.segment: r for r in counted.groupBy("segment").agg(
                F.sum("copies").alias("n"), F.count(F.lit(1)).alias("n_values")
            ).collect()  # one row per bracket or gap
        }
        parts, places = [], {}
        for p, (first, last) in open_ranks.items():
            below, hit = _segments_of(totals, first, last)
            if len(hit) > 1 or hit[0] % 2 == 0:
                brackets[p] = _limits(inside, hit, known.low, known.high)
            else:
                part = counted.filter(F.col("segment") == hit[0])
                part, below = _narrow(part, totals[hit[0]].n_values, below, first, last)
                places[p] = (len(parts), below, first, last)
                parts.append(part.withColumn("segment", F.lit(len(parts))))
        if parts:
            found |= _values_at(reduce(DataFrame.unionByName, parts), places)
    out = []
    for p in probabilities:
        lower, upper = found[p]
        out.append(lower + (upper - lower) * ((known.n - 1) * p - ranks[p][0]))
    return out


def _sketched(values: DataFrame, probabilities: Sequence[float], accuracy: int) -> Bracketing:
    margin = 2.0 / accuracy
    sides = {p + side for p in probabilities for side in (-margin, margin)}
    points = sorted(side for side in sides if 0 < side < 1) or [0.5]
    sketch = values.agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.percentile_approx("v", points, accuracy).alias("bounds"),
    ).first()
    return Bracketing(sketch.n, sketch.low, sketch.high, margin, dict(zip(points, sketch.bounds or ())))


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def _count_segments(values: DataFrame, inside: list[tuple[float, float]]) -> DataFrame:
    """(segment, v, copies): odd segments are brackets, by value; even ones the gaps around them."""
    segment: Column = F.lit(2 * len(inside))
    for i, (low, high) in reversed(list(enumerate(inside))):
        segment = F.when(F.col("v") < low, 2 * i).when(F.col("v") <= high, 2 * i + 1).otherwise(segment)
    placed = values.select(segment.alias("segment"), "v")
    kept = F.when(F.col("segment") % 2 == 1, F.col("v"))
    return placed.groupBy("segment", kept.alias("v")).agg(F.count(F.lit(1)).alias("copies"))


def _segments_of(totals: dict, first: int, last: int) -> tuple[int, list[int]]:
    """Rows below, and the segments that hold the ranks ``first`` to ``last``."""
    end, below, hit = 0, 0, []
    for segment in sorted(totals):
        start, end = end, end + totals[segment].n
        if end > first and start <= last:
            below = start if not hit else below
            hit.append(segment)
    return below, hit


def _limits(
    inside: list[tuple[float, float]], hit: list[int], smallest: float, largest: float
) -> tuple[float, float]:
    """A bracket that covers all of the given segments."""
    low, high = hit[0], hit[-1]
    if low % 2:
        start = inside[low // 2][0]
    else:
        start = inside[low // 2 - 1][1] if low else smallest
    if high % 2:
        stop = inside[high // 2][1]
    else:
        stop = inside[high // 2][0] if high // 2 < len(inside) else largest
    return start, stop


def _narrow(copies: DataFrame, n_values: int, below: int, first: int, last: int) -> tuple[DataFrame, int]:
    """Cut ``n_values`` counted values at evenly spaced distinct values until few enough are left.

    Spacing by distinct values shrinks the range even when one value holds most rows.
    """
    while n_values > ORDERED_VALUES:
        points = [i / _CUTS for i in range(1, _CUTS)]
        cuts = sorted(set(copies.agg(F.percentile_approx("v", points, 100 * _CUTS)).first()[0]))
        bucket = F.size(F.filter(F.lit(cuts), lambda cut: cut < F.col("v")))
        totals = {
            r.bucket: r for r in copies.groupBy(bucket.alias("bucket"))
            .agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("n_values")).collect()  # at most _CUTS rows
        }
        start, hit = _segments_of(totals, first - below, last - below)
        below += start
        n_values = sum(r.n_values for b, r in totals.items() if hit[0] <= b <= hit[-1])
        copies = copies.filter(bucket.between(hit[0], hit[-1]))
    return copies, below


def _values_at(
    counted: DataFrame, places: dict[float, tuple[int, int, int, int]]
) -> dict[float, tuple[float, float]]:
    """The values at the first and last rank of each (segment, rows below, first, last)."""
    upto = (
        Window.partitionBy("segment").orderBy("v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ended = counted.withColumn("end", F.sum("copies").over(upto))
    picks = []
    for segment, below, first, last in places.values():
        here = F.col("segment") == segment
        for rank in (first, last):
            picks.append(F.min(F.when(here & (F.col("end") > rank - below), F.col("v"))))
    row = ended.agg(*[c.alias(f"v{i}") for i, c in enumerate(picks)]).first()
    return {p: (row[2 * i], row[2 * i + 1]) for i, p in enumerate(places)}
