"""A Bloom filter of keys out of built-in functions, to keep rows that cannot meet out of a shuffle.

A key sets ``BITS`` bits in one 64-bit word that its hash names, so a filter is an array of words: ``bit_or`` merges those of the
tasks before the shuffle, and a test reads one word. A key that was put in always passes; another one passes seldom. Joins
on what passes therefore give the same rows as joins on all.

The array has at most ``WORDS`` words (8 MB) whatever the table, so it can go to every task. Above ``CROWDED`` keys a word it
would let most rows pass: then there is no filter, and the join alone decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, TimestampType

BITS = 4
WORDS = 1 << 20
#: Keys a word: what a filter is made for, and what it may hold at most.
EASY, CROWDED = 4, 12


def comparable(left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str]) -> bool:
    """Whether equal keys of two frames have equal hashes: whole numbers of any width, or texts, days and times of one type."""
    for a, b in zip(left_keys, right_keys, strict=True):
        x, y = left.schema[a].dataType, right.schema[b].dataType
        whole = isinstance(x, IntegralType) and isinstance(y, IntegralType)
        if not whole and (x != y or not isinstance(x, (StringType, DateType, TimestampType))):
            return False
    return True


def _hash(df: DataFrame, keys: Sequence[str]) -> Column:
    whole = {k for k in keys if isinstance(df.schema[k].dataType, IntegralType)}
    return F.xxhash64(*(F.col(k).cast("long") if k in whole else F.col(k) for k in keys))


def _mask(h: Column) -> Column:
    """The bits of a key, from six bits of its hash each; the word is named by the bits above."""
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def _word(h: Column, words: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 6 * BITS), F.lit(words)).cast("int")


@dataclass(frozen=True)
class KeyFilter:
    """The words of a filter, as a column of one row."""

    words: int
    array: DataFrame

    def passing(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows whose key may have been put in: all of those whose key was, and few others. NULL parts count as values."""
        h = _hash(df, keys)
        mask = _mask(h)
        return df.where(F.get(self.array.scalar(), _word(h, self.words)).bitwiseAND(mask) == mask)


def key_filter(df: DataFrame, keys: Sequence[str]) -> KeyFilter | None:
    """A filter of the distinct ``keys`` of ``df``; None when they are too many for one of bounded size. Estimates their number first."""
    h = df.select(_hash(df, keys).alias("h"))
    about = h.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    if about > CROWDED * WORDS:
        return None
    words = 1
    while words < WORDS and words * EASY < about:
        words *= 2
    held = h.groupBy(_word(F.col("h"), words).alias("word")).agg(F.bit_or(_mask(F.col("h"))).alias("bits"))
    every = df.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = every.unionByName(held).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # at most WORDS rows, whatever the table
    row = dense.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("all")).select(F.col("all.bits").alias("words"))
    return KeyFilter(words, row)
