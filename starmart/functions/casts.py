"""Casts from raw values to contract types that give NULL instead of failing.

A failing ``try_cast`` costs an exception per value, which for a column of ``4084316.0``
cast to an integer would be every row. So numbers are read as doubles, which take any
notation, or matched with a pattern first where doubles are not exact.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    DataType, DateType, DoubleType, FloatType, IntegerType, LongType, StringType,
)

_INTEGER = r"^\s*[+-]?\d+\s*$"
_WHOLE = r"^\s*[+-]?\d+(\.\d*)?\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def text_to_integer(c: Column, dtype: str = "int") -> Column:
    """Integer literals only; anything else is NULL."""
    return F.when(c.rlike(_INTEGER), c).try_cast(dtype)


def text_to_double(c: Column) -> Column:
    """Plain, point and exponent notation; ``NaN`` and other words are NULL."""
    # A double cast also takes 1d, 1f, 0x1p3, NaN and Infinity. Only text with a letter can be
    # one of these, and whether there is a letter is seen at a third of the pattern's cost.
    no_letter = F.upper(c) == F.lower(c)
    return F.when(no_letter | c.rlike(_NUMBER), c).try_cast("double")


def number_to_int(c: Column) -> Column:
    """Text in any number notation as 32 bits, cut toward zero. Double holds these exactly."""
    return text_to_double(c).try_cast("int")


def number_to_long(c: Column) -> Column:
    """Text in any number notation as 64 bits, cut toward zero, with every digit kept."""
    # Of at most 15 digits a double loses none, at a quarter of the patterns' cost; what it cannot read, or has
    # letters, or blanks or control characters around it, takes the patterns.
    plain = (F.length(c) <= 15) & (c >= "+") & (F.substring(c, -1, 1) >= ".") & (F.upper(c) == F.lower(c))
    short = F.when(plain, c).try_cast("double").try_cast("bigint")
    whole = F.when(c.rlike(_WHOLE), F.substring_index(c, ".", 1))
    other = F.when(whole.isNull() & c.rlike(_NUMBER), c).try_cast("decimal(38,18)")
    return F.coalesce(short, whole.try_cast("bigint"), other.try_cast("bigint"))


def cast_column(c: Column | str, source: DataType, target: DataType) -> Column:
    """``c`` as ``target``. Text such as ``4084316.0`` is read as a whole number."""
    c = F.col(c) if isinstance(c, str) else c
    if source == target:
        return c
    if isinstance(source, StringType):
        if isinstance(target, DateType):
            return F.try_to_date(c)
        if isinstance(target, IntegerType):
            return number_to_int(c)
        if isinstance(target, LongType):
            return number_to_long(c)
        if isinstance(target, (DoubleType, FloatType)):
            return text_to_double(c).cast(target)
    if isinstance(target, StringType):
        return c.cast("string")
    return c.try_cast(target)


def cast_failed(c: Column | str, source: DataType, target: DataType) -> Column:
    """True where a value is present but cannot be held by ``target``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & cast_column(c, source, target).isNull()
