"""SAS and calendar dates as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, StringType

from .casts import number_to_int, text_to_integer

# SAS counts days from 1960-01-01; day offsets of the first and
# last date a DateType may hold (0001-01-01 and 9999-12-31).
SAS_EPOCH = "1960-01-01"
FIRST_DAY = -715509
LAST_DAY = 2936549


def sas_day_number(c: Column | str, dtype: DataType | None = None, policy: str = "lenient") -> Column:
    """The whole number of days a raw SAS date holds, NULL for anything else.

    ``strict`` takes text only when it is an integer literal; ``lenient`` also
    reads ``20573.0``. Numbers are truncated toward zero under both. ``dtype`` is
    the column's type, text when not given.
    """
    if policy not in ("strict", "lenient"):
        raise ValueError(f"unknown policy {policy!r}")
    c = F.col(c) if isinstance(c, str) else c
    if dtype is not None and not isinstance(dtype, StringType):
        return c.try_cast("int")
    return text_to_integer(c) if policy == "strict" else number_to_int(c)


def day_number_to_date(days: Column | str) -> Column:
    """1960-01-01 plus a number of days; NULL outside the years 1 to 9999."""
    days = F.col(days) if isinstance(days, str) else days
    return F.when(
        days.between(FIRST_DAY, LAST_DAY), F.date_add(F.to_date(F.lit(SAS_EPOCH)), days)
    )


def sas_to_date(c: Column | str, dtype: DataType | None = None, policy: str = "lenient") -> Column:
    """Days since 1960-01-01 as a date; NULL for anything that is not a day number."""
    return day_number_to_date(sas_day_number(c, dtype, policy))


def sas_to_timestamp(c: Column | str) -> Column:
    """Days since 1960-01-01 with their fraction of a day, as a timestamp without zone."""
    c = F.col(c) if isinstance(c, str) else c
    seconds = (c.try_cast("double") * F.lit(86400.0)).try_cast("decimal(18,6)")
    start = F.lit(SAS_EPOCH).cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def to_date(c: Column | str) -> Column:
    """Text to date; NULL where the text is no date."""
    return F.try_to_date(c)
