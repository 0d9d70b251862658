"""Text clean-up: strip chains of the label files and name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


# White space of every script, and the four separator control characters.
_SPACE = r"[\s\x1c-\x1f]+"


def strip_blank(c: Column) -> Column:
    """Remove leading and trailing white space of every kind (blanks, tabs, line ends)."""
    return F.regexp_replace(c, rf"(?U)\A{_SPACE}|{_SPACE}\z", "")


def strip_tabs(c: Column) -> Column:
    """Remove leading and trailing tabs only; blanks stay."""
    return F.btrim(c, F.lit("\t"))


def strip_quotes(c: Column) -> Column:
    """Remove leading and trailing single quotes."""
    return F.btrim(c, F.lit("'"))


def upper_trim(c: Column | str) -> Column:
    """Join form of a place name."""
    return F.upper(F.trim(c))


def normalise_name(name: str) -> str:
    """Column name in lower case with every run of other characters as one ``_``."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")
