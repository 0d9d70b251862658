"""Joins of the star schema.

No side is broadcast by hint: Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (and re-checks it at run time), and otherwise
sorts both sides and splits skewed partitions. Reports aggregate before they join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from ..functions import number_to_int, upper_trim
from ..sinks.stage import stage
from .prefilter import comparable, key_filter


def join_on_uid(fact: DataFrame, dimension: DataFrame, key: str = "uid", how: str = "inner") -> DataFrame:
    """Fact with a dimension that has the same key, one row each."""
    return fact.join(dimension, key, how)


def lookup(
    df: DataFrame, codes: DataFrame, column: str, label: str, into: str, code: str = "code"
) -> DataFrame:
    """Left join to a code table: adds the label of ``column`` as ``into``."""
    pairs = codes.select(F.col(code).alias("__code"), F.col(label).alias(into))
    return df.join(pairs, F.col(column) == F.col("__code"), "left").drop("__code")


def code_text(df: DataFrame, column: str) -> Column:
    """A numeric code as the text the code tables hold: ``101.0`` and ``101`` both give ``101``."""
    c, dtype = F.col(column), df.schema[column].dataType
    if isinstance(dtype, IntegralType):
        return c.cast("string")
    text = c.cast("string")
    return F.coalesce(number_to_int(text).cast("string"), text)


def enrich_countries(personal: DataFrame, country_code: DataFrame) -> DataFrame:
    """Names of the countries of citizenship and residence."""
    coded = personal.withColumns({
        "__citizen": code_text(personal, "citizen_country"),
        "__residence": code_text(personal, "residence_country"),
    })
    named = lookup(coded, country_code, "__citizen", "country", "citizen_country_name")
    named = lookup(named, country_code, "__residence", "country", "residence_country_name")
    return named.drop("__citizen", "__residence")


def enrich_places(fact: DataFrame, city_code: DataFrame, state_code: DataFrame) -> DataFrame:
    """Names of the port of entry and the state of stay."""
    named = lookup(fact, city_code, "city_code", "city", "city")
    return lookup(named, state_code, "state_code", "state", "state")


def join_places(
    left: DataFrame, right: DataFrame, on: Sequence[str] = ("city", "state"), how: str = "inner"
) -> DataFrame:
    """Join by place names whatever their case or outer blanks; keeps the left spelling.

    The compared form stays in the result as ``<column>_key``.
    """
    keys = {c: f"{c}_key" for c in on}
    left = left.withColumns({k: upper_trim(c) for c, k in keys.items()})
    right = right.withColumns({k: upper_trim(c) for c, k in keys.items()}).drop(*on)
    return left.join(right, list(keys.values()), how)


def orphans(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str],
    normalised: bool = False, prefilter: bool = False,
) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with their row counts.

    Both sides are reduced to distinct keys before they meet, so a hot key is one
    row. A key with a NULL part refers to nothing and is no orphan. ``prefilter`` is for a parent much larger than the
    child's set of keys: rows of the parent that a Bloom filter of these keys rules out are not shuffled. The result is the same.
    """
    form = upper_trim if normalised else F.col
    keys = [f"__k{i}" for i in range(len(columns))]
    held = (
        child.select(*[form(c).alias(k) for c, k in zip(columns, keys)])
        .na.drop(subset=keys)
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(*[form(c).alias(k) for c, k in zip(parent_columns, keys)])
    if prefilter and comparable(held, keys, known, keys):
        held = stage(held, "held-keys")
        referred = key_filter(held, keys)
        known = known if referred is None else referred.passing(known, keys)
    return held.join(known.distinct(), keys, "left_anti").withColumnsRenamed(dict(zip(keys, columns)))


def orphan_rows(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """The rows of ``child`` whose key ``parent`` lacks.

    The lost keys are stored first, so that their size is known: when they are few the
    rows of ``child`` stay where they are.
    """
    lost = stage(orphans(child, parent, columns, parent_columns).drop("n_rows"), "orphans")
    return child.join(lost, list(columns), "left_semi")


def matched_rows(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str], prefilter: bool = False
) -> DataFrame:
    """The rows of ``child`` whose key ``parent`` has.

    ``prefilter`` is for a child of which few rows match: those that a Bloom filter of the parent's keys rules out are
    not shuffled. The result is the same.
    """
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)]).distinct()
    if prefilter and comparable(child, columns, known, columns):
        known = stage(known, "known-keys")
        held = key_filter(known, columns)
        child = child if held is None else held.passing(child, columns)
    return child.join(known, list(columns), "left_semi")


def city_of_port(c: Column | str) -> Column:
    """Join form of the city in a port label: ``SAMPLETOWN, XX`` -> ``SAMPLETOWN``."""
    return upper_trim(F.get(F.split(c, ","), F.lit(0)))


def climate_by_arrival(fact: DataFrame, city_code: DataFrame, climate: DataFrame) -> DataFrame:
    """Arrivals with the usual temperature of their port's city in the month of arrival.

    ``climate`` is what :func:`~starmart.analytics.climatology` gives. Spellings and
    countries that share a city name are averaged by their days, so no arrival is repeated.
    The averages are stored first, so that their size is known: when they are few the
    arrivals are not shuffled.
    """
    ports = city_code.select(F.col("code").alias("city_code"), city_of_port("city").alias("city_key"))
    weighted = F.sum(F.col("avg_temperature") * F.col("n_days")) / F.sum("n_days")
    usual = (
        climate.filter(F.col("n_days") > 0)
        .groupBy(upper_trim("city").alias("city_key"), "month")
        .agg(
            F.when(F.count(F.lit(1)) == 1, F.max("avg_temperature")).otherwise(weighted)
            .alias("usual_temperature")
        )
    )
    usual = stage(usual, "climate")
    return fact.join(ports, "city_code", "left").join(usual, ["city_key", "month"], "left")
