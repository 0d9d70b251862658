"""Scalar functions against plain Python."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from starmart import functions as fn

FEW = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
EPOCH = dt.date(1960, 1, 1)


def day(n):
    try:
        return EPOCH + dt.timedelta(days=int(n))
    except (ValueError, OverflowError, TypeError):
        return None


def column_of(spark, values, dtype, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r.out for r in df.select("i", expression.alias("out")).sort("i").collect()]


texts = st.lists(
    st.one_of(
        st.none(), st.integers(-800_000, 3_000_000).map(str), st.integers(-10**12, 10**12).map(str),
        st.floats(-1e6, 4e6).map(lambda x: f"{x:.3f}"),
        st.sampled_from(["", " ", "abc", "1e3", "20573", " 20573 ", "+5", "-1", "20573.0", "1.", ".5",
                         "NaN", "inf", "0x10", "--1", "1d", "1f", "2936549", "2936550"]),
    ),
    min_size=1, max_size=60,
)


@FEW
@given(texts)
def test_strict_text_dates(spark, values):
    found = column_of(spark, values, "string", fn.sas_to_date("v", policy="strict"))
    assert found == [day(v) for v in values]


@FEW
@given(texts)
def test_lenient_text_dates(spark, values):
    def number(v):
        if v is None or v.strip().lower() in ("nan", "inf"):
            return None
        try:
            return float(v)
        except ValueError:
            return None

    found = column_of(spark, values, "string", fn.sas_to_date("v"))
    assert found == [day(number(v)) for v in values]


@FEW
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True), st.floats(-8e5, 3e6)), min_size=1, max_size=60))
def test_double_dates(spark, values):
    found = column_of(spark, values, "double", fn.sas_to_date("v", DoubleType()))
    assert found == [day(v) for v in values]


def test_fixture_dates(spark):
    values = ["20573", "20573.0", None, "abc", "-1", "2936549", "2936550"]
    lenient = column_of(spark, values, "string", fn.sas_to_date("v"))
    may = dt.date(2016, 4, 29)
    assert lenient == [may, may, None, None, dt.date(1959, 12, 31), dt.date(9999, 12, 31), None]
    strict = column_of(spark, values, "string", fn.sas_to_date("v", policy="strict"))
    assert strict[1] is None and strict[0] == may
    with pytest.raises(ValueError):
        fn.sas_to_date("v", policy="other")


def test_timestamps_keep_the_fraction(spark):
    values = [0.0, 20573.5, -0.25, None]
    found = column_of(spark, values, "double", fn.sas_to_timestamp("v"))
    start = dt.datetime(1960, 1, 1)
    assert found == [None if v is None else start + dt.timedelta(days=v) for v in values]


def test_text_dates(spark):
    found = column_of(
        spark, ["1743-11-01", "2013-13-01", "x", None, "2013-08-01"], "string", fn.to_date("v")
    )
    assert found == [dt.date(1743, 11, 1), None, None, None, dt.date(2013, 8, 1)]


@FEW
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=40))
def test_long_casts_keep_every_digit(spark, values):
    target = LongType()
    plain = column_of(spark, [str(v) for v in values], "string", fn.cast_column("v", StringType(), target))
    pointed = column_of(spark, [f"{v}.0" for v in values], "string", fn.cast_column("v", StringType(), target))
    assert plain == values and pointed == values


def test_casts(spark):
    def cast(values, target, dtype="string", source=StringType()):
        return column_of(spark, values, dtype, fn.cast_column("v", source, target))

    assert cast(["4084316.0", "7", "-3.9", "1e3", "x", "", None, "3000000000", "1d"], IntegerType()) == [
        4084316, 7, -3, 1000, None, None, None, None, None]
    assert cast(["5.6582674633E10", ".5", "99999999999999999999", "a"], LongType()) == [
        56582674633, 0, None, None]
    assert cast(["1.5", "NaN", "x", "-2", None], DoubleType()) == [1.5, None, None, -2.0, None]
    assert cast([1.9, math.nan, 1e20, None], IntegerType(), "double", DoubleType()) == [1, None, None, None]
    failed = column_of(spark, ["1", "x", None], "string",
                       fn.cast_failed("v", StringType(), IntegerType()))
    assert failed == [False, True, False]


@FEW
@given(st.lists(st.text(alphabet=" \t\n\r'aB\x1f\x85\u00a0\u3000", max_size=8), min_size=1, max_size=40))
def test_strips(spark, values):
    c = F.col("v")
    assert column_of(spark, values, "string", fn.strip_blank(c)) == [v.strip() for v in values]
    assert column_of(spark, values, "string", fn.strip_tabs(c)) == [v.strip("\t") for v in values]
    assert column_of(spark, values, "string", fn.strip_quotes(c)) == [v.strip("'") for v in values]
    chain = fn.strip_quotes(fn.strip_blank(fn.strip_tabs(c)))
    assert column_of(spark, values, "string", chain) == [v.strip("\t").strip().strip("'") for v in values]


def test_names():
    assert fn.normalise_name("Number of Veterans") == "number_of_veterans"
    assert fn.normalise_name("Foreign-born") == "foreign_born"
    assert fn.normalise_name("  Median  Age ") == "median_age"
