from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import rows
from shopmill.functions import measures as M

D = Decimal


def test_clamp_keeps_null_and_type(frame):
    df = frame([(-1,), (0,), (5,), (None,)], "q int")
    got = df.select(M.clamp_negative(F.col("q"), "int").alias("q"))
    assert [r[0] for r in got.collect()] == [0, 0, 5, None]
    assert got.schema["q"].dataType.simpleString() == "int"


def test_amounts_are_rounded_separately(frame):
    df = frame([(1, D("1.00"), D("0.5")), (3, D("0.05"), D("10")), (None, D("1"), D("1"))],
               "q int, p decimal(12,2), d decimal(12,2)")
    got = df.select(
        *[c.alias(n) for n, c in M.rounded_amounts(F.col("q"), F.col("p"), F.col("d")).items()]
    )
    assert [tuple(r) for r in got.collect()] == [
        (D("1.00"), D("0.01"), D("1.00")),  # a half cent on both sides
        (D("0.15"), D("0.02"), D("0.14")),
        (None, None, None),
    ]


LINE = st.tuples(
    st.integers(0, 100),
    st.decimals("0", "99999.99", places=2),
    st.decimals("0", "250", places=2),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(LINE, min_size=50, max_size=200))
def test_cent_arithmetic_equals_decimal_arithmetic(spark, lines):
    df = spark.createDataFrame(lines, "q int, p decimal(12,2), d decimal(12,2)")
    fast = [c.alias(n) for n, c in M.rounded_amounts(F.col("q"), F.col("p"), F.col("d")).items()]
    g = M.gross(F.col("q"), F.col("p"))
    d = M.discount(g, F.col("d"))
    slow = [M.money(g), M.money(d), M.money(M.net(g, d))]
    for r in df.select(*fast, *slow).collect():
        assert tuple(r)[:3] == tuple(r)[3:]


@pytest.mark.parametrize(
    "value, strict, inclusive",
    [
        ("10000.00", "PREMIUM", "VIP"),
        ("10000.01", "VIP", "VIP"),
        ("5000.00", "REGULAR", "PREMIUM"),
        ("1000.00", "LOW_VALUE", "REGULAR"),
        ("999.99", "LOW_VALUE", "LOW_VALUE"),
        (None, "LOW_VALUE", "LOW_VALUE"),
    ],
)
def test_segment_bounds(frame, value, strict, inclusive):
    df = frame([(D(value) if value else None,)], "v decimal(18,2)")
    v = F.col("v")
    got = df.select(M.customer_segment(v, inclusive=False), M.customer_segment(v)).first()
    assert tuple(got) == (strict, inclusive)


def test_order_band_bounds(frame):
    df = frame([(D("1000"),), (D("999.99"),), (D("500"),), (D("499.99"),), (None,)], "v decimal(18,2)")
    got = [r[0] for r in df.select(M.order_band(F.col("v"))).collect()]
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_names_with_a_null_part(frame):
    df = frame([("Ann", None)], "a string, b string")
    got = df.select(M.full_name(F.col("a"), F.col("b")), M.strict_name(F.col("a"), F.col("b")))
    assert tuple(got.first()) == ("Ann", None)


def test_calendar(frame):
    df = frame([(date(2027, 1, 1),), (date(2024, 2, 29),), (None,)], "d date")
    parts = ("year", "week_of_year", "day_of_week")
    got = M.with_date_parts(df, "d", parts).withColumn("k", M.date_key(F.col("d")))
    assert [tuple(r)[1:] for r in got.collect()] == [
        (2027, 53, 6, 20270101),
        (2024, 9, 5, 20240229),
        (None, None, None, None),
    ]


def test_day_span(frame):
    df = frame([(date(2024, 2, 28), date(2024, 3, 1)), (None, date(2024, 1, 1))], "a date, b date")
    assert rows(df.select(M.day_span(F.col("a"), F.col("b")))) == [(2,), (None,)]
