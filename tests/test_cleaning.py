from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from shopmill.functions import cleaning as C


def test_clean_columns(frame):
    df = frame([(1, 2, 3)], "` Order ID` int, `order-date` int, Status int")
    assert C.clean_columns(df).columns == ["order_id", "order_date", "status"]


def test_clean_columns_refuses_a_collision(frame):
    with pytest.raises(ValueError, match="order_id"):
        C.clean_columns(frame([(1, 2)], "`Order ID` int, `order-id` int"))


def test_trim_and_case(frame):
    df = frame([(" A ", " b", 1), (None, "", 2)], "x string, y string, n int")
    assert rows(C.trim_strings(df)) == [("A", "b", 1), (None, "", 2)]
    assert rows(C.trim_strings(df, ["y"])) == [(" A ", "b", 1), (None, "", 2)]
    assert rows(C.normalise_case(df, lower=["x"], upper=["y"])) == [("a", "B", 1), (None, "", 2)]


def test_null_rows(frame):
    df = frame([(1, None), (None, "a"), (None, None)], "k int, v string")
    assert rows(C.require_keys(df, ["k"])) == [(1, None)]
    assert len(rows(C.drop_empty_rows(df))) == 2


def test_dedup_is_a_function_of_its_input(frame):
    data = [(1, "b", 3), (1, "a", 3), (1, "c", 9), (2, None, 1), (None, "z", 0), (None, "y", 0)]
    first = rows(C.dedup(frame(data, "k int, s string, n int"), ["k"], [F.desc("n")]))
    again = rows(C.dedup(frame(data[::-1], "k int, s string, n int"), ["k"], [F.desc("n")]))
    assert first == again == [(1, "c", 9), (2, None, 1), (None, "y", 0)]


def test_dedup_prunes_before_the_shuffle(frame):
    df = C.dedup(frame([(1, 2)], "k int, n int").repartition(3), ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_on_all_columns(frame):
    df = C.dedup(frame([(1, 2), (1, 2), (1, 3)], "a int, b int"), ["a", "b"])
    assert rows(df) == [(1, 2), (1, 3)]


BAD = [("abc",), ("",), ("1e3",), ("9" * 30,), ("12.345",), ("-7",), (None,)]


def test_bad_casts_become_null_and_are_counted(frame):
    df = frame(BAD, "v string")
    assert rows(C.cast_columns(df, {"v": "int"})).count((None,)) == 6
    amounts = [r[0] for r in C.cast_columns(df, {"v": "decimal(12,2)"}).collect()]
    assert amounts == [None, None, Decimal("1000.00"), None, Decimal("12.35"), Decimal("-7.00"), None]
    assert C.reject_counts(df, {"v": "int"}).first()["v"] == 5


def test_strict_cast_raises(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        C.cast_columns(frame(BAD, "v string"), {"v": "int"}, strict=True).collect()


def test_cast_ids_by_suffix_or_list(frame):
    df = frame([("1", "2", "x")], "orderid string, n string, paid string")
    assert rows(C.cast_ids(df)) == [(1, "2", None)]
    assert rows(C.cast_ids(df, ["orderid"])) == [(1, "2", "x")]


def test_parse_dates(frame):
    df = frame([("2024-02-29", "2024-01-01T10:00:00+00:00"), ("2024-02-30", "x")], "d string, t string")
    got = C.parse_dates(df, dates=["d"], timestamps=["t"]).collect()
    assert got[0]["d"] == date(2024, 2, 29) and got[0]["t"].hour == 10
    assert got[1]["d"] is None and got[1]["t"] is None
