import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from shopmill.operators import keysets as K

EDGES = [0, 1, -1, 63, 64, 65, -63, -64, -65, 2**31, -(2**31), 2**63 - 1, -(2**63), None]


@pytest.fixture(params=["10MB", "-1"])
def threshold(spark, request):
    """Sets that travel, and sets too large for it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_set_holds_its_keys_and_no_other(frame, threshold):
    draw = random.Random(7)
    parents = [draw.randrange(-300, 300) for _ in range(150)] + EDGES[::2] + EDGES[::2]
    child = [draw.randrange(-400, 400) for _ in range(400)] + EDGES
    keys = K.key_set(frame([(k,) for k in parents], "k long"), "k")
    known = set(parents) - {None}
    got = rows(K.mark_known(frame([(k,) for k in child], "k long"), "k", keys, "hit"))
    assert sorted(got, key=repr) == sorted([(k, k in known) for k in child], key=repr)
    left = rows(K.without_reference(frame([(k, "x") for k in child], "k long, bits string"), "k", keys))
    assert sorted(left, key=repr) == sorted([(k, "x") for k in child if k not in known], key=repr)


def test_a_hot_key_and_several_references(frame, threshold):
    child = frame([(1, 9, Decimal("2.50"))] * 500 + [(2, None, Decimal("1.00")), (None, 3, None)], "a int, b long, m decimal(12,2)")
    sets = {"a": K.key_set(frame([(2,), (2,), (5,)], "k int"), "k"), "b": K.key_set(frame([(9,)], "k long"), "k")}
    assert sorted(rows(K.references(child, sets, "t", "m"))) == [
        ("t.a", 502, 501, Decimal("1250.00")), ("t.b", 502, 2, Decimal("1.00"))
    ]
    assert [r[3] for r in rows(K.references(child, sets, "t"))] == [None, None]


def test_empty_tables(frame):
    none = frame([], "k long")
    keys = K.key_set(none, "k")
    assert keys.count() == 0 and rows(K.references(none, {"k": keys}, "t")) == [("t.k", 0, 0, None)]
    assert rows(K.without_reference(frame([(4,)], "k long"), "k", keys)) == [(4,)]


def test_sets_are_small(spark):
    """Dense keys: one row for 64 of them."""
    assert K.key_set(spark.range(64 * 1000), "id").count() == 1000


def test_other_keys_are_refused(frame):
    with pytest.raises(ValueError):
        K.key_set(frame([("a",)], "k string"), "k")
    with pytest.raises(ValueError):
        K.mark_known(frame([(1.0,)], "k double"), "k", frame([], "k long"), "hit")
