"""Marts by delta against a full rebuild after every delivery."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from fixtures import rows

from shopmill.operators import aggregates as A
from shopmill.plans import deltas
from shopmill.plans.star import fact_order_detail

LINES = "orderdetailid long, orderid long, productid long, quantity int, unitprice decimal(12,2), discount decimal(12,2)"
ORDERS = "order_id long, customer_id long, order_date date"


def _delivery(r, ids):
    """A version of each order: (header, lines), some without lines, some with NULLs, one product in most."""
    made = {}
    for i in ids:
        day = date(2024, 1, 1) + timedelta(r.randint(0, 60))
        header = (i, r.choice([1, 2, 3, 4, None]), r.choice([day, day, None]))
        n = r.choice([0, 1, 2, 5])
        lines = [
            (r.randint(1, 10**9), i, r.choice([7, 7, r.randint(1, 9), None]), r.choice([1, 3, None]), r.choice([5, 100, None]), r.choice([0, 5]))
            for _ in range(n)
        ]
        made[i] = header, lines
    return made


def _frames(spark, orders):
    headers = spark.createDataFrame([h for h, _ in orders.values()], ORDERS)
    lines = spark.createDataFrame([x for _, ls in orders.values() for x in ls], "a long, b long, c long, d int, e int, f int")
    typed = lines.selectExpr(
        "a AS orderdetailid", "b AS orderid", "c AS productid", "d AS quantity",
        "CAST(e AS decimal(12,2)) AS unitprice", "CAST(f AS decimal(12,2)) AS discount",
    )
    return fact_order_detail(typed, unique=True), headers


def _same(spark, root, current):
    lines, headers = _frames(spark, current)
    assert rows(deltas.customer_mart(spark, root)) == rows(A.customer_mart(lines, headers))
    assert rows(deltas.product_mart(spark, root)) == rows(A.product_mart(lines))


def test_equal_to_a_rebuild_after_every_delivery(spark, tmp_path):
    r, root, current = random.Random(4), str(tmp_path / "marts"), {}
    for number in range(1, 5):
        sent = _delivery(r, r.sample(range(60), 25))
        current |= sent
        deltas.apply(spark, root, number, *_frames(spark, sent), ids_per_folder=10, buckets=8)
        _same(spark, root, current)
    assert deltas.apply(spark, root, 4, *_frames(spark, _delivery(r, range(60)))) == 0
    _same(spark, root, current)


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_a_delivery_that_died_is_applied_again_and_counts_once(spark, tmp_path, monkeypatch, dies_at):
    """It dies at the writing of the first sums, the second sums, or the orders."""
    r, root = random.Random(dies_at), str(tmp_path / "marts")
    current = _delivery(r, range(30))
    deltas.apply(spark, root, 1, *_frames(spark, current), ids_per_folder=10, buckets=4)
    sent, whole, calls = _delivery(r, range(10, 40)), deltas._overwrite, []

    def dying(*args):
        calls.append(args[1])
        if len(calls) == dies_at:
            raise RuntimeError("lost")
        whole(*args)

    monkeypatch.setattr(deltas, "_overwrite", dying)
    with pytest.raises(RuntimeError):
        deltas.apply(spark, root, 2, *_frames(spark, sent), ids_per_folder=10)
    monkeypatch.setattr(deltas, "_overwrite", whole)
    deltas.apply(spark, root, 2, *_frames(spark, sent), ids_per_folder=10)
    _same(spark, root, current | sent)


def test_untouched_folders_keep_their_files(spark, tmp_path):
    r, root = random.Random(9), str(tmp_path / "marts")
    deltas.apply(spark, root, 1, *_frames(spark, _delivery(r, range(100))), ids_per_folder=10, buckets=64)
    before = {str(f) for f in Path(root).rglob("part-*.parquet")}
    one = {42: ((42, 1, date(2024, 3, 1)), [(1, 42, 7, 1, 5, 0)])}
    deltas.apply(spark, root, 2, *_frames(spark, one), ids_per_folder=10)
    after = {str(f) for f in Path(root).rglob("part-*.parquet")}
    assert {f for f in before - after if "/parts/" in f} and all("id_bucket=4" in f for f in before - after if "/parts/" in f)
    assert len([f for f in before - after if "/days/" in f]) <= 2  # the old and the new customer's folder


def test_many_narrow_ranges_share_folders(spark, tmp_path):
    """1,000 ranges of one order: orders that share a folder are replaced one by one, and its others stay."""
    r, root = random.Random(5), str(tmp_path / "marts")
    current = _delivery(r, range(0, 3000, 3))
    deltas.apply(spark, root, 1, *_frames(spark, current), ids_per_folder=1, buckets=4)
    assert len(list(Path(root, "parts").glob("id_bucket=*"))) < 400
    sent = _delivery(r, [6, 1500, 1503, 2002, 2997, 5000])
    deltas.apply(spark, root, 2, *_frames(spark, sent), ids_per_folder=1)
    _same(spark, root, current | sent)


def test_a_store_with_a_folder_for_each_range_is_refused(spark, tmp_path):
    root = str(tmp_path / "marts")
    spark.createDataFrame([(1, 8)], "delivery long, buckets long").write.parquet(f"{root}/applied")
    with pytest.raises(ValueError, match="anew"):
        deltas.apply(spark, root, 2, *_frames(spark, {}))


def test_an_empty_store_and_an_empty_delivery(spark, tmp_path):
    root = str(tmp_path / "marts")
    assert deltas.customer_mart(spark, root).count() == deltas.product_mart(spark, root).count() == 0
    deltas.apply(spark, root, 1, *_frames(spark, {}))
    assert deltas.customer_mart(spark, root).count() == 0
