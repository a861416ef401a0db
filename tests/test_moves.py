"""Jobs over orders and events move their rows no more often than they must."""

import json

from pyspark.sql import functions as F

from shopmill.operators import aggregates as A
from shopmill.operators.scale import hot_keys
from shopmill.plans.star import star_schema
from shopmill.sources.landing import read_or_empty
from shopmill.sources.sinks import event_text
from shopmill.sources.tpch import TABLES, Shop
from shopmill.streaming import ingest as I


def _shop(spark, tmp_path):
    """Order 1 once, 2 twice, 3 without lines, one without an id; lines of 1 out of order, of an unknown order, without an id."""
    day = "timestamp_ntz '1995-01-02 00:00:00'"
    orders = [(1, 7, "O", 10.0, "1-URGENT"), (2, 8, "F", 5.5, "5-LOW"), (2, 9, "O", 6.5, "5-LOW"), (3, 7, "P", 1.0, "2-HIGH")]
    orders.append((None, 5, "O", 2.0, "5-LOW"))
    frame = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    frame = frame.withColumn("o_orderdate", F.expr(day))
    frame.select(*[c.split()[0] for c in TABLES["orders"].split(", ")]).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 20, 2, 2, 3.0, 2.5), (1, 10, 1, 1, 2.0, 1.25), (2, 30, 1, 1, 1.0, 4.0), (99, 30, 1, 1, 1.0, 4.0), (None, 30, 1, 1, 1.0, 4.0)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    frame = spark.createDataFrame(lines, names).withColumns(
        {"l_discount": F.lit(0.1), "l_tax": F.lit(0.0), "l_returnflag": F.lit("N"), "l_linestatus": F.lit("O"), "l_shipdate": F.expr(day)}
    )
    frame.select(*[c.split()[0] for c in TABLES["lineitem"].split(", ")]).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in set(TABLES) - {"orders", "lineitem"}:
        spark.createDataFrame([], TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return Shop(spark, str(tmp_path))


def test_orders_and_lines_meet_in_one_shuffle(spark, tmp_path):
    nested = _shop(spark, tmp_path).events["nested"]
    assert nested._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    found = [json.loads(r[0]) for r in nested.select(event_text()).collect()]
    by_id = {i: [e for e in found if e["order"].get("OrderID") == i] for i in (1, 2, 3, None)}
    # a header, a payment and a summary of two rows each, and a shipment of the one that is shipped
    assert {i: len(events) for i, events in by_id.items()} == {1: 1, 2: 8, 3: 1, None: 1} and len(found) == 11
    one = by_id[1][0]
    assert [(d["OrderDetailID"], d["ProductID"], d["Quantity"], d["UnitPrice"]) for d in one["order_details"]] == [
        (10**11 + 1, 10, 2, 1.25), (2 * 10**11 + 1, 20, 3, 2.5),
    ]
    # 2 * 1.25 and 3 * 2.50, each less a tenth
    assert one["summary"] == {
        "subtotal": 9.0, "discount": 1.0, "tax_rate": 0.14, "tax_amount": 1.26, "shipping_cost": 50.0, "total_amount": 61.26,
    }
    assert one["shipment"]["ShipDate"] == "1995-01-03" and one["payment"]["PaymentMethod"] == " 1-urgent"
    assert {e["order"]["CustomerID"] for e in by_id[2]} == {8, 9}
    assert by_id[3][0]["order_details"] == [] and by_id[3][0]["summary"]["subtotal"] == 0
    assert [by_id[None][0][k] for k in ("payment", "shipment", "summary", "order_details")] == [None, None, None, []]


def test_marked_events_know_the_rows_of_their_order(spark, tmp_path):
    rows = _shop(spark, tmp_path).events["marked"].collect()
    assert sorted((r["orderid"], sorted(tuple(w) for w in r["who"])) for r in rows) == [
        (1, [("O", "1-URGENT")]), *[(2, [("F", "5-LOW"), ("O", "5-LOW")])] * 8, (3, [("P", "2-HIGH")]),
    ]


def test_nothing_moves_to_compare_with_an_empty_store(spark, tmp_path):
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "digest string, n int")
    fresh = I._new_only(batch, read_or_empty(spark, f"{tmp_path}/none", "digest string"), "digest")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and fresh.count() == 3


def test_product_mart_with_hot_products(spark):
    rows = [(p, o, q, 1.5) for o in range(300) for p, q in ((1, 2), (o % 7 + 2, None if o % 50 == 0 else 1), (1, 1))]
    rows += [(None, 5, 1, 2.5), (3, None, 1, None)]
    lines = spark.createDataFrame(rows, "product_id long, order_id long, quantity int, price double").select(
        "product_id",
        "order_id",
        "quantity",
        F.col("price").cast("decimal(12,2)").alias("unit_price"),
        *[(F.col("price") * n).cast("decimal(14,2)").alias(c) for n, c in enumerate(A._AMOUNTS, 2)],
    )
    plain = A.product_mart(lines)
    dealt = A.product_mart(lines, hot_keys(lines, "product_id"))
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, dealt.collect()), key=repr)
    assert dealt.columns == plain.columns


def test_written_lookups_stand_in_for_those_of_the_star(spark):
    methods = spark.createDataFrame([(1, "CARD")], "payment_method_id int, payment_method string")
    star = star_schema({}, lookups={"dim_payment_method": methods})
    assert star["dim_payment_method"] is methods and "dim_payment_method" in list(star)
