import json
from datetime import date
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fixtures import EVENTS, event, write_documents, rows
from shopmill.functions import events as E
from shopmill.operators import quality as Q
from shopmill.sources import files, sinks
from shopmill.sources.tpch import Shop

D = Decimal


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = write_documents(tmp_path_factory.mktemp("events") / "in", EVENTS)
    return files.read_events(spark, folder)


def test_flatten(events):
    orders = {r["orderid"]: r for r in E.event_orders(events).collect()}
    assert orders[2000002]["status"] == "CANCELLED"
    assert orders[2000001]["orderdate"] == date(2026, 9, 22)
    assert orders[2000001]["event_timestamp"].hour == 13
    lines = E.event_lines(events)
    assert lines.count() == 6
    assert dict(lines.dtypes)["unitprice"] == "decimal(12,2)"
    assert rows(lines.filter("orderid = 2000004")) == []
    assert {r["paymentstatus"] for r in E.event_payments(events).collect()} == {"COMPLETED", "FAILED"}
    assert rows(E.event_shipments(events).select("orderid")) == [(2000001,), (2000004,)]
    assert E.event_summary(events).filter("orderid = 2000003").first()["shipping_cost"] == D("0.00")


def test_all_null_shipments_still_type(spark, tmp_path):
    folder = write_documents(tmp_path / "in", [event(1, [(1, 1, 1.0, 0.0)], paid=False)])
    assert E.event_shipments(files.read_events(spark, folder)).count() == 0


def test_missing_and_null_lists(spark, tmp_path):
    gone = event(1, [])
    del gone["order_details"]
    folder = write_documents(tmp_path / "in", [gone, event(2, [], order_details=None)])
    assert E.event_lines(files.read_events(spark, folder)).count() == 0


def test_rules_hold_for_service_events(events):
    assert rows(Q.reconcile_events(events)) == []
    assert rows(Q.status_mismatch(events)) == []
    assert rows(Q.shipment_rules(events)) == []


def test_reconcile_finds_each_fault(spark, tmp_path):
    wrong = [event(i, [(1, 2, 10.0, 10.0)]) for i in range(1, 5)]
    wrong[0]["summary"]["subtotal"] = 18.5
    wrong[1]["summary"]["tax_rate"] = 0.2
    wrong[2]["summary"]["shipping_cost"] = 40.0
    wrong[3]["payment"]["Amount"] = 1.0
    found = Q.reconcile_events(files.read_events(spark, write_documents(tmp_path / "in", wrong)))
    got = rows(found.select("orderid", "field"))
    assert got == [(1, "subtotal"), (2, "tax_rate"), (3, "shipping_cost"), (4, "payment_amount")]


def test_status_and_shipment_faults(spark, tmp_path):
    late = event(1, [], order={**event(1, [])["order"], "OrderDate": "2026-09-20"})
    slow = event(2, [])
    slow["shipment"]["DeliveryDate"] = "2026-10-26"
    lost = event(3, [], shipment=None)
    extra = event(4, [], paid=False, shipment=event(4, [])["shipment"])
    open_ = event(5, [])
    open_["order"]["Status"] = "Pending"
    events = files.read_events(spark, write_documents(tmp_path / "in", [late, slow, lost, extra, open_]))
    assert rows(Q.shipment_rules(events)) == [
        (1, ["ship_date_not_next_day"]),
        (2, ["delivery_not_2_to_5_days"]),
        (3, ["shipment_missing"]),
        (4, ["shipment_unexpected"]),
    ]
    assert rows(Q.status_mismatch(events)) == [(5, "CONFIRMED", "PENDING")]


def _nested(events):
    return E.nest_events(
        E.event_orders(events),
        E.event_lines(events),
        E.event_payments(events),
        E.event_shipments(events),
        E.event_summary(events),
    )


def test_nest_is_the_inverse(events):
    again = _nested(events)
    for flatten in (E.event_lines, E.event_shipments, E.event_summary):
        assert rows(flatten(again)) == rows(flatten(events))
    columns = ["orderid", "customerid", "orderdate", "status", "event_id"]
    assert rows(E.event_orders(again).select(*columns)) == rows(E.event_orders(events).select(*columns))


def test_an_order_is_one_document_at_any_size(spark, tmp_path):
    lines = [(p, 1, 1.0, 0.0) for p in range(12_000)]
    big = files.read_events(spark, write_documents(tmp_path / "in", [event(1, lines), event(2, lines[:3])]))
    nested = _nested(big)
    sizes = rows(nested.selectExpr("order.OrderID id", "size(order_details) n", "metadata.event_type"))
    assert [(i, n) for i, n, _ in sizes] == [(1, 12_000), (2, 3)]
    assert {kind for *_, kind in sizes} == {r["event_type"] for r in E.event_orders(big).collect()}
    assert rows(E.event_lines(nested)) == rows(E.event_lines(big))


def test_double_delivery_is_no_fault(events):
    assert rows(Q.reconcile_events(events.unionAll(events))) == []


def test_text_that_looks_like_a_list_is_none(spark):
    texts = [('{"order":{"OrderID":1},"order_details":"[oops"}',), ('{"order":{"OrderID":1},"order_details":[]}',),
             ('[1]',), ('{"order":{"OrderID":"x"},"order_details":[]}',), ('{"order":"[","order_details":[]}',)]
    judged = Q.judge_events(spark.createDataFrame(texts, "value string"))
    assert [r["errors"] for r in judged.collect()] == [
        ["order_details_not_a_list"], [], ["not_an_object"], ["order_id_not_an_integer"], ["order_not_an_object"]
    ]


def test_judging_looks_at_kinds_only_and_parses_a_text_once(spark):
    """The schema of a whole text is not derived to learn that it is an object; what lies in its parts does not matter."""
    odd = ["{}", "[]", "null", "7", '"x"', '[null, {"a": []}]', '{"OrderID": {"a": [1, "x"]}}']
    texts = [json.dumps({"order": {"OrderID": 4}, "order_details": json.loads(o)}) for o in odd]
    texts += [json.dumps({"order": json.loads(o), "order_details": [[1], {"Quantity": {}}, None]}) for o in odd]
    judged = Q.judge_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    no_list, no_order = ["order_details_not_a_list"], ["order_not_an_object"]
    assert [r["errors"] for r in judged.collect()] == [
        no_list, [], no_list, no_list, no_list, [], no_list,
        ["order_id_missing"], no_order, no_order, no_order, no_order, no_order, ["order_id_not_an_integer"],
    ]
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "schema" not in plan.lower()


def test_pull_of_landed_events_reads_only_later_folders(spark, events, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_events(events, path, ids_per_folder=2)
    pulled = files.read_events_since(spark, path, 2000003, 10, ids_per_folder=2)
    assert rows(pulled.select("order.OrderID")) == [(2000003,), (2000004,)]
    plan = pulled._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_bucket" in plan and ">= 1000001)" in plan


def test_written_events_read_back(spark, events, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_events(events, path)
    back = files.read_events(spark, path, multiline=False)
    assert rows(E.event_lines(back)) == rows(E.event_lines(events))
    assert (tmp_path / "out" / "id_bucket=2").exists()
    text = spark.read.text(path).filter("value LIKE '%2000002%'").first()["value"]
    assert json.loads(text)["shipment"] is None


def test_lines_parse_each_document_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    plan = E.event_lines(files.parse_events(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_written_events_are_compressed(spark, events, tmp_path):
    path = tmp_path / "out"
    sinks.write_events(events, str(path))
    written = [f.name for f in path.glob("id_bucket=*/part-*")]
    assert written and all(name.endswith(".txt.gz") for name in written)
    assert spark.read.text(str(path)).count() == events.count()


def test_lines_of_orders_move_once(spark):
    """Numbering the lines of an order deals them out by order; grouping them by it moves nothing more."""
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    some = [(1, 7, 3, 1, 2.0, 10.5, 0.05), (1, 7, 3, 1, 2.0, 9.5, None), (1, 2, 3, 1, 1.0, 1.0, 0.0), (None, 2, 3, 1, 1.0, 1.0, 0.0)]
    lines = Shop.event_lines(SimpleNamespace(source={"lineitem": spark.createDataFrame(some, columns)}))
    got = lines.orderBy("orderid", "orderdetailid").collect()
    assert [tuple(r)[:4] for r in got] == [
        (None, None, 2, 1), (10**11 + 1, 1, 2, 1), (2 * 10**11 + 1, 1, 7, 2), (3 * 10**11 + 1, 1, 7, 2)
    ]
    assert [None if r["discount"] is None else int(r["discount"]) for r in got] == [0, 0, None, 5]
    grouped = lines.groupBy("orderid").agg(F.collect_list("orderdetailid"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
