from decimal import Decimal

from pyspark.sql import functions as F

from fixtures import rows
from shopmill.operators import quality as Q

D = Decimal


def test_null_profiles_on_empty_input(frame):
    empty = frame([], "a int, b string")
    assert tuple(Q.null_sums(empty).first()) == (None, None)
    assert tuple(Q.null_counts(empty).first()) == (0, 0)


def test_null_profiles(frame):
    df = frame([(1, None), (None, None)], "a int, b string")
    assert tuple(Q.null_sums(df).first()) == tuple(Q.null_counts(df).first()) == (1, 2)


def test_table_profiles(frame):
    tables = {"t": frame([(1, None)], "a int, b string"), "u": frame([], "c date")}
    assert rows(Q.profile_counts(tables)) == [("t", 1), ("u", 0)]
    assert rows(Q.profile_schema(tables)) == [
        ("t", "a", "int", True), ("t", "b", "string", True), ("u", "c", "date", True)
    ]
    assert rows(Q.profile_columns(tables)) == [
        ("t", "a", "int", 1, 0), ("t", "b", "string", 1, 1), ("u", "c", "date", 0, 0)
    ]


def test_duplicate_keys(frame):
    df = frame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(Q.duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]


def test_email_is_invalid_missing_or_fine(frame):
    df = frame([("a@b.co",), ("o'neil@x.com",), ("a b@x.com",), ("a@b",), (None,)], "e string")
    found = {r["e"] for r in Q.invalid_email(df, "e").collect()}
    assert found == {"a b@x.com", "a@b", "o'neil@x.com"}
    assert rows(Q.missing(df, "e")) == [(None,)]


def test_status_domains(frame):
    df = frame([("PENDING",), ("PROCESSING",), ("CONFIRMED",), (None,)], "s string")
    found = rows(Q.out_of_domain(df, "s", Q.HISTORICAL_STATUSES))
    assert found == [("CONFIRMED",), ("PROCESSING",)]
    assert rows(Q.out_of_domain(df, "s", Q.ALL_STATUSES)) == []


def test_nonpositive(frame):
    df = frame([(D("0"),), (D("-1"),), (D("1"),), (None,)], "p decimal(12,2)")
    assert Q.nonpositive(df, "p").count() == 3


def test_preview_is_ordered(frame):
    assert [r[0] for r in Q.preview(frame([(3,), (1,), (2,)], "k int"), ["k"], 2).collect()] == [1, 2]


def test_fk_report(frame):
    child = frame([(1, D("2.50")), (1, D("1.00")), (9, D("4.00")), (None, D("8.00"))], "k int, a decimal(12,2)")
    parent = frame([(1,), (1,), (2,)], "id int")
    assert tuple(Q.fk_report(child, parent, "k", "id", "a", "c->p").first()) == (
        "c->p", 4, 2, D("12.00")
    )
    empty = Q.fk_report(child.limit(0), parent, "k", "id").first()
    assert (empty["rows"], empty["unmatched"], empty["lost_amount"]) == (0, 0, None)


def test_structure_codes(frame):
    texts = {
        "good": '{"order":{"OrderID":1},"order_details":[],"payment":{},"shipment":null,"summary":{}}',
        "text id": '{"order":{"OrderID":"12"},"order_details":[],"payment":{},"shipment":{},"summary":{}}',
        "no payment": '{"order":{"OrderID":2},"order_details":[],"shipment":null,"summary":{}}',
        "array": "[1]",
        "junk": "{oops",
        "no order": '{"order_details":[]}',
        "order text": '{"order":"x","order_details":[]}',
        "order null": '{"order":null,"order_details":[]}',
        "no id": '{"order":{"X":1},"order_details":[]}',
        "bad id": '{"order":{"OrderID":"abc"},"order_details":[]}',
        "null id": '{"order":{"OrderID":null},"order_details":[]}',
        "no details": '{"order":{"OrderID":3}}',
        "details text": '{"order":{"OrderID":4},"order_details":"none"}',
        "details null": '{"order":{"OrderID":5},"order_details":null}',
    }
    df = frame(list(texts.items()), "name string, value string")
    got = {r["name"]: (r["orderid"], r["errors"], r["warnings"]) for r in Q.judge_events(df).collect()}
    assert got["good"] == (1, [], [])
    assert got["text id"] == (12, [], [])
    assert got["no payment"] == (2, [], ["payment_missing"])
    errors = {k: v[1] for k, v in got.items()}
    assert errors["array"] == errors["junk"] == ["not_an_object"]
    assert errors["no order"] == ["order_missing"]
    assert errors["order text"] == errors["order null"] == ["order_not_an_object"]
    assert errors["no id"] == ["order_id_missing"]
    assert errors["bad id"] == errors["null id"] == ["order_id_not_an_integer"]
    assert errors["no details"] == ["order_details_missing"]
    assert errors["details text"] == errors["details null"] == ["order_details_not_a_list"]
    valid, quarantine, warnings = Q.validate_events(df)
    assert rows(valid.select("name")) == [("good",), ("no payment",), ("text id",)]
    assert quarantine.count() == 11
    assert rows(warnings) == [(2, ["payment_missing"])]


def test_request_rules(frame):
    orders = frame([(1, 5), (2, 0), (3, 600000), (4, 5), (5, 5)], "orderid long, customerid long")
    lines = frame(
        [(1, 10, 1, 1, D("0")), (2, 11, 1, 1, D("0")), (3, 12, 1, 1, D("0")),
         (4, 13, 99, 101, D("101")), (4, 14, 1, 0, D("-1"))],
        "orderid long, orderdetailid long, productid long, quantity int, discount decimal(12,2)",
    )
    products = frame([(1,)], "productid long")
    payments = frame([(1, " credit card "), (2, "Cheque"), (3, "PayPal")], "orderid long, paymentmethod string")
    got = {r[0]: r[1] for r in Q.request_rules(lines, orders, products, payments).collect()}
    assert 1 not in got
    assert got[2] == ["customer_out_of_range", "payment_method_not_allowed"]
    assert got[3] == ["customer_out_of_range"]
    assert got[4] == ["product_unknown", "quantity_out_of_range", "discount_out_of_range"]
    assert got[5] == ["item_count_out_of_range"]


def test_payment_mismatch_with_two_payments(frame):
    from shopmill.operators.joins import payment_mismatch

    summary = frame([(1, D("10.00")), (2, D("5.00"))], "orderid long, order_total_amount decimal(18,2)")
    paid = frame(
        [(7, 1, D("10.00")), (8, 1, D("3.00")), (9, 2, D("5.00")), (10, 3, D("1.00"))],
        "paymentid long, orderid long, amount decimal(12,2)",
    )
    assert rows(payment_mismatch(summary, paid).select("paymentid")) == [(8,)]


def test_rules_stay_in_generated_code(frame):
    df = frame([(1,)], "k int").withColumn("v", F.lit("{}"))
    plan = Q.judge_events(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_a_repeated_key_counts_by_its_last_value(spark):
    text = '{"order": {"OrderID": 1, "OrderID": 7}, "order_details": 3, "order_details": []}'
    raw = spark.createDataFrame([(text,)], "value string")
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys", None)
    row = Q.judge_events(raw).first()
    assert (row["orderid"], row["errors"]) == (7, [])
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys", None) == before
