from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import EVENTS, write_documents, rows
from shopmill import schemas
from shopmill.operators import aggregates as A
from shopmill.operators import joins as J
from shopmill.operators import quality as Q
from shopmill.operators import windows as W
from shopmill.operators.scale import durable
from shopmill.operators.setops import unify
from shopmill.plans import curated, reports, star
from shopmill.sources import files, sinks

D = Decimal

CSV = {
    "customers": "CustomerID,FirstName,LastName,Email,City,Country,RegistrationDate\n"
    "1001, Ann ,Lee, ANN@X.COM ,Oslo,NO,2020-01-01\n1001, Ann ,Lee, ANN@X.COM ,Oslo,NO,2020-01-01\n"
    "1002,Bob,,bob@x.com,Rome,IT,2021-05-05\n,No,Key,a@b.co,X,Y,2021-01-01\n",
    "categories": "CategoryID,CategoryName\n1,Toys\n2,Books\n",
    "products": "ProductID,CategoryID,ProductName,Brand,Price,Cost,Stock\n"
    "1,1,Ball,B,10.00,5.00,3\n2,1,Ball,C,20.00,9.00,4\n3,2,Atlas,D,bad,1.00,1\n",
    "departments": "DepartmentID,DepartmentName\n1,Sales\n",
    "employees": "EmployeeID,ManagerID,DepartmentID,FirstName,LastName,Salary,HireDate\n"
    "1,,1,Eve,Roe,100.00,2019-01-01\n2,1,1,Max,Moe,90.50,2020-01-01\n",
    "suppliers": "SupplierID,SupplierName,Country\n1,Acme,DE\n",
    "product_suppliers": "ProductID,SupplierID\n1,1\n1,1\n2,1\n",
    "orders": "OrderID,CustomerID,OrderDate,Status\n1,1001,2024-01-15, pending\n"
    "2,1001,2024-01-15,Shipped\n3,1002,2024-03-02,shipped\n2000001,1001,2024-01-01,old\n",
    "order_details": "OrderDetailID,OrderID,ProductID,Quantity,UnitPrice,Discount\n"
    "1,1,1,2,10.00,10\n2,1,2,1,20.00,0\n3,2,1,-5,10.00,0\n4,3,2,3,20.00,5\n5,3,99,1,1.00,0\n",
    "payments": "PaymentID,OrderID,PaymentMethod,PaymentDate,Amount\n1,1,Cash,2024-01-15,38.00\n"
    "2,1, cash ,2024-01-16,2.00\n3,3,Credit Card,2024-03-02,58.00\n",
    "shippers": "ShipperID,CompanyName\n1,Fast\n",
    "shipments": "ShipmentID,OrderID,ShipperID,ShipDate,DeliveryDate\n1,1,1,2024-01-16,2024-01-20\n"
    "2,1,1,2024-01-18,2024-01-20\n3,77,9,2024-01-18,\n",
}


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    for name, text in CSV.items():
        (root / f"{name}.csv").write_text(text)
    raw = {n: files.read_csv(spark, f"{root}/{n}.csv", schemas.text_schema(n)) for n in CSV}
    return curated.clean_history(raw)


@pytest.fixture(scope="module")
def unified(spark, clean, tmp_path_factory):
    folder = write_documents(tmp_path_factory.mktemp("ev") / "in", EVENTS)
    tables = curated.unify_history(clean, files.read_events(spark, folder))
    return {n: durable(tables[n]) for n in tables}


def test_clean_history(clean):
    people = clean["customers"]
    assert rows(people.select("customerid", "email", "full_name")) == [
        (1001, "ann@x.com", "Ann Lee"),
        (1002, "bob@x.com", "Bob"),
    ]
    assert clean["products"].filter("price IS NULL").count() == 1
    assert rows(clean["order_details"].select("orderdetailid", "quantity", "total_amount"))[2] == (
        3, 0, D("0.00")
    )
    assert rows(clean["orders"].select("orderid", "status", "quarter"))[0] == (1, "PENDING", 1)


def test_null_keys_kept_on_request(spark, clean):
    raw = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "productid long, supplierid long")
    assert curated.clean_table("product_suppliers", raw).count() == 1
    assert curated.clean_table("product_suppliers", raw, keep_null_keys=True).count() == 2


def test_unified_tables(unified):
    orders = {r["orderid"]: r["status"] for r in unified["orders"].collect()}
    assert orders[2000001] == "CONFIRMED" and len(orders) == 7
    assert "double" not in dict(unified["order_details"].dtypes).values()
    assert unified["shipments"].count() == 5 and unified["payments"].count() == 7


def test_unify_again_changes_nothing(unified, clean, spark, tmp_path):
    columns = ["orderid", "customerid", "orderdate", "status"]
    once = unified["orders"]
    twice = unify(once, once, ["orderid"], columns)
    assert rows(twice) == rows(once)


def test_unify_prefers_incoming_then_latest(frame):
    old = frame([(1, "a"), (2, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = frame([(2, "c", 1), (2, "d", 9), (3, "e", 1)], "k int, v string, t int")
    want = [(1, "a"), (2, "d"), (3, "e")]
    assert rows(unify(old, new, ["k"], ["k", "v"], [F.desc_nulls_last("t")])) == want
    assert (None, "n") in rows(unify(old, new, ["k"], ["k", "v"], keep_null_keys=True))
    unique = old.filter("v <> 'b'")
    fast = unify(unique, new, ["k"], ["k", "v"], [F.desc_nulls_last("t")], historical_is_unique=True)
    assert rows(fast) == want


def test_unify_refuses_a_type_change(frame):
    with pytest.raises(TypeError, match="v"):
        unify(frame([], "k int, v double"), frame([], "k int, v decimal(12,2)"), ["k"], ["k", "v"])


def test_star_tables(unified):
    tables = star.star_schema(unified)
    assert len(tables) == 17
    for name in tables:
        key = tables[name].columns[0]
        if name != "bridge_product_supplier":
            assert tables[name].groupBy(key).count().filter("count > 1").count() == 0, name
    assert rows(tables["dim_payment_method"]) == [(1, "CASH"), (2, "CREDIT CARD")]
    assert rows(tables["bridge_product_supplier"]) == [(1, 1), (2, 1)]
    days = tables["dim_date"]
    assert days.count() == (date(2026, 9, 22) - date(2024, 1, 15)).days + 1
    one = days.filter("date_id = 20260922").first()
    assert (one["month_name"], one["day_name"], one["day_of_week"], one["week_of_year"]) == (
        "September", "Tuesday", 3, 39
    )
    assert rows(tables["dim_employee"].select("employee_id", "manager_id", "full_name")) == [
        (1, None, "Eve Roe"),
        (2, 1, "Max Moe"),
    ]
    payments = tables["fact_payment"]
    assert payments.filter("payment_method_id = 1").count() == 2


def test_written_star_gives_the_same_reports(spark, unified, tmp_path):
    root = str(tmp_path / "star")
    names = curated.write_star(spark, unified, root)
    built, stored = star.star_schema(unified), star.read_star(spark, root, names)
    sinks.register_views(spark, {n: stored[n] for n in names})
    for name in reports.REPORTS:
        want = rows(reports.report(built, name))
        assert rows(reports.report(spark, name)) == want, name
    sql = spark.sql(
        "SELECT order_status, count(*) AS order_count FROM fact_order "
        "JOIN dim_order_status USING (order_status_id) GROUP BY order_status"
    )
    assert rows(sql) == rows(reports.report(spark, "r07_orders_by_status"))


def test_rewritten_star_keeps_lookup_ids(spark, unified, tmp_path):
    first = {**unified, "orders": unified["orders"].filter("status = 'SHIPPED'")}
    statuses = star.star_schema(first)["dim_order_status"]
    again = star.star_schema(unified, existing={"dim_order_status": statuses})
    ids = {r["order_status"]: r["order_status_id"] for r in again["dim_order_status"].collect()}
    assert ids["SHIPPED"] == 1 and ids["CANCELLED"] == 2
    assert again["fact_order"].filter("order_status_id = 1").count() == 2
    with pytest.raises(ValueError):
        curated.write_star(spark, unified, "/x", previous="/x")


def test_reports_by_hand(unified):
    tables = star.star_schema(unified)
    status = dict(rows(reports.orders_by_status(tables)))
    assert status == {"PENDING": 1, "SHIPPED": 2, "CONFIRMED": 2, "CANCELLED": 1, "PROCESSING": 1}
    categories = reports.sales_by_category(tables).collect()
    assert categories[0]["category_name"] == "Toys"
    names = rows(reports.top_products(tables).select("product_name"))
    assert ("Ball",) in names  # two products of one name are one entry
    assert reports.top_products_by_id(tables).filter("product_name = 'Ball'").count() == 2
    growth = reports.monthly_growth(tables).collect()
    assert [(r["year"], r["month"]) for r in growth] == [(2024, 1), (2024, 3), (2026, 9)]
    assert growth[0]["prev_sales"] is None


def test_completed_payments_only(frame):
    methods = frame([(1, "CASH")], "payment_method_id int, payment_method string")
    raw = frame(
        [(1, 1, "cash", None, D("5.00"), "COMPLETED"), (2, 1, "Cash", None, D("7.00"), "FAILED")],
        "paymentid long, orderid long, paymentmethod string, paymentdate date, "
        "amount decimal(12,2), paymentstatus string",
    )
    tables = {"fact_payment": star.fact_payment(raw, methods), "dim_payment_method": methods}
    assert rows(reports.payments_by_method(tables)) == [("CASH", 2, D("12.00"), 6.0)]
    done = reports.payments_by_method(tables, completed_only=True)
    assert rows(done) == [("CASH", 1, D("5.00"), 5.0)]


def test_lookup_ids_stay_stable(frame):
    first = star.dim_lookup(frame([("b",), ("c",), (None,)], "n string"), "id")
    assert rows(first) == [(1, "b"), (2, "c")]
    grown = star.dim_lookup(frame([("a",), ("b",), ("d",)], "n string"), "id", first)
    assert rows(grown) == [(1, "b"), (2, "c"), (3, "a"), (4, "d")]
    many = star.dim_lookup(frame([(f"n{i:03}",) for i in range(50)], "n string"), "id", few=False)
    assert {r["n"]: r["id"] for r in many.collect()} == {f"n{i:03}": i + 1 for i in range(50)}


def test_too_many_names_for_one_pass_are_refused(frame, monkeypatch):
    monkeypatch.setattr(star, "FEW_NAMES", 2)
    names = frame([("a",), ("b",), ("c",)], "n string")
    with pytest.raises(Exception, match="few=False"):
        star.dim_lookup(names, "id").collect()
    assert rows(star.dim_lookup(names, "id", few=False)) == [(1, "a"), (2, "b"), (3, "c")]


def test_empty_orders_give_no_dates(frame):
    empty = frame([], "orderid long, orderdate date")
    assert star.dim_date(empty).count() == 0
    assert tuple(A.date_bounds(empty).first()) == (None, None)


def test_growth_after_a_zero_month(frame):
    df = frame([(1, D("0.00")), (2, D("10.00")), (3, D("15.00"))], "m int, v decimal(18,2)")
    got = [r["growth_pct"] for r in W.period_growth(df, ["m"], "v").orderBy("m").collect()]
    assert got == [None, None, 50.0]


def test_fan_out_is_kept(clean):
    pairs = J.orders_payments(clean["orders"], clean["payments"])
    assert rows(pairs.filter("orderid = 1").select("paymentid")) == [(1,), (2,)]
    sent = J.orders_shipments(clean["orders"], clean["shipments"], clean["shippers"])
    assert sent.filter("orderid = 1").count() == 2 and sent.filter("orderid = 2").count() == 1


def test_joins_by_hand(clean):
    wide = J.wide_sales(clean["orders"], clean["order_details"], clean["products"])
    assert wide.count() == 4 and len(wide.columns) == len(set(wide.columns))
    full = J.products_suppliers(clean["products"], clean["product_suppliers"], clean["suppliers"])
    assert rows(full.filter("productid = 3").select("suppliername")) == [(None,)]
    assert rows(J.unmatched(clean["shipments"], clean["orders"], "orderid").select("orderid")) == [(77,)]


def test_aggregates_by_hand(clean):
    totals = A.global_totals(clean["orders"], clean["order_details"]).first()
    assert totals["total_sales"] == D("101.00") and totals["total_orders"] == 4
    assert totals["avg_order_value"] == pytest.approx(101 / 3)
    assert rows(A.orders_per_customer(clean["orders"], 2)) == [(1001, 3)]
    first = W.pick_first(clean["orders"], ["customerid"], [F.asc("orderdate"), F.asc("orderid")])
    assert {r["customerid"]: r["orderid"] for r in first.collect()} == {1001: 2000001, 1002: 3}


def test_aggregates_on_no_rows(frame):
    none = frame([], "orderid long, productid long, quantity int, total_amount decimal(14,2)")
    orders = frame([], "orderid long, customerid long, year int, month int")
    assert tuple(A.global_totals(orders, none).first()) == (None, None, None, 0)
    assert A.order_summary(none).count() == 0
    assert A.mean_orders_per_month(orders.limit(0)).count() == 1
    assert A.mean_of(none, "total_amount", "m").first()[0] is None


def test_curated_outputs(spark, clean, tmp_path):
    names = curated.write_curated(spark, clean, str(tmp_path / "out"))
    assert len(names) == 12
    sums = {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in names}
    want = sums["fact_sales"].agg(F.sum("total_amount")).first()[0]
    for mart in ("customer_sales", "product_sales", "category_sales", "monthly_sales"):
        assert sums[mart].agg(F.sum("total_sales")).first()[0] == want


def test_totals_above_10_17_are_exact(spark):
    """Reports and aggregates over amounts whose sums leave 18 digits behind."""
    n, amount = 200_000, D("999999999999.99")
    whole = n * amount
    money = F.lit(amount).cast("decimal(14,2)")
    amounts = {c: money for c in ("unit_price", "gross_amount", "discount_amount", "total_amount")}
    lines = spark.range(n).select(
        F.col("id").alias("order_detail_id"),
        (F.col("id") % 1000).alias("order_id"),
        (F.col("id") % 10).alias("product_id"),
        F.lit(1).alias("quantity"),
        *[a.alias(c) for c, a in amounts.items()],
    )
    orders = spark.range(1000).selectExpr(
        "id AS order_id", "id % 5 AS customer_id", "20240100 + cast(id % 2 * 100 AS int) + 1 AS date_id",
        "date_add(date'2024-01-01', cast(id % 2 * 31 AS int)) AS order_date", "1 AS order_status_id",
    )
    tables = {
        "fact_order_detail": lines,
        "fact_order": orders,
        "fact_customer_sales": A.customer_mart(lines, orders),
        "dim_product": spark.range(10).selectExpr(
            "id AS product_id", "concat('p', id) AS product_name", "id % 2 AS category_id"
        ),
        "dim_category": spark.range(2).selectExpr("id AS category_id", "concat('c', id) AS category_name"),
        "dim_customer": spark.range(5).selectExpr("id AS customer_id", "'a' AS first_name", "'b' AS last_name"),
        "dim_date": spark.createDataFrame([(20240101, 2024, 1), (20240201, 2024, 2)], "date_id int, year int, month int"),
        "fact_payment": lines.selectExpr("order_detail_id AS payment_id", "1 AS payment_method_id", "total_amount AS amount"),
        "dim_payment_method": spark.createDataFrame([(1, "CASH")], "payment_method_id int, payment_method string"),
    }
    assert reports.totals(tables).first()["total_sales"] == whole
    for report, column in (
        ("monthly_sales", "monthly_sales"), ("sales_by_category", "total_sales"), ("top_products", "total_sales"),
        ("top_products_by_id", "total_sales"), ("top_customers", "total_spending"),
        ("top_products_per_category", "sales"), ("customer_ranking", "total_spending"),
        ("monthly_growth", "current_sales"), ("running_sales", "daily_sales"), ("payments_by_method", "total_amount"),
    ):
        found = [r[column] for r in getattr(reports, report)(tables).collect()]
        assert sum(found) == (whole if report != "top_products_per_category" else whole * len(found) / 10), report
    assert reports.running_sales(tables).collect()[-1]["running_total_sales"] == whole
    assert reports.average_order_value(tables).first()[0] == pytest.approx(float(whole) / 1000)
    raw = lines.withColumnRenamed("order_id", "orderid").withColumnRenamed("product_id", "productid")
    assert A.global_totals(orders.withColumnRenamed("order_id", "orderid"), raw).first()["total_sales"] == whole
    assert A.product_mart(lines).agg(F.sum("total_sales")).first()[0] == whole
    fk = Q.fk_report(raw, orders.limit(0), "orderid", "order_id", "total_amount").first()
    assert fk["lost_amount"] == whole and fk["unmatched"] == n
