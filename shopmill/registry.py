"""Every operator as a runnable query over a data folder, with the SQL that must agree with it.

A query's columns are declared once as ``name:kind`` (i integer, s text or date, m money,
d double) and cast to BIGINT, VARCHAR or DOUBLE on both sides, so that a comparison does not
depend on how a client maps decimals and dates. Library functions keep exact types.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill.functions import cleaning as C
from shopmill.functions import events as E
from shopmill.functions import measures as M
from shopmill.operators import aggregates as A
from shopmill.operators import joins as J
from shopmill.operators import keysets as K
from shopmill.operators import quality as Q
from shopmill.operators import windows as W
from shopmill.operators.scale import scratch
from shopmill.operators.setops import unify
from shopmill.oracle import typed
from shopmill.plans import curated, deltas, reports, star
from shopmill.sources import files, landing, sinks
from shopmill.sources.tpch import Shop, open_shop
from shopmill.streaming import ingest


class Query(NamedTuple):
    build: Callable[[Shop], DataFrame]
    columns: str
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        casts = {"i": "bigint", "s": "string", "d": "double"}
        picked = []
        for item in self.columns.split():
            name, kind = item.split(":")
            c = F.col(f"`{name}`")
            c = c.cast("decimal(38,2)").cast("double") if kind == "m" else c.cast(casts[kind])
            picked.append(c.alias(name))
        return self.build(open_shop(spark, folder)).select(*picked)

    def oracle(self) -> str | None:
        return None if self.sql is None else typed(self.sql, self.columns)


QUERIES: dict[str, Query] = {}


def query(columns: str, sql: str | None = None):
    def add(build: Callable[[Shop], DataFrame]):
        QUERIES[build.__name__] = Query(build, columns, sql)
        return build

    return add


def _scratch(shop: Shop) -> str:
    return scratch(shop.spark)


def _day(text: str):
    return F.lit(text).cast("date")


def _astray(df: DataFrame, *keys: str) -> DataFrame:
    """Every key that 7 divides points to nothing, so that a check of references finds something."""
    moved = {k: F.when(F.col(k) % 7 == 0, F.col(k) + 10**12).otherwise(F.col(k)) for k in keys}
    return df.withColumns(moved)


def _gone(key: str) -> str:
    """The same in SQL."""
    return f"CASE WHEN {key} % 7 = 0 THEN {key} + 1000000000000 ELSE {key} END"


# --- sources and sinks ----------------------------------------------------------------------

IDS_PER_FOLDER = 64  # so that the test data have several folders
ORDERS = "orderid:i customerid:i orderdate:s status:s"
LINES = "orderdetailid:s orderid:i productid:i quantity:i unitprice:m discount:m"


@query(
    "paymentid:i orderid:i paymentmethod:s paymentdate:s amount:m",
    "SELECT * FROM m_payments",
)
def csv_roundtrip(shop):
    """Payments written as headered CSV and read back with the declared schema."""
    path = _scratch(shop)
    names = ["PaymentID", "OrderID", "PaymentMethod", "PaymentDate", "Amount"]
    shop.raw["payments"].toDF(*names).write.option("header", True).csv(path)
    schema = "PaymentID long, OrderID long, PaymentMethod string, PaymentDate date, Amount decimal(12,2)"
    return C.clean_columns(files.read_csv(shop.spark, path, schema))


@query(
    "customerid:i note:s",
    "SELECT customerid, full_name || chr(10) || country AS note FROM m_customers",
)
def csv_multiline(shop):
    """Quoted fields with line breaks survive the round trip."""
    path = _scratch(shop)
    note = F.concat("full_name", F.lit("\n"), "country").alias("note")
    rows = shop.raw["customers"].select("customerid", note)
    rows.write.option("header", True).option("quoteAll", True).csv(path)
    return files.read_csv(shop.spark, path, "customerid long, note string", multiline=True)


@query(
    ORDERS + " year:i month:i",
    'SELECT orderid, customerid, orderdate, status, "year", "month" FROM m_orders',
)
def partition_roundtrip(shop):
    path = _scratch(shop)
    cols = ["orderid", "customerid", "orderdate", "status", "year", "month"]
    sinks.write_table(shop.raw["orders"].select(*cols), path, ["year", "month"])
    return shop.spark.read.parquet(path)


@query(
    "orderid:i customerid:i orderdate:s status:s event_id:s year:i month:i",
    "SELECT orderid, customerid, orderdate, status, 'evt-' || orderid AS event_id, "
    'year(orderdate) AS "year", month(orderdate) AS "month" FROM m_events',
)
def append_events(shop):
    """Event headers appended twice by year and month: the second run adds nothing."""
    path = _scratch(shop)
    parsed = shop.events["parsed"]
    ingest.append_event_orders(parsed, path)
    ingest.append_event_orders(parsed, path)
    return shop.spark.read.parquet(path)


@query("orderid:i customerid:i", "SELECT orderid, customerid FROM m_events")
def write_events(shop):
    """Events landed as JSON lines in id folders, then read with the event schema."""
    path = _scratch(shop)
    sinks.write_events(shop.events["nested"], path)
    return E.event_orders(files.read_events(shop.spark, path, multiline=False))


@query(
    "orderid:i customerid:i orderdate:s status:s",
    "SELECT orderid, customerid, orderdate, status FROM m_events WHERE orderid >= 100 "
    "ORDER BY orderid LIMIT 1000",
)
def read_since(shop):
    """A bounded pull of landed events by id; folders of lower ids are not read."""
    path = _scratch(shop)
    sinks.write_events(shop.events["nested"], path, IDS_PER_FOLDER)
    return E.event_orders(files.read_events_since(shop.spark, path, 100, 1000, IDS_PER_FOLDER))


@query(
    "next_id:i",
    "SELECT max(orderid) + 1 AS next_id FROM "
    "(SELECT orderid FROM m_orders WHERE orderid >= 100 ORDER BY orderid LIMIT 1000)",
)
def read_next_id(shop):
    return files.next_id(files.read_since(shop.raw["orders"], 100, 1000), 100)


@query(ORDERS, "SELECT orderid, customerid, orderdate, status FROM m_orders WHERE orderid = 77")
def get_event(shop):
    return files.get_event(shop.raw["orders"], 77)


@query(
    "country:s customers:i spending:m",
    "SELECT country, count(*) AS customers, sum(total_sales) AS spending FROM m_customer_mart "
    "JOIN m_customers ON customer_id = customerid GROUP BY country",
)
def sql_over_views(shop):
    """Star tables registered as views answer free SQL."""
    names = ("dim_customer", "fact_customer_sales")
    sinks.register_views(shop.spark, {n: shop.star[n] for n in names})
    return shop.spark.sql(
        "SELECT country, count(*) AS customers, sum(total_sales) AS spending "
        "FROM fact_customer_sales JOIN dim_customer USING (customer_id) GROUP BY country"
    )


@query(
    "country:s customers:i spending:m",
    "SELECT country, count(*) AS customers, sum(total_sales) AS spending FROM m_customer_mart "
    "JOIN m_customers ON customer_id = customerid GROUP BY country",
)
def sql_over_tables(shop):
    """Written star tables in the catalog, with statistics, answer the same SQL by table name."""
    root = _scratch(shop)
    names = ("dim_customer", "fact_customer_sales")
    for name in names:
        sinks.write_table(shop.star[name], f"{root}/{name}")
    database = f"shop_{root.rsplit('/', 1)[1].replace('-', '')}"
    sinks.register_tables(shop.spark, {n: f"{root}/{n}" for n in names}, database)
    return shop.spark.sql(
        "SELECT country, count(*) AS customers, sum(total_sales) AS spending "
        f"FROM {database}.fact_customer_sales JOIN {database}.dim_customer USING (customer_id) GROUP BY country"
    )


@query(
    "kind:s records:i",
    """SELECT CASE WHEN paymentid % 7 = 0 THEN 'rejected' ELSE 'read' END AS kind, count(*) AS records
       FROM m_payments GROUP BY ALL""",
)
def csv_rejects(shop):
    """Payments as CSV, the amount of every seventh no number: how many records are read and how many set aside."""
    path = _scratch(shop)
    payments = shop.raw["payments"].select("paymentid", "orderid", F.col("amount").cast("string").alias("amount"))
    broken = F.when(F.col("paymentid") % 7 == 0, F.concat("amount", F.lit(" (open)"))).otherwise(F.col("amount"))
    payments.withColumn("amount", broken).write.option("header", True).csv(path)
    checked = files.read_csv_checked(shop.spark, path, "paymentid long, orderid long, amount decimal(12,2)")
    good, bad = files.split_rejects(checked)
    one = good.agg(F.count("*").alias("records")).select(F.lit("read").alias("kind"), "records")
    two = bad.filter("file IS NOT NULL").agg(F.count("*").alias("records"))
    return one.unionAll(two.select(F.lit("rejected").alias("kind"), "records")).filter("records > 0")


@query(
    "kind:s records:i",
    """SELECT CASE WHEN u = '2-HIGH' AND s IN ('F', 'P') OR u = '1-URGENT' AND s = 'F' OR u = '3-MEDIUM' AND s = 'P'
                   THEN 'rejected' ELSE 'read' END AS kind, count(*) AS records FROM m_events GROUP BY ALL""",
)
def event_rejects(shop):
    """Event texts, some damaged, read as JSON lines: typed events and texts that are no event."""
    path = _scratch(shop)
    sinks.write_texts(_damaged_events(shop).select("value"), path)
    good, bad = files.split_rejects(files.read_events_checked(shop.spark, path, whole_files=False))
    one = good.agg(F.count("*").alias("records")).select(F.lit("read").alias("kind"), "records")
    two = bad.filter("file IS NOT NULL").agg(F.count("*").alias("records"))
    return one.unionAll(two.select(F.lit("rejected").alias("kind"), "records")).filter("records > 0")


@query(
    "column:s nulls:i",
    """SELECT 'rows' AS "column", count(*) AS nulls FROM m_customers UNION ALL
       SELECT 'customerid', count(CASE WHEN customerid IS NULL THEN 1 END) FROM m_customers UNION ALL
       SELECT 'email', count(CASE WHEN email IS NULL THEN 1 END) FROM m_customers UNION ALL
       SELECT 'country', count(CASE WHEN country IS NULL THEN 1 END) FROM m_customers""",
)
def profile_while_writing(shop):
    """Rows and NULLs of the customers, counted by the job that writes them."""
    columns = ["customerid", "email", "country"]
    counted = sinks.write_observed(shop.raw["customers"].select(*columns), _scratch(shop))
    return shop.spark.createDataFrame(list(counted.items()), "column string, nulls long")


@query("file:s", "SELECT 'lineitem.parquet' AS file UNION ALL SELECT 'orders.parquet'")
def list_inputs(shop):
    both = [files.list_inputs(shop.source[n]) for n in ("orders", "lineitem")]
    found = both[0].unionAll(both[1]).filter("bytes > 0")
    return found.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"))


# --- data quality ---------------------------------------------------------------------------


#: The twelve raw tables: their rows in SQL and the columns with types.
_RAW = {
    "customers": (
        "m_customers",
        "customerid bigint, firstname string, lastname string, full_name string, email string, city string, "
        "country string, registrationdate date",
    ),
    "categories": ("m_categories", "categoryid int, categoryname string"),
    "products": (
        "m_products",
        "productid bigint, productname string, brand string, price decimal(12,2), cost decimal(12,2), "
        "stock int, categoryid int",
    ),
    "departments": (
        "(SELECT r_regionkey AS departmentid, r_name AS departmentname FROM region)",
        "departmentid bigint, departmentname string",
    ),
    "employees": (
        """(SELECT s_suppkey AS employeeid, CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS managerid,
            n_regionkey AS departmentid, split_part(s_name, '#', 1) AS firstname,
            split_part(s_name, '#', 2) AS lastname, s_acctbal AS salary, s_nationkey AS hiredate
            FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
        "employeeid bigint, managerid bigint, departmentid bigint, firstname string, lastname string, "
        "salary decimal(12,2), hiredate date",
    ),
    "suppliers": (
        """(SELECT s_suppkey AS supplierid, s_name AS suppliername, n_name AS country
            FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
        "supplierid bigint, suppliername string, country string",
    ),
    "product_suppliers": (
        "(SELECT productid, supplierid FROM m_lines)", "productid bigint, supplierid bigint"
    ),
    "orders": (
        """(SELECT *, "day"(orderdate) AS "day", dayofweek(orderdate) + 1 AS day_of_week FROM m_orders)""",
        "orderid bigint, customerid bigint, orderdate date, status string, year int, month int, day int, "
        "quarter int, day_of_week int",
    ),
    "order_details": (
        "m_lines",
        "orderdetailid string, orderid bigint, productid bigint, quantity int, unitprice decimal(12,2), "
        "discount decimal(12,2), total_amount decimal(14,2)",
    ),
    "payments": (
        "m_payments",
        "paymentid bigint, orderid bigint, paymentmethod string, paymentdate date, amount decimal(12,2)",
    ),
    "shippers": (
        "(SELECT s_suppkey AS shipperid, s_name AS companyname FROM supplier)",
        "shipperid bigint, companyname string",
    ),
    "shipments": (
        "m_shipments",
        "shipmentid string, orderid bigint, shipperid bigint, shipdate date, deliverydate date",
    ),
}


def _columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ", 1)) for c in re.split(r", (?![0-9])", _RAW[table][1])]


def _per_column(pick: str) -> str:
    """SQL over every column of every raw table; ``pick`` may use {t}, {c}, {k} and the view v."""
    parts = [
        "SELECT " + pick.format(t=t, c=c, k=k) + f" FROM {_RAW[t][0]} v"
        for t in _RAW
        for c, k in _columns_of(t)
    ]
    return " UNION ALL ".join(parts)


def _long(shop, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row per table and column from a one-row frame per table."""
    parts = []
    for table in _RAW:
        one = count(shop.raw[table])
        rows = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nulls"))
                for c in one.columns
            ]
        )
        parts.append(one.select(F.lit(table).alias("table"), F.inline(rows)))
    return reduce(DataFrame.unionAll, parts)


@query(
    "table:s rows:i",
    " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS "rows" FROM {v}""" for t, (v, _) in _RAW.items()),
)
def profile_counts(shop):
    """Rows of all twelve tables."""
    return Q.profile_counts({n: shop.raw[n] for n in _RAW})


@query("table:s column:s nulls:i", _per_column("""'{t}' AS "table", '{c}' AS "column", sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS nulls"""))
def profile_nulls_sum(shop):
    """NULLs of every column of all twelve tables, as sums of flags."""
    return _long(shop, Q.null_sums)


@query("table:s column:s nulls:i", _per_column("""'{t}' AS "table", '{c}' AS "column", count(CASE WHEN "{c}" IS NULL THEN 1 END) AS nulls"""))
def profile_nulls_count(shop):
    """The same as conditional counts."""
    return _long(shop, Q.null_counts)


@query("table:s column:s type:s rows:i nulls:i", _per_column("""'{t}' AS "table", '{c}' AS "column", '{k}' AS "type", count(*) AS "rows", count(*) - count("{c}") AS nulls"""))
def profile_schema(shop):
    """Columns and types of all twelve tables with row and NULL counts."""
    return Q.profile_columns({n: shop.raw[n] for n in _RAW})


@query(
    "l_orderkey:i l_linenumber:i count:i",
    'SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem '
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def dup_keys(shop):
    return Q.duplicate_keys(shop.source["lineitem"], ["l_orderkey", "l_linenumber"])


@query(
    "customerid:i email:s",
    "SELECT customerid, email FROM m_customers WHERE NOT "
    "regexp_full_match(email, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')",
)
def email_invalid(shop):
    return Q.invalid_email(shop.raw["customers"], "email")


@query("customerid:i city:s", "SELECT customerid, city FROM m_customers WHERE email IS NULL")
def email_missing(shop):
    return Q.missing(shop.raw["customers"], "email")


@query(ORDERS, "SELECT * FROM m_orders WHERE status NOT IN ('O', 'F')")
def status_out_of_domain(shop):
    return Q.out_of_domain(shop.raw["orders"], "status", ["O", "F"])


@query(
    "c_custkey:i c_acctbal:d",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NULL OR c_acctbal <= 0",
)
def nonpositive_balance(shop):
    return Q.nonpositive(shop.source["customer"], "c_acctbal")


@query(ORDERS, "SELECT * FROM m_orders ORDER BY orderdate, orderid LIMIT 10")
def preview_orders(shop):
    return Q.preview(shop.raw["orders"], ["orderdate", "orderid"], 10)


@query(
    "paymentid:i orderid:i amount:m order_total_amount:m",
    "SELECT p.paymentid, p.orderid, p.amount, s.order_total_amount FROM m_payments p "
    "JOIN m_summary s ON p.orderid = s.orderid WHERE p.amount <> s.order_total_amount",
)
def payment_mismatch(shop):
    return J.payment_mismatch(A.order_summary(shop.raw["order_details"]), shop.raw["payments"])


@query(
    "fk:s rows:i unmatched:i lost_amount:m",
    f"""SELECT 'lines->orders' AS fk, count(*) AS "rows", count(*) - count(o.orderid) AS unmatched,
              sum(CASE WHEN o.orderid IS NULL THEN total_amount END) AS lost_amount
       FROM m_lines l LEFT JOIN m_orders o ON {_gone("l.orderid")} = o.orderid
       UNION ALL
       SELECT 'lines->products', count(*), count(*) - count(p.productid),
              sum(CASE WHEN p.productid IS NULL THEN total_amount END)
       FROM m_lines l LEFT JOIN m_products p ON {_gone("l.productid")} = p.productid
       UNION ALL
       SELECT 'orders->customers', count(*), count(*) - count(c.customerid), NULL
       FROM m_orders o LEFT JOIN m_customers c ON {_gone("o.customerid")} = c.customerid""",
)
def fk_report(shop):
    raw = shop.raw
    lines = _astray(raw["order_details"], "orderid", "productid")
    orders = _astray(raw["orders"], "customerid")
    reports = [
        Q.fk_report(lines, raw["orders"], "orderid", "orderid", "total_amount", "lines->orders"),
        Q.fk_report(lines, raw["products"], "productid", "productid", "total_amount", "lines->products"),
        Q.fk_report(orders, raw["customers"], "customerid", "customerid", name="orders->customers"),
    ]
    return reduce(DataFrame.unionAll, reports)


def _fk_sql(name: str, child: str, key: str, parent: str, pkey: str, amount: str) -> str:
    return f"""SELECT '{name}' AS fk, count(*) AS "rows", count(*) - count(p.k) AS unmatched,
        sum(CASE WHEN p.k IS NULL THEN {amount} END) AS lost_amount
        FROM {child} c LEFT JOIN (SELECT DISTINCT {pkey} AS k FROM {parent}) p ON c.{key} = p.k"""


@query(
    "fk:s rows:i unmatched:i lost_amount:m",
    " UNION ALL ".join(
        [
            _fk_sql("orders.customerid", "m_orders", "customerid", "customer", "c_custkey", "NULL"),
            _fk_sql(
                "order_details.orderid", "m_lines", "orderid", "orders", "o_orderkey", "total_amount"
            ),
            _fk_sql(
                "order_details.productid", "m_lines", "productid", "part", "p_partkey", "total_amount"
            ),
            _fk_sql("payments.orderid", "m_payments", "orderid", "orders", "o_orderkey", "amount"),
            _fk_sql("shipments.orderid", "m_shipments", "orderid", "orders", "o_orderkey", "NULL"),
            _fk_sql(
                "shipments.shipperid", "m_shipments", "shipperid", "supplier", "s_suppkey", "NULL"
            ),
            _fk_sql(
                "products.categoryid", "m_products", "categoryid", "m_categories", "categoryid", "NULL"
            ),
        ]
    ),
)
def integrity_report(shop):
    return Q.integrity_report(shop.raw)


@query(
    "fk:s rows:i unmatched:i lost_amount:m",
    f"""SELECT 'order_details.orderid' AS fk, count(*) AS "rows", count(*) - count(o.orderid) AS unmatched,
              sum(CASE WHEN o.orderid IS NULL THEN total_amount END) AS lost_amount
       FROM m_lines l LEFT JOIN m_orders o ON {_gone("l.orderid")} = o.orderid
       UNION ALL
       SELECT 'order_details.productid', count(*), count(*) - count(p.productid),
              sum(CASE WHEN p.productid IS NULL THEN total_amount END)
       FROM m_lines l LEFT JOIN m_products p ON {_gone("l.productid")} = p.productid""",
)
def references_one_pass(shop):
    """Both references of the lines against sets of keys, the lines read once."""
    lines = _astray(shop.raw["order_details"], "orderid", "productid")
    sets = {k: K.key_set(shop.raw[t], k) for k, t in (("orderid", "orders"), ("productid", "products"))}
    return K.references(lines, sets, "order_details", "total_amount")


@query(
    "shipmentid:s orderid:i shipdate:s",
    f"""SELECT shipmentid, {_gone("orderid")} AS orderid, shipdate FROM m_shipments
        WHERE {_gone("orderid")} NOT IN (SELECT orderid FROM m_orders)""",
)
def shipments_outside_key_set(shop):
    shipments = _astray(shop.raw["shipments"], "orderid")
    return K.without_reference(shipments, "orderid", K.key_set(shop.raw["orders"], "orderid"))


@query(
    "shipmentid:s orderid:i shipdate:s",
    f"""SELECT shipmentid, {_gone("orderid")} AS orderid, shipdate FROM m_shipments
        WHERE {_gone("orderid")} NOT IN (SELECT orderid FROM m_orders)""",
)
def shipments_without_order(shop):
    return J.unmatched(_astray(shop.raw["shipments"], "orderid"), shop.raw["orders"], "orderid", "right")


@query(
    ORDERS,
    f"""SELECT orderid, customerid, orderdate, status FROM m_orders WHERE orderid NOT IN
        (SELECT {_gone("orderid")} FROM m_shipments)""",
)
def orders_without_shipment(shop):
    return J.unmatched(shop.raw["orders"], _astray(shop.raw["shipments"], "orderid"), "orderid")


@query(
    "orderid:i field:s expected:m actual:m",
    """SELECT orderid, 'total_amount' AS field, subtotal + tax_amount + shipping_cost AS expected,
              subtotal + tax_amount + shipping_cost + slip AS actual
       FROM m_events WHERE slip > greatest(n, 1) * 0.01
       UNION ALL
       SELECT orderid, 'payment_amount', subtotal + tax_amount + shipping_cost + slip, paid
       FROM m_events
       WHERE abs(subtotal + tax_amount + shipping_cost + slip - paid) > greatest(n, 1) * 0.01
       UNION ALL
       SELECT orderid, 'shipping_cost', 50, 0 FROM m_events WHERE sent AND shipping_cost = 0""",
)
def event_reconcile(shop):
    """Every fifth document is delivered twice, which is no fault."""
    events = shop.events["parsed"]
    return Q.reconcile_events(events.unionAll(events.filter("order.OrderID % 5 = 0")))


@query(
    "orderid:i expected:s actual:s",
    """SELECT orderid, expected, status AS actual FROM
       (SELECT *, CASE WHEN s = 'F' THEN 'CANCELLED' WHEN shipping_cost > 0 THEN 'CONFIRMED'
                       ELSE 'PROCESSING' END AS expected FROM m_events)
       WHERE expected <> status""",
)
def event_status_check(shop):
    return Q.status_mismatch(shop.events["parsed"])


@query(
    "orderid:i codes:s",
    """SELECT * FROM (SELECT orderid, concat_ws(',',
         CASE WHEN s <> 'F' AND shipping_cost > 0 AND NOT sent THEN 'shipment_missing' END,
         CASE WHEN NOT (s <> 'F' AND shipping_cost > 0) AND sent THEN 'shipment_unexpected' END,
         CASE WHEN sent AND leaves <> orderdate + 1 THEN 'ship_date_not_next_day' END,
         CASE WHEN sent AND travel NOT BETWEEN 2 AND 5 THEN 'delivery_not_2_to_5_days' END
       ) AS codes FROM m_events) WHERE codes <> ''""",
)
def shipment_rules(shop):
    found = Q.shipment_rules(shop.events["parsed"])
    return found.select("orderid", F.concat_ws(",", "reasons").alias("codes"))


def _damaged_events(shop, *also):
    """Event texts in which status and priority decide what is broken, one for each row of ``orders`` with the id."""
    text, s, u = F.col("value"), F.col("o_orderstatus"), F.col("o_orderpriority")
    broken = (
        F.when((u == "5-LOW") & (s == "F"), F.regexp_replace(text, '"payment":', '"paid":'))
        .when((u == "5-LOW") & (s == "O"), F.regexp_replace(text, '"order_details":', '"lines":'))
        .when((u == "2-HIGH") & (s == "F"), F.concat(F.lit("["), text, F.lit("]")))
        .when((u == "2-HIGH") & (s == "P"), F.lit("{not json"))
        .when(
            (u == "1-URGENT") & (s == "F"),
            F.regexp_replace(text, '"order":\\{"OrderID":', '"order":{"OrderID":"x","Old":'),
        )
        .when(
            (u == "1-URGENT") & (s == "P"),
            F.regexp_replace(text, '"order":\\{"OrderID":', '"order":{"Old":'),
        )
        .when(
            (u == "3-MEDIUM") & (s == "P"),
            F.regexp_replace(text, '"order_details":\\[', '"order_details":"[oops","lines":['),
        )
        .otherwise(text)
    )
    texts = shop.events["marked"].select("orderid", "value", "who", F.inline("who"))
    return texts.select(F.col("orderid").alias("source_id"), broken.alias("value"), *also)


@query(
    "source_id:i orderid:i errors:s warnings:s",
    """SELECT orderid AS source_id,
              CASE WHEN (u = '2-HIGH' AND s IN ('F', 'P')) OR (u = '1-URGENT' AND s IN ('F', 'P'))
                   THEN NULL ELSE orderid END AS orderid,
              CASE WHEN u = '5-LOW' AND s = 'O' THEN 'order_details_missing'
                   WHEN u = '2-HIGH' AND s IN ('F', 'P') THEN 'not_an_object'
                   WHEN u = '1-URGENT' AND s = 'F' THEN 'order_id_not_an_integer'
                   WHEN u = '1-URGENT' AND s = 'P' THEN 'order_id_missing'
                   WHEN u = '3-MEDIUM' AND s = 'P' THEN 'order_details_not_a_list'
                   ELSE '' END AS errors,
              CASE WHEN u = '5-LOW' AND s = 'F' THEN 'payment_missing' ELSE '' END AS warnings
       FROM m_events""",
)
def event_structure(shop):
    judged = Q.judge_events(_damaged_events(shop))
    return judged.select(
        "source_id",
        "orderid",
        F.concat_ws(",", "errors").alias("errors"),
        F.concat_ws(",", "warnings").alias("warnings"),
    )


@query(
    "orderid:i codes:s",
    """SELECT * FROM (SELECT o.orderid, concat_ws(',',
         CASE WHEN customerid NOT BETWEEN 1 AND 1000 THEN 'customer_out_of_range' END,
         CASE WHEN coalesce(items, 0) NOT BETWEEN 1 AND 7 THEN 'item_count_out_of_range' END,
         CASE WHEN unknown > 0 THEN 'product_unknown' END,
         CASE WHEN big > 0 THEN 'quantity_out_of_range' END,
         CASE WHEN deep > 0 THEN 'discount_out_of_range' END,
         CASE WHEN urgency IN ('4-NOT SPECIFIED') THEN 'payment_method_not_allowed' END
       ) AS codes FROM m_orders o LEFT JOIN
         (SELECT orderid, count(*) AS items, sum(CASE WHEN quantity > 45 THEN 1 ELSE 0 END) AS big,
                 sum(CASE WHEN discount > 9 THEN 1 ELSE 0 END) AS deep,
                 sum(CASE WHEN productid NOT IN
                     (SELECT productid FROM m_products) THEN 1 ELSE 0 END) AS unknown
          FROM (SELECT * REPLACE (CASE WHEN productid % 7 = 0 THEN productid + 1000000000000
                                  ELSE productid END AS productid) FROM m_lines) GROUP BY orderid) l ON o.orderid = l.orderid) WHERE codes <> ''""",
)
def request_rules(shop):
    limits = {"customer_max": 1000, "items_max": 7, "quantity_max": 45, "discount_max": 9}
    found = Q.request_rules(
        _astray(shop.raw["order_details"], "productid"),
        shop.raw["orders"],
        shop.raw["products"],
        shop.raw["payments"],
        limits,
        ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"],
    )
    return found.select("orderid", F.concat_ws(",", "reasons").alias("codes"))


# --- cleaning -------------------------------------------------------------------------------


@query(
    "order_id:i customer_id:i order_status:s",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status "
    "FROM orders",
)
def clean_columns(shop):
    messy = shop.source["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    return C.clean_columns(messy.toDF(" Order ID", "Customer-ID ", "ORDER STATUS"))


@query("c_custkey:i c_name:s c_mktsegment:s", "SELECT * FROM customer")
def trim_all(shop):
    padded = shop.source["customer"].withColumns(
        {
            "c_name": F.concat(F.lit("  "), "c_name", F.lit(" ")),
            "c_mktsegment": F.concat("c_mktsegment", F.lit("   ")),
        }
    )
    return C.trim_strings(padded)


@query(
    "customerid:i email:s city:s",
    "SELECT customerid, email, upper(city) AS city FROM m_customers",
)
def normalise_case(shop):
    loud = shop.raw["customers"].withColumns(
        {"email": F.concat(F.lit(" "), F.upper("email")), "city": F.lower("city")}
    )
    return C.normalise_case(loud, lower=["email"], upper=["city"])


@query("orderid:i status:s", "SELECT orderid, status FROM m_orders WHERE status <> 'P'")
def dropna_keys(shop):
    holed = shop.raw["orders"].select("orderid", F.nullif("status", F.lit("P")).alias("status"))
    return C.require_keys(holed, ["status"])


@query("a:i b:s", "SELECT orderid AS a, shipdate AS b FROM m_lines WHERE linestatus <> 'O'")
def dropna_all(shop):
    kept = F.col("l_linestatus") != "O"
    rows = shop.source["lineitem"].select(
        F.when(kept, F.col("l_orderkey")).alias("a"),
        F.when(kept, F.col("l_shipdate").cast("date")).alias("b"),
    )
    return C.drop_empty_rows(rows)


@query(
    "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_extendedprice:d",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM
       (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS nth FROM lineitem)
       WHERE nth = 1""",
)
def dedup_key(shop):
    keys = ["l_orderkey", "l_linenumber"]
    lines = shop.source["lineitem"].select(*keys, "l_partkey", "l_suppkey", "l_extendedprice")
    return C.dedup(lines, keys, [F.desc("l_extendedprice")])


@query(
    "productid:i supplierid:i", "SELECT DISTINCT productid, supplierid FROM m_lines"
)
def dedup_composite(shop):
    return C.dedup(shop.raw["product_suppliers"], ["productid", "supplierid"])


@query(
    "orderid:i partid:i note:s",
    """SELECT CASE WHEN returnflag = 'R' THEN NULL ELSE orderid END AS orderid,
              productid AS partid, returnflag AS note FROM m_lines""",
)
def cast_ids(shop):
    dirty = shop.source["lineitem"].select(
        F.concat("l_orderkey", F.when(F.col("l_returnflag") == "R", "x").otherwise("")).alias(
            "orderid"
        ),
        F.col("l_partkey").cast("string").alias("partid"),
        F.col("l_returnflag").alias("note"),
    )
    return C.cast_ids(dirty)


@query(
    "orderid:i unitprice:m quantity:i",
    """SELECT orderid, CASE WHEN returnflag = 'A' THEN NULL ELSE unitprice END AS unitprice,
              quantity FROM m_lines""",
)
def cast_money(shop):
    dirty = shop.source["lineitem"].select(
        F.col("l_orderkey").alias("orderid"),
        F.when(F.col("l_returnflag") == "A", "n/a")
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
        .alias("unitprice"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
    )
    return C.cast_columns(dirty, {"unitprice": "decimal(12,2)", "quantity": "int"})


@query(
    "price:i day:i",
    """SELECT count(CASE WHEN returnflag = 'A' THEN 1 END) AS price,
              count(CASE WHEN linestatus = 'F' THEN 1 END) AS "day" FROM m_lines""",
)
def cast_rejects(shop):
    dirty = shop.source["lineitem"].select(
        F.when(F.col("l_returnflag") == "A", "n/a")
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
        .alias("price"),
        F.when(F.col("l_linestatus") == "F", "2024-02-30")
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("day"),
    )
    return C.reject_counts(dirty, {"price": "decimal(12,2)", "day": "date"})


@query(
    "c_custkey:i balance:m",
    "SELECT c_custkey, greatest(CAST(c_acctbal AS DECIMAL(12,2)), 0) AS balance FROM customer",
)
def clamp_negative(shop):
    balance = F.col("c_acctbal").cast("decimal(12,2)")
    clamped = M.clamp_negative(balance, "decimal(12,2)").alias("balance")
    return shop.source["customer"].select("c_custkey", clamped)


@query(
    "orderid:i orderdate:s",
    "SELECT orderid, CASE WHEN urgency = '5-LOW' THEN NULL ELSE orderdate END AS orderdate "
    "FROM m_orders",
)
def parse_dates(shop):
    text = F.col("o_orderdate").cast("date").cast("string")
    dirty = shop.source["orders"].select(
        F.col("o_orderkey").alias("orderid"),
        F.when(F.col("o_orderpriority") == "5-LOW", "2024-02-30").otherwise(text).alias("orderdate"),
    )
    return C.parse_dates(dirty, dates=["orderdate"])


# --- derived columns ------------------------------------------------------------------------


@query(
    "order_detail_id:s gross_amount:m discount_amount:m total_amount:m",
    "SELECT order_detail_id, gross_amount, discount_amount, net_amount AS total_amount FROM m_facts",
)
def line_amounts(shop):
    return star.fact_order_detail(shop.raw["order_details"], unique=True)


@query(
    "orderdetailid:s gross_amount:m discount_amount:d total_amount:d",
    """SELECT orderdetailid, total_amount AS gross_amount, total_amount * discount * 0.01
              AS discount_amount, total_amount - total_amount * discount * 0.01 AS total_amount
       FROM m_lines""",
)
def line_amounts_unrounded(shop):
    return star.line_amounts(shop.raw["order_details"])


@query(
    "orderid:i year:i month:i day:i quarter:i day_of_week:i week_of_year:i",
    """SELECT orderid, year(orderdate) AS "year", month(orderdate) AS "month",
              day(orderdate) AS "day", quarter(orderdate) AS "quarter",
              dayofweek(orderdate) + 1 AS day_of_week, week(orderdate) AS week_of_year
       FROM m_orders""",
)
def date_parts(shop):
    parts = ("year", "month", "day", "quarter", "day_of_week", "week_of_year")
    return M.with_date_parts(shop.raw["orders"].select("orderid", "orderdate"), "orderdate", parts)


@query(
    "customerid:i skipping:s strict:s",
    """SELECT customerid, CASE WHEN email IS NULL THEN firstname ELSE full_name END AS skipping,
              CASE WHEN email IS NULL THEN NULL ELSE full_name END AS strict FROM m_customers""",
)
def full_name(shop):
    last = F.when(F.col("email").isNotNull(), F.col("lastname"))
    return shop.raw["customers"].select(
        "customerid",
        M.full_name(F.col("firstname"), last).alias("skipping"),
        M.strict_name(F.col("firstname"), last).alias("strict"),
    )


@query(
    "orderid:i order_value_category:s",
    """SELECT orderid, CASE WHEN order_total_amount >= 6000000 THEN 'HIGH'
              WHEN order_total_amount >= 3000000 THEN 'MEDIUM' ELSE 'LOW' END
              AS order_value_category FROM m_summary""",
)
def order_band(shop):
    band = M.order_band(F.col("order_total_amount"), (6_000_000, 3_000_000))
    return A.order_summary(shop.raw["order_details"]).withColumn("order_value_category", band)


@query(
    "customerid:i customer_segment:s",
    """SELECT customerid, CASE WHEN n > 14 THEN 'VIP' WHEN n > 10 THEN 'PREMIUM'
              WHEN n > 7 THEN 'REGULAR' ELSE 'LOW_VALUE' END AS customer_segment
       FROM (SELECT customerid, count(*) AS n FROM m_orders GROUP BY customerid)""",
)
def segment_strict(shop):
    segment = M.customer_segment(F.col("num_orders"), (14, 10, 7), inclusive=False)
    return A.orders_per_customer(shop.raw["orders"]).withColumn("customer_segment", segment)


@query(
    "customerid:i customer_segment:s",
    """SELECT customerid, CASE WHEN n >= 14 THEN 'VIP' WHEN n >= 10 THEN 'PREMIUM'
              WHEN n >= 7 THEN 'REGULAR' ELSE 'LOW_VALUE' END AS customer_segment
       FROM (SELECT customerid, count(*) AS n FROM m_orders GROUP BY customerid)""",
)
def segment_inclusive(shop):
    segment = M.customer_segment(F.col("num_orders"), (14, 10, 7), inclusive=True)
    return A.orders_per_customer(shop.raw["orders"]).withColumn("customer_segment", segment)


@query(
    "orderid:i date_id:i",
    "SELECT orderid, strftime(orderdate, '%Y%m%d') AS date_id FROM m_orders",
)
def date_key(shop):
    return shop.raw["orders"].select("orderid", M.date_key(F.col("orderdate")).alias("date_id"))


@query(
    "shipmentid:s days:i",
    "SELECT shipmentid, date_diff('day', shipdate, deliverydate) AS days FROM m_shipments",
)
def ship_days(shop):
    days = M.day_span(F.col("shipdate"), F.col("deliverydate")).alias("days")
    return shop.raw["shipments"].select("shipmentid", days)


# --- joins ----------------------------------------------------------------------------------


@query(
    "orderid:i customerid:i orderdate:s status:s productid:i quantity:i unitprice:m total_amount:m",
    f"""SELECT o.orderid, o.customerid, o.orderdate, o.status, l.productid, l.quantity, l.unitprice,
               l.total_amount FROM m_orders o JOIN m_lines l ON o.orderid = {_gone("l.orderid")}""",
)
def orders_lines_inner(shop):
    """Lines of unknown orders have no match."""
    return J.orders_lines(shop.raw["orders"], _astray(shop.raw["order_details"], "orderid"))


@query(
    "orderid:i customerid:i customer_name:s city:s country:s orderdate:s status:s",
    f"""SELECT o.orderid, {_gone("o.customerid")} AS customerid, c.full_name AS customer_name, c.city,
              c.country, o.orderdate, o.status
       FROM m_orders o LEFT JOIN m_customers c ON {_gone("o.customerid")} = c.customerid""",
)
def orders_customers_left(shop):
    return J.orders_customers(_astray(shop.raw["orders"], "customerid"), shop.raw["customers"])


@query(
    "productid:i categoryid:i productname:s categoryname:s",
    """SELECT p.productid, p.k AS categoryid, p.productname, c.categoryname
       FROM (SELECT *, CASE WHEN productid % 7 = 0 THEN categoryid + 1000 ELSE categoryid END AS k
             FROM m_products) p LEFT JOIN m_categories c ON p.k = c.categoryid""",
)
def products_categories_left(shop):
    astray = F.when(F.col("productid") % 7 == 0, F.col("categoryid") + 1000).otherwise(F.col("categoryid"))
    products = shop.raw["products"].withColumn("categoryid", astray)
    return J.products_categories(products, shop.raw["categories"])


@query(
    "productid:i productname:s supplierid:i suppliername:s country:s",
    f"""SELECT p.productid, p.productname, b.supplierid, s.s_name AS suppliername,
              n.n_name AS country FROM m_products p
       LEFT JOIN (SELECT DISTINCT {_gone("productid")} AS productid, {_gone("supplierid")} AS supplierid
                  FROM m_lines) b ON p.productid = b.productid
       LEFT JOIN supplier s ON b.supplierid = s.s_suppkey
       LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
)
def products_suppliers_left(shop):
    keys = ["productid", "supplierid"]
    bridge = C.dedup(_astray(shop.raw["product_suppliers"], *keys), keys)
    return J.products_suppliers(shop.raw["products"], bridge, shop.raw["suppliers"])


@query(
    "orderid:i customerid:i paymentid:i paymentmethod:s amount:m",
    f"""SELECT o.orderid, o.customerid, p.paymentid, p.paymentmethod, p.amount FROM m_orders o
       LEFT JOIN m_payments p ON o.orderid = {_gone("p.orderid")}""",
)
def orders_payments_left(shop):
    return J.orders_payments(shop.raw["orders"], _astray(shop.raw["payments"], "orderid"))


@query(
    "orderid:i customerid:i shipmentid:s shipdate:s shipperid:i companyname:s",
    f"""SELECT o.orderid, o.customerid, h.shipmentid, h.shipdate, h.k AS shipperid, s.s_name AS companyname
       FROM m_orders o
       LEFT JOIN (SELECT *, {_gone("shipperid")} AS k FROM m_shipments) h
         ON o.orderid = {_gone("h.orderid")}
       LEFT JOIN supplier s ON h.k = s.s_suppkey""",
)
def orders_shipments_left(shop):
    sent = _astray(shop.raw["shipments"], "orderid", "shipperid")
    return J.orders_shipments(shop.raw["orders"], sent, shop.raw["shippers"])


@query(
    "orderid:i productid:i customerid:i status:s categoryid:i productname:s quantity:i total_amount:m",
    "SELECT * FROM m_wide",
)
def wide_sales(shop):
    return J.wide_sales(shop.raw["orders"], shop.raw["order_details"], shop.raw["products"])


@query(
    "orderid:i order_status_id:i",
    """SELECT orderid, order_status_id FROM m_orders LEFT JOIN m_statuses
       ON CASE WHEN orderid % 7 = 0 THEN 'LOST' ELSE status END = order_status""",
)
def status_lookup(shop):
    """An unknown name has no id."""
    name = F.when(F.col("orderid") % 7 == 0, "LOST").otherwise(F.col("status")).alias("order_status")
    named = shop.raw["orders"].select("orderid", name)
    return J.with_lookup_id(named, shop.star["dim_order_status"], "order_status", "order_status_id")


@query(
    "customerid:i full_name:s",
    f"""SELECT customerid, full_name FROM m_customers WHERE customerid NOT IN
       (SELECT {_gone("customerid")} FROM m_orders)""",
)
def customers_never_ordered(shop):
    orders = _astray(shop.raw["orders"], "customerid")
    return J.unmatched(shop.raw["customers"], orders, "customerid")


@query(
    "productid:i productname:s",
    f"""SELECT productid, productname FROM m_products WHERE productid NOT IN
       (SELECT {_gone("productid")} FROM m_lines)""",
)
def products_never_sold(shop):
    lines = _astray(shop.raw["order_details"], "productid")
    return J.unmatched(shop.raw["products"], lines, "productid")


# --- aggregates -----------------------------------------------------------------------------


@query(
    "orderid:i order_total_amount:m order_total_quantity:i",
    "SELECT * FROM m_summary",
)
def order_summary(shop):
    return A.order_summary(shop.raw["order_details"])


@query(
    "customerid:i total_customer_sales:m",
    "SELECT customerid, sum(total_amount) AS total_customer_sales FROM m_sales GROUP BY customerid",
)
def customer_total(shop):
    return A.customer_total(shop.raw["orders"], A.order_summary(shop.raw["order_details"]))


@query(
    "average_product_price:d",
    "SELECT CAST(sum(price) AS DOUBLE) / CAST(count(price) AS DOUBLE) AS average_product_price "
    "FROM m_products",
)
def avg_price(shop):
    return A.mean_of(shop.raw["products"], "price", "average_product_price")


@query(
    "total_sales:m total_orders:i total_quantity:i avg_order_value:d",
    """SELECT (SELECT sum(total_amount) FROM m_lines) AS total_sales,
              (SELECT count(orderid) FROM m_orders) AS total_orders,
              (SELECT sum(quantity) FROM m_lines) AS total_quantity,
              (SELECT CAST(CAST(sum(order_total_amount) AS DECIMAL(38,2)) AS DOUBLE)
                      / CAST(count(*) AS DOUBLE) FROM m_summary) AS avg_order_value""",
)
def global_totals(shop):
    return A.global_totals(shop.raw["orders"], shop.raw["order_details"])


def _grouped(keys: str) -> str:
    return f"SELECT {keys}, sum(total_amount) AS total_sales FROM m_sales GROUP BY {keys}"


def _order_sales(shop):
    return A.order_sales(shop.raw["orders"], shop.raw["order_details"])


# Lines of unknown products count for no customer, product or category.
_KNOWN = f"m_sales s JOIN m_products p ON {_gone('s.productid')} = p.productid"
_BY_CUSTOMER = f"SELECT customerid, sum(total_amount) AS total_sales FROM {_KNOWN} GROUP BY customerid"


@query("customerid:i total_sales:m", _BY_CUSTOMER)
def sales_by_customer(shop):
    raw = shop.raw
    lines = _astray(raw["order_details"], "productid")
    return A.sales_by_customer(lines, raw["orders"], raw["products"])


def _product_sales(shop):
    raw = shop.raw
    lines = _astray(raw["order_details"], "productid")
    return A.sales_by_product(lines, raw["orders"], raw["products"])


@query(
    "productid:i total_sales:m",
    f"SELECT p.productid, sum(total_amount) AS total_sales FROM {_KNOWN} GROUP BY p.productid",
)
def sales_by_product(shop):
    return _product_sales(shop)


@query(
    "categoryid:i total_sales:m",
    f"SELECT categoryid, sum(total_amount) AS total_sales FROM {_KNOWN} GROUP BY categoryid",
)
def sales_by_category(shop):
    return A.sales_by(_product_sales(shop), ["categoryid"], "total_sales")


def _place_sql(place: str) -> str:
    return f"""SELECT c.{place}, sum(s.total_amount) AS total_sales FROM m_sales s
        LEFT JOIN m_customers c ON {_gone("s.customerid")} = c.customerid GROUP BY c.{place}"""


def _placed(shop):
    """Customer sales next to the customer's place: one row per customer in the join."""
    orders = _astray(shop.raw["orders"], "customerid")
    per_customer = A.sales_by(A.order_sales(orders, shop.raw["order_details"]), ["customerid"])
    known = shop.raw["customers"].select("customerid", "city", "country")
    return per_customer.join(known, "customerid", "left")


@query("country:s total_sales:m", _place_sql("country"))
def sales_by_country(shop):
    return A.sales_by(_placed(shop), ["country"], "total_sales")


@query("city:s total_sales:m", _place_sql("city"))
def sales_by_city(shop):
    return A.sales_by(_placed(shop), ["city"], "total_sales")


@query("year:i month:i total_sales:m", _grouped('"year", "month"'))
def sales_by_month(shop):
    return A.sales_by(_order_sales(shop), ["year", "month"])


@query("year:i total_sales:m", _grouped('"year"'))
def sales_by_year(shop):
    return A.sales_by(_order_sales(shop), ["year"])


@query("status:s total_sales:m", _grouped("status"))
def sales_by_status(shop):
    return A.sales_by(_order_sales(shop), ["status"])


@query("year:i quarter:i total_sales:m", _grouped('"year", "quarter"'))
def sales_by_quarter(shop):
    return A.sales_by(_order_sales(shop), ["year", "quarter"])


@query(
    "orderdate:s daily_sales:m",
    "SELECT orderdate, sum(total_amount) AS daily_sales FROM m_sales GROUP BY orderdate",
)
def sales_by_day(shop):
    return A.daily_sales(shop.raw["orders"], shop.raw["order_details"])


@query(
    "customerid:i num_orders:i",
    "SELECT customerid, count(*) AS num_orders FROM m_orders GROUP BY customerid",
)
def orders_per_customer(shop):
    return A.orders_per_customer(shop.raw["orders"])


@query(
    "customerid:i num_orders:i",
    "SELECT customerid, count(*) AS num_orders FROM m_orders GROUP BY customerid "
    "HAVING count(*) > 10",
)
def more_than_10_orders(shop):
    return A.orders_per_customer(shop.raw["orders"], 10)


@query(
    "avg_orders_per_month:d",
    """SELECT CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_orders_per_month FROM
       (SELECT "year", "month", count(*) AS n FROM m_orders GROUP BY "year", "month")""",
)
def avg_orders_per_month(shop):
    return A.mean_orders_per_month(shop.raw["orders"])


@query(
    "year:i month:i total_sales:m",
    _grouped('"year", "month"') + ' ORDER BY total_sales DESC, "year", "month" LIMIT 1',
)
def best_month(shop):
    return A.best(sales_by_month(shop), "total_sales", ["year", "month"])


@query(
    "orderdate:s count:i",
    'SELECT orderdate, count(*) AS "count" FROM m_orders GROUP BY orderdate '
    'ORDER BY "count" DESC, orderdate LIMIT 1',
)
def busiest_day(shop):
    daily = shop.raw["orders"].groupBy("orderdate").agg(F.count("*").alias("count"))
    return A.best(daily, "count", ["orderdate"])


@query(
    "min_date:s max_date:s",
    "SELECT min(orderdate) AS min_date, max(orderdate) AS max_date FROM m_orders",
)
def date_bounds(shop):
    return A.date_bounds(shop.raw["orders"])


@query(
    "customers:i",
    "SELECT count(DISTINCT customerid) AS customers FROM m_orders",
)
def distinct_customers(shop):
    return shop.raw["orders"].agg(F.countDistinct("customerid").alias("customers"))


# --- windows and top-k ----------------------------------------------------------------------


def _nth_order(direction: str) -> str:
    return f"""SELECT orderid, customerid, orderdate, status FROM
        (SELECT *, row_number() OVER (PARTITION BY customerid
                ORDER BY orderdate {direction}, orderid {direction}) AS nth FROM m_orders)
        WHERE nth = 1"""


@query(ORDERS, _nth_order("DESC"))
def latest_order(shop):
    order = [F.desc("orderdate"), F.desc("orderid")]
    return W.pick_first(shop.raw["orders"], ["customerid"], order)


@query(ORDERS, _nth_order("ASC"))
def first_order(shop):
    order = [F.asc_nulls_last("orderdate"), F.asc("orderid")]
    return W.pick_first(shop.raw["orders"], ["customerid"], order)


@query(
    "orderid:i shipmentid:s shipdate:s",
    """SELECT orderid, shipmentid, shipdate FROM
       (SELECT *, row_number() OVER (PARTITION BY orderid ORDER BY shipdate DESC, shipmentid DESC)
               AS nth FROM m_shipments) WHERE nth = 1""",
)
def latest_shipment(shop):
    order = [F.desc("shipdate"), F.desc("shipmentid")]
    return W.pick_first(shop.raw["shipments"], ["orderid"], order)


@query(
    "customerid:i total_customer_sales:m sales_rank:i",
    """SELECT *, rank() OVER (ORDER BY total_customer_sales DESC) AS sales_rank FROM
       (SELECT customerid, sum(total_amount) AS total_customer_sales FROM m_sales
        GROUP BY customerid)""",
)
def customer_rank(shop):
    return W.ranked(customer_total(shop), "total_customer_sales", "sales_rank")


@query(
    "orderid:i quantity:i position:i",
    "SELECT orderid, order_total_quantity AS quantity, "
    "rank() OVER (ORDER BY order_total_quantity DESC) AS position FROM m_summary",
)
def customer_rank_ranged(shop):
    """Global rank with long ties: many orders share a total quantity."""
    sums = A.order_summary(shop.raw["order_details"])
    rows = sums.select("orderid", F.col("order_total_quantity").alias("quantity"))
    return W.ranked(rows, "quantity", "position")


def _price_sql(n: int) -> str:
    return f"""SELECT * FROM (SELECT productid, categoryid, price, row_number() OVER
        (PARTITION BY categoryid ORDER BY price DESC, productid) AS price_rank FROM m_products)
        WHERE price_rank <= {n}"""


@query("productid:i categoryid:i price:m price_rank:i", _price_sql(3))
def price_top3(shop):
    order = [F.desc("price"), F.asc("productid")]
    return W.top_n_per_group(shop.raw["products"], ["categoryid"], order, 3, "price_rank")


@query("productid:i categoryid:i price:m", _price_sql(1))
def price_top1(shop):
    return W.pick_first(shop.raw["products"], ["categoryid"], [F.desc("price"), F.asc("productid")])


@query(
    "orderdate:s daily_sales:m running_total:m",
    """SELECT orderdate, daily_sales, sum(daily_sales) OVER (ORDER BY orderdate
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total FROM
       (SELECT orderdate, sum(total_amount) AS daily_sales FROM m_sales GROUP BY orderdate)""",
)
def running_sales(shop):
    return W.running_total(sales_by_day(shop), "orderdate", "daily_sales")


_GROWTH = """SELECT *, lag({v}) OVER w AS prev_sales, {v} - lag({v}) OVER w AS sales_diff,
       CAST({v} - lag({v}) OVER w AS DOUBLE) / nullif(CAST(lag({v}) OVER w AS DOUBLE), 0.0) * 100
         AS growth_pct
FROM (SELECT "year", "month", CAST(sum({m}) AS DECIMAL(38,2)) AS {v} FROM {t}
      GROUP BY "year", "month") WINDOW w AS (ORDER BY "year", "month")"""


@query(
    "year:i month:i total_sales:m prev_sales:m sales_diff:m growth_pct:d",
    _GROWTH.format(v="total_sales", m="total_amount", t="m_sales"),
)
def mom_growth(shop):
    return W.period_growth(sales_by_month(shop), ["year", "month"], "total_sales")


@query(
    "categoryid:i stock:i rank:i productid:i",
    """SELECT * FROM (SELECT categoryid, stock, productid,
              rank() OVER (PARTITION BY categoryid ORDER BY stock DESC) AS "rank" FROM m_products)
       WHERE "rank" <= 3""",
)
def category_top3(shop):
    """Rank in group with many ties: all products sharing a top stock level stay."""
    rows = shop.raw["products"].select("categoryid", "stock", "productid")
    return W.rank_in_group(rows, ["categoryid"], "stock", 3)


@query(
    "customerid:i total_sales:m",
    _BY_CUSTOMER + " ORDER BY total_sales DESC, customerid LIMIT 10",
)
def top10_customers(shop):
    return A.top_k(sales_by_customer(shop), "total_sales", ["customerid"], 10)


@query(
    "productid:i total_sales:m",
    f"""SELECT p.productid, sum(total_amount) AS total_sales FROM {_KNOWN} GROUP BY p.productid
       ORDER BY total_sales DESC, p.productid LIMIT 10""",
)
def top10_products(shop):
    return A.top_k(_product_sales(shop), "total_sales", ["productid"], 10)


@query(
    "categoryid:i total_sales:m",
    f"""SELECT categoryid, sum(total_amount) AS total_sales FROM {_KNOWN} GROUP BY categoryid
       ORDER BY total_sales DESC, categoryid LIMIT 5""",
)
def top5_categories(shop):
    return A.top_k(sales_by_category(shop), "total_sales", ["categoryid"], 5)


# --- unify ----------------------------------------------------------------------------------

_OLD, _NEW = "DATE '2001-01-01'", "DATE '2000-07-01'"


def _split(df: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """Historical and incoming rows by date; half a year of keys is in both."""
    return df.filter(F.col(day) < _day("2001-01-01")), df.filter(F.col(day) >= _day("2000-07-01"))


@query(
    ORDERS,
    f"""SELECT orderid, customerid, orderdate,
               CASE WHEN orderdate >= {_NEW} THEN 'SHIPPED' ELSE status END AS status
        FROM m_orders""",
)
def unify_orders(shop):
    old, new = _split(shop.raw["orders"], "orderdate")
    new = new.withColumn("status", F.lit("SHIPPED"))
    return unify(old, new, ["orderid"], ["orderid", "customerid", "orderdate", "status"])


@query(
    ORDERS,
    f"""SELECT orderid, customerid, orderdate,
               CASE WHEN orderdate >= {_NEW} THEN 'SHIPPED' ELSE status END AS status
        FROM m_orders""",
)
def unify_orders_bucketed(shop):
    """The same with the history as a bucketed table, which the union does not shuffle."""
    columns = ["orderid", "customerid", "orderdate", "status"]
    old, new = _split(shop.raw["orders"], "orderdate")
    path = _scratch(shop)
    name = f"orders_{path.rsplit('/', 1)[1].replace('-', '')}"
    stored = sinks.write_bucketed(old.select(*columns), name, "orderid", 8, path)
    new = new.withColumn("status", F.lit("SHIPPED"))
    return unify(stored, new, ["orderid"], columns, historical_is_unique=True)


@query(
    "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i quantity:i",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity FROM
        (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY src, l_partkey, l_suppkey, quantity) AS nth FROM
          (SELECT 0 AS src, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  CAST(l_quantity AS INTEGER) + 100 AS quantity
           FROM lineitem WHERE CAST(l_shipdate AS DATE) >= {_NEW}
           UNION ALL
           SELECT 1, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)
           FROM lineitem WHERE CAST(l_shipdate AS DATE) < {_OLD}))
        WHERE nth = 1""",
)
def unify_lines(shop):
    """Line numbers repeat within an order here, so this really drops rows."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity"]
    lines = shop.source["lineitem"].withColumns(
        {"quantity": F.col("l_quantity").cast("int"), "day": F.col("l_shipdate").cast("date")}
    )
    old, new = _split(lines, "day")
    new = new.withColumn("quantity", F.col("quantity") + 100)
    return unify(old, new, ["l_orderkey", "l_linenumber"], cols)


@query(
    "paymentid:i orderid:i paymentmethod:s paymentdate:s amount:m",
    f"""SELECT paymentid, orderid, paymentmethod, paymentdate,
               CASE WHEN paymentdate >= {_NEW} THEN amount + 1 ELSE amount END AS amount
        FROM m_payments""",
)
def unify_payments(shop):
    """The stored side is known unique: only its replaced keys are removed."""
    old, new = _split(shop.raw["payments"], "paymentdate")
    new = new.withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)"))
    cols = ["paymentid", "orderid", "paymentmethod", "paymentdate", "amount"]
    return unify(old, new, ["paymentid"], cols, historical_is_unique=True)


@query(
    "shipmentid:s orderid:i shipperid:i shipdate:s deliverydate:s",
    f"""SELECT shipmentid, orderid, shipperid, shipdate, deliverydate FROM
        (SELECT *, row_number() OVER (PARTITION BY shipmentid
                ORDER BY src, orderid, shipperid, shipdate, deliverydate) AS nth FROM
          (SELECT 0 AS src, shipmentid, orderid, -1 AS shipperid, shipdate, deliverydate
           FROM m_shipments WHERE shipdate >= {_NEW}
           UNION ALL
           SELECT 1, shipmentid, orderid, shipperid, shipdate, deliverydate
           FROM m_shipments WHERE shipdate < {_OLD}))
        WHERE nth = 1""",
)
def unify_shipments(shop):
    old, new = _split(shop.raw["shipments"], "shipdate")
    new = new.withColumn("shipperid", F.lit(-1).cast("long"))
    cols = ["shipmentid", "orderid", "shipperid", "shipdate", "deliverydate"]
    return unify(old, new, ["shipmentid"], cols)


# --- events ---------------------------------------------------------------------------------


@query(
    "orderid:i customerid:i orderdate:s status:s event_id:s event_type:s source:s",
    "SELECT orderid, customerid, orderdate, status, 'evt-' || orderid AS event_id, "
    "'ORDER_CREATED' AS event_type, 'shop' AS source FROM m_events",
)
def events_orders(shop):
    return E.event_orders(shop.events["parsed"])


@query(
    "orderid:i orderdetailid:i productid:i quantity:i unitprice:m discount:m",
    """SELECT orderid, orderid + 100000000000 * row_number() OVER (PARTITION BY orderid
                ORDER BY linenumber, productid, supplierid, unitprice, quantity, discount) AS orderdetailid,
              productid, quantity, unitprice, discount
       FROM m_lines WHERE orderid IN (SELECT orderid FROM m_orders)""",
)
def events_lines(shop):
    return E.event_lines(shop.events["parsed"])


@query(
    "paymentid:i orderid:i paymentmethod:s paymentdate:s amount:m paymentstatus:s",
    """SELECT orderid AS paymentid, orderid, lower(u) AS paymentmethod, orderdate AS paymentdate,
              paid AS amount, CASE WHEN s = 'F' THEN 'FAILED' ELSE 'COMPLETED' END AS paymentstatus
       FROM m_events""",
)
def events_payments(shop):
    return E.event_payments(shop.events["parsed"]).withColumn(
        "paymentmethod", F.lower("paymentmethod")
    )


@query(
    "shipmentid:i orderid:i shipperid:i shipdate:s deliverydate:s",
    """SELECT orderid AS shipmentid, orderid, customerid AS shipperid, CAST(leaves AS DATE) AS shipdate,
              CAST(leaves + CAST(travel AS INTEGER) AS DATE) AS deliverydate
       FROM m_events WHERE sent""",
)
def events_shipments(shop):
    return E.event_shipments(shop.events["parsed"])


@query(
    "orderid:i subtotal:m discount:m tax_rate:m tax_amount:m shipping_cost:m total_amount:m",
    """SELECT orderid, subtotal, discount, 0.14 AS tax_rate, tax_amount, shipping_cost,
              subtotal + tax_amount + shipping_cost + slip AS total_amount FROM m_events""",
)
def events_summary(shop):
    return E.event_summary(shop.events["parsed"])


# --- star schema ----------------------------------------------------------------------------


def _table(name: str, columns: str, sql: str) -> None:
    QUERIES[name] = Query(lambda shop: shop.star[name], columns, sql)


_table(
    "dim_customer",
    "customer_id:i first_name:s last_name:s full_name:s email:s city:s country:s registration_date:s",
    """SELECT customerid AS customer_id, firstname AS first_name, lastname AS last_name, full_name,
              email, city, country, registrationdate AS registration_date FROM m_customers""",
)
_table(
    "dim_category",
    "category_id:i category_name:s",
    "SELECT categoryid AS category_id, categoryname AS category_name FROM m_categories",
)
_table(
    "dim_department",
    "department_id:i department_name:s",
    "SELECT r_regionkey AS department_id, r_name AS department_name FROM region",
)
_table(
    "dim_product",
    "product_id:i category_id:i product_name:s brand:s price:m cost:m stock:i",
    """SELECT productid AS product_id, categoryid AS category_id, productname AS product_name,
              brand, price, cost, stock FROM m_products""",
)
_table(
    "dim_supplier",
    "supplier_id:i supplier_name:s country:s",
    """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS country
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
_table(
    "dim_employee",
    "employee_id:i manager_id:i department_id:i first_name:s last_name:s full_name:s salary:m "
    "hire_date:s",
    """SELECT s_suppkey AS employee_id,
              CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS manager_id,
              n_regionkey AS department_id, split_part(s_name, '#', 1) AS first_name,
              split_part(s_name, '#', 2) AS last_name, replace(s_name, '#', ' ') AS full_name,
              CAST(s_acctbal AS DECIMAL(12,2)) AS salary,
              CAST(DATE '1992-01-01' + CAST(s_nationkey AS INTEGER) AS DATE) AS hire_date
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
_table(
    "dim_shipper",
    "shipper_id:i company_name:s",
    "SELECT s_suppkey AS shipper_id, s_name AS company_name FROM supplier",
)
_table(
    "dim_date",
    "date_id:i date:s year:i quarter:i month:i month_name:s day:i day_of_week:i day_name:s "
    "week_of_year:i",
    """SELECT strftime(d, '%Y%m%d') AS date_id, CAST(d AS DATE) AS "date", year(d) AS "year",
              quarter(d) AS "quarter", month(d) AS "month", monthname(d) AS month_name,
              day(d) AS "day", dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name,
              week(d) AS week_of_year
       FROM (SELECT unnest(generate_series(CAST(min(orderdate) AS TIMESTAMP),
                    CAST(max(orderdate) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM m_orders)""",
)
_table(
    "dim_payment_method",
    "payment_method_id:i payment_method:s",
    "SELECT * FROM m_methods",
)
_table("dim_order_status", "order_status_id:i order_status:s", "SELECT * FROM m_statuses")
_table(
    "fact_order",
    "order_id:i customer_id:i date_id:i order_date:s order_status_id:i",
    """SELECT orderid AS order_id, customerid AS customer_id,
              strftime(orderdate, '%Y%m%d') AS date_id, orderdate AS order_date, order_status_id
       FROM m_orders LEFT JOIN m_statuses ON status = order_status""",
)


@query(
    "order_detail_id:s order_id:i product_id:i quantity:i unit_price:m discount:m gross_amount:m "
    "discount_amount:m total_amount:m",
    """SELECT order_detail_id, order_id, product_id, quantity, unit_price, discount, gross_amount,
              discount_amount, net_amount AS total_amount FROM
       (SELECT *, row_number() OVER (PARTITION BY order_detail_id
               ORDER BY order_id, product_id, quantity, unit_price, discount) AS nth FROM m_facts)
       WHERE nth = 1""",
)
def fact_order_detail(shop):
    """With every line delivered twice: the dedup restores one row per line."""
    lines = shop.raw["order_details"]
    return star.fact_order_detail(lines.unionAll(lines))


_table(
    "fact_payment",
    "payment_id:i order_id:i date_id:i payment_date:s payment_method_id:i amount:m",
    """SELECT paymentid AS payment_id, orderid AS order_id,
              strftime(paymentdate, '%Y%m%d') AS date_id, paymentdate AS payment_date,
              payment_method_id, amount
       FROM m_payments LEFT JOIN m_methods ON paymentmethod = payment_method""",
)
_table(
    "fact_shipment",
    "shipment_id:s order_id:i shipper_id:i ship_date:s delivery_date:s shipping_days:i",
    """SELECT shipmentid AS shipment_id, orderid AS order_id, shipperid AS shipper_id,
              shipdate AS ship_date, deliverydate AS delivery_date,
              date_diff('day', shipdate, deliverydate) AS shipping_days FROM m_shipments""",
)
_table(
    "fact_customer_sales",
    "customer_id:i total_orders:i total_quantity:i gross_sales:m total_discount:m total_sales:m "
    "average_order_line:d first_order_date:s last_order_date:s customer_segment:s",
    """SELECT *, CASE WHEN total_sales >= 10000 THEN 'VIP' WHEN total_sales >= 5000 THEN 'PREMIUM'
              WHEN total_sales >= 1000 THEN 'REGULAR' ELSE 'LOW_VALUE' END AS customer_segment
       FROM m_customer_mart""",
)
_table(
    "fact_product_sales",
    "product_id:i total_orders:i units_sold:i gross_sales:m total_discount:m total_sales:m "
    "average_unit_price:d",
    """SELECT product_id, count(DISTINCT order_id) AS total_orders, sum(quantity) AS units_sold,
              sum(gross_amount) AS gross_sales, sum(discount_amount) AS total_discount,
              sum(net_amount) AS total_sales,
              CAST(CAST(sum(unit_price) AS DECIMAL(38,2)) AS DOUBLE)
                / CAST(count(unit_price) AS DOUBLE) AS average_unit_price
       FROM m_facts GROUP BY product_id""",
)
_table(
    "bridge_product_supplier",
    "product_id:i supplier_id:i",
    "SELECT DISTINCT productid AS product_id, supplierid AS supplier_id FROM m_lines",
)


@query(
    "customer_id:i total_sales:m customer_segment:s",
    """SELECT customer_id, total_sales, CASE WHEN total_sales >= 70000000 THEN 'VIP'
              WHEN total_sales >= 50000000 THEN 'PREMIUM' WHEN total_sales >= 30000000 THEN 'REGULAR'
              ELSE 'LOW_VALUE' END AS customer_segment FROM m_customer_mart""",
)
def customer_mart(shop):
    """Customer mart with segment bounds that fit this data."""
    facts = shop.star
    bounds = (70_000_000, 50_000_000, 30_000_000)
    return A.customer_mart(facts["fact_order_detail"], facts["fact_order"], bounds=bounds)


@query(
    "product_id:i total_orders:i total_sales:m",
    """SELECT product_id, count(DISTINCT order_id) AS total_orders, sum(net_amount) AS total_sales
       FROM m_facts GROUP BY product_id""",
)
def product_mart(shop):
    return A.product_mart(shop.star["fact_order_detail"])


@query(
    "mart:s key:i total_sales:m",
    """SELECT 'customer_sales' AS mart, customerid AS "key", sum(total_amount) AS total_sales
       FROM m_wide GROUP BY customerid UNION ALL
       SELECT 'product_sales', productid, sum(total_amount) FROM m_wide GROUP BY productid UNION ALL
       SELECT 'category_sales', categoryid, sum(total_amount) FROM m_wide GROUP BY categoryid
       UNION ALL SELECT 'monthly_sales', "year" * 100 + "month", sum(total_amount) FROM m_wide
       GROUP BY "year", "month" """,
)
def curated_marts(shop):
    """The historical outputs written, and the four marts read back."""
    root = _scratch(shop)
    curated.write_curated(shop.spark, shop.raw, root)
    keys = {
        "customer_sales": F.col("customerid"),
        "product_sales": F.col("productid"),
        "category_sales": F.col("categoryid"),
        "monthly_sales": F.col("year") * 100 + F.col("month"),
    }
    parts = [
        shop.spark.read.parquet(f"{root}/{n}").select(
            F.lit(n).alias("mart"), k.cast("long").alias("key"), "total_sales"
        )
        for n, k in keys.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


# --- reports --------------------------------------------------------------------------------

_REPORT_SQL = {
    "r01_totals": (
        "total_orders:i total_customers:i total_quantity_sold:i total_sales:m",
        """SELECT count(DISTINCT f.order_id) AS total_orders,
                  count(DISTINCT o.customerid) AS total_customers,
                  sum(f.quantity) AS total_quantity_sold, sum(f.net_amount) AS total_sales
           FROM m_facts f LEFT JOIN m_orders o ON f.order_id = o.orderid""",
    ),
    "r02_monthly_sales": (
        "year:i month:i monthly_sales:m monthly_orders:i monthly_quantity:i",
        """SELECT "year", "month", sum(net_amount) AS monthly_sales,
                  count(DISTINCT order_id) AS monthly_orders, sum(quantity) AS monthly_quantity
           FROM m_fact_sales GROUP BY "year", "month" """,
    ),
    "r03_sales_by_category": (
        "category_name:s total_sales:m",
        """SELECT categoryname AS category_name, sum(net_amount) AS total_sales
           FROM m_facts JOIN m_products p ON product_id = productid
           JOIN m_categories c ON p.categoryid = c.categoryid GROUP BY categoryname""",
    ),
    "r04_top_products": (
        "product_name:s total_sales:m",
        """SELECT productname AS product_name, sum(net_amount) AS total_sales
           FROM m_facts JOIN m_products ON product_id = productid
           GROUP BY productname ORDER BY total_sales DESC, productname LIMIT 10""",
    ),
    "r05_top_customers": (
        "customer_name:s total_spending:m",
        """SELECT full_name AS customer_name, total_sales AS total_spending
           FROM m_customer_mart JOIN m_customers ON customer_id = customerid
           ORDER BY total_sales DESC, customer_id LIMIT 10""",
    ),
    "r06_average_order_value": (
        "average_order_value:d",
        """SELECT CAST(CAST(sum(net_amount) AS DECIMAL(38,2)) AS DOUBLE)
                  / CAST(count(DISTINCT order_id) AS DOUBLE) AS average_order_value FROM m_facts""",
    ),
    "r07_orders_by_status": (
        "order_status:s order_count:i",
        "SELECT status AS order_status, count(*) AS order_count FROM m_orders "
        "WHERE status IS NOT NULL GROUP BY status",
    ),
    "r08_payments_by_method": (
        "payment_method:s num_transactions:i total_amount:m avg_payment_amount:d",
        """SELECT paymentmethod AS payment_method, count(*) AS num_transactions,
                  sum(amount) AS total_amount,
                  CAST(CAST(sum(amount) AS DECIMAL(38,2)) AS DOUBLE) / CAST(count(amount) AS DOUBLE)
                    AS avg_payment_amount
           FROM m_payments GROUP BY paymentmethod""",
    ),
    "r09_shipment_performance": (
        "total_shipments:i avg_delivery_days:d min_delivery_days:i max_delivery_days:i",
        """SELECT count(*) AS total_shipments,
                  CAST(sum(d) AS DOUBLE) / CAST(count(d) AS DOUBLE) AS avg_delivery_days,
                  min(d) AS min_delivery_days, max(d) AS max_delivery_days
           FROM (SELECT date_diff('day', shipdate, deliverydate) AS d FROM m_shipments)""",
    ),
    "r10_running_sales": (
        "order_date:s daily_sales:m running_total_sales:m",
        """SELECT order_date, daily_sales, sum(daily_sales) OVER (ORDER BY order_date ROWS BETWEEN
                  UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total_sales
           FROM (SELECT orderdate AS order_date, sum(net_amount) AS daily_sales
                 FROM m_fact_sales GROUP BY orderdate)""",
    ),
    "r11_monthly_growth": (
        "year:i month:i current_sales:m prev_sales:m sales_diff:m growth_pct:d",
        _GROWTH.format(v="current_sales", m="net_amount", t="m_fact_sales"),
    ),
    "r12_category_top3": (
        "category_name:s product_name:s sales:m rank:i",
        """SELECT * FROM (SELECT categoryname AS category_name, productname AS product_name,
                  sum(net_amount) AS sales, rank() OVER (PARTITION BY categoryname
                  ORDER BY sum(net_amount) DESC) AS "rank"
           FROM m_facts JOIN m_products p ON product_id = productid
           JOIN m_categories c ON p.categoryid = c.categoryid
           GROUP BY categoryname, productname) WHERE "rank" <= 3""",
    ),
    "r13_customer_ranking": (
        "customer:s total_spending:m order_count:i rank:i",
        """SELECT full_name AS customer, total_sales AS total_spending, total_orders AS order_count,
                  rank() OVER (ORDER BY total_sales DESC) AS "rank"
           FROM m_customer_mart JOIN m_customers ON customer_id = customerid""",
    ),
}
for _name, (_columns, _sql) in _REPORT_SQL.items():
    QUERIES[_name] = Query(lambda shop, f=reports.REPORTS[_name]: f(shop.star), _columns, _sql)


@query(
    "product_id:i product_name:s total_sales:m",
    """SELECT product_id, productname AS product_name, sum(net_amount) AS total_sales
       FROM m_facts JOIN m_products ON product_id = productid
       GROUP BY product_id, productname ORDER BY total_sales DESC, product_id LIMIT 10""",
)
def r04_top_products_by_id(shop):
    return reports.top_products_by_id(shop.star)


@query(
    "payment_method:s num_transactions:i total_amount:m avg_payment_amount:d",
    """SELECT upper(u) AS payment_method, count(*) AS num_transactions, sum(paid) AS total_amount,
              CAST(CAST(sum(paid) AS DECIMAL(38,2)) AS DOUBLE) / CAST(count(paid) AS DOUBLE)
                AS avg_payment_amount
       FROM m_events WHERE s <> 'F' GROUP BY u""",
)
def r08_completed_payments(shop):
    """Payments of the events, failed ones left out."""
    paid = E.event_payments(shop.events["parsed"])
    methods = shop.star["dim_payment_method"]
    tables = {"fact_payment": star.fact_payment(paid, methods), "dim_payment_method": methods}
    return reports.payments_by_method(tables, completed_only=True)


# --- ingestion ------------------------------------------------------------------------------

_VALID = """SELECT orderid, customerid FROM m_events WHERE NOT (
    (u = '5-LOW' AND s = 'O') OR (u IN ('1-URGENT', '2-HIGH') AND s IN ('F', 'P'))
    OR (u = '3-MEDIUM' AND s = 'P'))"""


# A later version of some orders is delivered as well; it replaces the first.
_LATEST = f"""SELECT orderid, v.customerid, CASE WHEN u = '2-HIGH' AND s = 'O' THEN 'SHIPPED' ELSE status END
    AS status FROM ({_VALID}) v JOIN m_events USING (orderid)"""


def _versions(texts: DataFrame) -> DataFrame:
    """Later versions of confirmed orders of high priority."""
    later = F.regexp_replace("value", "T00:00:00", "T12:00:00")
    sent = F.regexp_replace(later, '"Status":"Confirmed"', '"Status":"Shipped"')
    return texts.filter((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "O")).select(
        sent.alias("value")
    )


def _deliveries(shop):
    """Event texts, every one once, and later versions of some."""
    texts = _damaged_events(shop, "who").select("value", F.inline("who"))
    return texts.select("value"), _versions(texts)


@query("orderid:i customerid:i status:s", _LATEST)
def ingest_batch(shop):
    """Two pulls of a quarter of the orders and one of the rest, later versions before the first ones."""
    target, mark = _scratch(shop), _scratch(shop)
    ingest.save_mark(shop.spark, mark, -1)
    texts, later = _deliveries(shop)
    both = later.unionAll(texts)
    orders = shop.source["orders"].count()
    ingest.ingest_batch(both, target, mark, limit=max(100, orders // 4))
    ingest.ingest_batch(both, target, mark, limit=max(100, orders // 4))
    ingest.ingest_batch(both, target, mark, limit=None)
    return E.event_orders(ingest.stored_events(shop.spark, target))


def _landed(shop) -> str:
    """All deliveries landed in two batches, the first version of an order after the later one."""
    root = _scratch(shop)
    texts, later = _deliveries(shop)
    landing.land(later, root, "later", ids_per_folder=IDS_PER_FOLDER)
    landing.land(texts, root, "first", ids_per_folder=IDS_PER_FOLDER)
    return root


@query(
    "orderid:i documents:i",
    f"""SELECT orderid, CASE WHEN u = '2-HIGH' AND s = 'O' THEN 2 ELSE 1 END AS documents
        FROM ({_VALID}) v JOIN m_events USING (orderid) WHERE orderid >= 100 ORDER BY orderid LIMIT 1000""",
)
def pull_landed(shop):
    """A pull of 1,000 whole orders from a landing of two batches, by its manifest."""
    pulled = landing.pull(shop.spark, _landed(shop), 100, 1000)
    return pulled.documents.groupBy("orderid").agg(F.count("*").alias("documents"))


@query("orderid:i customerid:i status:s", _LATEST)
def ingest_landed(shop):
    """Two pulls from a landing, then, as one batch, what the pulls have not come to."""
    root, target, mark = _landed(shop), _scratch(shop), _scratch(shop)
    ingest.save_mark(shop.spark, mark, -1)
    for _ in range(2):
        ingest.ingest_landed(shop.spark, root, target, mark)
    rest = shop.spark.read.schema(f"{landing.LANDED}, batch string, id_bucket long").parquet(f"{root}/data")
    ingest.ingest_batch(rest, target, mark, limit=None)
    return E.event_orders(ingest.stored_events(shop.spark, target))


@query("orderid:i customerid:i status:s", _LATEST)
def ingest_compacted(shop):
    """First versions ingested and compacted, later ones of some orders delivered, and compacted again."""
    target, marks = _scratch(shop), _scratch(shop)
    texts, later = _deliveries(shop)
    for number, delivery in enumerate((texts, later)):
        ingest.save_mark(shop.spark, f"{marks}/{number}", -1)
        ingest.ingest_batch(delivery, target, f"{marks}/{number}", limit=None)
        ingest.compact(shop.spark, target)
    return E.event_orders(ingest.stored_events(shop.spark, target))


@query("orderid:i customerid:i status:s", _LATEST)
def ingest_stream(shop):
    """Landed JSON lines taken as a stream, then delivered again with later versions in new files."""
    landing, target, checkpoint = _scratch(shop), _scratch(shop), _scratch(shop)
    texts, later = _deliveries(shop)
    for delivery in (texts, texts.unionAll(later)):
        sinks.write_texts(delivery, landing, "append")
        ingest.ingest_stream(
            shop.spark, landing, target, checkpoint, whole_files=False
        ).awaitTermination()
    return E.event_orders(ingest.stored_events(shop.spark, target))


@query(
    "run:i message:s received:i uploaded:i replaced:i skipped:i quarantined:i previous_mark:i new_mark:i",
    f"""WITH valid AS ({_VALID}), counted AS (
          SELECT (SELECT count(*) FROM valid) AS n, (SELECT max(orderid) FROM valid) AS top,
                 (SELECT count(*) FROM m_events) AS total,
                 (SELECT max(CASE WHEN u = '2-HIGH' AND s = 'P' THEN 1 ELSE 0 END) FROM m_events) AS junk,
                 (SELECT sum(CASE WHEN u = '2-HIGH' AND s = 'P' THEN 1 ELSE 0 END) FROM m_events) AS copies)
        SELECT 1 AS run, 'Orders processed' AS message, n AS received, n AS uploaded, 0 AS replaced,
               0 AS skipped, total - n - copies + junk AS quarantined, -1 AS previous_mark, top AS new_mark
        FROM counted
        UNION ALL
        SELECT 2, 'No new orders', 0, 0, 0, n, 0, top, top FROM counted""",
)
def ingest_summary(shop):
    """What two pulls report: the second finds every order below the mark."""
    target, mark = _scratch(shop), _scratch(shop)
    ingest.save_mark(shop.spark, mark, -1)
    texts, _ = _deliveries(shop)
    runs = [ingest.ingest_batch(texts, target, mark, limit=None) for _ in range(2)]
    return reduce(DataFrame.unionAll, [r.withColumn("run", F.lit(i)) for i, r in enumerate(runs, 1)])


@query("orderid:i customerid:i status:s", _LATEST)
def ingest_stream_keyed(shop):
    """Later versions first, then all first ones and again the later: versions are told apart by the stream's state."""
    landed, target, checkpoint = _scratch(shop), _scratch(shop), _scratch(shop)
    texts, later = _deliveries(shop)
    for delivery in (later, texts.unionAll(later)):
        sinks.write_texts(delivery, landed, "append")
        ingest.ingest_stream_keyed(shop.spark, landed, target, checkpoint, whole_files=False).awaitTermination()
    return E.event_orders(ingest.stored_events(shop.spark, target))


# --- marts by delta -------------------------------------------------------------------------


def _taken(shop) -> str:
    """Marts that took three deliveries: orders of the wrong customer, day and lines; every third order mended and
    every fifth emptied; the rest, and again what was emptied, as it should be."""
    root = _scratch(shop)
    lines, orders = shop.star["fact_order_detail"], shop.star["fact_order"]
    third, fifth = F.col("order_id") % 3 == 0, F.col("order_id") % 5 == 0
    wrong = orders.withColumns({"customer_id": F.col("customer_id") + 1, "order_date": F.date_add("order_date", -40)})
    deltas.apply(shop.spark, root, 1, lines.filter(F.col("quantity") % 2 == 0), wrong, IDS_PER_FOLDER, 16)
    deltas.apply(shop.spark, root, 2, lines.filter(~fifth), orders.filter(third | fifth), IDS_PER_FOLDER)
    deltas.apply(shop.spark, root, 3, lines, orders.filter(~third | fifth), IDS_PER_FOLDER)
    return root


@query(
    "customer_id:i total_orders:i total_quantity:i gross_sales:m total_discount:m total_sales:m average_order_line:d "
    "first_order_date:s last_order_date:s",
    "SELECT * FROM m_customer_mart",
)
def customer_mart_by_delta(shop):
    """The customer mart after three deliveries that correct each other."""
    return deltas.customer_mart(shop.spark, _taken(shop))


@query(
    "product_id:i total_orders:i units_sold:i gross_sales:m total_discount:m total_sales:m average_unit_price:d",
    """SELECT product_id, count(DISTINCT order_id) AS total_orders, sum(quantity) AS units_sold,
              sum(gross_amount) AS gross_sales, sum(discount_amount) AS total_discount, sum(net_amount) AS total_sales,
              CAST(CAST(sum(unit_price) AS DECIMAL(38,2)) AS DOUBLE) / CAST(count(unit_price) AS DOUBLE) AS average_unit_price
       FROM m_facts WHERE order_id IN (SELECT orderid FROM m_orders) GROUP BY product_id""",
)
def product_mart_by_delta(shop):
    """The product mart after three deliveries that correct each other."""
    return deltas.product_mart(shop.spark, _taken(shop))


# --- history and events to a written star ---------------------------------------------------

_HISTORY = "orderid % 2 = 0"  # orders of the history; the others arrive as events, every third order in both
_ARRIVED = "(orderid % 2 = 1 OR orderid % 3 = 0)"


def _history(shop):
    """The raw history: even orders with their lines, payments and shipments."""
    lines = shop.event_lines().withColumn("orderdetailid", F.col("orderdetailid").cast("long"))
    raw = {n: shop.raw[n] for n in _RAW}
    raw["orders"] = raw["orders"].filter(_HISTORY)
    raw["order_details"] = curated.gross_lines(lines.filter(_HISTORY))
    raw["payments"] = raw["payments"].filter(_HISTORY)
    one = raw["shipments"].groupBy("orderid").agg(
        *[F.min(c).alias(c) for c in ("shipperid", "shipdate", "deliverydate")]
    )
    sent = one.withColumn("shipmentid", F.col("orderid"))
    raw["shipments"] = sent.select("shipmentid", "orderid", "shipperid", "shipdate", "deliverydate").filter(_HISTORY)
    return raw


def _unified(shop):
    events = shop.events["parsed"].withColumn("orderid", F.col("order.OrderID")).filter(_ARRIVED)
    history = _history(shop)
    return history, events, curated.unify_history(history, events)


@query(
    "table:s before:i incoming:i after:i",
    f"""SELECT 'orders' AS "table", sum(CASE WHEN {_HISTORY} THEN 1 ELSE 0 END) AS "before",
               sum(CASE WHEN {_ARRIVED} THEN 1 ELSE 0 END) AS incoming, count(*) AS "after" FROM m_orders
        UNION ALL
        SELECT 'order_details', sum(CASE WHEN {_HISTORY} THEN 1 ELSE 0 END),
               sum(CASE WHEN {_ARRIVED} THEN 1 ELSE 0 END), count(*) FROM m_lines
        UNION ALL
        SELECT 'payments', sum(CASE WHEN {_HISTORY} THEN 1 ELSE 0 END),
               sum(CASE WHEN {_ARRIVED} THEN 1 ELSE 0 END), count(*) FROM m_payments
        UNION ALL
        SELECT 'shipments', sum(CASE WHEN {_HISTORY} AND l.k IS NOT NULL THEN 1 ELSE 0 END),
               sum(CASE WHEN {_ARRIVED} AND sent THEN 1 ELSE 0 END),
               sum(CASE WHEN ({_HISTORY} AND l.k IS NOT NULL) OR ({_ARRIVED} AND sent) THEN 1 ELSE 0 END)
        FROM m_events LEFT JOIN (SELECT DISTINCT orderid AS k FROM m_lines) l ON orderid = l.k""",
)
def union_counts(shop):
    """Rows of the history, of the events and of both merged, for each of the four merged tables."""
    history, events, merged = _unified(shop)
    return curated.union_counts(history, events, merged)


@query(
    "year:i month:i status:s orders:i sales:m",
    f"""SELECT "year", "month", CASE WHEN {_ARRIVED} THEN e.status ELSE o.status END AS status,
               count(DISTINCT order_id) AS orders, sum(net_amount) AS sales
        FROM m_facts f JOIN m_orders o ON f.order_id = o.orderid JOIN m_events e USING (orderid)
        GROUP BY ALL""",
)
def star_with_events(shop):
    """The whole job: history and events merged, seventeen tables written, a report over what was written."""
    root = _scratch(shop)
    _, _, merged = _unified(shop)
    names = curated.write_star(shop.spark, merged, root)
    sinks.register_views(shop.spark, star.read_star(shop.spark, root, names))
    return shop.spark.sql(
        """SELECT d.year, d.month, s.order_status AS status, count(DISTINCT o.order_id) AS orders,
                  sum(l.total_amount) AS sales
           FROM fact_order_detail l JOIN fact_order o USING (order_id) JOIN dim_date d USING (date_id)
           JOIN dim_order_status s USING (order_status_id) GROUP BY ALL"""
    )
