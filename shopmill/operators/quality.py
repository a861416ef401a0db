"""Data-quality checks. Each returns a DataFrame of findings; none prints or raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.functions.measures import day_span
from shopmill.operators.scale import skew_join
from shopmill.schemas import FOREIGN_KEYS, KEYS

# Fixed values of the order service.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
HISTORICAL_STATUSES = ("PENDING", "SHIPPED", "DELIVERED", "CANCELLED")
ALL_STATUSES = ("PENDING", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED")
PAYMENT_METHODS = ("CREDIT CARD", "DEBIT CARD", "CASH ON DELIVERY", "PAYPAL", "BANK TRANSFER")
TAX_RATE = "0.14"
SHIPPING_COST = 50
REQUEST_LIMITS = {
    "customer_min": 1,
    "customer_max": 500_000,
    "quantity_max": 100,
    "discount_max": 100,
    "items_max": 20,
}


# --- profiles -------------------------------------------------------------------------------


def profile_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, in a single job."""
    rows = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, rows)


def profile_schema(tables: Mapping[str, DataFrame]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for f in df.schema.fields
    ]
    return spark.createDataFrame(rows, "table string, column string, type string, nullable boolean")


def profile_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Schema listing with row and NULL counts per column: one aggregate per table."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
        rows = [
            F.struct(
                F.lit(name).alias("table"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("rows"),
                (F.col("_rows") - F.col(f.name)).alias("nulls"),
            )
            for f in df.schema.fields
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, parts)


def null_sums(df: DataFrame) -> DataFrame:
    """NULLs per column as a sum of flags: NULL, not 0, on empty input."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column as a conditional count: 0 on empty input."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


# --- row predicates -------------------------------------------------------------------------


def invalid_email(df: DataFrame, column: str, pattern: str = EMAIL) -> DataFrame:
    """Rows whose address does not match; a NULL address is missing, not invalid."""
    return df.filter(~F.col(column).rlike(pattern))


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def out_of_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(list(allowed)))


def nonpositive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.col(column) <= 0))


# --- references -----------------------------------------------------------------------------


def fk_report(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    amount: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """One row: child rows, rows without a parent, and the amount an inner join would lose.

    The child is summed per key first, so a hot key reaches the join as one row.
    """
    lost = F.sum(amount) if amount else F.lit(None).cast("decimal(14,2)")
    per_key = child.groupBy(F.col(child_key).alias("_key")).agg(
        F.count("*").alias("n"), lost.alias("amount")
    )
    known = parent.select(F.col(parent_key).alias("_key")).distinct().withColumn("hit", F.lit(1))
    missed = F.col("hit").isNull()
    return per_key.join(known, "_key", "left").agg(
        F.lit(name or f"{child_key}->{parent_key}").alias("fk"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(missed, F.col("n"))), F.lit(0)).alias("unmatched"),
        F.sum(F.when(missed, F.col("amount"))).cast("decimal(38,2)").alias("lost_amount"),
    )


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``fk_report`` for every foreign key of the model whose two tables are given."""
    parts = []
    for child, key, parent, amount in FOREIGN_KEYS:
        if child in tables and parent in tables:
            name = f"{child}.{key}"
            parts.append(
                fk_report(tables[child], tables[parent], key, KEYS[parent][0], amount, name)
            )
    return reduce(DataFrame.unionAll, parts)


# --- event rules ----------------------------------------------------------------------------


def _cents(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def reconcile_events(events: DataFrame, tax: str = TAX_RATE, tol: str = "0.01") -> DataFrame:
    """Amounts an event states against those its lines imply, where they differ.

    Each step is rounded half up in decimals. The sender computes in binary floats, so a
    difference up to ``tol`` per line is not reported. Each document is checked by itself, its lines folded
    inside it; equal findings of a document delivered twice are one.
    """
    zero = F.lit(Decimal("0.00")).cast("decimal(18,2)")
    line_gross = lambda d: _cents(d["Quantity"] * d["UnitPrice"])
    line_off = lambda d: _cents(line_gross(d) * d["Discount"] * F.lit(Decimal("0.01")))
    lines = F.col("order_details")
    per_doc = events.select(
        F.col("order.OrderID").alias("orderid"),
        F.size(lines).alias("n"),
        F.aggregate(lines, zero, lambda a, d: _cents(a + line_gross(d) - line_off(d))).alias("net"),
        F.aggregate(lines, zero, lambda a, d: _cents(a + line_off(d))).alias("off"),
        "summary.*",
        F.col("shipment").isNotNull().alias("sent"),
        F.col("payment.Amount").alias("paid"),
    )
    stated = F.col("shipping_cost")
    flat = F.lit(SHIPPING_COST).cast("decimal(12,2)")
    shipping = F.when(F.col("sent") | (stated != 0), flat).otherwise(stated)
    tax_amount = _cents(F.col("net") * F.lit(Decimal(tax)))
    checks = [
        ("subtotal", F.col("net"), F.col("subtotal")),
        ("discount", F.col("off"), F.col("discount")),
        ("tax_rate", F.lit(Decimal(tax)), F.col("tax_rate")),
        ("tax_amount", tax_amount, F.col("tax_amount")),
        ("shipping_cost", shipping, stated),
        ("total_amount", F.col("net") + tax_amount + shipping, F.col("total_amount")),
        ("payment_amount", F.col("total_amount"), F.col("paid")),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("field"), _cents(e).alias("expected"), _cents(a).alias("actual")
            )
            for n, e, a in checks
        ]
    )
    allowed = F.when(F.col("field") == "tax_rate", F.lit(0)).otherwise(F.greatest("n", F.lit(1)))
    found = per_doc.select("orderid", "n", F.inline(rows))
    return found.filter(
        F.abs(F.col("expected") - F.col("actual")) > allowed * F.lit(Decimal(tol))
    ).select("orderid", "field", "expected", "actual").distinct()


def _paid(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("order.OrderID").alias("orderid"),
        F.upper(F.trim("order.Status")).alias("actual"),
        (F.upper(F.trim("payment.PaymentStatus")) == "COMPLETED").alias("paid"),
        (F.col("summary.shipping_cost") > 0).alias("to_ship"),
        F.try_to_date("order.OrderDate").alias("ordered"),
        F.col("shipment").isNotNull().alias("sent"),
        F.try_to_date("shipment.ShipDate").alias("shipped"),
        F.try_to_date("shipment.DeliveryDate").alias("delivered"),
    )


def status_mismatch(events: DataFrame) -> DataFrame:
    """Events whose status does not follow from payment and shipping."""
    expected = (
        F.when(~F.col("paid"), "CANCELLED").when(F.col("to_ship"), "CONFIRMED").otherwise("PROCESSING")
    )
    checked = _paid(events).withColumn("expected", expected)
    return checked.filter(F.col("expected") != F.col("actual")).select("orderid", "expected", "actual")


def _reasons(rules: Mapping[str, Column]) -> Column:
    """Codes of the rules that hold, in the order given."""
    return F.filter(
        F.array(*[F.when(rule, F.lit(code)) for code, rule in rules.items()]),
        lambda r: r.isNotNull(),
    )


def shipment_rules(events: DataFrame) -> DataFrame:
    """Shipment exists iff paid and to be shipped; leaves next day; arrives 2 to 5 days later."""
    due = F.col("paid") & F.col("to_ship")
    rules = {
        "shipment_missing": due & ~F.col("sent"),
        "shipment_unexpected": ~due & F.col("sent"),
        "ship_date_not_next_day": day_span(F.col("ordered"), F.col("shipped")) != 1,
        "delivery_not_2_to_5_days": ~day_span(F.col("shipped"), F.col("delivered")).between(2, 5),
    }
    return (
        _paid(events)
        .select("orderid", _reasons(rules).alias("reasons"))
        .filter(F.size("reasons") > 0)
    )


_EVENT_PARTS = ("order", "order_details", "payment", "shipment", "summary")


_LAST_KEY = "spark.sql.variant.allowDuplicateKeys"


def _parsed(raw: DataFrame, column: str) -> DataFrame:
    """``raw`` with its text as a variant; of a key repeated in an object the last counts, as when events are typed.

    The setting is read when the expression is resolved, here; the session keeps its own for everything else.
    """
    conf = raw.sparkSession.conf
    own = conf.get(_LAST_KEY, None)
    conf.set(_LAST_KEY, "true")
    try:
        return raw.withColumn("_v", F.try_parse_json(column))
    finally:
        conf.unset(_LAST_KEY) if own is None else conf.set(_LAST_KEY, own)


def judge_events(raw: DataFrame, column: str = "value") -> DataFrame:
    """Raw event text with its order id and the codes of broken and doubtful structure.

    Each text is parsed once, to a variant; types are those of JSON, so a text that looks like a list is none. Only an object
    can be had as a struct and only a list as an array, whatever lies in them, so nothing inside the parts is looked at.
    """
    parsed = _parsed(raw, column)
    fields = ", ".join(f"{p}: variant" for p in _EVENT_PARTS)
    parts = parsed.withColumn("_doc", F.try_variant_get("_v", "$", f"struct<{fields}>"))
    parts = parts.withColumn("_order", F.try_variant_get("_doc.order", "$", "struct<OrderID: variant>"))
    id_text = F.try_variant_get("_order.OrderID", "$", "string")
    parts = parts.withColumn("orderid", id_text.try_cast("long"))
    has = lambda key: F.col(f"_doc.{key}").isNotNull()
    whole = F.col("_doc").isNotNull()
    order_ok = F.col("_order").isNotNull()
    id_given = F.col("_order.OrderID").isNotNull()
    listed = F.try_variant_get("_doc.order_details", "$", "array<boolean>").isNotNull()
    errors = {
        "not_an_object": ~whole,
        "order_missing": whole & ~has("order"),
        "order_not_an_object": has("order") & ~order_ok,
        "order_id_missing": order_ok & ~id_given,
        "order_id_not_an_integer": id_given & F.col("orderid").isNull(),
        "order_details_missing": whole & ~has("order_details"),
        "order_details_not_a_list": has("order_details") & ~listed,
    }
    warnings = {f"{k}_missing": whole & ~has(k) for k in ("payment", "shipment", "summary")}
    return parts.select(
        *raw.columns,
        "orderid",
        _reasons(errors).alias("errors"),
        _reasons(warnings).alias("warnings"),
    )


def validate_events(raw: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, quarantine, warnings) of raw event text; a key present with null is no warning."""
    judged = judge_events(raw, column)
    sound = F.size("errors") == 0
    return (
        judged.filter(sound).select(*raw.columns, "orderid"),
        judged.filter(~sound).drop("warnings"),
        judged.filter(sound & (F.size("warnings") > 0)).select("orderid", "warnings"),
    )


def request_rules(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    limits: Mapping[str, int] | None = None,
    methods: Sequence[str] = PAYMENT_METHODS,
) -> DataFrame:
    """Orders that an order request check would refuse, with reason codes."""
    lim = REQUEST_LIMITS | dict(limits or {})
    # The distinct product ids shrink before any shuffle; the lines then meet only the unknown ones.
    sold = lines.select("productid").distinct()
    unknown = skew_join(sold, products, "productid", "left_anti", "right")
    checked = skew_join(
        lines.select("orderid", "productid", "quantity", "discount"),
        unknown.withColumn("unknown", F.lit(True)),
        "productid",
        "left",
        "right",
    )
    per_order = checked.groupBy("orderid").agg(
        F.count("*").alias("items"),
        F.bool_or(F.col("unknown").isNotNull() | F.col("productid").isNull()).alias("unknown"),
        F.bool_or(~F.col("quantity").between(1, lim["quantity_max"])).alias("bad_quantity"),
        F.bool_or(~F.col("discount").between(0, lim["discount_max"])).alias("bad_discount"),
    )
    method = F.upper(F.trim("paymentmethod"))
    per_payment = payments.groupBy("orderid").agg(
        F.bool_or(~method.isin(list(methods))).alias("bad_method")
    )
    rules = {
        "customer_out_of_range": ~F.col("customerid").between(
            lim["customer_min"], lim["customer_max"]
        ),
        "item_count_out_of_range": ~F.coalesce("items", F.lit(0)).between(1, lim["items_max"]),
        "product_unknown": F.col("unknown"),
        "quantity_out_of_range": F.col("bad_quantity"),
        "discount_out_of_range": F.col("bad_discount"),
        "payment_method_not_allowed": F.col("bad_method"),
    }
    return (
        orders.select("orderid", "customerid")
        .join(per_order, "orderid", "left")
        .join(per_payment, "orderid", "left")
        .select("orderid", _reasons(rules).alias("reasons"))
        .filter(F.size("reasons") > 0)
    )
