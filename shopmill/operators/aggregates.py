"""Aggregations and marts.

Lines are summed per order before they meet order headers: map-side partial sums fold a hot
order or product first, the join then sees one row per order, and "distinct orders" is a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.functions.measures import customer_segment, from_cents, to_cents
from shopmill.operators.scale import SALTS, skew_join

TOTAL = "decimal(38,2)"
WIDE = "decimal(38,0)"
MILLION = 1_000_000


def cents(column: str, alias: str | None = None) -> Column:
    """Sum of a stored amount (decimal, two places, up to 15 digits) as whole cents, ``decimal(38,0)``.

    Millions of cents and the rest are summed apart as longs, which stay primitive in generated code and
    hold 10^10 rows of the largest amount in one group; only the two sums are decimals.
    """
    whole = to_cents(F.col(column))
    high = F.sum(F.call_function("div", whole, F.lit(MILLION))).cast("decimal(31,0)")
    low = F.sum(whole % MILLION)
    return (high * F.lit(MILLION) + low).cast(WIDE).alias(alias or column)


def total(df: DataFrame, column: str, alias: str | None = None) -> Column:
    """Exact money sum, ``decimal(38,2)``. A column without decimal places holds cents already summed."""
    kind = df.schema[column].dataType
    decimal = isinstance(kind, T.DecimalType)
    if isinstance(kind, T.IntegralType) or decimal and kind.scale == 0:
        summed = from_cents(F.sum(F.col(column).cast(WIDE)), 38)
    elif decimal and kind.precision <= 15 and kind.scale <= 2:
        summed = from_cents(cents(column), 38)
    else:
        summed = F.sum(column).cast(TOTAL)
    return summed.alias(alias or column)


def order_summary(lines: DataFrame) -> DataFrame:
    return lines.groupBy("orderid").agg(
        total(lines, "total_amount", "order_total_amount"),
        F.sum("quantity").alias("order_total_quantity"),
    )


def order_sales(orders: DataFrame, lines: DataFrame, measure: str = "total_amount") -> DataFrame:
    """Order headers with the sum of their lines in ``cents``: one row per order with lines."""
    sums = lines.groupBy("orderid").agg(cents(measure, "cents"))
    return orders.join(sums, "orderid")


def customer_total(orders: DataFrame, summary: DataFrame) -> DataFrame:
    joined = orders.join(summary, "orderid")
    return joined.groupBy("customerid").agg(
        total(joined, "order_total_amount", "total_customer_sales")
    )


def mean_of(df: DataFrame, column: str, alias: str) -> DataFrame:
    mean = F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0)).cast("double")
    return df.agg(mean.alias(alias))


def global_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row: sales, orders, quantity and the mean order total over orders with lines."""
    per_order = lines.groupBy("orderid").agg(
        cents("total_amount", "sales"), F.sum("quantity").alias("quantity")
    )
    whole = total(per_order, "sales")
    sums = per_order.agg(
        whole.alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        (whole.cast("double") / F.nullif(F.count("sales"), F.lit(0)).cast("double")).alias(
            "avg_order_value"
        ),
    )
    counted = orders.agg(F.count("orderid").alias("total_orders"))
    parts = sums.unionByName(counted, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def sales_by(sales: DataFrame, keys: Sequence[str], measure: str = "cents") -> DataFrame:
    """Sum of a money column, or of cents from ``order_sales``, by the given columns."""
    return sales.groupBy(*keys).agg(total(sales, measure, "total_sales"))


def sales_by_customer(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per customer over lines of known orders and known products.

    Lines are cut to known products before they are summed per order.
    """
    known = skew_join(lines, products, "productid", "left_semi", "right")
    return sales_by(order_sales(orders, known), ["customerid"])


def sales_by_product(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per known product over lines of known orders, with the product's category."""
    known = skew_join(lines, orders, "orderid", "left_semi", "right")
    per_product = known.groupBy("productid").agg(total(known, "total_amount", "total_sales"))
    return per_product.join(products.select("productid", "categoryid"), "productid")


def orders_per_customer(orders: DataFrame, min_orders: int | None = None) -> DataFrame:
    """Orders per customer; with ``min_orders``, only customers with more than that many."""
    counts = orders.groupBy("customerid").agg(F.count("*").alias("num_orders"))
    return counts if min_orders is None else counts.filter(F.col("num_orders") > min_orders)


def mean_orders_per_month(orders: DataFrame) -> DataFrame:
    """Mean over months that have orders."""
    monthly = orders.groupBy("year", "month").agg(F.count("*").alias("n"))
    return monthly.agg(
        (F.sum("n").cast("double") / F.count("*").cast("double")).alias("avg_orders_per_month")
    )


def top_k(df: DataFrame, score: str, tie: Sequence[str], k: int) -> DataFrame:
    """The ``k`` best rows; each task keeps ``k`` (TakeOrderedAndProject)."""
    return df.orderBy(F.col(score).desc_nulls_last(), *[F.asc_nulls_last(t) for t in tie]).limit(k)


def best(df: DataFrame, score: str, tie: Sequence[str]) -> DataFrame:
    return top_k(df, score, tie, 1)


def date_bounds(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("orderdate").isNotNull()).agg(
        F.min("orderdate").alias("min_date"), F.max("orderdate").alias("max_date")
    )


_AMOUNTS = {
    "gross_amount": "gross_sales",
    "discount_amount": "total_discount",
    "total_amount": "total_sales",
}


def customer_mart(fact_lines: DataFrame, fact_orders: DataFrame, **segment) -> DataFrame:
    """Per customer: orders, quantity, amounts, mean line, first and last order, segment.

    ``fact_orders`` has one row per order; lines without an order drop out.
    """
    per_order = fact_lines.groupBy("order_id").agg(
        F.sum("quantity").alias("quantity"),
        *[cents(c, alias) for c, alias in _AMOUNTS.items()],
        F.count("total_amount").alias("lines"),
    )
    joined = per_order.join(
        fact_orders.select("order_id", "customer_id", "order_date"), "order_id"
    )
    sums = joined.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        *[total(joined, alias) for alias in _AMOUNTS.values()],
        F.sum("lines").alias("lines"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    mean = F.col("total_sales").cast("double") / F.nullif("lines", F.lit(0)).cast("double")
    return sums.select(
        "customer_id",
        "total_orders",
        "total_quantity",
        *_AMOUNTS.values(),
        mean.alias("average_order_line"),
        "first_order_date",
        "last_order_date",
        customer_segment(F.col("total_sales"), **segment).alias("customer_segment"),
    )


def product_mart(fact_lines: DataFrame, hot: Column | None = None) -> DataFrame:
    """Per product: orders, units, amounts, mean unit price.

    Summed per (product, order) first, so a hot product is spread over its orders. With ``hot``, the array of hot products
    (``scale.hot_keys``), only these are spread; lines of any other product meet in one task, which sums them to one row.
    """
    keys = ["product_id"]
    if hot is not None:
        part = F.pmod(F.xxhash64("order_id"), F.lit(SALTS)).cast("int")
        is_hot = F.coalesce(F.array_contains(hot, F.col("product_id")), F.lit(False))
        fact_lines = fact_lines.select(
            *["product_id", "order_id", "quantity", *_AMOUNTS, "unit_price"], F.when(is_hot, part).otherwise(0).alias("_part")
        ).repartition("product_id", "_part")
        keys = ["product_id", "_part"]
    per_pair = fact_lines.groupBy(*keys, "order_id").agg(
        F.sum("quantity").alias("units_sold"),
        *[cents(c, alias) for c, alias in _AMOUNTS.items()],
        cents("unit_price", "price_sum"),
        F.count("unit_price").alias("prices"),
    )
    sums = per_pair.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("units_sold").alias("units_sold"),
        *[total(per_pair, alias) for alias in (*_AMOUNTS.values(), "price_sum")],
        F.sum("prices").alias("prices"),
    )
    mean = F.col("price_sum").cast("double") / F.nullif("prices", F.lit(0)).cast("double")
    return sums.select(
        "product_id",
        "total_orders",
        "units_sold",
        *_AMOUNTS.values(),
        mean.alias("average_unit_price"),
    )


def daily_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    sales = order_sales(orders, lines)
    return sales.groupBy("orderdate").agg(total(sales, "cents", "daily_sales"))


