"""The thirteen reports over the star schema, as DataFrame plans.

Facts are summed by their own key before they meet a dimension, which is the same total with one
row per order or product in the join. Ordering is part of each report.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill.functions.measures import from_cents, strict_name
from shopmill.operators.aggregates import cents, top_k, total
from shopmill.operators.windows import period_growth, rank_in_group, ranked, running_total

Star = Mapping[str, DataFrame]


def _ratio(top: str, bottom: str):
    return F.col(top).cast("double") / F.nullif(F.col(bottom), F.lit(0)).cast("double")


def _per_order(star: Star) -> DataFrame:
    """Sales in cents and quantity of each order that has lines."""
    return star["fact_order_detail"].groupBy("order_id").agg(
        cents("total_amount", "sales"), F.sum("quantity").alias("quantity")
    )


def _per_product(star: Star) -> DataFrame:
    """Sales in cents of each known product with its name and category id."""
    sums = star["fact_order_detail"].groupBy("product_id").agg(cents("total_amount", "sales"))
    names = star["dim_product"].select("product_id", "product_name", "category_id")
    return sums.join(names, "product_id")


def _sales_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("sales").alias("sales"))


def _per_customer(star: Star) -> DataFrame:
    names = star["dim_customer"].select(
        "customer_id", strict_name(F.col("first_name"), F.col("last_name")).alias("name")
    )
    return star["fact_customer_sales"].join(names, "customer_id")


def _monthly(star: Star) -> DataFrame:
    orders = star["fact_order"].select("order_id", "date_id")
    daily = (
        _per_order(star)
        .join(orders, "order_id")
        .groupBy("date_id")
        .agg(
            F.sum("sales").alias("sales"),
            F.count("order_id").alias("orders"),
            F.sum("quantity").alias("quantity"),
        )
    )
    dated = daily.join(star["dim_date"].select("date_id", "year", "month"), "date_id")
    return dated.groupBy("year", "month").agg(
        total(dated, "sales", "monthly_sales"),
        F.sum("orders").alias("monthly_orders"),
        F.sum("quantity").alias("monthly_quantity"),
    )


def totals(star: Star) -> DataFrame:
    """Overall orders, customers, quantity and sales. Lines of unknown orders still count."""
    orders = star["fact_order"].select("order_id", "customer_id")
    joined = _per_order(star).join(orders, "order_id", "left")
    return joined.agg(
        F.count("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("total_customers"),
        F.sum("quantity").alias("total_quantity_sold"),
        total(joined, "sales", "total_sales"),
    )


def monthly_sales(star: Star) -> DataFrame:
    return _monthly(star).orderBy("year", "month")


def sales_by_category(star: Star) -> DataFrame:
    per_category = _sales_by(_per_product(star), "category_id")
    named = per_category.join(star["dim_category"], "category_id")
    sums = named.groupBy("category_name").agg(total(named, "sales", "total_sales"))
    return sums.orderBy(F.desc_nulls_last("total_sales"), "category_name")


def top_products(star: Star, k: int = 10) -> DataFrame:
    """By name: products that share a name are one entry."""
    sold = _per_product(star)
    sums = sold.groupBy("product_name").agg(total(sold, "sales", "total_sales"))
    return top_k(sums, "total_sales", ["product_name"], k)


def top_products_by_id(star: Star, k: int = 10) -> DataFrame:
    sums = _per_product(star).select(
        "product_id", "product_name", from_cents(F.col("sales"), 38).alias("total_sales")
    )
    return top_k(sums, "total_sales", ["product_id"], k)


def top_customers(star: Star, k: int = 10) -> DataFrame:
    best = top_k(_per_customer(star), "total_sales", ["customer_id"], k)
    return best.select(
        F.col("name").alias("customer_name"), F.col("total_sales").alias("total_spending")
    )


def average_order_value(star: Star) -> DataFrame:
    per_order = _per_order(star)
    sums = per_order.agg(total(per_order, "sales"), F.count("order_id").alias("orders"))
    return sums.select(_ratio("sales", "orders").alias("average_order_value"))


def orders_by_status(star: Star) -> DataFrame:
    counts = star["fact_order"].groupBy("order_status_id").agg(F.count("order_id").alias("n"))
    named = counts.join(star["dim_order_status"], "order_status_id")
    return named.groupBy("order_status").agg(F.sum("n").alias("order_count"))


def payments_by_method(star: Star, completed_only: bool = False) -> DataFrame:
    """Failed payments count, as in the stored fact, unless ``completed_only``."""
    payments = star["fact_payment"]
    if completed_only:
        payments = payments.filter(F.col("payment_status") == "COMPLETED")
    sums = payments.groupBy("payment_method_id").agg(
        F.count("payment_id").alias("n"), total(payments, "amount"), F.count("amount").alias("amounts")
    )
    named = sums.join(star["dim_payment_method"], "payment_method_id")
    return named.select(
        "payment_method",
        F.col("n").alias("num_transactions"),
        F.col("amount").alias("total_amount"),
        _ratio("amount", "amounts").alias("avg_payment_amount"),
    )


def shipment_performance(star: Star) -> DataFrame:
    days = star["fact_shipment"].agg(
        F.count("shipment_id").alias("total_shipments"),
        F.sum("shipping_days").alias("days"),
        F.count("shipping_days").alias("dated"),
        F.min("shipping_days").alias("min_delivery_days"),
        F.max("shipping_days").alias("max_delivery_days"),
    )
    return days.select(
        "total_shipments",
        _ratio("days", "dated").alias("avg_delivery_days"),
        "min_delivery_days",
        "max_delivery_days",
    )


def running_sales(star: Star) -> DataFrame:
    orders = star["fact_order"].select("order_id", "order_date")
    joined = _per_order(star).join(orders, "order_id")
    daily = joined.groupBy("order_date").agg(total(joined, "sales", "daily_sales"))
    return running_total(daily, "order_date", "daily_sales", "running_total_sales").orderBy("order_date")


def monthly_growth(star: Star) -> DataFrame:
    sales = _monthly(star).select("year", "month", F.col("monthly_sales").alias("current_sales"))
    return period_growth(sales, ["year", "month"], "current_sales").orderBy("year", "month")


def top_products_per_category(star: Star, max_rank: int = 3) -> DataFrame:
    categories = star["dim_category"].select("category_id", "category_name")
    sold = _sales_by(_per_product(star), "category_id", "product_name")
    named = _sales_by(sold.join(categories, "category_id"), "category_name", "product_name")
    sums = named.withColumn("sales", from_cents(F.col("sales"), 38))
    top = rank_in_group(sums, ["category_name"], "sales", max_rank)
    return top.orderBy("category_name", "rank", "product_name")


def customer_ranking(star: Star) -> DataFrame:
    entries = _per_customer(star).select(
        "customer_id",
        F.col("name").alias("customer"),
        F.col("total_sales").alias("total_spending"),
        F.col("total_orders").alias("order_count"),
    )
    return ranked(entries, "total_spending").drop("customer_id")


REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "r01_totals": totals,
    "r02_monthly_sales": monthly_sales,
    "r03_sales_by_category": sales_by_category,
    "r04_top_products": top_products,
    "r05_top_customers": top_customers,
    "r06_average_order_value": average_order_value,
    "r07_orders_by_status": orders_by_status,
    "r08_payments_by_method": payments_by_method,
    "r09_shipment_performance": shipment_performance,
    "r10_running_sales": running_sales,
    "r11_monthly_growth": monthly_growth,
    "r12_category_top3": top_products_per_category,
    "r13_customer_ranking": customer_ranking,
}


def report(star: Star | SparkSession, name: str) -> DataFrame:
    """Run a report over star tables, or over the views registered in a session."""
    if isinstance(star, SparkSession):
        spark = star
        star = _Views(spark)
    return REPORTS[name](star)


class _Views(dict):
    def __init__(self, spark: SparkSession):
        super().__init__()
        self._spark = spark

    def __missing__(self, name: str) -> DataFrame:
        return self._spark.table(name)
