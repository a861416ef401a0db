"""Joined sets of the retail model. Fact-to-fact joins go through ``skew_join``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmill.operators.scale import skew_join


def orders_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order header next to each of its lines."""
    return skew_join(lines, orders, "orderid", unique="right").select(
        "orderid",
        "customerid",
        "orderdate",
        "status",
        "productid",
        "quantity",
        "unitprice",
        "total_amount",
    )


def orders_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Every order with its customer's name and place; unknown customers keep NULLs."""
    people = customers.select(
        "customerid", F.col("full_name").alias("customer_name"), "city", "country"
    )
    return skew_join(orders, people, "customerid", "left", unique="right").select(
        "orderid", "customerid", "customer_name", "city", "country", "orderdate", "status"
    )


def products_categories(products: DataFrame, categories: DataFrame) -> DataFrame:
    return skew_join(products, categories, "categoryid", "left", unique="right")


def products_suppliers(products: DataFrame, bridge: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Products with each of their suppliers; a product without one keeps NULLs."""
    links = skew_join(products, bridge, "productid", "left")
    return skew_join(links, suppliers, "supplierid", "left", unique="right")


def orders_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with each of its payments (several payments repeat the order)."""
    return skew_join(orders, payments, "orderid", "left")


def orders_shipments(orders: DataFrame, shipments: DataFrame, shippers: DataFrame) -> DataFrame:
    sent = skew_join(orders, shipments, "orderid", "left")
    return skew_join(sent, shippers, "shipperid", "left", unique="right")


def wide_sales(orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Order, line and product columns, one row per line, shared keys once."""
    sold = skew_join(lines, orders, "orderid", unique="right")
    return skew_join(sold, products, "productid", unique="right")


def with_lookup_id(df: DataFrame, dim: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """Replace a name by its surrogate id; an unknown or NULL name gets NULL."""
    ids = dim.select(name_col, id_col)
    return df.join(ids, name_col, "left").drop(name_col)


def unmatched(left: DataFrame, right: DataFrame, key: str, unique: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right`` (NULL keys included)."""
    return skew_join(left, right, key, "left_anti", unique)


def payment_mismatch(order_summary: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments that differ from the total of their order."""
    joined = skew_join(payments, order_summary, "orderid", unique="right")
    return joined.filter(F.col("order_total_amount") != F.col("amount"))
