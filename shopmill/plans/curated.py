"""End-to-end jobs: clean raw history, unify it with events, write curated tables and the star."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill import schemas
from shopmill.functions import cleaning as C
from shopmill.functions import events as E
from shopmill.functions.measures import clamp_negative, from_cents, full_name, to_cents, with_date_parts
from shopmill.operators.aggregates import customer_mart, product_mart, sales_by
from shopmill.operators.joins import wide_sales
from shopmill.operators.scale import hot_keys, kept
from shopmill.operators.setops import unify
from shopmill.plans.star import Tables, read_star, star_schema
from shopmill.sources.sinks import write_table

_MARTS = {
    "customer_sales": ["customerid"],
    "product_sales": ["productid"],
    "category_sales": ["categoryid"],
    "monthly_sales": ["year", "month"],
}


def clean_table(name: str, raw: DataFrame, keep_null_keys: bool = False) -> DataFrame:
    """Names, trimming, declared types, keys and one row per key, for any raw entity."""
    keys = schemas.KEYS[name]
    types = {f.name: f.dataType.simpleString() for f in schemas.schema(name).fields}
    df = C.clean_columns(raw)
    casts = {c: t for c, t in types.items() if c in df.columns and t != "string"}
    df = C.cast_columns(C.trim_strings(df), casts)
    if name == "customers":
        df = C.normalise_case(df, lower=["email"])
        df = df.withColumn("full_name", full_name(F.col("firstname"), F.col("lastname")))
    if name == "orders":
        df = C.normalise_case(df, upper=["status"])
        df = with_date_parts(df, "orderdate")
    if name == "order_details":
        df = gross_lines(df)
    df = df if keep_null_keys else C.require_keys(df, keys)
    return C.dedup(df, keys)


def gross_lines(lines: DataFrame) -> DataFrame:
    """Historical dialect: clamp quantity and price; the line total ignores the discount."""
    quantity = clamp_negative(F.col("quantity"), "int")
    price = clamp_negative(F.col("unitprice"), "decimal(12,2)")
    clamped = lines.withColumns({"quantity": quantity, "unitprice": price})
    cents = F.col("quantity") * to_cents(F.col("unitprice"))
    return clamped.withColumn("total_amount", from_cents(cents))


def clean_history(raw: Mapping[str, DataFrame], keep_null_keys: bool = False) -> Tables:
    """All raw entities cleaned, each on first use."""
    return Tables({n: (lambda n=n: clean_table(n, raw[n], keep_null_keys)) for n in raw})


def write_curated(spark: SparkSession, clean: Mapping[str, DataFrame], root: str) -> list[str]:
    """The twelve historical outputs. Orders are foldered by year and month.

    The wide sales set is written once and the four marts read it back, so the large joins run
    one time instead of once per mart.
    """
    plain = ["customers", "products", "categories", "order_details", "payments", "shipments"]
    for name in plain:
        write_table(clean[name], f"{root}/{name}")
    write_table(clean["orders"], f"{root}/orders", ["year", "month"])
    stored = {
        n: spark.read.schema(clean[n].schema).parquet(f"{root}/{n}")
        for n in ("orders", "order_details", "products")
    }
    wide = wide_sales(stored["orders"], stored["order_details"], stored["products"])
    write_table(wide, f"{root}/fact_sales")
    sales = spark.read.parquet(f"{root}/fact_sales")
    for name, keys in _MARTS.items():
        write_table(sales_by(sales, keys, "total_amount"), f"{root}/{name}")
    return [*plain, "orders", "fact_sales", *_MARTS]


_UNIFIED = {
    "orders": (E.event_orders, ["orderid", "customerid", "orderdate", "status"]),
    "order_details": (
        E.event_lines,
        ["orderdetailid", "orderid", "productid", "quantity", "unitprice", "discount"],
    ),
    "payments": (
        E.event_payments,
        ["paymentid", "orderid", "paymentmethod", "paymentdate", "amount"],
    ),
    "shipments": (
        E.event_shipments,
        ["shipmentid", "orderid", "shipperid", "shipdate", "deliverydate"],
    ),
}


def unify_history(clean: Mapping[str, DataFrame], events: DataFrame, unique: bool = False) -> Tables:
    """Historical tables with the events merged in; an event replaces a historical row."""
    builders = {n: (lambda n=n: clean[n]) for n in clean if n not in _UNIFIED}
    for name, (flatten, columns) in _UNIFIED.items():
        latest = [F.col("event_timestamp").desc_nulls_last()] if name == "orders" else []
        builders[name] = lambda name=name, flatten=flatten, columns=columns, latest=latest: unify(
            clean[name],
            flatten(events),
            schemas.KEYS[name],
            columns,
            latest,
            historical_is_unique=unique,
        )
    return Tables(builders)


def union_counts(
    clean: Mapping[str, DataFrame], events: DataFrame, merged: Mapping[str, DataFrame]
) -> DataFrame:
    """``table, before, incoming, after``: rows of the history, of the events and of both merged."""
    rows = []
    for name, (flatten, _) in _UNIFIED.items():
        sides = {"before": clean[name], "incoming": flatten(events), "after": merged[name]}
        counts = [
            side.agg(F.count("*").alias("n")).select(F.lit(label).alias("side"), "n")
            for label, side in sides.items()
        ]
        one = reduce(DataFrame.unionAll, counts).agg(
            *[F.max(F.when(F.col("side") == label, F.col("n"))).alias(label) for label in sides]
        )
        rows.append(one.select(F.lit(name).alias("table"), *sides))
    return reduce(DataFrame.unionAll, rows)


_SHARED = ("orders", "payments")


def write_star(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    previous: str | None = None,
) -> list[str]:
    """Write the star schema, compressed by zstd. Marts read the written facts instead of repeating their plans.

    ``previous`` is the folder of an earlier star (not ``root``) whose lookup ids are kept.
    """
    if previous == root:
        raise ValueError("the previous star must lie in another folder than the new one")
    lookups = ["dim_payment_method", "dim_order_status"]
    marts = ["fact_customer_sales", "fact_product_sales"]
    with kept(spark) as keep:
        # Several tables read orders and payments, so what lies behind these runs one time.
        shared = Tables({n: (lambda n=n: keep(raw[n]) if n in _SHARED else raw[n]) for n in raw})
        first = star_schema(shared, existing=read_star(spark, previous, lookups) if previous else None)
        for name in lookups:
            write_table(first[name], f"{root}/{name}", compression="zstd")
        # Spark knows the size of a written lookup and does not move the facts to join it.
        star = star_schema(shared, lookups=read_star(spark, root, lookups))
        for name in [n for n in star if n not in (*lookups, *marts)]:
            write_table(star[name], f"{root}/{name}", compression="zstd")
    stored = {n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in star if n not in marts}
    facts = Tables(stored)
    lines = facts["fact_order_detail"]
    write_table(customer_mart(lines, facts["fact_order"]), f"{root}/{marts[0]}", compression="zstd")
    write_table(product_mart(lines, hot_keys(lines, "product_id")), f"{root}/{marts[1]}", compression="zstd")
    return list(star)
