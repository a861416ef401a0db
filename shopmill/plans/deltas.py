"""Customer and product marts that follow deliveries of orders without a rebuild.

The store keeps what every order adds: one row per order and product (``parts``, foldered by ranges of order ids, ``sinks.shelf``), and two sums of them,
per customer and day and per product (foldered by a hash of the key). A delivery brings whole orders: what the
stored version of each added is retracted, what the new one adds is added, and only the folders of touched orders,
customers and products are rewritten. First and last order dates follow from the days, so they can move back as well. Cost follows
the delivery and the folders it touches, not the history.

A delivery has a number above all earlier ones. The sums carry the number of the last delivery they took, folder by folder, and
orders are overwritten last; a delivery that died half-way is applied again under its number, and no folder takes it twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill.functions.measures import customer_segment
from shopmill.operators.aggregates import TOTAL
from shopmill.operators.scale import kept, skew_join
from shopmill.sources.landing import read_or_empty
from shopmill.sources.sinks import IDS_PER_FOLDER, shelf

BUCKETS = 256  # folders of the sums of a new store; a store keeps its number
MEASURES = ("quantity", "gross_amount", "discount_amount", "total_amount", "unit_price")
Keep = Callable[[DataFrame], DataFrame]

_SUMS = ", ".join(f"{m} {TOTAL}, {m}_n long" for m in MEASURES)
PARTS = f"order_id long, product_id long, customer_id long, order_date date, lines long, {_SUMS}, id_bucket long"
APPLIED = "delivery long, buckets long, shelves boolean"
DAYS = f"customer_id long, order_date date, orders long, {_SUMS}, delivery long, bucket long"
PRODUCTS = f"product_id long, orders long, {_SUMS}, delivery long, bucket long"


def order_parts(fact_lines: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """What each order adds, per product: sums of the measures and how many values each has. An order without
    lines is one row that adds nothing, so that its earlier lines go."""
    sums = fact_lines.groupBy("order_id", "product_id").agg(
        F.count("*").alias("lines"),
        *[F.coalesce(F.sum(m), F.lit(0)).cast(TOTAL).alias(m) for m in MEASURES],
        *[F.count(m).alias(f"{m}_n") for m in MEASURES],
    )
    headers = fact_orders.filter("order_id IS NOT NULL").select("order_id", "customer_id", "order_date")
    joined = skew_join(headers, sums, "order_id", "left")
    numbers = ["lines", *MEASURES, *[f"{m}_n" for m in MEASURES]]
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast(sums.schema[c].dataType) for c in numbers})


def _signed(column: str):
    return F.sum(F.col(column) * F.col("sign"))


def _sums() -> list:
    return [_signed(m).cast(TOTAL).alias(m) for m in MEASURES] + [_signed(f"{m}_n").alias(f"{m}_n") for m in MEASURES]


def _overwrite(rows: DataFrame, path: str, folder: str) -> None:
    """Replace the folders that ``rows`` has; others keep their files. ``rows`` may read them: Spark writes beside the folders and
    puts them in place of the old ones when all rows are written."""
    writer = rows.hint("rebalance", folder).write.mode("overwrite").partitionBy(folder)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _folders(df: DataFrame, folder: str) -> list[int]:
    return [r[0] for r in df.select(folder).distinct().collect()]  # one number a folder


def _merge(spark: SparkSession, path: str, schema: str, keys: Sequence[str], delta: DataFrame, number: int, buckets: int, keep: Keep) -> int:
    """Add a delivery's changes to the sums, in the folders that have not taken it; returns how many."""
    delta = keep(delta.withColumn("bucket", F.pmod(F.xxhash64(keys[0]), F.lit(buckets))))
    touched = _folders(delta, "bucket")
    held = read_or_empty(spark, path, schema).filter(F.col("bucket").isin(touched))
    taken = held.groupBy("bucket").agg(F.max("delivery").alias("delivery")).filter(F.col("delivery") >= number)
    taken = set(_folders(taken, "bucket"))
    todo = [b for b in touched if b not in taken]
    if not todo:
        return 0
    open_to = F.col("bucket").isin(todo)
    both = held.filter(open_to).drop("delivery").unionByName(delta.filter(open_to))
    sums = ["orders", *MEASURES, *[f"{m}_n" for m in MEASURES]]
    kinds = {c: delta.schema[c].dataType for c in sums}
    rows = both.groupBy(*keys, "bucket").agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums])
    # Rows that have come to nothing stay: they carry the folder's delivery.
    _overwrite(rows.withColumn("delivery", F.lit(number).cast("long")), path, "bucket")
    return len(todo)


def apply(
    spark: SparkSession,
    root: str,
    number: int,
    fact_lines: DataFrame,
    fact_orders: DataFrame,
    ids_per_folder: int = IDS_PER_FOLDER,
    buckets: int = BUCKETS,
) -> int:
    """Take a delivery: whole orders, one header each, that replace what the store holds of them.

    Returns the number of folders of sums rewritten; 0 for a delivery taken before. Lines of orders without a header in the
    delivery, and headers without an id, are left out.
    """
    log = read_or_empty(spark, f"{root}/applied", APPLIED)
    last = log.agg(
        F.max("delivery").alias("delivery"), F.max("buckets").alias("buckets"), F.count_if(F.col("shelves").isNull()).alias("unshelved")
    ).first()
    if last["unshelved"]:
        raise ValueError(f"the store at {root} has a folder for each range of order ids; build it anew")
    if last["delivery"] is not None and number <= last["delivery"]:
        return 0
    buckets = last["buckets"] or buckets
    bucket = shelf(F.floor(F.col("order_id") / F.lit(ids_per_folder)).cast("long"))
    with kept(spark) as keep:
        fresh = keep(order_parts(fact_lines, fact_orders).withColumn("id_bucket", bucket))
        ids = fresh.select("order_id").distinct()
        stored = read_or_empty(spark, f"{root}/parts", PARTS).filter(F.col("id_bucket").isin(_folders(fresh, "id_bucket")))
        old = keep(skew_join(stored, ids, "order_id", "left_semi", "right"))
        signed = fresh.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1))).filter("lines > 0")
        per_order = signed.groupBy("order_id", "customer_id", "order_date", "sign").agg(
            *[F.sum(c).alias(c) for m in MEASURES for c in (m, f"{m}_n")]
        )
        days = per_order.groupBy("customer_id", "order_date").agg(F.sum("sign").alias("orders"), *_sums())
        products = signed.groupBy("product_id").agg(F.sum("sign").alias("orders"), *_sums())
        done = _merge(spark, f"{root}/days", DAYS, ["customer_id", "order_date"], days, number, buckets, keep)
        done += _merge(spark, f"{root}/products", PRODUCTS, ["product_id"], products, number, buckets, keep)
        if not fresh.isEmpty():
            rest = skew_join(stored, ids, "order_id", "left_anti", "right")
            _overwrite(rest.unionByName(fresh), f"{root}/parts", "id_bucket")
    row = spark.createDataFrame([(number, buckets, True)], APPLIED)
    row.coalesce(1).write.mode("append").parquet(f"{root}/applied")
    return done


def _value(measure: str, alias: str, kind: str = TOTAL):
    """A sum, NULL where no row has a value."""
    return F.when(F.col(f"{measure}_n") > 0, F.col(measure)).cast(kind).alias(alias)


_AMOUNTS = [("gross_amount", "gross_sales"), ("discount_amount", "total_discount"), ("total_amount", "total_sales")]


def customer_mart(spark: SparkSession, root: str, **segment) -> DataFrame:
    """As ``aggregates.customer_mart`` over the latest version of every order taken."""
    days = read_or_empty(spark, f"{root}/days", DAYS).filter("orders > 0")
    sums = days.groupBy("customer_id").agg(
        F.sum("orders").alias("total_orders"),
        *[F.sum(c).alias(c) for m in MEASURES for c in (m, f"{m}_n")],
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    rows = sums.select(
        "customer_id",
        "total_orders",
        _value("quantity", "total_quantity", "long"),
        *[_value(m, alias) for m, alias in _AMOUNTS],
        F.col("total_amount_n").alias("lines"),
        "first_order_date",
        "last_order_date",
    )
    mean = F.col("total_sales").cast("double") / F.nullif("lines", F.lit(0)).cast("double")
    return rows.select(
        "customer_id",
        "total_orders",
        "total_quantity",
        *[alias for _, alias in _AMOUNTS],
        mean.alias("average_order_line"),
        "first_order_date",
        "last_order_date",
        customer_segment(F.col("total_sales"), **segment).alias("customer_segment"),
    )


def product_mart(spark: SparkSession, root: str) -> DataFrame:
    """As ``aggregates.product_mart`` over the latest version of every order taken."""
    sums = read_or_empty(spark, f"{root}/products", PRODUCTS).filter("orders > 0")
    mean = _value("unit_price", "p").cast("double") / F.nullif("unit_price_n", F.lit(0)).cast("double")
    return sums.select(
        "product_id",
        F.col("orders").alias("total_orders"),
        _value("quantity", "units_sold", "long"),
        *[_value(m, alias) for m, alias in _AMOUNTS],
        mean.alias("average_unit_price"),
    )
