"""Flatten nested order events into tables, and build them from tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(path: str):
    return F.try_to_date(F.col(path))


def event_orders(events: DataFrame) -> DataFrame:
    """Order header with the event's metadata."""
    return events.select(
        F.col("order.OrderID").alias("orderid"),
        F.col("order.CustomerID").alias("customerid"),
        _day("order.OrderDate").alias("orderdate"),
        F.upper(F.trim("order.Status")).alias("status"),
        F.col("metadata.event_id").alias("event_id"),
        F.try_to_timestamp(F.col("metadata.event_timestamp")).alias("event_timestamp"),
        F.col("metadata.event_type").alias("event_type"),
        F.col("metadata.source").alias("source"),
    )


def event_lines(events: DataFrame) -> DataFrame:
    """One row per order line; an empty or missing list gives none.

    The outer form, filtered afterwards, keeps the optimizer from testing the list's size below
    the JSON parse, which would parse each document twice.
    """
    order_id = F.col("order.OrderID").alias("orderid")
    lines = events.select(order_id, F.posexplode_outer("order_details").alias("pos", "d"))
    lines = lines.filter(F.col("pos").isNotNull())
    return lines.select(
        F.col("d.OrderDetailID").alias("orderdetailid"),
        "orderid",
        F.col("d.ProductID").alias("productid"),
        F.col("d.Quantity").try_cast("int").alias("quantity"),
        F.col("d.UnitPrice").alias("unitprice"),
        F.col("d.Discount").alias("discount"),
    )


def event_payments(events: DataFrame) -> DataFrame:
    return events.filter(F.col("payment").isNotNull()).select(
        F.col("payment.PaymentID").alias("paymentid"),
        F.col("payment.OrderID").alias("orderid"),
        F.trim("payment.PaymentMethod").alias("paymentmethod"),
        _day("payment.PaymentDate").alias("paymentdate"),
        F.col("payment.Amount").alias("amount"),
        F.upper(F.trim("payment.PaymentStatus")).alias("paymentstatus"),
    )


def event_shipments(events: DataFrame) -> DataFrame:
    """One row per shipped order; a NULL shipment is no row."""
    return events.filter(F.col("shipment").isNotNull()).select(
        F.col("shipment.ShipmentID").alias("shipmentid"),
        F.col("shipment.OrderID").alias("orderid"),
        F.col("shipment.ShipperID").alias("shipperid"),
        _day("shipment.ShipDate").alias("shipdate"),
        _day("shipment.DeliveryDate").alias("deliverydate"),
    )


def event_summary(events: DataFrame) -> DataFrame:
    return events.select(F.col("order.OrderID").alias("orderid"), "summary.*")


def _iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def _columns(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in df.columns}


def detail_of(c: Mapping[str, Column]) -> Column:
    """A line as the event holds it, from its columns by name; so for the other parts below."""
    return F.struct(
        c["orderdetailid"].alias("OrderDetailID"),
        c["orderid"].alias("OrderID"),
        c["productid"].alias("ProductID"),
        c["quantity"].cast("long").alias("Quantity"),
        c["unitprice"].alias("UnitPrice"),
        c["discount"].alias("Discount"),
    )


def payment_of(c: Mapping[str, Column]) -> Column:
    return F.struct(
        c["paymentid"].alias("PaymentID"),
        c["orderid"].alias("OrderID"),
        c["paymentmethod"].alias("PaymentMethod"),
        _iso(c["paymentdate"]).alias("PaymentDate"),
        c["amount"].cast("decimal(12,2)").alias("Amount"),
        c["paymentstatus"].alias("PaymentStatus"),
    )


def shipment_of(c: Mapping[str, Column]) -> Column:
    return F.struct(
        c["shipmentid"].alias("ShipmentID"),
        c["orderid"].alias("OrderID"),
        c["shipperid"].alias("ShipperID"),
        _iso(c["shipdate"]).alias("ShipDate"),
        _iso(c["deliverydate"]).alias("DeliveryDate"),
    )


def metadata_of(c: Mapping[str, Column]) -> Column:
    """Missing columns are NULL."""
    names = ("event_id", "event_type", "event_timestamp", "source")
    return F.struct(*[c.get(n, F.lit(None)).cast("string").alias(n) for n in names])


def order_of(c: Mapping[str, Column]) -> Column:
    return F.struct(
        c["orderid"].alias("OrderID"),
        c["customerid"].alias("CustomerID"),
        _iso(c["orderdate"]).alias("OrderDate"),
        c["status"].alias("Status"),
    )


def nest_events(
    orders: DataFrame,
    lines: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    summary: DataFrame,
) -> DataFrame:
    """One event per order from flat tables (the inverse of the ``event_*`` functions).

    ``orders`` may carry event_id, event_type, event_timestamp and source. At most one payment,
    shipment and summary row per order. An order is one document whatever its number of lines; the order
    service admits few, and ``quality.request_rules`` reports orders that have more.
    """
    documents = lines.groupBy("orderid").agg(
        F.sort_array(F.collect_list(detail_of(_columns(lines)))).alias("order_details")
    )
    paid = payments.select("orderid", payment_of(_columns(payments)).alias("payment"))
    sent = shipments.select("orderid", shipment_of(_columns(shipments)).alias("shipment"))
    fields = ("subtotal", "discount", "tax_rate", "tax_amount", "shipping_cost", "total_amount")
    sums = summary.select("orderid", F.struct(*fields).alias("summary"))
    header = orders.select(
        "orderid", metadata_of(_columns(orders)).alias("metadata"), order_of(_columns(orders)).alias("order")
    )
    return (
        header.join(documents, "orderid", "left")
        .join(paid, "orderid", "left")
        .join(sent, "orderid", "left")
        .join(sums, "orderid", "left")
        .select(
            "metadata",
            "order",
            F.coalesce("order_details", F.array().cast(documents.schema["order_details"].dataType))
            .alias("order_details"),
            "payment",
            "shipment",
            "summary",
        )
    )
