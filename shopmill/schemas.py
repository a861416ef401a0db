"""Declared schemas. Nothing in the package infers a type from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw CSV entities, one schema each (fixed values: column names and order of the files).
RAW = {
    "customers": "customerid long, firstname string, lastname string, email string, "
    "city string, country string, registrationdate date",
    "categories": "categoryid long, categoryname string",
    "products": "productid long, categoryid long, productname string, brand string, "
    "price decimal(12,2), cost decimal(12,2), stock int",
    "departments": "departmentid long, departmentname string",
    "employees": "employeeid long, managerid long, departmentid long, firstname string, "
    "lastname string, salary decimal(12,2), hiredate date",
    "suppliers": "supplierid long, suppliername string, country string",
    "product_suppliers": "productid long, supplierid long",
    "orders": "orderid long, customerid long, orderdate date, status string",
    "order_details": "orderdetailid long, orderid long, productid long, quantity int, "
    "unitprice decimal(12,2), discount decimal(12,2)",
    "payments": "paymentid long, orderid long, paymentmethod string, paymentdate date, "
    "amount decimal(12,2)",
    "shippers": "shipperid long, companyname string",
    "shipments": "shipmentid long, orderid long, shipperid long, shipdate date, deliverydate date",
}

KEYS = {
    "customers": ["customerid"],
    "categories": ["categoryid"],
    "products": ["productid"],
    "departments": ["departmentid"],
    "employees": ["employeeid"],
    "suppliers": ["supplierid"],
    "product_suppliers": ["productid", "supplierid"],
    "orders": ["orderid"],
    "order_details": ["orderdetailid"],
    "payments": ["paymentid"],
    "shippers": ["shipperid"],
    "shipments": ["shipmentid"],
}

# (child table, child column, parent table, amount column of the child or None)
FOREIGN_KEYS = [
    ("orders", "customerid", "customers", None),
    ("order_details", "orderid", "orders", "total_amount"),
    ("order_details", "productid", "products", "total_amount"),
    ("payments", "orderid", "orders", "amount"),
    ("shipments", "orderid", "orders", None),
    ("shipments", "shipperid", "shippers", None),
    ("products", "categoryid", "categories", None),
]

# One order event; dates are text in JSON and typed when flattened. Order sums are wide enough for
# an order that holds a large part of all lines.
EVENT = (
    "metadata struct<event_id:string,event_type:string,event_timestamp:string,source:string>,"
    "`order` struct<OrderID:long,CustomerID:long,OrderDate:string,Status:string>,"
    "order_details array<struct<OrderDetailID:long,OrderID:long,ProductID:long,"
    "Quantity:long,UnitPrice:decimal(12,2),Discount:decimal(12,2)>>,"
    "payment struct<PaymentID:long,OrderID:long,PaymentMethod:string,PaymentDate:string,"
    "Amount:decimal(12,2),PaymentStatus:string>,"
    "shipment struct<ShipmentID:long,OrderID:long,ShipperID:long,ShipDate:string,"
    "DeliveryDate:string>,"
    "summary struct<subtotal:decimal(18,2),discount:decimal(18,2),tax_rate:decimal(5,2),"
    "tax_amount:decimal(18,2),shipping_cost:decimal(12,2),total_amount:decimal(18,2)>"
)


def schema(name: str) -> T.StructType:
    """StructType of a raw entity, or of the order event for ``"event"``."""
    return T.StructType.fromDDL(EVENT if name == "event" else RAW[name])


def text_schema(name: str) -> T.StructType:
    """Same columns, all strings: for input that must be cast with a reject count."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema(name).fields])
