"""Star schema: dimensions, facts, bridge, and the wiring that builds each table on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopmill.functions.cleaning import dedup
from shopmill.functions.measures import (
    clamp_negative,
    date_key,
    day_span,
    discount,
    full_name,
    gross,
    money,
    net,
    rounded_amounts,
    with_date_parts,
)
from shopmill.operators.aggregates import customer_mart, date_bounds, product_mart
from shopmill.operators.joins import with_lookup_id
from shopmill.operators.windows import ranked

# Star column names by raw column name, one mapping per plain dimension.
_DIMS = {
    "dim_customer": ("customers", {
        "customerid": "customer_id", "firstname": "first_name", "lastname": "last_name",
        "full_name": "full_name", "email": "email", "city": "city", "country": "country",
        "registrationdate": "registration_date",
    }),
    "dim_category": ("categories", {"categoryid": "category_id", "categoryname": "category_name"}),
    "dim_department": (
        "departments", {"departmentid": "department_id", "departmentname": "department_name"}
    ),
    "dim_product": ("products", {
        "productid": "product_id", "categoryid": "category_id", "productname": "product_name",
        "brand": "brand", "price": "price", "cost": "cost", "stock": "stock",
    }),
    "dim_supplier": ("suppliers", {
        "supplierid": "supplier_id", "suppliername": "supplier_name", "country": "country",
    }),
    "dim_employee": ("employees", {
        "employeeid": "employee_id", "managerid": "manager_id", "departmentid": "department_id",
        "firstname": "first_name", "lastname": "last_name", "full_name": "full_name",
        "salary": "salary", "hiredate": "hire_date",
    }),
    "dim_shipper": ("shippers", {"shipperid": "shipper_id", "companyname": "company_name"}),
}


def dimension(name: str, raw: DataFrame) -> DataFrame:
    """A plain dimension from its raw table: trimmed text, star names, one row per id."""
    _, names = _DIMS[name]
    text = {f.name for f in raw.schema.fields if f.dataType.simpleString() == "string"}
    cols = {c: F.trim(F.col(c)) if c in text else F.col(c) for c in raw.columns}
    if "full_name" in names:
        cols["full_name"] = full_name(cols["firstname"], cols["lastname"])
    picked = raw.select(*[cols[c].alias(alias) for c, alias in names.items()])
    return dedup(picked, [next(iter(names.values()))])


def dim_date(orders: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last order; no rows without orders."""
    bounds = date_bounds(orders).filter(F.col("min_date").isNotNull())
    days = bounds.select(F.explode(F.sequence("min_date", "max_date")).alias("date"))
    parts = ("year", "quarter", "month", "day", "day_of_week", "week_of_year")
    named = with_date_parts(days, "date", parts).withColumns(
        {
            "date_id": date_key(F.col("date")),
            "month_name": F.date_format("date", "MMMM"),
            "day_name": F.date_format("date", "EEEE"),
        }
    )
    return named.select(
        "date_id",
        "date",
        "year",
        "quarter",
        "month",
        "month_name",
        "day",
        "day_of_week",
        "day_name",
        "week_of_year",
    )


FEW_NAMES = 100_000


def dim_lookup(
    names: DataFrame, id_col: str, existing: DataFrame | None = None, few: bool = True
) -> DataFrame:
    """Surrogate ids 1..n over the distinct names in order.

    With ``existing`` (the stored lookup) known names keep their ids and new ones continue after
    the highest, where a rebuild would re-number. One ordered pass numbers at most ``FEW_NAMES`` names and
    refuses more; ``few=False`` numbers without it, for name lists that grow with the data.
    """
    name_col = names.columns[0]
    fresh = names.filter(F.col(name_col).isNotNull()).distinct()
    offset = F.lit(0)
    if existing is not None:
        fresh = fresh.join(existing, name_col, "left_anti")
        top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).first()["top"]
        offset = F.lit(top)
    if few:
        place = F.row_number().over(Window.orderBy(name_col))
        refused = F.raise_error(F.lit(f"over {FEW_NAMES} names: number them with few=False"))
        numbered = fresh.withColumn("_n", F.when(place <= FEW_NAMES, place).otherwise(refused.cast("int")))
    else:
        total = fresh.count()
        numbered = ranked(fresh, name_col, "_n").withColumn("_n", F.lit(total + 1) - F.col("_n"))
    built = numbered.select((offset + F.col("_n")).cast("int").alias(id_col), name_col)
    return built if existing is None else existing.select(id_col, name_col).unionByName(built)


def _upper(column: str):
    return F.upper(F.trim(F.col(column)))


def dim_payment_method(payments: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    names = payments.select(_upper("paymentmethod").alias("payment_method"))
    return dim_lookup(names, "payment_method_id", existing)


def dim_order_status(orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    names = orders.select(_upper("status").alias("order_status"))
    return dim_lookup(names, "order_status_id", existing)


def fact_order(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    base = orders.select(
        F.col("orderid").alias("order_id"),
        F.col("customerid").alias("customer_id"),
        date_key(F.col("orderdate")).alias("date_id"),
        F.col("orderdate").alias("order_date"),
        _upper("status").alias("order_status"),
    )
    return with_lookup_id(base, statuses, "order_status", "order_status_id")


def line_amounts(lines: DataFrame) -> DataFrame:
    """Clamp negatives, then unrounded gross, discount and net amounts of each line."""
    quantity = clamp_negative(F.col("quantity"), "int")
    price = clamp_negative(F.col("unitprice"), "decimal(12,2)")
    percent = clamp_negative(F.col("discount"), "decimal(12,2)")
    clamped = lines.withColumns({"quantity": quantity, "unitprice": price, "discount": percent})
    priced = clamped.withColumn("gross_amount", gross(F.col("quantity"), F.col("unitprice")))
    off = discount(F.col("gross_amount"), F.col("discount"))
    return priced.withColumn("discount_amount", off).withColumn(
        "total_amount", net(F.col("gross_amount"), F.col("discount_amount"))
    )


def fact_order_detail(lines: DataFrame, unique: bool = False) -> DataFrame:
    """Order lines with amounts, each rounded on its own; one row per line id.

    ``unique=True`` skips the dedup (a full shuffle) when the input is already one row per line.
    """
    quantity = clamp_negative(F.col("quantity"), "int")
    price = clamp_negative(F.col("unitprice"), "decimal(12,2)")
    percent = clamp_negative(F.col("discount"), "decimal(12,2)")
    amounts = rounded_amounts(quantity, price, percent)
    fact = lines.select(
        F.col("orderdetailid").alias("order_detail_id"),
        F.col("orderid").alias("order_id"),
        F.col("productid").alias("product_id"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        percent.alias("discount"),
        *[c.alias(name) for name, c in amounts.items()],
    )
    return fact if unique else dedup(fact, ["order_detail_id"])


def fact_payment(payments: DataFrame, methods: DataFrame) -> DataFrame:
    """Payments with method ids. ``paymentstatus`` is carried along when the input has it."""
    status = [F.col("paymentstatus").alias("payment_status")] if "paymentstatus" in payments.columns else []
    base = payments.select(
        F.col("paymentid").alias("payment_id"),
        F.col("orderid").alias("order_id"),
        date_key(F.col("paymentdate")).alias("date_id"),
        F.col("paymentdate").alias("payment_date"),
        money(F.col("amount")).alias("amount"),
        *status,
        _upper("paymentmethod").alias("payment_method"),
    )
    return with_lookup_id(base, methods, "payment_method", "payment_method_id")


def fact_shipment(shipments: DataFrame) -> DataFrame:
    return shipments.select(
        F.col("shipmentid").alias("shipment_id"),
        F.col("orderid").alias("order_id"),
        F.col("shipperid").alias("shipper_id"),
        F.col("shipdate").alias("ship_date"),
        F.col("deliverydate").alias("delivery_date"),
        day_span(F.col("shipdate"), F.col("deliverydate")).alias("shipping_days"),
    )


def bridge_product_supplier(raw: DataFrame) -> DataFrame:
    pairs = raw.select(
        F.col("productid").alias("product_id"), F.col("supplierid").alias("supplier_id")
    )
    return pairs.dropDuplicates(["product_id", "supplier_id"])


class Tables(Mapping):
    """Named tables, each built on first use and then shared."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def star_schema(
    raw: Mapping[str, DataFrame],
    unique_lines: bool = False,
    existing: Mapping[str, DataFrame] | None = None,
    lookups: Mapping[str, DataFrame] | None = None,
) -> Tables:
    """The 17 star tables over unified raw tables.

    ``existing`` may hold the stored ``dim_payment_method`` and ``dim_order_status``, whose ids
    then stay as they are. ``lookups`` are these two as already written for the same raw tables.
    """
    stored = existing or {}
    star: Tables
    builders: dict[str, Callable[[], DataFrame]] = {
        name: (lambda name=name, source=source: dimension(name, raw[source]))
        for name, (source, _) in _DIMS.items()
        if source in raw
    }
    builders |= {
        "dim_date": lambda: dim_date(raw["orders"]),
        "dim_payment_method": lambda: dim_payment_method(
            raw["payments"], stored.get("dim_payment_method")
        ),
        "dim_order_status": lambda: dim_order_status(
            raw["orders"], stored.get("dim_order_status")
        ),
        "fact_order": lambda: fact_order(raw["orders"], star["dim_order_status"]),
        "fact_order_detail": lambda: fact_order_detail(raw["order_details"], unique_lines),
        "fact_payment": lambda: fact_payment(raw["payments"], star["dim_payment_method"]),
        "fact_shipment": lambda: fact_shipment(raw["shipments"]),
        "fact_customer_sales": lambda: customer_mart(star["fact_order_detail"], star["fact_order"]),
        "fact_product_sales": lambda: product_mart(star["fact_order_detail"]),
        "bridge_product_supplier": lambda: bridge_product_supplier(raw["product_suppliers"]),
    }
    builders |= {name: (lambda name=name: lookups[name]) for name in lookups or ()}
    star = Tables(builders)
    return star


def read_star(spark: SparkSession, root: str, names: list[str]) -> Tables:
    """Written star tables, in the shape the reports take."""
    return Tables({n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in names})
