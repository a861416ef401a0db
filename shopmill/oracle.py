"""SQL building blocks for checking: the retail model over the same Parquet tables, in plain SQL.

Written for DuckDB, naively and independently of the Spark plans, to check their results.
"""

from __future__ import annotations

import re

# Common table expressions in dependency order; a query gets the ones it mentions.
CTES = {
    "m_customers": """
        SELECT c_custkey AS customerid, split_part(c_name, '#', 1) AS firstname,
               split_part(c_name, '#', 2) AS lastname,
               split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN lower(split_part(c_name, '#', 1)
                    || CASE WHEN c_mktsegment = 'FURNITURE' THEN ' ' ELSE '.' END
                    || split_part(c_name, '#', 2) || '@' || c_mktsegment || '.com') END AS email,
               c_mktsegment AS city, n_name AS country,
               CAST(DATE '1992-01-01' + CAST(c_nationkey AS INTEGER) AS DATE) AS registrationdate
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "m_categories": """
        SELECT row_number() OVER (ORDER BY p_type) AS categoryid, p_type AS categoryname
        FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)""",
    "m_products": """
        SELECT p_partkey AS productid, categoryid, p_name AS productname, p_brand AS brand,
               CAST(p_retailprice AS DECIMAL(12,2)) AS price,
               CAST(p_size AS DECIMAL(12,2)) AS cost, p_size AS stock
        FROM part LEFT JOIN m_categories ON p_type = categoryname""",
    "m_orders": """
        SELECT o_orderkey AS orderid, o_custkey AS customerid,
               CAST(o_orderdate AS DATE) AS orderdate, upper(trim(o_orderstatus)) AS status,
               year(o_orderdate) AS "year", month(o_orderdate) AS "month",
               quarter(o_orderdate) AS "quarter", o_orderpriority AS urgency
        FROM orders""",
    "m_lines": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
                 || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS orderdetailid,
               l_orderkey AS orderid, l_partkey AS productid, l_suppkey AS supplierid,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS unitprice,
               CAST(round(l_discount * 100, 0) AS DECIMAL(5,2)) AS discount,
               CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(12,2))
                    AS DECIMAL(14,2)) AS total_amount,
               l_linenumber AS linenumber, CAST(l_shipdate AS DATE) AS shipdate,
               l_returnflag AS returnflag, l_linestatus AS linestatus
        FROM lineitem""",
    "m_facts": """
        SELECT orderdetailid AS order_detail_id, orderid AS order_id, productid AS product_id,
               quantity, unitprice AS unit_price, discount, total_amount AS gross_amount,
               CAST(total_amount * discount * 0.01 AS DECIMAL(14,2)) AS discount_amount,
               CAST(total_amount - total_amount * discount * 0.01 AS DECIMAL(14,2)) AS net_amount
        FROM m_lines""",
    "m_payments": """
        SELECT o_orderkey AS paymentid, o_orderkey AS orderid,
               upper(trim(o_orderpriority)) AS paymentmethod,
               CAST(o_orderdate AS DATE) AS paymentdate,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount
        FROM orders""",
    "m_shipments": """
        SELECT orderdetailid AS shipmentid, orderid, supplierid AS shipperid, shipdate,
               CAST(shipdate + linenumber AS DATE) AS deliverydate
        FROM m_lines""",
    "m_summary": """
        SELECT orderid, sum(total_amount) AS order_total_amount,
               sum(quantity) AS order_total_quantity
        FROM m_lines GROUP BY orderid""",
    "m_sales": """
        SELECT o.*, l.productid, l.quantity, l.unitprice, l.total_amount
        FROM m_lines l JOIN m_orders o ON l.orderid = o.orderid""",
    "m_wide": """
        SELECT s.*, p.categoryid, p.productname
        FROM m_sales s JOIN m_products p ON s.productid = p.productid""",
    "m_fact_sales": """
        SELECT f.*, o.customerid, o.orderdate, o.status, o."year", o."month"
        FROM m_facts f JOIN m_orders o ON f.order_id = o.orderid""",
    "m_statuses": """
        SELECT row_number() OVER (ORDER BY status) AS order_status_id, status AS order_status
        FROM (SELECT DISTINCT status FROM m_orders WHERE status IS NOT NULL)""",
    "m_methods": """
        SELECT row_number() OVER (ORDER BY paymentmethod) AS payment_method_id,
               paymentmethod AS payment_method
        FROM (SELECT DISTINCT paymentmethod FROM m_payments WHERE paymentmethod IS NOT NULL)""",
    "m_customer_mart": """
        SELECT customerid AS customer_id, count(DISTINCT order_id) AS total_orders,
               sum(quantity) AS total_quantity, sum(gross_amount) AS gross_sales,
               sum(discount_amount) AS total_discount, sum(net_amount) AS total_sales,
               CAST(CAST(sum(net_amount) AS DECIMAL(38,2)) AS DOUBLE) / CAST(count(net_amount) AS DOUBLE) AS average_order_line,
               min(orderdate) AS first_order_date, max(orderdate) AS last_order_date
        FROM m_fact_sales GROUP BY customerid""",
    "m_sums": """
        SELECT orderid, sum(total_amount - off) AS subtotal, sum(off) AS discount, count(*) AS n
        FROM (SELECT orderid, total_amount,
                     CAST(total_amount * discount * 0.01 AS DECIMAL(18,2)) AS off FROM m_lines)
        GROUP BY orderid""",
    "m_events": """
        SELECT o_orderkey AS orderid, o_custkey AS customerid,
               CAST(o_orderdate AS DATE) AS orderdate, o_orderstatus AS s, o_orderpriority AS u,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'PENDING'
                    WHEN o_orderstatus = 'F' THEN 'CANCELLED'
                    WHEN o_orderstatus = 'O' THEN 'CONFIRMED' ELSE 'PROCESSING' END AS status,
               CAST(coalesce(subtotal, 0) AS DECIMAL(18,2)) AS subtotal,
               CAST(coalesce(m.discount, 0) AS DECIMAL(18,2)) AS discount,
               CAST(coalesce(subtotal, 0) * 0.14 AS DECIMAL(18,2)) AS tax_amount,
               CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 50 END AS shipping_cost,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS slip,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderstatus = 'F'
                    ELSE o_orderstatus = 'O' END AS sent,
               CAST(o_orderdate AS DATE)
                 + CASE WHEN o_orderpriority = '2-HIGH' THEN 2 ELSE 1 END AS leaves,
               1 + dayofweek(o_orderdate) AS travel,
               CAST(o_totalprice AS DECIMAL(12,2)) AS paid, coalesce(n, 0) AS n
        FROM orders LEFT JOIN m_sums m ON o_orderkey = m.orderid""",
}

_KINDS = {
    "i": "CAST({0} AS BIGINT)",
    "s": "CAST({0} AS VARCHAR)",
    "m": "CAST(CAST({0} AS DECIMAL(38,2)) AS DOUBLE)",
    "d": "CAST({0} AS DOUBLE)",
}


def with_model(sql: str) -> str:
    """Prefix the common table expressions the text mentions, directly or through others."""
    needed: list[str] = []
    text = sql
    for name in reversed(CTES):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, name)
            text += CTES[name]
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + sql


def typed(sql: str, columns: str) -> str:
    """The query with its columns in portable types: BIGINT, VARCHAR, DOUBLE."""
    picked = []
    for item in columns.split():
        name, kind = item.split(":")
        picked.append(_KINDS[kind].format(f'"{name}"') + f' AS "{name}"')
    return with_model(f"SELECT {', '.join(picked)} FROM (\n{sql.strip()}\n) AS answer")
