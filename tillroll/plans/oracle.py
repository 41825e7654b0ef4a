"""Independent SQL (DuckDB dialect) for every registered query.

Only the raw driver tables exist in the oracle engine, so each statement carries
the fixture views it needs as a ``WITH`` list. The views are the plain-SQL
definitions of FIXTURES.md §3; the bodies are written from the operator
"""

from __future__ import annotations

# Fixture views, in dependency order (FIXTURES.md §3).
FIXTURE_VIEWS: list[tuple[str, str]] = [
    ("clients_raw", """
SELECT CAST(c_custkey AS BIGINT) AS client_id, split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name,
       lower(replace(c_name,'#','.')) || '@example.com' AS email, CAST('2024-01-02 00:00:00' AS TIMESTAMP) AS signup_date
FROM customer
UNION ALL
SELECT CAST(c_custkey AS BIGINT), 'Stale', split_part(c_name,'#',2),
       lower(replace(c_name,'#','.')) || '@example.com', CAST('2024-01-01 00:00:00' AS TIMESTAMP)
FROM customer WHERE c_custkey % 10 = 3"""),
    ("clients", """
SELECT client_id, first_name, last_name, email, signup_date FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY signup_date DESC, first_name DESC, last_name DESC, email DESC) AS rn
  FROM clients_raw) q WHERE rn = 1"""),
    ("sellers_raw", """
SELECT CAST(s_suppkey AS BIGINT) AS seller_id, split_part(s_name,'#',1) AS first_name, split_part(s_name,'#',2) AS last_name,
       s_name AS company_name, lower(replace(s_name,'#','.')) || '@example.com' AS email,
       CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS created_at
FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS BIGINT), repeat('Stale', 25), split_part(s_name,'#',2), NULL,
       lower(replace(s_name,'#','.')) || '@example.com', CAST('2023-12-31 00:00:00' AS TIMESTAMP)
FROM supplier WHERE s_suppkey % 10 = 3"""),
    ("sellers", """
SELECT * FROM sellers_raw
QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY created_at DESC NULLS LAST, first_name DESC NULLS LAST,
  last_name DESC NULLS LAST, company_name DESC NULLS LAST, email DESC NULLS LAST) = 1"""),
    ("products_raw", """
SELECT CAST(p_partkey AS BIGINT) AS product_id,
       CAST(CASE WHEN p_partkey % 40 = 0 THEN n - 1 - (p_partkey // 40) % greatest(1, n // 10)
                 ELSE p_partkey % (n - greatest(1, n // 10)) END AS BIGINT) AS seller_id,
       CASE WHEN v = 0 OR (p_partkey // 10) % 2 = 0 THEN p_name END AS name,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) + v AS DECIMAL(12,2)) AS price, CAST(p_size AS BIGINT) AS quantity,
       CASE WHEN v = 1 AND (p_partkey // 10) % 2 = 0 THEN TIMESTAMP '2023-12-31 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at
FROM part, (SELECT count(*) AS n FROM supplier), (VALUES (0), (1)) t(v) WHERE v = 0 OR p_partkey % 10 = 3"""),
    ("products", """
SELECT * FROM products_raw
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY created_at DESC NULLS LAST, seller_id DESC NULLS LAST,
  name DESC NULLS LAST, price DESC NULLS LAST, quantity DESC NULLS LAST) = 1"""),
    ("purchase_events", """
SELECT CAST(l_orderkey*8+l_linenumber AS BIGINT) AS purchase_id, CAST(CASE WHEN o_custkey % 50 = 0 THEN -1 - o_custkey ELSE o_custkey END AS BIGINT) AS client_id,
       CAST(CASE WHEN l_partkey % 40 = 0 THEN -1 - l_partkey ELSE l_partkey END AS BIGINT) AS product_id,
       CAST(l_quantity AS BIGINT) AS quantity, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       CAST(CAST(p_retailprice AS DECIMAL(10,2))*CAST(l_quantity AS BIGINT) AS DECIMAL(10,2)) AS full_price, l_shipdate AS purchased_at
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey"""),
    ("purchase_events_tied", """
SELECT * FROM purchase_events
UNION ALL
SELECT purchase_id, client_id + 1, product_id, quantity, price, full_price, purchased_at FROM purchase_events WHERE purchase_id % 8 = 1
UNION ALL
SELECT purchase_id, client_id, product_id, quantity, CAST(price + 1 AS DECIMAL(10,2)), full_price, purchased_at
FROM purchase_events WHERE purchase_id % 8 = 1"""),
    ("purchases", """
SELECT purchase_id, client_id, product_id, quantity, price, full_price, purchased_at FROM (
  SELECT *, row_number() OVER (PARTITION BY purchase_id ORDER BY purchased_at DESC, product_id DESC, quantity DESC,
                               full_price DESC, client_id DESC, price DESC) AS rn
  FROM purchase_events) q WHERE rn = 1"""),
    ("fact", """
SELECT d.purchase_id, c.client_id, d.product_id, p.seller_id, d.quantity, d.price, d.full_price, d.purchased_at
FROM purchases d LEFT JOIN clients c ON d.client_id=c.client_id LEFT JOIN products p ON d.product_id=p.product_id"""),
]

MONTH = "strftime(purchased_at, '%Y-%m')"
DAY = "CAST(purchased_at AS DATE)"
YEAR = "CAST(year(purchased_at) AS INTEGER)"
REV = "CAST(sum(full_price) AS DECIMAL(20,2))"
QTY = "CAST(sum(quantity) AS BIGINT)"
ORD = "CAST(count(purchase_id) AS BIGINT)"
CNAME = "first_name || ' ' || last_name"

# The fifteen marts, written over the ``fact`` view.
MART_VIEWS: list[tuple[str, str]] = [
    ("mart_sales_by_day", f"SELECT {DAY} AS sale_date, {QTY} AS total_quantity, {REV} AS total_revenue FROM fact GROUP BY 1"),
    ("mart_sales_by_month", f"SELECT {MONTH} AS sale_month, {QTY} AS total_quantity, {REV} AS total_revenue FROM fact GROUP BY 1"),
    ("mart_sales_by_year", f"SELECT {YEAR} AS sale_year, {QTY} AS total_quantity, {REV} AS total_revenue FROM fact GROUP BY 1"),
    ("mart_sales_by_product", f"""
SELECT a.product_id, p.name, a.total_quantity, a.total_revenue FROM
 (SELECT product_id, {QTY} AS total_quantity, {REV} AS total_revenue FROM fact GROUP BY product_id) a
 LEFT JOIN products p ON a.product_id = p.product_id"""),
    ("mart_sales_by_client", f"""
SELECT a.client_id, {CNAME} AS client_name, a.total_quantity, a.total_revenue FROM
 (SELECT client_id, {QTY} AS total_quantity, {REV} AS total_revenue FROM fact GROUP BY client_id) a
 LEFT JOIN clients c ON a.client_id = c.client_id"""),
    ("mart_sales_by_seller", f"""
SELECT a.seller_id, {CNAME} AS seller_name, a.total_quantity, a.total_revenue FROM
 (SELECT seller_id, {QTY} AS total_quantity, {REV} AS total_revenue FROM fact GROUP BY seller_id) a
 LEFT JOIN sellers s ON a.seller_id = s.seller_id"""),
    ("mart_avg_order_value_by_day", f"SELECT {DAY} AS sale_date, {ORD} AS total_orders, {REV} AS total_revenue FROM fact GROUP BY 1"),
    ("mart_unique_clients_per_day", f"SELECT {DAY} AS sale_date, CAST(count(DISTINCT client_id) AS BIGINT) AS unique_clients FROM fact GROUP BY 1"),
    ("mart_unique_products_per_day", f"SELECT {DAY} AS sale_date, CAST(count(DISTINCT product_id) AS BIGINT) AS unique_products FROM fact GROUP BY 1"),
    ("mart_seller_revenue_by_month", f"SELECT seller_id, {MONTH} AS sale_month, {QTY} AS total_quantity, {REV} AS total_revenue FROM fact GROUP BY 1, 2"),
    ("mart_client_revenue_by_month", f"SELECT client_id, {MONTH} AS sale_month, {ORD} AS total_orders, {REV} AS total_revenue FROM fact GROUP BY 1, 2"),
    ("mart_product_quantity_sold_by_month", f"SELECT product_id, {MONTH} AS sale_month, {QTY} AS total_quantity FROM fact GROUP BY 1, 2"),
    ("mart_top_products_by_year", f"""
SELECT a.sale_year, a.product_id, p.name, a.total_revenue FROM
 (SELECT {YEAR} AS sale_year, product_id, {REV} AS total_revenue FROM fact GROUP BY 1, 2) a
 LEFT JOIN products p ON a.product_id = p.product_id"""),
    ("mart_top_clients_by_year", f"""
SELECT a.sale_year, a.client_id, {CNAME} AS client_name, a.total_revenue FROM
 (SELECT {YEAR} AS sale_year, client_id, {REV} AS total_revenue FROM fact GROUP BY 1, 2) a
 LEFT JOIN clients c ON a.client_id = c.client_id"""),
    ("mart_client_purchase_frequency", f"""
SELECT a.client_id, {CNAME} AS client_name, a.total_orders, a.total_revenue FROM
 (SELECT client_id, {ORD} AS total_orders, {REV} AS total_revenue FROM fact GROUP BY client_id) a
 LEFT JOIN clients c ON a.client_id = c.client_id"""),
]

RREV = "CAST(sum(total_revenue) AS DECIMAL(20,2)) AS total_revenue"


def _rs(c: str) -> str:
    return f"CAST(sum({c}) AS BIGINT) AS {c}"


# Dashboard reports R01–R15 over the marts.
REPORT_VIEWS: list[tuple[str, str]] = [
    ("report_sales_by_day", f"SELECT sale_date, {_rs('total_quantity')}, {RREV} FROM mart_sales_by_day GROUP BY sale_date ORDER BY sale_date DESC"),
    ("report_sales_by_month", f"SELECT sale_month, {_rs('total_quantity')}, {RREV} FROM mart_sales_by_month GROUP BY sale_month ORDER BY sale_month DESC"),
    ("report_sales_by_year", f"SELECT sale_year, {_rs('total_quantity')}, {RREV} FROM mart_sales_by_year GROUP BY sale_year ORDER BY sale_year DESC"),
    ("report_sales_by_product", f"SELECT product_id, name, {_rs('total_quantity')}, {RREV} FROM mart_sales_by_product GROUP BY product_id, name ORDER BY total_revenue DESC"),
    ("report_sales_by_client", f"SELECT client_id, client_name, {_rs('total_quantity')}, {RREV} FROM mart_sales_by_client GROUP BY client_id, client_name ORDER BY total_revenue DESC"),
    ("report_sales_by_seller", f"SELECT seller_id, seller_name, {_rs('total_quantity')}, {RREV} FROM mart_sales_by_seller GROUP BY seller_id, seller_name ORDER BY total_revenue DESC"),
    ("report_avg_order_value_by_day", f"SELECT sale_date, {_rs('total_orders')}, {RREV} FROM mart_avg_order_value_by_day GROUP BY sale_date ORDER BY sale_date DESC"),
    ("report_unique_clients", f"SELECT sale_date, {_rs('unique_clients')} FROM mart_unique_clients_per_day GROUP BY sale_date ORDER BY sale_date DESC"),
    ("report_unique_products", f"SELECT sale_date, {_rs('unique_products')} FROM mart_unique_products_per_day GROUP BY sale_date ORDER BY sale_date DESC"),
    ("report_seller_month", f"SELECT seller_id, sale_month, {_rs('total_quantity')}, {RREV} FROM mart_seller_revenue_by_month GROUP BY seller_id, sale_month ORDER BY sale_month DESC"),
    ("report_client_month", f"SELECT client_id, sale_month, {_rs('total_orders')}, {RREV} FROM mart_client_revenue_by_month GROUP BY client_id, sale_month ORDER BY sale_month DESC"),
    ("report_product_month", f"SELECT product_id, sale_month, {_rs('total_quantity')} FROM mart_product_quantity_sold_by_month GROUP BY product_id, sale_month ORDER BY sale_month DESC"),
    ("report_products_by_year", f"SELECT sale_year, product_id, name, {RREV} FROM mart_top_products_by_year GROUP BY sale_year, product_id, name ORDER BY sale_year DESC, total_revenue DESC"),
    ("report_clients_by_year", f"SELECT sale_year, client_id, client_name, {RREV} FROM mart_top_clients_by_year GROUP BY sale_year, client_id, client_name ORDER BY sale_year DESC, total_revenue DESC"),
    ("report_client_frequency", f"SELECT client_id, client_name, {_rs('total_orders')}, {RREV} FROM mart_client_purchase_frequency GROUP BY client_id, client_name ORDER BY total_revenue DESC"),
]

VIEWS: list[tuple[str, str]] = FIXTURE_VIEWS + MART_VIEWS + REPORT_VIEWS
_VIEW_NAMES = [n for n, _ in VIEWS]


def with_views(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the views it mentions (and their dependencies)."""
    defs = list(VIEWS) + list(extra or [])
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name, text in defs:
            if name not in needed and _mentions(sql, name):
                needed.add(name)
                visit(text)

    visit(body)
    ctes = [f"{name} AS ({text.strip()})" for name, text in defs if name in needed]
    body = body.strip()
    if not ctes:
        return body
    head = "WITH "
    for lead in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(lead):
            # the statement's own WITH list continues after the views
            head, body = lead, ", " + body[len(lead):]
            break
    else:
        body = "\n" + body
    return head + ",\n".join(ctes) + body


def _mentions(sql: str, name: str) -> bool:
    import re

    return re.search(rf"(?<![\w.]){re.escape(name)}(?!\w)", sql) is not None


# Request tables (FIXTURES.md §6).
REQUEST_VIEWS: list[tuple[str, str]] = [
    ("client_inserts", """
SELECT CAST(c_custkey AS BIGINT) AS request_id, split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name,
       CASE c_mktsegment WHEN 'FURNITURE' THEN lower(replace(c_name,'#','.'))
                         WHEN 'HOUSEHOLD' THEN lower(replace(c_name,'#','.')) || '.new@example.com'
                         WHEN 'BUILDING' THEN 'shared' || CAST(c_custkey // 10 AS VARCHAR) || '@example.com'
                         WHEN 'MACHINERY' THEN NULL
                         ELSE lower(replace(c_name,'#','.')) || '@example.com' END AS email
FROM customer"""),
    ("client_deletes", """
SELECT CAST(c_custkey AS BIGINT) AS client_id FROM customer WHERE c_acctbal < 0
UNION ALL SELECT CAST(c_custkey AS BIGINT) FROM customer WHERE c_custkey % 50 = 0 AND c_acctbal >= 0
UNION ALL SELECT CAST(-1 - c_custkey AS BIGINT) FROM customer WHERE c_acctbal < -500"""),
    ("client_patches", """
SELECT CAST(c_custkey AS BIGINT) AS client_id,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '{"first_name":"' || upper(split_part(c_name,'#',1)) || '"}'
                         WHEN 'MACHINERY' THEN '{"email":null}'
                         WHEN 'BUILDING' THEN '{"last_name":"Renamed"}'
                         WHEN 'FURNITURE' THEN '{"email":"shared' || CAST(c_custkey // 10 AS VARCHAR) || '@example.com"}'
                         ELSE '{}' END AS patch,
       CAST(c_custkey * 10 AS BIGINT) AS seq
FROM customer
UNION ALL
SELECT CAST(c_custkey AS BIGINT),
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '{"last_name":"Second"}' WHEN 'MACHINERY' THEN '{"first_name":null}'
                         WHEN 'BUILDING' THEN 'not json' WHEN 'FURNITURE' THEN '{"email":"nobody"}'
                         ELSE '{"last_name":"' || repeat('x', 101) || '"}' END,
       CAST(c_custkey * 10 + 1 AS BIGINT)
FROM customer
UNION ALL
SELECT CAST(-1 - c_custkey AS BIGINT), '{"first_name":"Nobody"}', CAST(c_custkey * 10 + 2 AS BIGINT) FROM customer WHERE c_acctbal < 0"""),
    ("seller_inserts", """
SELECT CAST(s_suppkey AS BIGINT) AS request_id, split_part(s_name,'#',1) AS first_name,
       CASE WHEN s_acctbal < 1000 THEN NULL ELSE split_part(s_name,'#',2) END AS last_name,
       CASE WHEN s_acctbal > 9000 THEN repeat(s_name, 20) ELSE s_name END AS company_name,
       lower(replace(s_name,'#','.')) || '.new@example.com' AS email
FROM supplier"""),
    ("seller_deletes", """
SELECT CAST(s_suppkey AS BIGINT) AS seller_id FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 8000
UNION ALL SELECT CAST(-1 - s_suppkey AS BIGINT) FROM supplier WHERE s_acctbal > 9000"""),
    ("seller_patches", """
SELECT CAST(s_suppkey AS BIGINT) AS seller_id,
       CASE WHEN s_acctbal > 5000 THEN '{"company_name":"' || s_name || ' Group"}'
            WHEN s_acctbal < 1000 THEN '{"company_name":null}' WHEN s_acctbal < 2000 THEN '{"email":"no address"}'
            WHEN s_acctbal < 3000 THEN '["list"]' ELSE '{}' END AS patch,
       CAST(s_suppkey AS BIGINT) AS seq
FROM supplier"""),
    ("product_inserts", """
SELECT CAST(p_partkey AS BIGINT) AS request_id, CAST(p_partkey % (SELECT count(*) + 3 FROM supplier) AS BIGINT) AS seller_id,
       p_name AS name,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) - CASE WHEN p_type = 'PROMO' THEN 1000 ELSE 0 END AS DECIMAL(12,2)) AS price,
       CAST(CASE WHEN p_size > 40 THEN NULL WHEN p_size < 4 THEN 0 ELSE p_size END AS BIGINT) AS quantity
FROM part"""),
    ("product_patches", """
SELECT CAST(p_partkey AS BIGINT) AS product_id,
       CASE p_type WHEN 'STANDARD' THEN '{"price":"' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 1 AS VARCHAR) || '"}'
                   WHEN 'SMALL' THEN '{"name":"' || p_name || ' v2"}'
                   WHEN 'LARGE' THEN '{"quantity":"' || CAST(p_size + 10 AS VARCHAR) || '"}' ELSE '{}' END AS patch,
       CAST(p_partkey * 10 AS BIGINT) AS seq
FROM part
UNION ALL
SELECT CAST(p_partkey AS BIGINT),
       CASE p_type WHEN 'STANDARD' THEN '{"quantity":"-5"}' WHEN 'SMALL' THEN '{"quantity":7}' WHEN 'LARGE' THEN '{"quantity":"abc"}'
                   WHEN 'PROMO' THEN '{"price":"0.00"}' WHEN 'MEDIUM' THEN '{"quantity":null}' ELSE 'not json' END,
       CAST(p_partkey * 10 + 1 AS BIGINT)
FROM part
UNION ALL
SELECT CAST(-1 - p_partkey AS BIGINT), '{"name":"nothing"}', CAST(p_partkey * 10 + 2 AS BIGINT) FROM part WHERE p_type = 'PROMO'"""),
    ("product_deletes", """
SELECT CAST(p_partkey AS BIGINT) AS product_id FROM part WHERE p_type = 'ECONOMY'
UNION ALL SELECT CAST(-1 - p_partkey AS BIGINT) FROM part WHERE p_type = 'PROMO'"""),
    ("purchase_requests", """
SELECT purchase_id AS request_id, NULLIF(client_id, 0) AS client_id, product_id,
       CAST(CASE WHEN quantity = 50 THEN 0 ELSE quantity END AS BIGINT) AS quantity, purchased_at AS requested_at FROM purchase_events"""),
    ("purchase_deletes", """
SELECT DISTINCT CAST(l_orderkey*8+l_linenumber AS BIGINT) AS purchase_id FROM lineitem WHERE l_returnflag = 'R'"""),
]

VIEWS.extend(REQUEST_VIEWS)
