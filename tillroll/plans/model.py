"""Registered staging / dedup / join / projection / filter / rule queries and their
oracle SQL (SURVEY §2.2–§2.5, §2.9, L1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import buckets as B
from tillroll.functions import casts as C
from tillroll.operators import access as A
from tillroll.operators import dedup as D
from tillroll.operators import ledger
from tillroll.operators import rules as U
from tillroll.operators import star as S
from tillroll.operators import stock
from tillroll.plans.oracle import with_views
from tillroll.session import scratch_path
from tillroll.sources import requests as RQ
from tillroll.sources.fixtures import Fixture

# Fixed job parameter: the "now" used for generated timestamps (P16), so runs are reproducible.
JOB_NOW = "2025-01-01 00:00:00"

QUERIES = {}
SQL = {}


def reg(key, sql):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = with_views(sql)
        return fn
    return deco


def fx(spark, d) -> Fixture:
    return Fixture(spark, d)


# ---- D1–D4 ----------------------------------------------------------------------------

reg("dedup_clients", "SELECT * FROM clients")(lambda s, d: D.dedup_clients(fx(s, d).clients_raw))
reg("dedup_sellers", "SELECT * FROM sellers")(lambda s, d: D.dedup_sellers(fx(s, d).sellers_raw))
reg("dedup_products", "SELECT * FROM products")(lambda s, d: D.dedup_products(fx(s, d).products_raw))
reg("dedup_purchases", """
SELECT * FROM purchase_events_tied
QUALIFY row_number() OVER (PARTITION BY purchase_id ORDER BY purchased_at DESC, product_id DESC, quantity DESC, full_price DESC,
                           client_id DESC, price DESC) = 1""")(
    lambda s, d: D.dedup_purchases(fx(s, d).purchase_events_tied))


# ---- P1–P3, P6–P9, P13–P16 ---------------------------------------------------------------

reg("project_clients", "SELECT client_id, first_name, last_name, email, signup_date FROM clients_raw")(
    lambda s, d: fx(s, d).clients_raw.select(*schemas.CLIENT_COLS))
reg("project_sellers", "SELECT seller_id, first_name, last_name, company_name, email, created_at FROM sellers")(
    lambda s, d: fx(s, d).sellers.select(*schemas.SELLER_COLS))
reg("project_products", "SELECT product_id, seller_id, name, price, quantity, created_at FROM products")(
    lambda s, d: fx(s, d).products.select(*schemas.PRODUCT_COLS))


@reg("ts_normalise", "SELECT purchase_id, purchased_at FROM purchase_events")
def _ts_normalise(s, d):
    ev = fx(s, d).purchase_events.select(
        "purchase_id", F.date_format("purchased_at", "yyyy-MM-dd'T'HH:mm:ss").alias("purchased_at"))
    return C.ts_normalise(ev, ["purchased_at"])


@reg("conform_purchases", "SELECT * FROM purchase_events")
def _conform(s, d):
    ev = fx(s, d).purchase_events
    as_text = ev.select(*[F.col(c).cast("string").alias(c) for c in ev.columns])
    return C.conform_purchases(as_text)


reg("display_name", "SELECT client_id, first_name || ' ' || last_name AS client_name FROM clients")(
    lambda s, d: fx(s, d).clients.select("client_id", B.display_name().alias("client_name")))
reg("bucket_day", "SELECT purchase_id, CAST(purchased_at AS DATE) AS sale_date FROM fact")(
    lambda s, d: fx(s, d).fact.select("purchase_id", B.sale_date().alias("sale_date")))
reg("bucket_month", "SELECT purchase_id, strftime(purchased_at, '%Y-%m') AS sale_month FROM fact")(
    lambda s, d: fx(s, d).fact.select("purchase_id", B.sale_month().alias("sale_month")))
reg("bucket_year", "SELECT purchase_id, CAST(year(purchased_at) AS INTEGER) AS sale_year FROM fact")(
    lambda s, d: fx(s, d).fact.select("purchase_id", B.sale_year().alias("sale_year")))


@reg("json_parse", "SELECT * FROM purchases")
def _json_parse(s, d):
    ev = C.parse_events(C.event_json(fx(s, d).purchases))
    return C.conform_purchases(ev.select(*schemas.PURCHASE_COLS))


@reg("event_json", "SELECT * FROM purchases")
def _event_json(s, d):
    """P15 envelope, parsed back (the envelope text itself is engine formatting)."""
    text = C.event_json(fx(s, d).purchases)
    back = text.select(F.from_json("value", schemas.EVENT_PAYLOAD).alias("e")).select("e.*")
    return C.conform_purchases(back.select(*schemas.PURCHASE_COLS))


@reg("price_purchases", """
SELECT r.request_id, r.client_id, r.product_id, r.quantity, r.requested_at,
       CAST(COALESCE(p.price, 0) AS DECIMAL(10,2)) AS price,
       CAST(CAST(COALESCE(p.price, 0) AS DECIMAL(10,2)) * r.quantity AS DECIMAL(12,2)) AS full_price
FROM purchase_requests r LEFT JOIN products p ON r.product_id = p.product_id""")
def _price(s, d):
    return U.price_purchases(RQ.purchase_requests(s, d), fx(s, d).products)


reg("fill_defaults_quantity", """
SELECT request_id, seller_id, name, price, COALESCE(quantity, 1) AS quantity FROM product_inserts""")(
    lambda s, d: U.fill_defaults(RQ.product_inserts(s, d), JOB_NOW))


@reg("fill_defaults", f"SELECT *, TIMESTAMP '{JOB_NOW}' AS signup_date FROM client_inserts")
def _fill(s, d):
    req = RQ.client_inserts(s, d).withColumn("signup_date", F.lit(None).cast("timestamp_ntz"))
    return U.fill_defaults(req, JOB_NOW, quantity=None, timestamps=["signup_date"])


# ---- F1, F2, F4, L1 ----------------------------------------------------------------------

reg("lookup_client", "SELECT * FROM clients WHERE client_id IN (SELECT client_id FROM client_deletes)")(
    lambda s, d: A.lookup(fx(s, d).clients, RQ.client_deletes(s, d), "client_id"))
reg("lookup_seller", "SELECT * FROM sellers WHERE seller_id IN (SELECT seller_id FROM seller_deletes)")(
    lambda s, d: A.lookup(fx(s, d).sellers, RQ.seller_deletes(s, d), "seller_id"))
reg("lookup_product", "SELECT * FROM products WHERE product_id IN (SELECT product_id FROM product_deletes)")(
    lambda s, d: A.lookup(fx(s, d).products, RQ.product_deletes(s, d), "product_id"))
reg("lookup_purchase", "SELECT * FROM purchases WHERE purchase_id IN (SELECT purchase_id FROM purchase_deletes)")(
    lambda s, d: A.lookup(fx(s, d).purchases, RQ.purchase_deletes(s, d), "purchase_id"))
reg("lookup_client_not_found",
    "SELECT client_id FROM client_deletes WHERE client_id NOT IN (SELECT client_id FROM clients)")(
    lambda s, d: A.not_found(RQ.client_deletes(s, d), fx(s, d).clients, "client_id"))

reg("list_products_by_seller", "SELECT * FROM products WHERE seller_id = 0")(
    lambda s, d: A.filter_optional(fx(s, d).products, seller_id=0))
reg("list_purchases_filtered", "SELECT * FROM purchases WHERE client_id = 1")(
    lambda s, d: A.filter_optional(fx(s, d).purchases, client_id=1, product_id=None))


@reg("list_purchases_both", """
SELECT * FROM purchases WHERE client_id = 1 AND product_id = (SELECT max(product_id) FROM purchases WHERE client_id = 1)""")
def _list_both(s, d):
    bought = fx(s, d).purchases
    product = bought.where("client_id = 1").select(F.max("product_id")).scalar()
    return A.filter_optional(bought, client_id=1, product_id=product)


reg("stock_available", """
SELECT r.product_id, r.request_id, r.client_id, r.quantity, r.requested_at, p.quantity AS stock
FROM purchase_requests r JOIN products p ON r.product_id = p.product_id WHERE p.quantity >= r.quantity""")(
    lambda s, d: U.stock_available(RQ.purchase_requests(s, d), fx(s, d).products))

for _key, _view, _pk, _skip in [("page_clients", "clients", "client_id", 100),
                                ("page_products", "products", "product_id", 100),
                                ("page_purchases", "purchases", "purchase_id", 100),
                                ("page_sellers", "sellers", "seller_id", 0)]:
    reg(_key, f"SELECT * FROM {_view} ORDER BY {_pk} LIMIT 100 OFFSET {_skip}")(
        (lambda v, pk, skip: lambda s, d: A.page(getattr(fx(s, d), v), pk, skip, 100))(_view, _pk, _skip))


# L1 deep pages: keyset form (the page after a known key: pushed-down filter + top-k, no offset scan).
KEYSET_AFTER = 1000
reg("page_purchases_keyset", f"SELECT * FROM purchases WHERE purchase_id > {KEYSET_AFTER} ORDER BY purchase_id LIMIT 100")(
    lambda s, d: A.page_after(fx(s, d).purchases, "purchase_id", KEYSET_AFTER, 100))


# ---- J1, J2, J7–J12 -------------------------------------------------------------------------

reg("fact_client_resolve", """
SELECT d.purchase_id, c.client_id, d.product_id, d.quantity, d.price, d.full_price, d.purchased_at
FROM purchases d LEFT JOIN clients c ON d.client_id = c.client_id""")(
    lambda s, d: S.resolve_client(fx(s, d).purchases, fx(s, d).clients))


@reg("fact_seller_resolve", """
SELECT d.*, p.seller_id FROM purchases d LEFT JOIN products p ON d.product_id = p.product_id""")
def _seller_resolve(s, d):
    f = fx(s, d)
    return S.resolve_seller(f.purchases, f.products)


@reg("valid_purchases_semi", """
SELECT * FROM purchase_requests r
WHERE EXISTS (SELECT 1 FROM clients c WHERE c.client_id = r.client_id)
  AND EXISTS (SELECT 1 FROM products p WHERE p.product_id = r.product_id)""")
def _valid(s, d):
    f = fx(s, d)
    return U.valid_purchases(RQ.purchase_requests(s, d), f.clients, f.products)


@reg("orphan_purchases_anti", """
SELECT r.*, CASE WHEN NOT EXISTS (SELECT 1 FROM clients c WHERE c.client_id = r.client_id)
                 THEN 'Client not found' ELSE 'Product not found' END AS reason
FROM purchase_requests r
WHERE NOT EXISTS (SELECT 1 FROM clients c WHERE c.client_id = r.client_id)
   OR NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = r.product_id)""")
def _orphans(s, d):
    f = fx(s, d)
    return U.orphan_purchases(RQ.purchase_requests(s, d), f.clients, f.products)


@reg("deletable_clients", """
SELECT q.client_id FROM client_deletes q
WHERE EXISTS (SELECT 1 FROM clients c WHERE c.client_id = q.client_id)
  AND NOT EXISTS (SELECT 1 FROM purchases p WHERE p.client_id = q.client_id)""")
def _deletable(s, d):
    f = fx(s, d)
    return U.deletable_clients(RQ.client_deletes(s, d), f.clients, f.purchases)


_NOT_DELETED = """
SELECT * FROM purchases p WHERE NOT EXISTS (SELECT 1 FROM purchase_deletes x WHERE x.purchase_id = p.purchase_id)"""
reg("purchases_not_deleted", _NOT_DELETED)(
    lambda s, d: U.purchases_not_deleted(fx(s, d).purchases, RQ.purchase_deletes(s, d)))
reg("delete_purchases", _NOT_DELETED)(
    lambda s, d: U.delete_purchases(fx(s, d).purchases, fx(s, d).products, RQ.purchase_deletes(s, d))[0])

_UNIQUE_EMAIL = """
SELECT * FROM client_inserts r WHERE NOT EXISTS (SELECT 1 FROM clients c WHERE c.email = r.email)
QUALIFY email IS NULL OR row_number() OVER (PARTITION BY email ORDER BY request_id) = 1"""
reg("new_clients_unique_email", _UNIQUE_EMAIL)(
    lambda s, d: U.new_clients_unique_email(RQ.client_inserts(s, d), fx(s, d).clients))

reg("email_taken", f"""
SELECT *, 'Email already registered' AS reason FROM client_inserts r
WHERE request_id NOT IN (SELECT request_id FROM ({_UNIQUE_EMAIL}) k)""")(
    lambda s, d: U.email_taken(RQ.client_inserts(s, d), fx(s, d).clients))

# Deletes that the purchases hold back: known and not purchased, by product and by seller.
_OK_PRODUCTS = """
SELECT x.product_id FROM product_deletes x
WHERE EXISTS (SELECT 1 FROM products p WHERE p.product_id = x.product_id)
  AND NOT EXISTS (SELECT 1 FROM purchases b WHERE b.product_id = x.product_id)"""
_OK_SELLERS = """
SELECT x.seller_id FROM seller_deletes x
WHERE EXISTS (SELECT 1 FROM sellers t WHERE t.seller_id = x.seller_id)
  AND NOT EXISTS (SELECT 1 FROM products p JOIN purchases b ON b.product_id = p.product_id WHERE p.seller_id = x.seller_id)"""


def _ok_clients(s, d):
    f = fx(s, d)
    return U.deletable_clients(RQ.client_deletes(s, d), f.clients, f.purchases)


def _ok_products(s, d):
    f = fx(s, d)
    return U.deletable_products(RQ.product_deletes(s, d), f.products, f.purchases)


def _ok_sellers(s, d):
    f = fx(s, d)
    return U.deletable_sellers(RQ.seller_deletes(s, d), f.sellers, f.products, f.purchases)


reg("deletable_products", _OK_PRODUCTS)(_ok_products)
reg("deletable_sellers", _OK_SELLERS)(_ok_sellers)


def _refused_sql(deletes, ok, table, key, reason):
    return f"""
SELECT x.{key}, CASE WHEN NOT EXISTS (SELECT 1 FROM {table} t WHERE t.{key} = x.{key}) THEN 'not found' ELSE '{reason}' END AS reason
FROM {deletes} x WHERE NOT EXISTS (SELECT 1 FROM ({ok}) k WHERE k.{key} = x.{key})"""


_OK_CLIENTS = """
SELECT q.client_id FROM client_deletes q
WHERE EXISTS (SELECT 1 FROM clients c WHERE c.client_id = q.client_id)
  AND NOT EXISTS (SELECT 1 FROM purchases p WHERE p.client_id = q.client_id)"""
reg("delete_clients_rejected", _refused_sql("client_deletes", _OK_CLIENTS, "clients", "client_id",
                                            "Cannot delete client with existing purchases"))(
    lambda s, d: U.refused_deletes(RQ.client_deletes(s, d), _ok_clients(s, d), fx(s, d).clients, "client_id", U.HAS_PURCHASES))
reg("delete_products_rejected", _refused_sql("product_deletes", _OK_PRODUCTS, "products", "product_id",
                                             "Cannot delete product with existing purchases"))(
    lambda s, d: U.refused_deletes(RQ.product_deletes(s, d), _ok_products(s, d), fx(s, d).products, "product_id",
                                   U.PRODUCT_HAS_PURCHASES))
reg("delete_sellers_rejected", _refused_sql("seller_deletes", _OK_SELLERS, "sellers", "seller_id",
                                            "Cannot delete seller with purchased products"))(
    lambda s, d: U.refused_deletes(RQ.seller_deletes(s, d), _ok_sellers(s, d), fx(s, d).sellers, "seller_id",
                                   U.SELLER_HAS_PURCHASES))

reg("cascade_delete_products", f"""
SELECT * FROM products p WHERE p.seller_id NOT IN (SELECT seller_id FROM ({_OK_SELLERS}) x)""")(
    lambda s, d: U.cascade_delete_products(fx(s, d).products, _ok_sellers(s, d)))


@reg("set_null_missing_dim", """
SELECT f.purchase_id, f.client_id, f.product_id, s.seller_id, f.quantity, f.price, f.full_price, f.purchased_at
FROM fact f LEFT JOIN (SELECT seller_id FROM sellers x
                        WHERE NOT EXISTS (SELECT 1 FROM seller_deletes y WHERE y.seller_id = x.seller_id)) s
  ON f.seller_id = s.seller_id""")
def _set_null(s, d):
    f = fx(s, d)
    kept = U.delete_by_key(f.sellers, RQ.seller_deletes(s, d), "seller_id")
    return S.set_null_missing(f.fact, kept, "seller_id").select(*schemas.FACT_COLS)


# ---- U3 deletes, U5 restock ----------------------------------------------------------------

reg("delete_clients", """
SELECT * FROM clients c WHERE NOT EXISTS (
  SELECT 1 FROM client_deletes q WHERE q.client_id = c.client_id
    AND NOT EXISTS (SELECT 1 FROM purchases p WHERE p.client_id = q.client_id))""")(
    lambda s, d: U.delete_by_key(fx(s, d).clients,
                                 U.deletable_clients(RQ.client_deletes(s, d), fx(s, d).clients, fx(s, d).purchases),
                                 "client_id"))
reg("delete_products", f"SELECT * FROM products p WHERE product_id NOT IN (SELECT product_id FROM ({_OK_PRODUCTS}) x)")(
    lambda s, d: U.delete_by_key(fx(s, d).products, _ok_products(s, d), "product_id"))
reg("delete_sellers", f"SELECT * FROM sellers p WHERE seller_id NOT IN (SELECT seller_id FROM ({_OK_SELLERS}) x)")(
    lambda s, d: U.delete_by_key(fx(s, d).sellers, _ok_sellers(s, d), "seller_id"))


@reg("restock", """
SELECT p.product_id, p.seller_id, p.name, p.price, CAST(p.quantity + COALESCE(b.back, 0) AS BIGINT) AS quantity, p.created_at
FROM products p LEFT JOIN (
  SELECT product_id, sum(quantity) AS back FROM purchases x
  WHERE EXISTS (SELECT 1 FROM purchase_deletes y WHERE y.purchase_id = x.purchase_id) GROUP BY product_id) b
ON p.product_id = b.product_id""")
def _restock(s, d):
    f = fx(s, d)
    return U.delete_purchases(f.purchases, f.products, RQ.purchase_deletes(s, d))[1]


# ---- V1–V3 -----------------------------------------------------------------------------------

def _reason_sql(parts: list[str]) -> str:
    return "NULLIF(concat_ws(';', " + ", ".join(parts) + "), '') AS reason"


def _text_sql(field, limit):
    return [f"CASE WHEN {field} IS NULL THEN '{field} missing' END",
            f"CASE WHEN length({field}) > {limit} THEN '{field} too long' END"]


_EMAIL_SQL = ["CASE WHEN email IS NULL THEN 'email missing' END",
              "CASE WHEN length(email) > 255 THEN 'email too long' END",
              r"CASE WHEN email IS NOT NULL AND NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$') "
              "THEN 'email invalid' END"]
CLIENT_REASON_SQL = _reason_sql(_text_sql("first_name", 100) + _text_sql("last_name", 100) + _EMAIL_SQL)
SELLER_REASON_SQL = _reason_sql(_text_sql("first_name", 100) + _text_sql("last_name", 100)
                                + _text_sql("company_name", 200) + _EMAIL_SQL)
PRODUCT_REASON_SQL = _reason_sql(["CASE WHEN seller_id IS NULL THEN 'seller_id missing' END"]
                                 + _text_sql("name", 200)
                                 + ["CASE WHEN price IS NULL THEN 'price missing' END",
                                    "CASE WHEN price <= 0 THEN 'price must be positive' END",
                                    "CASE WHEN quantity < 1 THEN 'quantity below 1' END"])
PURCHASE_REASON_SQL = _reason_sql(["CASE WHEN client_id IS NULL THEN 'client_id missing' END",
                                   "CASE WHEN product_id IS NULL THEN 'product_id missing' END",
                                   "CASE WHEN quantity < 1 THEN 'quantity below 1' END"])

reg("validate_clients", f"SELECT *, {CLIENT_REASON_SQL} FROM client_inserts")(
    lambda s, d: U.with_reasons(RQ.client_inserts(s, d), U.client_rules()))
reg("validate_sellers", f"SELECT *, {SELLER_REASON_SQL} FROM seller_inserts")(
    lambda s, d: U.with_reasons(RQ.seller_inserts(s, d), U.seller_rules()))
reg("validate_products", f"SELECT *, {PRODUCT_REASON_SQL} FROM product_inserts")(
    lambda s, d: U.with_reasons(RQ.product_inserts(s, d), U.product_rules()))
reg("validate_purchases", f"SELECT *, {PURCHASE_REASON_SQL} FROM purchase_requests")(
    lambda s, d: U.with_reasons(RQ.purchase_requests(s, d), U.purchase_rules()))


@reg("classify_purchases", """
SELECT r.*, CASE WHEN c.client_id IS NULL THEN 'Client not found'
                 WHEN p.product_id IS NULL THEN 'Product not found'
                 WHEN p.quantity < r.quantity THEN 'Not enough quantity available' END AS reason
FROM purchase_requests r LEFT JOIN clients c ON r.client_id = c.client_id
LEFT JOIN products p ON r.product_id = p.product_id""")
def _classify(s, d):
    f = fx(s, d)
    return U.classify_purchases(RQ.purchase_requests(s, d), f.clients, f.products)


# ---- U1 partial updates ----------------------------------------------------------------------

# field → (type of its value, longest text or None, may not be NULL)
_CLIENT_FIELDS = {"first_name": ("VARCHAR", 100, True), "last_name": ("VARCHAR", 100, True), "email": ("VARCHAR", 255, False)}
_SELLER_FIELDS = {"first_name": ("VARCHAR", 100, True), "last_name": ("VARCHAR", 100, True),
                  "company_name": ("VARCHAR", 200, True), "email": ("VARCHAR", 255, False)}
_PRODUCT_FIELDS = {"name": ("VARCHAR", 200, True), "price": ("DECIMAL(12,2)", None, True), "quantity": ("BIGINT", None, True)}


def _field_reason_sql(f, limit, required):
    parts = [f"CASE WHEN has_{f} AND raw_{f} IS NULL THEN '{f} missing' END"] if required else []
    parts.append(f"CASE WHEN raw_{f} IS NOT NULL AND val_{f} IS NULL THEN '{f} invalid' END")
    if limit:
        parts.append(f"CASE WHEN length(val_{f}) > {limit} THEN '{f} too long' END")
    if f == "email":
        parts.append(r"CASE WHEN NOT regexp_matches(val_email, '^[^@\s]+@[^@\s]+\.[^@\s]+$') THEN 'email invalid' END")
    if f == "price":
        parts.append("CASE WHEN val_price <= 0 THEN 'price must be positive' END")
    if f == "quantity":
        parts.append("CASE WHEN val_quantity < 1 THEN 'quantity below 1' END")
    return parts


def _patch_ctes(table, patches, key, fields):
    """``checked_<table>``: every patch with its typed fields and reason; ``merged_<table>``: latest accepted value of each field."""
    has = ", ".join(f"coalesce(json_exists(p, '$.{f}'), false) AS has_{f}, json_extract_string(p, '$.{f}') AS raw_{f}" for f in fields)
    val = ", ".join(f"TRY_CAST(raw_{f} AS {t}) AS val_{f}" for f, (t, _, _) in fields.items())
    reasons = ["CASE WHEN p IS NULL THEN 'patch is not a JSON object' END",
               f"CASE WHEN NOT EXISTS (SELECT 1 FROM {table} t WHERE t.{key} = w.{key}) THEN 'not found' END"]
    for f, (_, limit, required) in fields.items():
        reasons += _field_reason_sql(f, limit, required)
    taken = "reason"
    if "email" in fields:
        taken = f"""CASE WHEN reason IS NULL AND val_email IS NOT NULL AND coalesce(
    (SELECT min(t.{key}) FROM {table} t WHERE t.email = v.val_email),
    (SELECT arg_min(o.{key}, o.seq) FROM valued_{table} o WHERE o.reason IS NULL AND o.val_email = v.val_email)) <> v.{key}
  THEN 'Email already registered' ELSE reason END AS reason"""
    last = ", ".join(f"bool_or(has_{f}) AS any_{f}, last(val_{f} ORDER BY seq) FILTER (WHERE has_{f}) AS new_{f}" for f in fields)
    return f"""object_{table} AS (
  SELECT {key}, seq, patch, CASE WHEN CASE WHEN json_valid(patch) THEN json_type(patch) END = 'OBJECT' THEN patch END AS p FROM {patches}),
raw_{table} AS (SELECT {key}, seq, patch, p, {has} FROM object_{table}),
typed_{table} AS (SELECT *, {val} FROM raw_{table}),
valued_{table} AS (SELECT *, {_reason_sql(reasons)} FROM typed_{table} w),
checked_{table} AS (SELECT * EXCLUDE (reason), {taken} FROM valued_{table} v),
merged_{table} AS (SELECT {key}, {last} FROM checked_{table} WHERE reason IS NULL GROUP BY {key})"""


def _updated_sql(table, key, columns, fields):
    cols = ", ".join(f"CASE WHEN m.any_{c} THEN m.new_{c} ELSE t.{c} END AS {c}" if c in fields else f"t.{c}" for c in columns)
    return f"SELECT {cols} FROM {table} t LEFT JOIN merged_{table} m ON t.{key} = m.{key}"


_PATCHED = {"clients": ("client_patches", "client_id", _CLIENT_FIELDS, schemas.CLIENT_COLS),
            "sellers": ("seller_patches", "seller_id", _SELLER_FIELDS, schemas.SELLER_COLS),
            "products": ("product_patches", "product_id", _PRODUCT_FIELDS, schemas.PRODUCT_COLS)}


def _patched(s, d, table):
    patches, key, fields, _ = _PATCHED[table]
    return U.apply_patches(getattr(fx(s, d), table), getattr(RQ, patches)(s, d), key, list(fields), order="seq")


for _table, (_patches, _key, _fields, _columns) in _PATCHED.items():
    _ctes = _patch_ctes(_table, _patches, _key, _fields)
    reg(f"update_{_table}", f"WITH {_ctes} {_updated_sql(_table, _key, _columns, _fields)}")(
        (lambda t: lambda s, d: _patched(s, d, t)[0])(_table))
    reg(f"update_{_table}_rejected", f"WITH {_ctes} SELECT {_key}, seq, reason FROM checked_{_table} WHERE reason IS NOT NULL")(
        (lambda t: lambda s, d: _patched(s, d, t)[1])(_table))


# ---- U2 inserts with generated keys --------------------------------------------------------------

@reg("insert_clients", f"""
WITH ok AS (
  SELECT * FROM (SELECT *, {CLIENT_REASON_SQL} FROM client_inserts) v
  WHERE reason IS NULL AND NOT EXISTS (SELECT 1 FROM clients c WHERE c.email = v.email)
  QUALIFY row_number() OVER (PARTITION BY email ORDER BY request_id) = 1)
SELECT CAST((SELECT max(client_id) FROM clients) + row_number() OVER (ORDER BY request_id) AS BIGINT) AS client_id,
       first_name, last_name, email, TIMESTAMP '{JOB_NOW}' AS signup_date
FROM ok""")
def _insert_clients(s, d):
    f = fx(s, d)
    ok, _ = U.validate(RQ.client_inserts(s, d), U.client_rules())
    ok = U.new_clients_unique_email(ok, f.clients)
    ok = U.fill_defaults(ok.withColumn("signup_date", F.lit(None).cast("timestamp_ntz")), JOB_NOW, None,
                         ["signup_date"])
    return U.assign_ids(ok, f.clients, "client_id", ["request_id"]).select(*schemas.CLIENT_COLS)


@reg("insert_sellers", f"""
WITH ok AS (
  SELECT * FROM (SELECT *, {SELLER_REASON_SQL} FROM seller_inserts) v
  WHERE reason IS NULL AND NOT EXISTS (SELECT 1 FROM sellers c WHERE c.email = v.email)
  QUALIFY row_number() OVER (PARTITION BY email ORDER BY request_id) = 1)
SELECT CAST((SELECT max(seller_id) FROM sellers) + row_number() OVER (ORDER BY request_id) AS BIGINT) AS seller_id,
       first_name, last_name, company_name, email, TIMESTAMP '{JOB_NOW}' AS created_at
FROM ok""")
def _insert_sellers(s, d):
    f = fx(s, d)
    ok, _ = U.validate(RQ.seller_inserts(s, d), U.seller_rules())
    ok = U.new_clients_unique_email(ok, f.sellers)
    ok = U.fill_defaults(ok.withColumn("created_at", F.lit(None).cast("timestamp_ntz")), JOB_NOW, None,
                         ["created_at"])
    return U.assign_ids(ok, f.sellers, "seller_id", ["request_id"]).select(*schemas.SELLER_COLS)


@reg("insert_products", f"""
WITH ok AS (
  SELECT * FROM (SELECT *, {PRODUCT_REASON_SQL} FROM product_inserts) v
  WHERE reason IS NULL AND EXISTS (SELECT 1 FROM sellers s WHERE s.seller_id = v.seller_id))
SELECT CAST((SELECT max(product_id) FROM products) + row_number() OVER (ORDER BY request_id) AS BIGINT) AS product_id,
       seller_id, name, price, CAST(COALESCE(quantity, 1) AS BIGINT) AS quantity, TIMESTAMP '{JOB_NOW}' AS created_at
FROM ok""")
def _insert_products(s, d):
    f = fx(s, d)
    ok, _ = U.validate(RQ.product_inserts(s, d), U.product_rules())
    ok = ok.join(f.sellers.select("seller_id"), "seller_id", "left_semi")
    ok = U.fill_defaults(ok.withColumn("created_at", F.lit(None).cast("timestamp_ntz")), JOB_NOW, "quantity",
                         ["created_at"])
    return U.assign_ids(ok, f.products, "product_id", ["request_id"]).select(*schemas.PRODUCT_COLS)


# ---- V2 constraint audit ---------------------------------------------------------------------------

def _audit_sql(table, pk, unique, not_null, limits, fks):
    def row(name, sql):
        return f"SELECT '{table}' AS table_name, '{name}' AS check_name, CAST(({sql}) AS BIGINT) AS violations"

    def twice(c, where=""):
        return f"SELECT count(*) FROM (SELECT {c} FROM {table} {where} GROUP BY {c} HAVING count(*) > 1)"

    out = [row("pk_unique", twice(pk))] + [row(f"{u}_unique", twice(u, f"WHERE {u} IS NOT NULL")) for u in unique]
    if not_null:
        out.append(row("not_null", f"SELECT count(*) FROM {table} WHERE " + " OR ".join(f"{c} IS NULL" for c in not_null)))
    if limits:
        out.append(row("too_long", f"SELECT count(*) FROM {table} WHERE " + " OR ".join(f"length({c}) > {n}" for c, n in limits)))
    for c, parent, name in fks:
        out.append(row(name, f"SELECT count(*) FROM {table} t WHERE t.{c} IS NOT NULL AND NOT EXISTS "
                             f"(SELECT 1 FROM {parent} p WHERE p.{c} = t.{c})"))
    return " UNION ALL ".join(out)


_CLIENT_LIMITS = [("first_name", 100), ("last_name", 100), ("email", 255)]
_SELLER_LIMITS = [("first_name", 100), ("last_name", 100), ("company_name", 200), ("email", 255)]
_CLIENT_NOT_NULL = ["client_id", "first_name", "last_name", "signup_date"]
_SELLER_NOT_NULL = ["seller_id", "first_name", "last_name", "company_name", "created_at"]
_PRODUCT_NOT_NULL = ["product_id", "seller_id", "name", "price", "quantity", "created_at"]
_FK_SELLER = [("seller_id", "sellers", "fk_seller")]
_AUDIT_SQL = " UNION ALL ".join([
    _audit_sql("clients_raw", "client_id", [], _CLIENT_NOT_NULL, _CLIENT_LIMITS, []),
    _audit_sql("clients", "client_id", ["email"], _CLIENT_NOT_NULL, _CLIENT_LIMITS, []),
    _audit_sql("sellers_raw", "seller_id", ["email"], _SELLER_NOT_NULL, _SELLER_LIMITS, []),
    _audit_sql("sellers", "seller_id", ["email"], _SELLER_NOT_NULL, _SELLER_LIMITS, []),
    _audit_sql("products_raw", "product_id", [], _PRODUCT_NOT_NULL, [("name", 200)], _FK_SELLER),
    _audit_sql("products", "product_id", [], _PRODUCT_NOT_NULL, [("name", 200)], _FK_SELLER),
    _audit_sql("purchases", "purchase_id", [], ["purchase_id", "client_id", "product_id", "quantity", "purchased_at"], [],
               [("client_id", "clients", "fk_client"), ("product_id", "products", "fk_product")]),
    _audit_sql("fact", "purchase_id", [], ["purchase_id", "quantity", "price", "full_price", "purchased_at"], [],
               [("client_id", "clients", "fk_client"), ("product_id", "products", "fk_product"), ("seller_id", "sellers", "fk_seller")]),
])


def audited_tables(s, d):
    f = fx(s, d)
    return {
        "clients_raw": f.clients_raw, "clients": f.clients, "sellers_raw": f.sellers_raw, "sellers": f.sellers,
        "products_raw": f.products_raw, "products": f.products, "purchases": f.purchases, "fact": f.fact}


@reg("audit_constraints", _AUDIT_SQL)
def _audit(s, d):
    from tillroll.operators import audit
    return audit.audit_constraints(audited_tables(s, d))


# ---- U4 stock allocation ------------------------------------------------------------------------

@reg("allocate_stock", """
WITH RECURSIVE q AS (
  SELECT r.purchase_id, r.product_id, r.quantity, p.quantity AS stock,
         row_number() OVER (PARTITION BY r.product_id ORDER BY r.purchased_at, r.purchase_id) AS rn
  FROM purchases r JOIN products p ON r.product_id = p.product_id),
t AS (
  SELECT purchase_id, product_id, quantity, rn, quantity <= stock AS accepted,
         CASE WHEN quantity <= stock THEN stock - quantity ELSE stock END AS remaining FROM q WHERE rn = 1
  UNION ALL
  SELECT q.purchase_id, q.product_id, q.quantity, q.rn, q.quantity <= t.remaining,
         CASE WHEN q.quantity <= t.remaining THEN t.remaining - q.quantity ELSE t.remaining END
  FROM t JOIN q ON q.product_id = t.product_id AND q.rn = t.rn + 1)
SELECT purchase_id, product_id, quantity, accepted, CAST(remaining AS BIGINT) AS remaining,
       CASE WHEN NOT accepted THEN 'Not enough quantity available' END AS reason FROM t""")
def _allocate(s, d):
    f = fx(s, d)
    return stock.allocate(f.purchases, f.products)


# Fixed value: a returned item is cancelled this many days after its purchase (FIXTURES.md §6).
CANCEL_AFTER_DAYS = 15


@reg("allocate_stock_ledger", f"""
WITH RECURSIVE ev AS (
  SELECT product_id, purchase_id, quantity, purchased_at AS ts, 0 AS kind FROM purchases
  UNION ALL
  SELECT p.product_id, p.purchase_id, p.quantity, p.purchased_at + INTERVAL {CANCEL_AFTER_DAYS} DAY AS ts, 1 AS kind
  FROM purchases p JOIN purchase_deletes x ON p.purchase_id = x.purchase_id),
q AS (
  SELECT ev.*, pr.quantity AS stock,
         row_number() OVER (PARTITION BY ev.product_id ORDER BY ts, kind, purchase_id) AS rn
  FROM ev JOIN products pr ON ev.product_id = pr.product_id),
t AS (
  SELECT product_id, purchase_id, quantity, kind, rn,
         CASE WHEN kind = 0 AND quantity <= stock THEN 'accepted' WHEN kind = 0 THEN 'refused' ELSE 'ignored' END AS effect,
         CASE WHEN kind = 0 AND quantity <= stock THEN stock - quantity ELSE stock END AS remaining,
         CASE WHEN kind = 0 AND quantity <= stock THEN [purchase_id] ELSE CAST([] AS BIGINT[]) END AS open_ids
  FROM q WHERE rn = 1
  UNION ALL
  SELECT q.product_id, q.purchase_id, q.quantity, q.kind, q.rn,
         CASE WHEN q.kind = 0 AND q.quantity <= t.remaining THEN 'accepted'
              WHEN q.kind = 0 THEN 'refused'
              WHEN list_contains(t.open_ids, q.purchase_id) THEN 'restocked' ELSE 'ignored' END,
         CASE WHEN q.kind = 0 AND q.quantity <= t.remaining THEN t.remaining - q.quantity
              WHEN q.kind = 1 AND list_contains(t.open_ids, q.purchase_id) THEN t.remaining + q.quantity
              ELSE t.remaining END,
         CASE WHEN q.kind = 0 AND q.quantity <= t.remaining THEN list_append(t.open_ids, q.purchase_id)
              WHEN q.kind = 1 AND list_contains(t.open_ids, q.purchase_id)
                   THEN list_filter(t.open_ids, lambda x: x <> q.purchase_id)
              ELSE t.open_ids END
  FROM t JOIN q ON q.product_id = t.product_id AND q.rn = t.rn + 1)
SELECT product_id, purchase_id, CASE kind WHEN 0 THEN 'purchase' ELSE 'cancel' END AS event, quantity, effect,
       CAST(remaining AS BIGINT) AS remaining
FROM t""")
def _allocate_ledger(s, d):
    f, path = fx(s, d), scratch_path(s, "ledger-purchases")
    f.purchases.write.parquet(path)  # requests, and what the cancellations are made of and joined with
    bought = s.read.schema(f.purchases.schema).parquet(path)
    cancels = A.lookup(bought, RQ.purchase_deletes(s, d), "purchase_id").select(
        "purchase_id", (F.col("purchased_at") + F.make_dt_interval(F.lit(CANCEL_AFTER_DAYS))).alias("cancelled_at"))
    return ledger.allocate_ledger(bought, cancels, f.products)


@reg("event_envelopes", "WITH " + ", ".join(
    [_patch_ctes(t, p, k, f) + f", updated_{t} AS ({_updated_sql(t, k, c, f)})" for t, (p, k, f, c) in _PATCHED.items()
     if t != "sellers"]) + """
SELECT 'product_created' AS kind, NULL::BIGINT AS purchase_id, NULL::BIGINT AS client_id, product_id, seller_id,
       NULL AS first_name, NULL AS last_name, NULL AS email, name, price, NULL::DECIMAL(12,2) AS full_price, quantity,
       NULL::TIMESTAMP AS purchased_at, created_at, NULL::TIMESTAMP AS signup_date, NULL::BOOLEAN AS deleted, NULL AS operation
FROM products
UNION ALL
SELECT 'product_updated', NULL, NULL, t.product_id, NULL, NULL, NULL, NULL, t.name, t.price, NULL, t.quantity,
       NULL, NULL, NULL, NULL, NULL
FROM updated_products t WHERE t.product_id IN (SELECT product_id FROM checked_products WHERE reason IS NULL AND patch <> '{}')
UNION ALL
SELECT 'product_deleted', NULL, NULL, p.product_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true, NULL
FROM products p JOIN product_deletes x ON p.product_id = x.product_id
UNION ALL
SELECT 'client_created', NULL, client_id, NULL, NULL, first_name, last_name, email, NULL, NULL, NULL, NULL, NULL, NULL,
       signup_date, NULL, NULL
FROM clients
UNION ALL
SELECT 'client_updated', NULL, t.client_id, NULL, NULL, t.first_name, t.last_name, t.email,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'update'
FROM updated_clients t WHERE t.client_id IN (SELECT client_id FROM checked_clients WHERE reason IS NULL AND patch <> '{}')
UNION ALL
SELECT 'purchase_created', purchase_id, client_id, product_id, NULL, NULL, NULL, NULL, NULL, price, full_price, quantity,
       purchased_at, NULL, NULL, NULL, NULL
FROM purchases
UNION ALL
SELECT 'purchase_deleted', x.purchase_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true, NULL
FROM purchases p JOIN purchase_deletes x ON p.purchase_id = x.purchase_id""")
def _event_envelopes(s, d):
    """P15 for every event kind, rendered as JSON and parsed back (JSON text is engine formatting)."""
    from tillroll.functions import envelopes as EV

    return EV.parse_envelopes(rendered_events(s, d))


def rendered_events(s, d):
    """Events of every kind as (kind, JSON text)."""
    from tillroll.functions import envelopes as EV

    f = fx(s, d)

    def changed(table):
        """Rows that an accepted patch changed."""
        patches, key, fields, _ = _PATCHED[table]
        asked = getattr(RQ, patches)(s, d).where(F.col("patch") != "{}")
        rows, rejected = U.apply_patches(getattr(f, table), asked, key, list(fields), order="seq")
        return rows.join(asked.join(rejected, [key, "seq"], "left_anti").select(key), key, "left_semi")

    changed_products, changed_clients = changed("products"), changed("clients")
    events = [
        EV.envelope(f.products, "product_created"),
        EV.envelope(changed_products, "product_updated"),
        EV.envelope(A.lookup(f.products, RQ.product_deletes(s, d), "product_id"), "product_deleted"),
        EV.envelope(f.clients, "client_created"),
        EV.envelope(changed_clients, "client_updated"),
        EV.envelope(f.purchases, "purchase_created"),
        EV.envelope(A.lookup(f.purchases, RQ.purchase_deletes(s, d), "purchase_id"), "purchase_deleted"),
    ]
    out = events[0]
    for e in events[1:]:
        out = out.unionByName(e)
    return out
