"""Write-side data rules as set operators.

The reference checks one HTTP request at a time; here each rule takes a table of
requests (or a micro-batch) and returns ``(accepted, rejected)``, the rejected
rows carrying a ``reason``. Existence checks are semi/anti joins; nothing is
collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.dedup import latest

# Field limits and messages of the request schemas / handlers.
NAME_MAX = 100
COMPANY_MAX = 200
PRODUCT_NAME_MAX = 200
EMAIL_MAX = 255
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
CLIENT_NOT_FOUND = "Client not found"
PRODUCT_NOT_FOUND = "Product not found"
SELLER_NOT_FOUND = "Seller not found"
NOT_ENOUGH = "Not enough quantity available"
EMAIL_TAKEN = "Email already registered"
HAS_PURCHASES = "Cannot delete client with existing purchases"
PRODUCT_HAS_PURCHASES = "Cannot delete product with existing purchases"
SELLER_HAS_PURCHASES = "Cannot delete seller with purchased products"
NOT_FOUND = "not found"
PATCH_NOT_OBJECT = "patch is not a JSON object"


# ---- V1 field validation ------------------------------------------------------

def _text_rules(field: str, limit: int) -> list[tuple[str, Column]]:
    c = F.col(field)
    return [(f"{field} missing", c.isNull()), (f"{field} too long", F.length(c) > limit)]


def _email_rules() -> list[tuple[str, Column]]:
    c = F.col("email")
    return [("email missing", c.isNull()), ("email too long", F.length(c) > EMAIL_MAX),
            ("email invalid", c.isNotNull() & ~c.rlike(EMAIL_PATTERN))]


def client_rules() -> list[tuple[str, Column]]:
    return _text_rules("first_name", NAME_MAX) + _text_rules("last_name", NAME_MAX) + _email_rules()


def seller_rules() -> list[tuple[str, Column]]:
    return (_text_rules("first_name", NAME_MAX) + _text_rules("last_name", NAME_MAX)
            + _text_rules("company_name", COMPANY_MAX) + _email_rules())


def product_rules() -> list[tuple[str, Column]]:
    return [
        ("seller_id missing", F.col("seller_id").isNull()),
        *_text_rules("name", PRODUCT_NAME_MAX),
        ("price missing", F.col("price").isNull()),
        ("price must be positive", F.col("price") <= 0),
        ("quantity below 1", F.col("quantity") < 1),
    ]


def purchase_rules() -> list[tuple[str, Column]]:
    return [
        ("client_id missing", F.col("client_id").isNull()),
        ("product_id missing", F.col("product_id").isNull()),
        ("quantity below 1", F.col("quantity") < 1),
    ]


def with_reasons(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds ``reason``: every failed rule, ``;``-joined in rule order; NULL when all pass."""
    hits = F.array_compact(F.array(*[F.when(cond, F.lit(msg)) for msg, cond in rules]))
    return df.withColumn("reason", F.when(F.size(hits) > 0, F.array_join(hits, ";")))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by the ``reason`` column."""
    return df.where(F.col("reason").isNull()).drop("reason"), df.where(F.col("reason").isNotNull())


def validate(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    return split(with_reasons(df, rules))


# ---- J7 / V3 / F4 existence and stock ----------------------------------------------

def valid_purchases(requests: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """J7 accepted: client and product both exist (two semi joins)."""
    return (requests.join(clients.select("client_id"), "client_id", "left_semi")
            .join(products.select("product_id"), "product_id", "left_semi"))


def orphan_purchases(requests: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """J7 rejected: client missing, or client present and product missing.

    One pass: two left joins against the key columns (a broadcast when a dimension
    is measured small) and a ``reason`` from the first missing key.
    """
    c = clients.select(F.col("client_id").alias("_c"))
    p = products.select(F.col("product_id").alias("_p"))
    j = requests.join(c, requests["client_id"] == c["_c"], "left").join(p, requests["product_id"] == p["_p"], "left")
    reason = F.when(F.col("_c").isNull(), F.lit(CLIENT_NOT_FOUND)).when(F.col("_p").isNull(), F.lit(PRODUCT_NOT_FOUND))
    return j.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("_c", "_p")


def classify_purchases(requests: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """V3: first failing rule per request — client missing → product missing → stock short.

    Stock is checked against the product's current quantity (one request alone);
    the ordered fold over many requests is ``stock.allocate``.
    """
    c = clients.select(F.col("client_id").alias("_c"))
    p = products.select(F.col("product_id").alias("_p"), F.col("quantity").alias("_stock"))
    j = requests.join(c, requests["client_id"] == c["_c"], "left").join(p, requests["product_id"] == p["_p"], "left")
    reason = (F.when(F.col("_c").isNull(), F.lit(CLIENT_NOT_FOUND))
              .when(F.col("_p").isNull(), F.lit(PRODUCT_NOT_FOUND))
              .when(F.col("_stock") < F.col("quantity"), F.lit(NOT_ENOUGH)))
    return j.withColumn("reason", reason).drop("_c", "_p", "_stock")


def stock_available(requests: DataFrame, products: DataFrame) -> DataFrame:
    """requests whose product has at least the requested quantity on hand."""
    p = products.select("product_id", F.col("quantity").alias("stock"))
    return requests.join(p, "product_id").where(F.col("stock") >= F.col("quantity"))


# ---- P14 / P16 ----------------------------------------------------------------------

def price_purchases(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Unit price from the product (0 if it vanished), ``full_price = price × quantity``."""
    p = products.select(F.col("product_id").alias("_p"), F.col("price").alias("_price"))
    j = requests.join(p, requests["product_id"] == p["_p"], "left")
    price = F.coalesce(F.col("_price"), F.lit(0)).cast("decimal(10,2)")
    return j.withColumn("price", price).drop("_p", "_price").withColumn(
        "full_price", (F.col("price") * F.col("quantity")).cast("decimal(12,2)"))


def fill_defaults(df: DataFrame, now: str, quantity: str | None = "quantity",
                  timestamps: Sequence[str] = ()) -> DataFrame:
    """``quantity`` defaults to 1; listed timestamps default to ``now`` (a job parameter)."""
    out = df
    if quantity and quantity in df.columns:
        out = out.withColumn(quantity, F.coalesce(F.col(quantity), F.lit(1)))
    for t in timestamps:
        out = out.withColumn(t, F.coalesce(F.col(t), F.lit(now).cast(df.schema[t].dataType)))
    return out


# ---- J8 J9 J10 J11 U3 U5 --------------------------------------------------------------

def deletable_clients(deletes: DataFrame, clients: DataFrame, purchases: DataFrame) -> DataFrame:
    """Delete requests for existing clients that have no purchases.

    The purchase side is reduced to distinct client ids first: map-side partial
    aggregation collapses a hot client before the shuffle, and that shuffle is the
    one the anti join needs anyway.
    """
    buyers = purchases.select("client_id").where(F.col("client_id").isNotNull()).distinct()
    return (deletes.join(clients.select("client_id"), "client_id", "left_semi")
            .join(buyers, "client_id", "left_anti"))


def deletable_products(deletes: DataFrame, products: DataFrame, purchases: DataFrame) -> DataFrame:
    """U3 guard: delete requests for existing products that no purchase refers to."""
    bought = purchases.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    return (deletes.join(products.select("product_id"), "product_id", "left_semi")
            .join(bought, "product_id", "left_anti"))


def deletable_sellers(deletes: DataFrame, sellers: DataFrame, products: DataFrame, purchases: DataFrame) -> DataFrame:
    """U3 guard: a seller's products go with it (J11), so none of them may have been purchased."""
    bought = purchases.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    blocked = products.join(bought, "product_id", "left_semi").select("seller_id").where(
        F.col("seller_id").isNotNull()).distinct()
    return (deletes.join(sellers.select("seller_id"), "seller_id", "left_semi")
            .join(blocked, "seller_id", "left_anti"))


def refused_deletes(deletes: DataFrame, allowed: DataFrame, existing: DataFrame, key: str, reason: str) -> DataFrame:
    """Rejected side of a guarded delete: unknown keys, and keys that the guard holds back."""
    known = existing.select(F.col(key).alias("_k")).distinct()
    left = deletes.join(allowed.select(key), key, "left_anti")
    return left.join(known, left[key] == F.col("_k"), "left").select(
        *[left[c] for c in left.columns],
        F.when(F.col("_k").isNull(), F.lit(NOT_FOUND)).otherwise(F.lit(reason)).alias("reason"))


def delete_purchases(purchases: DataFrame, products: DataFrame, deletes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """U3 + U5 as one operator: the purchases that stay, and the products with the deleted quantities put back."""
    gone = purchases.join(deletes.select("purchase_id"), "purchase_id", "left_semi")
    return purchases_not_deleted(purchases, deletes), restock(products, gone)


def purchases_not_deleted(purchases: DataFrame, deletes: DataFrame) -> DataFrame:
    """J9 / U3 (purchases): drop tombstoned or deleted purchase ids."""
    return purchases.join(deletes.select("purchase_id"), "purchase_id", "left_anti")


def new_clients_unique_email(requests: DataFrame, clients: DataFrame, order: str = "request_id") -> DataFrame:
    """E-mail not yet registered and first of its e-mail within the batch.

    A NULL e-mail is equal to no other (the unique constraint lets any number in), so such requests pass."""
    fresh = requests.join(clients.select("email"), "email", "left_anti")
    named = latest(fresh.where(F.col("email").isNotNull()), "email", [F.col(order).asc()])
    return named.unionByName(fresh.where(F.col("email").isNull()).select(*named.columns))


def email_taken(requests: DataFrame, clients: DataFrame, order: str = "request_id") -> DataFrame:
    """J10 rejected side."""
    ok = new_clients_unique_email(requests, clients, order).select(order)
    return requests.join(ok, order, "left_anti").withColumn("reason", F.lit(EMAIL_TAKEN))


def cascade_delete_products(products: DataFrame, seller_deletes: DataFrame) -> DataFrame:
    """Products of deleted sellers go with them."""
    return products.join(seller_deletes.select("seller_id"), "seller_id", "left_anti")


def delete_by_key(df: DataFrame, deletes: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not deleted."""
    return df.join(deletes.select(key), key, "left_anti")


def restock(products: DataFrame, deleted_purchases: DataFrame) -> DataFrame:
    """``quantity += Σ deleted quantity`` per product (aggregate, then left join)."""
    back = deleted_purchases.groupBy("product_id").agg(F.sum("quantity").alias("_back"))
    j = products.join(back, "product_id", "left")
    return j.withColumn("quantity", (F.col("quantity") + F.coalesce(F.col("_back"), F.lit(0))).cast("bigint")).drop(
        "_back").select(*products.columns)


# ---- U1 partial update ----------------------------------------------------------------

# Columns that must not be set to NULL (the e-mail may be).
NOT_NULL_FIELDS = ("first_name", "last_name", "company_name", "name", "price", "quantity")
_LIMITS = {"first_name": NAME_MAX, "last_name": NAME_MAX, "company_name": COMPANY_MAX, "name": PRODUCT_NAME_MAX,
           "email": EMAIL_MAX}


def _patch_field_rules(field: str, present: Column, raw: Column, value: Column) -> list[tuple[str, Column]]:
    out = []
    if field in NOT_NULL_FIELDS:
        out.append((f"{field} missing", present & raw.isNull()))
    out.append((f"{field} invalid", raw.isNotNull() & value.isNull()))
    if field in _LIMITS:
        out.append((f"{field} too long", F.length(value) > _LIMITS[field]))
    if field == "email":
        out.append(("email invalid", ~value.rlike(EMAIL_PATTERN)))
    if field == "price":
        out.append(("price must be positive", value <= 0))
    if field == "quantity":
        out.append(("quantity below 1", value < 1))
    return out


def apply_patches(df: DataFrame, patches: DataFrame, key: str, fields: Sequence[str],
                  order: str) -> tuple[DataFrame, DataFrame]:
    """Merge JSON patches into ``df``; only the fields present in a patch change.

    ``patch`` is a JSON object; a key present with ``null`` sets NULL, an absent key keeps the value
    (``map_contains_key`` on a ``map<string,string>``). Each patch is checked like a single request: a JSON
    object, an existing key, fields that convert (``try_cast``) and keep to their rules, an e-mail no other row
    has. The accepted patches of a key apply in ``order``: each field takes its latest value. Rejected patches
    come back as ``(key, order, reason)`` and change nothing.
    """
    types = {f: df.schema[f].dataType for f in fields}
    parsed = patches.select(F.col(key).alias("_key"), F.col(order).alias("_order"),
                            F.from_json("patch", "map<string,string>").alias("_m"))
    known = df.select(F.col(key).alias("_known")).distinct()
    parsed = parsed.join(known, F.col("_key") == F.col("_known"), "left")
    present = {f: F.coalesce(F.map_contains_key("_m", F.lit(f)), F.lit(False)) for f in fields}
    raw = {f: F.col("_m")[f] for f in fields}
    parsed = parsed.select("_key", "_order", "_m", "_known", *[present[f].alias(f"_has_{f}") for f in fields],
                           *[raw[f].alias(f"_raw_{f}") for f in fields],
                           *[raw[f].try_cast(types[f]).alias(f"_val_{f}") for f in fields])
    rules = [(PATCH_NOT_OBJECT, F.col("_m").isNull()), (NOT_FOUND, F.col("_known").isNull())]
    for f in fields:
        rules += _patch_field_rules(f, F.col(f"_has_{f}"), F.col(f"_raw_{f}"), F.col(f"_val_{f}"))
    checked = with_reasons(parsed, rules)
    if "email" in fields:
        checked = _email_of_another(checked, df, key)
    accepted = checked.where(F.col("reason").isNull())
    last = [F.max(F.when(F.col(f"_has_{f}"), F.struct("_order", F.col(f"_val_{f}").alias("v")))).alias(f"_new_{f}")
            for f in fields]
    merged = accepted.groupBy("_key").agg(*last)
    j = df.join(merged, F.col(key) == F.col("_key"), "left")
    cols = [F.when(F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}")["v"]).otherwise(F.col(c)).alias(c)
            if c in fields else F.col(c) for c in df.columns]
    rejected = checked.where(F.col("reason").isNotNull()).select(
        F.col("_key").alias(key), F.col("_order").alias(order), "reason")
    return j.select(*cols), rejected


def _email_of_another(checked: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Adds the reason for a new e-mail that another row of ``df`` has, or an earlier patch of another key took."""
    owner = df.where(F.col("email").isNotNull()).groupBy(F.col("email").alias("_owned")).agg(
        F.min(key).alias("_owner"))
    asks = F.col("reason").isNull() & F.col("_val_email").isNotNull()
    first = checked.where(asks).groupBy(F.col("_val_email").alias("_asked")).agg(
        F.min(F.struct("_order", "_key")).alias("_first"))
    j = checked.join(owner, F.col("_val_email") == F.col("_owned"), "left").join(
        first, F.col("_val_email") == F.col("_asked"), "left")
    taken = (F.col("_owner") != F.col("_key")) | (F.col("_owner").isNull() & (F.col("_first")["_key"] != F.col("_key")))
    reason = F.when(asks & F.coalesce(taken, F.lit(False)), F.lit(EMAIL_TAKEN)).otherwise(F.col("reason"))
    return j.withColumn("reason", reason).drop("_owned", "_owner", "_asked", "_first")


# ---- U2 insert with generated keys --------------------------------------------------------

def assign_ids(new_rows: DataFrame, existing: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Dense new keys ``max(existing key) + 1, +2, …`` in ``order`` — no global window.

    Rows are range-partitioned and sorted by ``order`` and checkpointed (so the
    partition layout is fixed even if an executor is lost); each partition's row
    count gives its offset (a table with one row per partition — its size is
    bounded by the partition count, so broadcasting it is safe); the row's index
    inside its partition comes from ``monotonically_increasing_id``.
    """
    max_id = existing.select(F.coalesce(F.max(key), F.lit(0))).scalar()
    ordered = (new_rows.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local_idx = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = ordered.join(F.broadcast(offsets), "_pid").withColumn(
        key, (max_id + F.col("_off") + local_idx + 1).cast("bigint"))
    return out.drop("_pid", "_mid", "_off")
