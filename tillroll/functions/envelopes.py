"""P15 event envelopes: one flat JSON object per change, as the write API publishes
them (NULL fields are omitted by ``to_json``; timestamps in ISO form).

Fixed values: the field lists and markers of each event kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ISO = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}

# kind → payload fields (and a constant marker where the kind has one)
KINDS = {
    "purchase_created": (["purchase_id", "client_id", "product_id", "quantity", "price", "full_price", "purchased_at"], None),
    "purchase_deleted": (["purchase_id"], ("deleted", True)),
    "product_created": (["product_id", "seller_id", "name", "price", "quantity", "created_at"], None),
    "product_updated": (["product_id", "name", "price", "quantity"], None),
    "product_deleted": (["product_id"], ("deleted", True)),
    "client_created": (["client_id", "first_name", "last_name", "email", "signup_date"], None),
    "client_updated": (["client_id", "first_name", "last_name", "email"], ("operation", "update")),
    "client_deleted": (["client_id"], ("operation", "delete")),
}

# One wide reader schema for every kind (each payload fills a subset).
PAYLOAD = ("purchase_id bigint, client_id bigint, product_id bigint, seller_id bigint, first_name string, last_name string, "
           "email string, name string, price decimal(12,2), full_price decimal(12,2), quantity bigint, "
           "purchased_at string, created_at string, signup_date string, deleted boolean, operation string")


def envelope(df: DataFrame, kind: str) -> DataFrame:
    """Rows → ``(kind, value)`` with ``value`` the event's JSON text."""
    fields, marker = KINDS[kind]
    cols = [F.col(c) for c in fields]
    if marker is not None:
        cols.append(F.lit(marker[1]).alias(marker[0]))
    return df.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*cols), ISO).alias("value"))


def parse_envelopes(events: DataFrame) -> DataFrame:
    """``(kind, value)`` → kind plus the wide payload columns (timestamps as ``timestamp_ntz``)."""
    from tillroll.functions.casts import to_ts

    p = events.select("kind", F.from_json("value", PAYLOAD).alias("e")).select("kind", "e.*")
    return p.withColumns({c: to_ts(F.col(c)) for c in ("purchased_at", "created_at", "signup_date")})

