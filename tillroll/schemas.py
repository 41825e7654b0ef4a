"""Declared schemas. Readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T

# Ids and quantities are 64 bit: a large table passes 2^31 rows.
LONG = T.LongType()
STR = T.StringType()
TS = T.TimestampType()
TS_NTZ = T.TimestampNTZType()
PRICE12 = T.DecimalType(12, 2)
PRICE10 = T.DecimalType(10, 2)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CLIENTS = _s(("client_id", LONG), ("first_name", STR), ("last_name", STR), ("email", STR), ("signup_date", TS_NTZ))
SELLERS = _s(("seller_id", LONG), ("first_name", STR), ("last_name", STR), ("company_name", STR), ("email", STR),
             ("created_at", TS_NTZ))
PRODUCTS = _s(("product_id", LONG), ("seller_id", LONG), ("name", STR), ("price", PRICE12), ("quantity", LONG),
              ("created_at", TS_NTZ))
PURCHASES = _s(("purchase_id", LONG), ("client_id", LONG), ("product_id", LONG), ("quantity", LONG),
               ("price", PRICE10), ("full_price", PRICE10), ("purchased_at", TS_NTZ))
FACT = _s(("purchase_id", LONG), ("client_id", LONG), ("product_id", LONG), ("seller_id", LONG), ("quantity", LONG),
          ("price", PRICE10), ("full_price", PRICE10), ("purchased_at", TS_NTZ))

# Column orders that the reference fixes.
CLIENT_COLS = [f.name for f in CLIENTS]
SELLER_COLS = [f.name for f in SELLERS]
PRODUCT_COLS = [f.name for f in PRODUCTS]
PURCHASE_COLS = [f.name for f in PURCHASES]
FACT_COLS = [f.name for f in FACT]

# Purchase event as published on the topic; ``deleted`` marks a tombstone and
# ``_corrupt_record`` keeps lines that are not a JSON object.
EVENT = _s(("purchase_id", LONG), ("client_id", LONG), ("product_id", LONG), ("purchased_at", STR),
           ("price", PRICE10), ("full_price", PRICE10), ("quantity", LONG), ("deleted", T.BooleanType()),
           ("_corrupt_record", STR))
EVENT_FIELDS = [f for f in EVENT.fields if f.name != "_corrupt_record"]
EVENT_PAYLOAD = T.StructType(EVENT_FIELDS)

# Landed events (one row per data event), stream landing schema.
LANDED = _s(("purchase_id", LONG), ("client_id", LONG), ("product_id", LONG), ("purchased_at", TS_NTZ),
            ("price", PRICE10), ("full_price", PRICE10), ("quantity", LONG))

# CSV product drop: fixed column order, header line.
CSV_PRODUCT = _s(("seller_id", LONG), ("name", STR), ("price", PRICE12), ("quantity", LONG), ("created_at", STR),
                 ("_corrupt_record", STR))
