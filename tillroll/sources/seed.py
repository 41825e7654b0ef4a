"""The seed rows of the relational tables, for unit fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas

# The seed rows of the source tables (ids are assigned in insert order).
SEED_CLIENTS = [
    (1, "John", "Doe", "john.doe@example.com", "2025-01-10 08:30:00"),
    (2, "Jane", "Smith", "jane.smith@example.com", "2025-02-15 14:45:00"),
    (3, "Bob", "Johnson", "bob.johnson@example.com", "2025-03-20 09:15:00"),
]
SEED_SELLERS = [
    (1, "Alice", "Williams", "Alice Co", "alice@example.com", "2025-01-05 11:00:00"),
    (2, "Charlie", "Brown", "Charlie LLC", "charlie@example.com", "2025-02-12 16:20:00"),
]
SEED_PRODUCTS = [
    (1, 1, "Widget A", "19.99", 100, "2025-01-06 10:00:00"),
    (2, 2, "Gadget B", "29.99", 200, "2025-02-13 12:30:00"),
]
SEED_PURCHASES = [
    (1, 1, 1, 2, "2025-03-01 13:00:00"),
    (2, 2, 2, 1, "2025-03-02 15:30:00"),
]


def _ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def seed(spark: SparkSession) -> dict[str, DataFrame]:
    """Clients, sellers, products and purchases (purchases without prices: P14 prices them)."""
    return {
        "clients": spark.createDataFrame([(*r[:4], _ts(r[4])) for r in SEED_CLIENTS], schemas.CLIENTS),
        "sellers": spark.createDataFrame([(*r[:5], _ts(r[5])) for r in SEED_SELLERS], schemas.SELLERS),
        "products": spark.createDataFrame([(r[0], r[1], r[2], Decimal(r[3]), r[4], _ts(r[5])) for r in SEED_PRODUCTS],
                                          schemas.PRODUCTS),
        "purchases": spark.createDataFrame([(*r[:4], _ts(r[4])) for r in SEED_PURCHASES],
                                           "purchase_id bigint, client_id bigint, product_id bigint, quantity bigint, "
                                           "purchased_at timestamp_ntz"),
    }
