"""Deduplication D1–D4: one row per key, latest wins, deterministic.

``row_number() = 1`` over a key window is planned as a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so a key with many copies is cut
down to one row per map task before it moves: a hot key does not load one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per ``key`` under ``order`` (each entry a column or a sort Column)."""
    keys = [key] if isinstance(key, str) else list(key)
    sort = [F.col(o).desc() if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# Tie-break orders: the business timestamp first, then every other column, all descending.
CLIENT_ORDER = ["signup_date", "first_name", "last_name", "email"]
SELLER_ORDER = ["created_at", "first_name", "last_name", "company_name", "email"]
PRODUCT_ORDER = ["created_at", "seller_id", "name", "price", "quantity"]
PURCHASE_ORDER = ["purchased_at", "product_id", "quantity", "full_price", "client_id", "price"]


def dedup_clients(df: DataFrame) -> DataFrame:
    """D1"""
    return latest(df, "client_id", CLIENT_ORDER)


def dedup_sellers(df: DataFrame) -> DataFrame:
    """D2"""
    return latest(df, "seller_id", SELLER_ORDER)


def dedup_products(df: DataFrame) -> DataFrame:
    """D3"""
    return latest(df, "product_id", PRODUCT_ORDER)


def dedup_purchases(df: DataFrame) -> DataFrame:
    """D4"""
    return latest(df, "purchase_id", PURCHASE_ORDER)
