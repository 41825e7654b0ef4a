"""Star joins J1–J3, J12 and the fact layout P4/P5.

Orphan asymmetry (SURVEY Q5) is kept exactly: an unknown client becomes NULL,
an unknown product keeps its id, the seller comes through the product and is
NULL when the product is unknown.

No join is forced to broadcast: the dimensions grow with the business. Catalyst
broadcasts a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks the measured shuffle
size at runtime; above it the join is a sort-merge join whose skewed partitions
(e.g. a hot client, or the NULL-client group) AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import FACT_COLS


def set_null_missing(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Replace ``df[key]`` by the dimension's key (NULL when not found)."""
    k = dim.select(F.col(key).alias("_dim_key"))
    out = df.join(k, df[key] == k["_dim_key"], "left")
    return out.withColumn(key, F.col("_dim_key")).drop("_dim_key")


def resolve_client(purchases: DataFrame, clients: DataFrame) -> DataFrame:
    """NULL-out client ids that are not in the client dimension."""
    return set_null_missing(purchases, clients, "client_id")


def resolve_seller(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """Bring ``seller_id`` through the product (snowflake arm); product id kept."""
    p = products.select(F.col("product_id").alias("_p_product_id"), "seller_id")
    out = purchases.join(p, purchases["product_id"] == p["_p_product_id"], "left")
    return out.drop("_p_product_id")


def fact_purchases(purchases: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """J3 (+P5): deduplicated purchases → client resolve → seller resolve → fixed layout.

    ``purchases`` must already be one row per ``purchase_id`` (D4) and the
    dimensions one row per key (D1, D3).
    """
    return resolve_seller(resolve_client(purchases, clients), products).select(*FACT_COLS)
