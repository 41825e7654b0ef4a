"""Registered queries over incrementally refreshed state: fact and marts after two runs, distinct sets over longer
periods, snapshot differences.

The driver tables are played as two runs (FIXTURES.md §7): the first with two thirds of the events, some tombstones and
older dimensions (clients and products missing, some products with another seller); the second with the rest, late
copies of the first run's events, the other tombstones and the dimensions as they are. The result has to be that of a
rebuild from everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import increments as I
from tillroll.operators import marts as M
from tillroll.plans.oracle import MART_VIEWS, with_views
from tillroll.plans.refresh import CODEC, MartState
from tillroll.session import drop, scratch_path, shuffles_dropped
from tillroll.sources import requests as RQ
from tillroll.sources.fixtures import Fixture

QUERIES, SQL = {}, {}
_STATES: dict[tuple[str, str], MartState] = {}


def earlier(fx: Fixture) -> dict[str, DataFrame]:
    """The dimensions of the first run."""
    other = F.when(F.col("product_id") % 9 == 4, F.col("seller_id") + 1).otherwise(F.col("seller_id"))
    dearer = F.when(F.col("product_id") % 5 == 2, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(12,2)")
    ghosts = fx.products.where("product_id % 11 = 6").withColumn("product_id", -F.col("product_id") - 1_000_000)
    return {
        "clients": fx.clients.where("client_id % 7 <> 3"),
        "sellers": fx.sellers,
        "products": fx.products.where("product_id % 13 <> 5").withColumns({"seller_id": other, "price": dearer}).unionByName(ghosts),
    }


def state(spark: SparkSession, d: str) -> MartState:
    """The state after both runs; one for all queries of a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STATES:
        fx, deletes = Fixture(spark, d), RQ.purchase_deletes(spark, d)
        path = scratch_path(spark, "mart-input")
        with shuffles_dropped(spark):
            fx.purchase_events.write.option("compression", CODEC).parquet(path)  # read by both runs
        events = spark.read.schema(fx.purchase_events.schema).parquet(path)
        first = F.pmod(F.xxhash64(*events.columns), F.lit(3)) < 2
        made = MartState(spark, scratch_path(spark, "mart-state"))
        made.apply(events.where(first), deletes.where("purchase_id % 2 = 0"), earlier(fx))
        late = first & (F.col("purchase_id") % 10 < 3)
        now = {"clients": fx.clients, "sellers": fx.sellers, "products": fx.products}
        made.apply(events.where(~first | late), deletes, now, taken=lambda: drop(spark, path))
        _STATES[key] = made
    return _STATES[key]


_LIVE = [("live_fact", "SELECT * FROM fact WHERE purchase_id NOT IN (SELECT purchase_id FROM purchase_deletes)")]


def reg(key: str, sql: str):
    def deco(fn):
        QUERIES[key], SQL[key] = fn, with_views(sql, _LIVE)
        return fn
    return deco


reg("incremental_fact", "SELECT * FROM live_fact")(lambda s, d: state(s, d).fact())

for _name, _sql in MART_VIEWS:
    assert _name in M.MARTS
    reg(f"incremental_{_name}", _sql.replace("FROM fact", "FROM live_fact"))(lambda s, d, n=_name: state(s, d).mart(n))

reg("distinct_clients_by_month", """
SELECT strftime(purchased_at, '%Y-%m') AS sale_month, count(DISTINCT client_id) AS unique_clients FROM live_fact
GROUP BY 1 HAVING count(client_id) > 0""")(
    lambda s, d: state(s, d).distinct("client_days", F.date_format("sale_date", "yyyy-MM").alias("sale_month"), "unique_clients"))
reg("distinct_products_by_year", """
SELECT CAST(year(purchased_at) AS INTEGER) AS sale_year, count(DISTINCT product_id) AS unique_products FROM live_fact
GROUP BY 1 HAVING count(product_id) > 0""")(
    lambda s, d: state(s, d).distinct("product_days", F.year("sale_date").alias("sale_year"), "unique_products"))

_EARLIER = """
earlier AS (
  SELECT product_id, CASE WHEN product_id % 9 = 4 THEN seller_id + 1 ELSE seller_id END AS seller_id, name,
         CAST(CASE WHEN product_id % 5 = 2 THEN price + 1 ELSE price END AS DECIMAL(12,2)) AS price, quantity, created_at
  FROM products WHERE product_id % 13 <> 5
  UNION ALL SELECT -product_id - 1000000, seller_id, name, price, quantity, created_at FROM products WHERE product_id % 11 = 6)"""


@reg("snapshot_diff_products", f"""
WITH {_EARLIER}
SELECT CASE WHEN e.product_id IS NULL THEN 'insert' WHEN p.product_id IS NULL THEN 'delete' ELSE 'update' END AS change,
       coalesce(p.product_id, e.product_id) AS product_id, p.seller_id, p.name, p.price, p.quantity, p.created_at
FROM earlier e FULL JOIN products p ON e.product_id = p.product_id
WHERE e.product_id IS NULL OR p.product_id IS NULL
   OR (e.seller_id, e.name, e.price, e.quantity, e.created_at) IS DISTINCT FROM (p.seller_id, p.name, p.price, p.quantity, p.created_at)""")
def _diff(s: SparkSession, d: str) -> DataFrame:
    f = Fixture(s, d)
    return I.snapshot_diff(earlier(f)["products"], f.products, "product_id")


@reg("snapshot_diff_applied", "SELECT * FROM products")
def _applied(s: SparkSession, d: str) -> DataFrame:
    f = Fixture(s, d)
    old = earlier(f)["products"]
    return I.apply_diff(old, I.snapshot_diff(old, f.products, "product_id"), "product_id")
