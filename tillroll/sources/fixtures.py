"""Driver tables → the reference's shapes (FIXTURES.md §3), as DataFrames.

customer → clients, supplier → sellers, part → products,
lineitem ⋈ orders ⋈ part → purchase events. Every dimension row is kept. Events of
customers with key % 50 = 0 and of parts with key % 40 = 0 are re-keyed to ids that
exist nowhere (orphan rules), so those clients and products have no purchases (delete
guards); the last tenth of the sellers offer only such products. Every tenth client,
seller and product has a stale second version so that dedup has work to do.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import dedup, star
from tillroll.sources.tables import read_table

# Fixed values of the fixture definition (FIXTURES.md §3).
FRESH_SIGNUP = "2024-01-02 00:00:00"
STALE_SIGNUP = "2024-01-01 00:00:00"
DIM_CREATED = "2024-01-01 00:00:00"
EMAIL_DOMAIN = "@example.com"
STALE_FIRST_NAME = "Stale"
STALE_CREATED = "2023-12-31 00:00:00"
CLIENT_ORPHANS, PRODUCT_ORPHANS, IDLE_SELLERS = 50, 40, 10


def _ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _email(name_col: str):
    return F.concat(F.lower(F.regexp_replace(F.col(name_col), "#", ".")), F.lit(EMAIL_DOMAIN))


def clients_raw(spark: SparkSession, d: str) -> DataFrame:
    """Client snapshot with stale copies: one scan of ``customer``, the copy made by ``explode``."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    version = F.explode(F.when(F.col("c_custkey") % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    c = c.select("*", version.alias("_v"))
    stale = F.col("_v") == 1
    return c.select(
        F.col("c_custkey").cast("bigint").alias("client_id"),
        F.when(stale, F.lit(STALE_FIRST_NAME)).otherwise(F.split_part("c_name", F.lit("#"), F.lit(1))).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        _email("c_name").alias("email"),
        F.when(stale, _ntz(STALE_SIGNUP)).otherwise(_ntz(FRESH_SIGNUP)).alias("signup_date"),
    )


def clients(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_clients(clients_raw(spark, d))


def _versions(df: DataFrame, key: str) -> DataFrame:
    """Each row, and a second (``_v`` = 1) of every tenth one; one scan, the copy made by ``explode``."""
    return df.select("*", F.explode(F.when(F.col(key) % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))).alias("_v"))


def sellers_raw(spark: SparkSession, d: str) -> DataFrame:
    """Seller snapshot with stale copies (older, no company name, too long a first name)."""
    s = _versions(read_table(spark, d, "supplier"), "s_suppkey")
    stale = F.col("_v") == 1
    return s.select(
        F.col("s_suppkey").cast("bigint").alias("seller_id"),
        F.when(stale, F.repeat(F.lit(STALE_FIRST_NAME), 25)).otherwise(F.split_part("s_name", F.lit("#"), F.lit(1))).alias("first_name"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(~stale, F.col("s_name")).alias("company_name"),
        _email("s_name").alias("email"),
        F.when(stale, _ntz(STALE_CREATED)).otherwise(_ntz(DIM_CREATED)).alias("created_at"),
    )


def sellers(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_sellers(sellers_raw(spark, d))


def products_raw(spark: SparkSession, d: str) -> DataFrame:
    """Product snapshot with stale copies (older, dearer; as old but without a name where the key is odd)."""
    n = read_table(spark, d, "supplier").select(F.count(F.lit(1))).scalar()
    idle = F.greatest(F.lit(1), F.floor(n / IDLE_SELLERS))
    p = _versions(read_table(spark, d, "part"), "p_partkey")
    stale, key = F.col("_v") == 1, F.col("p_partkey")
    seller = F.when(key % PRODUCT_ORPHANS == 0, n - 1 - F.floor(key / PRODUCT_ORPHANS) % idle).otherwise(key % (n - idle))
    old = stale & (F.floor(key / 10) % 2 == 0)
    return p.select(
        key.cast("bigint").alias("product_id"),
        seller.cast("bigint").alias("seller_id"),
        F.when(~stale | old, F.col("p_name")).alias("name"),
        (F.col("p_retailprice").cast("decimal(12,2)") + F.when(stale, F.lit(1)).otherwise(F.lit(0))).cast("decimal(12,2)").alias("price"),
        F.col("p_size").cast("bigint").alias("quantity"),
        F.when(old, _ntz(STALE_CREATED)).otherwise(_ntz(DIM_CREATED)).alias("created_at"),
    )


def products(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_products(products_raw(spark, d))


def _re_keyed(key: str, every: int):
    """The key; for one in ``every`` keys an id that no table has."""
    k = F.col(key).cast("bigint")
    return F.when(k % every == 0, -1 - k).otherwise(k)


def purchase_events(spark: SparkSession, d: str) -> DataFrame:
    """Every line item as a purchase event (duplicated ids included)."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    p = read_table(spark, d, "part").select("p_partkey", "p_retailprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    price = F.col("p_retailprice").cast("decimal(10,2)")
    qty = F.col("l_quantity").cast("bigint")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("purchase_id"),
        _re_keyed("o_custkey", CLIENT_ORPHANS).alias("client_id"),
        _re_keyed("l_partkey", PRODUCT_ORPHANS).alias("product_id"),
        qty.alias("quantity"),
        price.alias("price"),
        (price * qty).cast("decimal(10,2)").alias("full_price"),
        F.col("l_shipdate").alias("purchased_at"),
    )


def purchase_events_tied(spark: SparkSession, d: str) -> DataFrame:
    """The events, and of every first line item copies that differ only in client or only in price."""
    e = purchase_events(spark, d)
    first = e.where(F.col("purchase_id") % 8 == 1)
    return (e.unionByName(first.withColumn("client_id", F.col("client_id") + 1))
            .unionByName(first.withColumn("price", (F.col("price") + 1).cast("decimal(10,2)"))))


def purchases(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_purchases(purchase_events(spark, d))


def fact(spark: SparkSession, d: str) -> DataFrame:
    return star.fact_purchases(purchases(spark, d), clients(spark, d), products(spark, d))


@dataclass
class Fixture:
    """Lazily built fixture views for one data directory (plans are built once per view)."""

    spark: SparkSession
    data_dir: str
    _memo: dict = field(default_factory=dict)

    def _get(self, name, fn):
        if name not in self._memo:
            self._memo[name] = fn(self.spark, self.data_dir)
        return self._memo[name]

    def table(self, name: str) -> DataFrame:
        return self._get("t:" + name, lambda s, d: read_table(s, d, name))

    @property
    def clients_raw(self) -> DataFrame:
        return self._get("clients_raw", clients_raw)

    @property
    def clients(self) -> DataFrame:
        return self._get("clients", clients)

    @property
    def sellers_raw(self) -> DataFrame:
        return self._get("sellers_raw", sellers_raw)

    @property
    def products_raw(self) -> DataFrame:
        return self._get("products_raw", products_raw)

    @property
    def purchase_events_tied(self) -> DataFrame:
        return self._get("purchase_events_tied", purchase_events_tied)

    @property
    def sellers(self) -> DataFrame:
        return self._get("sellers", sellers)

    @property
    def products(self) -> DataFrame:
        return self._get("products", products)

    @property
    def purchase_events(self) -> DataFrame:
        return self._get("purchase_events", purchase_events)

    @property
    def purchases(self) -> DataFrame:
        return self._get("purchases", purchases)

    @property
    def fact(self) -> DataFrame:
        return self._get("fact", lambda s, d: star.fact_purchases(self.purchases, self.clients, self.products))
