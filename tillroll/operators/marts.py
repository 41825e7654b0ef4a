"""The fifteen sales marts M01–M15 (hash aggregates, partial + final).

Every mart is an exact function of two grains of the fact:

* product grain — one row per (sale_date, product_id, seller_id)
* client grain  — one row per (sale_date, client_id)

with the additive measures ``_qty`` (Σ quantity), ``_rev`` (Σ full_price) and
``_orders`` (count of non-NULL purchase ids). Distinct clients/products per day
survive the grouping because the day is part of both grains. Month and year are
functions of the day.

``MartSource.from_fact`` uses the fact rows themselves as both grains (one scan
per mart, what a single mart query needs). ``MartSource.shared``, for the job that
writes all fifteen, puts persisted roll-ups in between, each one partial aggregate over
the pruned fact columns: day totals (M01–M03, M07), and on request product × month (M04,
M06, M10, M12, M13) and client × month (M05, M11, M14, M15). All are exact because the
measures are additive. The two distinct-count marts (M08, M09) read the fact. Day totals
have one row per day whatever the size of the fact, so they always pay. The monthly
roll-ups pay where a product or a client has many purchases a month; where it has one
caller names them; nothing is switched by size. Hot keys (a third of all rows on one
client, or the NULL-client group) are absorbed by the partial aggregation before the shuffle.

A roll-up keeps a ``sale_date`` column (the month start for monthly roll-ups), so
the same mart code reads the fact or a roll-up.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.buckets import display_name, month_of_day, sale_date

REVENUE = "decimal(20,2)"


def _measures(fact: DataFrame) -> DataFrame:
    return fact.select(
        sale_date("purchased_at").alias("sale_date"),
        "client_id", "product_id", "seller_id",
        F.col("quantity").alias("_qty"),
        F.col("full_price").alias("_rev"),
        F.col("purchase_id").isNotNull().cast("long").alias("_orders"),
    )


ROLLUPS = {
    # name → (keys besides sale_date, truncate sale_date to month)
    "day": ([], False),
    "product_month": (["product_id", "seller_id"], True),
    "client_month": (["client_id"], True),
}


@dataclass
class MartSource:
    product_grain: DataFrame
    client_grain: DataFrame
    rollups: dict[str, DataFrame] = field(default_factory=dict)
    parts: int | None = None

    @classmethod
    def from_fact(cls, fact: DataFrame, parts: int | None = None) -> "MartSource":
        """``parts``: in how many parts a mart that is as long as the fact (M12) is summed."""
        m = _measures(fact)
        return cls(m, m, parts=parts)

    @classmethod
    def shared(cls, fact: DataFrame, storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
               checkpoint: bool = False, rollups: tuple[str, ...] = ("day",)) -> "MartSource":
        """Roll-ups (names of ``ROLLUPS``) between the fact and the marts they serve.

        ``storage`` persists them; lost blocks are recomputed from lineage if an executor
        goes. ``checkpoint=True`` instead writes them to ``spark.checkpoint.dir`` and cuts
        the lineage.
        """
        m = _measures(fact)
        out = {}
        for name in rollups:
            keys, monthly = ROLLUPS[name]
            day = F.trunc("sale_date", "month") if monthly else F.col("sale_date")
            r = m.groupBy(day.alias("sale_date"), *keys).agg(
                F.sum("_qty").alias("_qty"), F.sum("_rev").cast(REVENUE).alias("_rev"),
                F.sum("_orders").alias("_orders"))
            out[name] = r.checkpoint(eager=False) if checkpoint else r.persist(storage) if storage is not None else r
        return cls(m, m, out)

    def rollup(self, name: str) -> DataFrame:
        """A roll-up, or the fact rows where there is none."""
        return self.rollups.get(name, self.client_grain)

    def materialise(self, name: str) -> None:
        """Compute a roll-up, so that no two concurrent mart jobs do."""
        if name in self.rollups:
            self.rollups[name].count()

    def release(self) -> None:
        for r in self.rollups.values():
            r.unpersist()


def _qty() -> Column:
    return F.sum("_qty").cast("bigint").alias("total_quantity")


def _rev() -> Column:
    return F.sum("_rev").cast(REVENUE).alias("total_revenue")


def _orders() -> Column:
    return F.sum("_orders").cast("bigint").alias("total_orders")


def _month() -> Column:
    return month_of_day("sale_date").alias("sale_month")


def _year() -> Column:
    return F.year("sale_date").alias("sale_year")


def product_names(products: DataFrame) -> DataFrame:
    return products.select("product_id", "name")


def client_names(clients: DataFrame) -> DataFrame:
    return clients.select("client_id", display_name().alias("client_name"))


def seller_names(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", display_name().alias("seller_name"))


# ---- M01–M15 -------------------------------------------------------------

def sales_by_day(src: MartSource) -> DataFrame:
    """M01"""
    return src.rollup("day").groupBy("sale_date").agg(_qty(), _rev())


def sales_by_month(src: MartSource) -> DataFrame:
    """M02"""
    return src.rollup("day").groupBy(_month()).agg(_qty(), _rev())


def sales_by_year(src: MartSource) -> DataFrame:
    """M03"""
    return src.rollup("day").groupBy(_year()).agg(_qty(), _rev())


def sales_by_product(src: MartSource, products: DataFrame) -> DataFrame:
    """Aggregate first, then the name."""
    a = src.rollup("product_month").groupBy("product_id").agg(_qty(), _rev())
    return a.join(product_names(products), "product_id", "left").select(
        "product_id", "name", "total_quantity", "total_revenue")


def sales_by_client(src: MartSource, clients: DataFrame) -> DataFrame:
    """M05 (+J5)"""
    a = src.rollup("client_month").groupBy("client_id").agg(_qty(), _rev())
    return a.join(client_names(clients), "client_id", "left").select(
        "client_id", "client_name", "total_quantity", "total_revenue")


def sales_by_seller(src: MartSource, sellers: DataFrame) -> DataFrame:
    """M06 (+J6)"""
    a = src.rollup("product_month").groupBy("seller_id").agg(_qty(), _rev())
    return a.join(seller_names(sellers), "seller_id", "left").select(
        "seller_id", "seller_name", "total_quantity", "total_revenue")


def avg_order_value_by_day(src: MartSource) -> DataFrame:
    """Counts and revenue only; the ratio is P10."""
    return src.rollup("day").groupBy("sale_date").agg(_orders(), _rev())


def unique_clients_per_day(src: MartSource) -> DataFrame:
    """Exact distinct client ids (NULL ignored)."""
    return src.client_grain.groupBy("sale_date").agg(F.countDistinct("client_id").alias("unique_clients"))


def unique_products_per_day(src: MartSource) -> DataFrame:
    """Exact distinct product ids."""
    return src.product_grain.groupBy("sale_date").agg(F.countDistinct("product_id").alias("unique_products"))


def seller_revenue_by_month(src: MartSource) -> DataFrame:
    """M10"""
    return src.rollup("product_month").groupBy("seller_id", _month()).agg(_qty(), _rev())


def client_revenue_by_month(src: MartSource) -> DataFrame:
    """M11"""
    return src.rollup("client_month").groupBy("client_id", _month()).agg(_orders(), _rev())


def product_quantity_sold_by_month(src: MartSource) -> DataFrame:
    """M12. Nearly every row is a group of its own, so a task's hash table is as long as its part: with ``parts`` the
    rows are dealt by the whole key, once, and not merged into larger parts as their few bytes suggest. Without a
    partial aggregate the rows of one product and month meet in one task, as a stream into one sum."""
    rows = src.rollup("product_month").select("product_id", _month(), "_qty")
    if src.parts:
        rows = rows.repartition(src.parts, "product_id", "sale_month")
    return rows.groupBy("product_id", "sale_month").agg(_qty())


def top_products_by_year(src: MartSource, products: DataFrame) -> DataFrame:
    """M13 (no ranking here, SURVEY Q9)."""
    a = src.rollup("product_month").groupBy(_year(), "product_id").agg(_rev())
    return a.join(product_names(products), "product_id", "left").select(
        "sale_year", "product_id", "name", "total_revenue")


def top_clients_by_year(src: MartSource, clients: DataFrame) -> DataFrame:
    """M14"""
    a = src.rollup("client_month").groupBy(_year(), "client_id").agg(_rev())
    return a.join(client_names(clients), "client_id", "left").select(
        "sale_year", "client_id", "client_name", "total_revenue")


def client_purchase_frequency(src: MartSource, clients: DataFrame) -> DataFrame:
    """M15"""
    a = src.rollup("client_month").groupBy("client_id").agg(_orders(), _rev())
    return a.join(client_names(clients), "client_id", "left").select(
        "client_id", "client_name", "total_orders", "total_revenue")


# roll-up that each mart reads; the two distinct counts read the fact
MART_ROLLUP = {
    "day": ["mart_sales_by_day", "mart_sales_by_month", "mart_sales_by_year", "mart_avg_order_value_by_day"],
    "product_month": ["mart_sales_by_product", "mart_sales_by_seller", "mart_seller_revenue_by_month",
                      "mart_product_quantity_sold_by_month", "mart_top_products_by_year"],
    "client_month": ["mart_sales_by_client", "mart_client_revenue_by_month", "mart_top_clients_by_year",
                     "mart_client_purchase_frequency"],
}

# name → (function, dimension it needs or None, sort key of the stored mart)
MARTS = {
    "mart_sales_by_day": (sales_by_day, None, ["sale_date"]),
    "mart_sales_by_month": (sales_by_month, None, ["sale_month"]),
    "mart_sales_by_year": (sales_by_year, None, ["sale_year"]),
    "mart_sales_by_product": (sales_by_product, "products", ["product_id"]),
    "mart_sales_by_client": (sales_by_client, "clients", ["client_id"]),
    "mart_sales_by_seller": (sales_by_seller, "sellers", ["seller_id"]),
    "mart_avg_order_value_by_day": (avg_order_value_by_day, None, ["sale_date"]),
    "mart_unique_clients_per_day": (unique_clients_per_day, None, ["sale_date"]),
    "mart_unique_products_per_day": (unique_products_per_day, None, ["sale_date"]),
    "mart_seller_revenue_by_month": (seller_revenue_by_month, None, ["seller_id", "sale_month"]),
    "mart_client_revenue_by_month": (client_revenue_by_month, None, ["client_id", "sale_month"]),
    "mart_product_quantity_sold_by_month": (product_quantity_sold_by_month, None, ["product_id", "sale_month"]),
    "mart_top_products_by_year": (top_products_by_year, "products", ["sale_year", "product_id"]),
    "mart_top_clients_by_year": (top_clients_by_year, "clients", ["sale_year", "client_id"]),
    "mart_client_purchase_frequency": (client_purchase_frequency, "clients", ["client_id"]),
}


def build_mart(name: str, src: MartSource, dims: dict[str, DataFrame]) -> DataFrame:
    fn, dim, _ = MARTS[name]
    return fn(src) if dim is None else fn(src, dims[dim])


def build_marts(src: MartSource, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build_mart(name, src, dims) for name in MARTS}
