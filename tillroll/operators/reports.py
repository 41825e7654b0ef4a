"""Dashboard reports over the marts: R01–R15, top-k K1–K6, series T1–T9,
ratio/label/coercion P10–P12, latest-period filter F3, row count N1.

R-rows re-aggregate a mart on its own key (``sum`` per key, so duplicate mart rows
collapse) and order it. Ties in top-k are broken by ascending id (SURVEY Q10);
``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject`` (no full sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.buckets import month_to_date

REVENUE = "decimal(20,2)"


def _s(c: str, t: str = "bigint") -> Column:
    return F.sum(c).cast(t).alias(c)


def _rev() -> Column:
    return _s("total_revenue", REVENUE)


# ---- R01–R15 --------------------------------------------------------------

def report_sales_by_day(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_date").agg(_s("total_quantity"), _rev()).orderBy(F.col("sale_date").desc())


def report_sales_by_month(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_month").agg(_s("total_quantity"), _rev()).orderBy(F.col("sale_month").desc())


def report_sales_by_year(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_year").agg(_s("total_quantity"), _rev()).orderBy(F.col("sale_year").desc())


def report_sales_by_product(m: DataFrame) -> DataFrame:
    return m.groupBy("product_id", "name").agg(_s("total_quantity"), _rev()).orderBy(F.col("total_revenue").desc())


def report_sales_by_client(m: DataFrame) -> DataFrame:
    return m.groupBy("client_id", "client_name").agg(_s("total_quantity"), _rev()).orderBy(
        F.col("total_revenue").desc())


def report_sales_by_seller(m: DataFrame) -> DataFrame:
    return m.groupBy("seller_id", "seller_name").agg(_s("total_quantity"), _rev()).orderBy(
        F.col("total_revenue").desc())


def report_avg_order_value_by_day(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_date").agg(_s("total_orders"), _rev()).orderBy(F.col("sale_date").desc())


def report_unique_clients(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_date").agg(_s("unique_clients")).orderBy(F.col("sale_date").desc())


def report_unique_products(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_date").agg(_s("unique_products")).orderBy(F.col("sale_date").desc())


def report_seller_month(m: DataFrame) -> DataFrame:
    return m.groupBy("seller_id", "sale_month").agg(_s("total_quantity"), _rev()).orderBy(
        F.col("sale_month").desc())


def report_client_month(m: DataFrame) -> DataFrame:
    return m.groupBy("client_id", "sale_month").agg(_s("total_orders"), _rev()).orderBy(F.col("sale_month").desc())


def report_product_month(m: DataFrame) -> DataFrame:
    # ordered within the month too, so that a month can be sorted in many tasks
    return m.groupBy("product_id", "sale_month").agg(_s("total_quantity")).orderBy(
        F.col("sale_month").desc(), F.col("product_id"))


def report_products_by_year(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_year", "product_id", "name").agg(_rev()).orderBy(
        F.col("sale_year").desc(), F.col("total_revenue").desc())


def report_clients_by_year(m: DataFrame) -> DataFrame:
    return m.groupBy("sale_year", "client_id", "client_name").agg(_rev()).orderBy(
        F.col("sale_year").desc(), F.col("total_revenue").desc())


def report_client_frequency(m: DataFrame) -> DataFrame:
    return m.groupBy("client_id", "client_name").agg(_s("total_orders"), _rev()).orderBy(
        F.col("total_revenue").desc())


# mart name → report function (the dashboard's fixed query per mart)
REPORTS = {
    "mart_sales_by_day": ("report_sales_by_day", report_sales_by_day),
    "mart_sales_by_month": ("report_sales_by_month", report_sales_by_month),
    "mart_sales_by_year": ("report_sales_by_year", report_sales_by_year),
    "mart_sales_by_product": ("report_sales_by_product", report_sales_by_product),
    "mart_sales_by_client": ("report_sales_by_client", report_sales_by_client),
    "mart_sales_by_seller": ("report_sales_by_seller", report_sales_by_seller),
    "mart_avg_order_value_by_day": ("report_avg_order_value_by_day", report_avg_order_value_by_day),
    "mart_unique_clients_per_day": ("report_unique_clients", report_unique_clients),
    "mart_unique_products_per_day": ("report_unique_products", report_unique_products),
    "mart_seller_revenue_by_month": ("report_seller_month", report_seller_month),
    "mart_client_revenue_by_month": ("report_client_month", report_client_month),
    "mart_product_quantity_sold_by_month": ("report_product_month", report_product_month),
    "mart_top_products_by_year": ("report_products_by_year", report_products_by_year),
    "mart_top_clients_by_year": ("report_clients_by_year", report_clients_by_year),
    "mart_client_purchase_frequency": ("report_client_frequency", report_client_frequency),
}


# ---- P10–P12, F3 ------------------------------------------------------------

def coerce_measures(df: DataFrame) -> DataFrame:
    """Non-numeric measure values become NULL doubles (the five measure columns)."""
    measures = ["total_quantity", "total_revenue", "total_orders", "unique_clients", "unique_products"]
    return df.select(*[
        F.col(c).try_cast("double").alias(c) if c in measures else F.col(c) for c in df.columns
    ])


def with_avg_order_value(m: DataFrame) -> DataFrame:
    """P10: revenue / orders as double; NULL when there are no orders."""
    return m.withColumn(
        "avg_order_value", F.try_divide(F.col("total_revenue").cast("double"), F.col("total_orders")))


def latest_year(df: DataFrame, col: str = "sale_year", years: DataFrame | None = None) -> DataFrame:
    """rows of the latest year — a scalar subquery, not a global window.

    ``years`` (a column ``col``) is a smaller source of the same years, such as the events
    or the year mart; without it the subquery computes ``df`` a second time."""
    latest = (df if years is None else years).select(F.max(col)).scalar()
    return df.where(F.col(col) == latest)


# ---- K1–K6 -----------------------------------------------------------------

def top_k(df: DataFrame, measure: str, id_col: str, k: int = 10) -> DataFrame:
    """Top ``k`` by ``measure`` desc, ties by ascending id (NULL id last)."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(id_col).asc_nulls_last()).limit(k)


# ---- T1–T9, N1 ----------------------------------------------------------------

def series(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Ascending time series of ``cols`` on ``key`` (NULL key last)."""
    return df.select(key, *cols).orderBy(F.col(key).asc_nulls_last())


def month_series(df: DataFrame, cols: list[str]) -> DataFrame:
    """Month label → month start date, ascending."""
    return series(df.select(month_to_date("sale_month").alias("month_start"), *cols), "month_start", cols)


def rollup_month(df: DataFrame, measure: str) -> DataFrame:
    """Re-sum one measure over all entities per month; NULL months dropped."""
    t = "bigint" if measure != "total_revenue" else REVENUE
    m = df.select(month_to_date("sale_month").alias("month_start"), measure).where(F.col("month_start").isNotNull())
    return m.groupBy("month_start").agg(F.sum(measure).cast(t).alias(measure)).orderBy("month_start")


def row_count(report: DataFrame, name: str) -> DataFrame:
    """The number of rows a report has."""
    return report.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("report"), "row_count")
