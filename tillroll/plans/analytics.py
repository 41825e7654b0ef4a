"""Registered analytics queries: fact, marts M01–M15, reports R01–R15, top-k,
series, roll-ups (each ``(spark, data_dir) -> DataFrame``) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import marts as M
from tillroll.operators import reports as R
from tillroll.plans.oracle import MART_VIEWS, with_views
from tillroll.session import input_parts
from tillroll.sources.fixtures import Fixture


def _fx(spark: SparkSession, d: str) -> Fixture:
    return Fixture(spark, d)


def _source(fx: Fixture, name: str) -> M.MartSource:
    """The fact. M12 takes its columns as the purchases have them, which the joins of the fact (one row per key,
    product ids kept) leave alone, in parts for the size of the input."""
    if name != "mart_product_quantity_sold_by_month":
        return M.MartSource.from_fact(fx.fact)
    purchases = fx.purchases.withColumn("seller_id", F.lit(None).cast("bigint"))
    return M.MartSource.from_fact(purchases, max(8, input_parts(fx.spark, fx.data_dir)))


def mart(fx: Fixture, name: str, src: M.MartSource | None = None) -> DataFrame:
    src = src or _source(fx, name)
    return M.build_mart(name, src, {"clients": fx.clients, "sellers": fx.sellers, "products": fx.products})


def report(fx: Fixture, mart_name: str) -> DataFrame:
    return R.REPORTS[mart_name][1](mart(fx, mart_name))


def _mart_q(name):
    return lambda spark, d: mart(_fx(spark, d), name)


def _report_q(mart_name):
    return lambda spark, d: report(_fx(spark, d), mart_name)


QUERIES = {}
SQL = {}

QUERIES["fact_purchases"] = lambda spark, d: _fx(spark, d).fact
SQL["fact_purchases"] = with_views("SELECT * FROM fact")

for _name, _sql in MART_VIEWS:
    QUERIES[_name] = _mart_q(_name)
    SQL[_name] = with_views(f"SELECT * FROM {_name}")

for _mart_name, (_rname, _fn) in R.REPORTS.items():
    QUERIES[_rname] = _report_q(_mart_name)
    SQL[_rname] = with_views(f"SELECT * FROM {_rname}")


# ---- top-k (K1–K6) ---------------------------------------------------------

def _years(spark, d):
    """The events' years: one column of one table (dedup keeps the latest event of a purchase, so the last year stays)."""
    return _fx(spark, d).table("lineitem").select(F.year("l_shipdate").alias("sale_year"))


def _top(mart_name, measure, id_col, latest=False):
    def q(spark, d):
        r = report(_fx(spark, d), mart_name)
        if latest:
            r = R.latest_year(r, years=_years(spark, d))
        return R.top_k(r, measure, id_col)
    return q


_TOPS = {
    "top10_products": ("mart_sales_by_product", "report_sales_by_product", "product_id", False),
    "top10_clients": ("mart_sales_by_client", "report_sales_by_client", "client_id", False),
    "top10_sellers": ("mart_sales_by_seller", "report_sales_by_seller", "seller_id", False),
    "top10_products_latest_year": ("mart_top_products_by_year", "report_products_by_year", "product_id", True),
    "top10_clients_latest_year": ("mart_top_clients_by_year", "report_clients_by_year", "client_id", True),
    "top10_loyal_clients": ("mart_client_purchase_frequency", "report_client_frequency", "client_id", False),
}
for _k, (_m, _r, _id, _latest) in _TOPS.items():
    QUERIES[_k] = _top(_m, "total_revenue", _id, _latest)
    _where = f" WHERE sale_year = (SELECT max(sale_year) FROM {_r})" if _latest else ""
    SQL[_k] = with_views(
        f"SELECT * FROM {_r}{_where} ORDER BY total_revenue DESC NULLS LAST, {_id} ASC NULLS LAST LIMIT 10")

QUERIES["latest_year"] = lambda spark, d: R.latest_year(
    report(_fx(spark, d), "mart_top_products_by_year"), years=_years(spark, d))
SQL["latest_year"] = with_views(
    "SELECT * FROM report_products_by_year WHERE sale_year = (SELECT max(sale_year) FROM report_products_by_year)")


# ---- series, ratio, labels (T1–T9, P10–P12, N1) ------------------------------

QUERIES["series_sales_day"] = lambda spark, d: R.series(
    report(_fx(spark, d), "mart_sales_by_day"), "sale_date", ["total_revenue", "total_quantity"])
SQL["series_sales_day"] = with_views(
    "SELECT sale_date, total_revenue, total_quantity FROM report_sales_by_day ORDER BY sale_date")

QUERIES["series_sales_month"] = lambda spark, d: R.month_series(
    report(_fx(spark, d), "mart_sales_by_month"), ["total_revenue", "total_quantity"])
SQL["series_sales_month"] = with_views(
    "SELECT CAST(sale_month || '-01' AS DATE) AS month_start, total_revenue, total_quantity "
    "FROM report_sales_by_month ORDER BY month_start")

QUERIES["month_to_date"] = QUERIES["series_sales_month"]
SQL["month_to_date"] = SQL["series_sales_month"]

QUERIES["series_sales_year"] = lambda spark, d: R.series(
    report(_fx(spark, d), "mart_sales_by_year"), "sale_year", ["total_revenue", "total_quantity"])
SQL["series_sales_year"] = with_views(
    "SELECT sale_year, total_revenue, total_quantity FROM report_sales_by_year ORDER BY sale_year")

QUERIES["aov_by_day"] = lambda spark, d: R.series(
    R.with_avg_order_value(report(_fx(spark, d), "mart_avg_order_value_by_day")), "sale_date",
    ["total_orders", "total_revenue", "avg_order_value"])
SQL["aov_by_day"] = with_views(
    "SELECT sale_date, total_orders, total_revenue, "
    "CASE WHEN total_orders = 0 THEN NULL ELSE CAST(total_revenue AS DOUBLE) / total_orders END AS avg_order_value "
    "FROM report_avg_order_value_by_day ORDER BY sale_date")

QUERIES["series_unique_clients"] = lambda spark, d: R.series(
    report(_fx(spark, d), "mart_unique_clients_per_day"), "sale_date", ["unique_clients"])
SQL["series_unique_clients"] = with_views(
    "SELECT sale_date, unique_clients FROM report_unique_clients ORDER BY sale_date")

QUERIES["series_unique_products"] = lambda spark, d: R.series(
    report(_fx(spark, d), "mart_unique_products_per_day"), "sale_date", ["unique_products"])
SQL["series_unique_products"] = with_views(
    "SELECT sale_date, unique_products FROM report_unique_products ORDER BY sale_date")

for _k, _m, _r, _meas in [
    ("rollup_seller_month", "mart_seller_revenue_by_month", "report_seller_month", "total_revenue"),
    ("rollup_client_month", "mart_client_revenue_by_month", "report_client_month", "total_revenue"),
    ("rollup_product_month", "mart_product_quantity_sold_by_month", "report_product_month", "total_quantity"),
]:
    QUERIES[_k] = (lambda m, meas: lambda spark, d: R.rollup_month(report(_fx(spark, d), m), meas))(_m, _meas)
    _t = "DECIMAL(20,2)" if _meas == "total_revenue" else "BIGINT"
    SQL[_k] = with_views(
        f"SELECT CAST(sale_month || '-01' AS DATE) AS month_start, CAST(sum({_meas}) AS {_t}) AS {_meas} "
        f"FROM {_r} WHERE sale_month IS NOT NULL GROUP BY 1 ORDER BY 1")

QUERIES["coerce_measures"] = lambda spark, d: R.coerce_measures(report(_fx(spark, d), "mart_sales_by_client"))
SQL["coerce_measures"] = with_views(
    "SELECT client_id, client_name, TRY_CAST(total_quantity AS DOUBLE) AS total_quantity, "
    "TRY_CAST(total_revenue AS DOUBLE) AS total_revenue FROM report_sales_by_client")

QUERIES["report_row_count"] = lambda spark, d: R.row_count(
    report(_fx(spark, d), "mart_client_purchase_frequency"), "report_client_frequency")
SQL["report_row_count"] = with_views(
    "SELECT 'report_client_frequency' AS report, CAST(count(*) AS BIGINT) AS row_count FROM report_client_frequency")
