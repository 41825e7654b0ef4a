"""Goldens: a small purchase sample of our own through stream landing →
fact → marts → reports, and the seed rows through pricing and the fact build."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import casts as C
from tillroll.operators import marts as M
from tillroll.operators import reports as R
from tillroll.operators import rules as U
from tillroll.operators import star as S
from tillroll.session import scratch_path
from tillroll.sources import files
from tillroll.sources.seed import seed
from tillroll.streaming import landing as L


# Eight purchases of our own; the goldens below were worked out by hand from these rows.
SAMPLE = [
    # purchase, client, product, purchased_at, price, full_price, quantity
    (1, 1, 10, "2024-11-30T23:59:59", 2.50, 5.00, 2),
    (2, 2, 11, "2024-12-01T00:00:00", 4.00, 4.00, 1),
    (3, 1, 11, "2024-12-24T18:00:00", 4.00, 12.00, 3),
    (4, 3, 12, "2024-12-31T23:00:00", 0.75, 3.00, 4),
    (5, 2, 10, "2025-01-01T08:30:00", 2.50, 2.50, 1),
    (6, 3, 10, "2025-01-15T08:30:00", 2.50, 7.50, 3),
    (7, 1, 12, "2025-01-15T12:00:00", 0.75, 1.50, 2),
    (8, 9, 13, "2025-02-02T02:02:02", 6.00, 6.00, 1),
]


def test_sample_goldens(spark):
    root = scratch_path(spark, "t-golden")
    ev = spark.createDataFrame(SAMPLE, "purchase_id bigint, client_id bigint, product_id bigint, purchased_at string, "
                                       "price double, full_price double, quantity bigint")
    L.write_ndjson(ev.select(F.to_json(F.struct(*ev.columns)).alias("value")), f"{root}/topic")
    L.start_landing(L.purchase_stream(spark, "text", path=f"{root}/topic"), f"{root}/out", f"{root}/ck",
                    available_now=True).awaitTermination()
    landed = L.read_route(spark, f"{root}/out", "data")
    clients = spark.createDataFrame([(c, f"F{c}", f"L{c}", f"c{c}@x.io", dt.datetime(2024, 1, 1)) for c in (1, 2, 3)],
                                    schemas.CLIENTS)
    products = spark.createDataFrame([(p, s, f"P{p}", Decimal(x), 100, dt.datetime(2024, 1, 1))
                                      for p, s, x in ((10, 1, "2.50"), (11, 1, "4.00"), (12, 2, "0.75"))], schemas.PRODUCTS)
    fact = S.fact_purchases(C.conform_purchases(landed), clients, products)
    src = M.MartSource.from_fact(fact)

    month = {r.sale_month: (r.total_quantity, r.total_revenue) for r in M.sales_by_month(src).collect()}
    assert month == {"2024-11": (2, Decimal("5.00")), "2024-12": (8, Decimal("19.00")), "2025-01": (6, Decimal("11.50")),
                     "2025-02": (1, Decimal("6.00"))}
    year = {r.sale_year: (r.total_quantity, r.total_revenue) for r in M.sales_by_year(src).collect()}
    assert year == {2024: (10, Decimal("24.00")), 2025: (7, Decimal("17.50"))}
    freq = {r.client_id: (r.total_orders, r.total_revenue) for r in M.client_purchase_frequency(src, clients).collect()}
    assert freq == {1: (3, Decimal("18.50")), 2: (2, Decimal("6.50")), 3: (2, Decimal("10.50")), None: (1, Decimal("6.00"))}
    prod = {r.product_id: (r.total_quantity, r.total_revenue) for r in M.sales_by_product(src, products).collect()}
    assert prod == {10: (6, Decimal("15.00")), 11: (4, Decimal("16.00")), 12: (6, Decimal("4.50")), 13: (1, Decimal("6.00"))}
    top = R.top_k(R.report_sales_by_product(M.sales_by_product(src, products)), "total_revenue", "product_id", 3)
    assert [r.product_id for r in top.collect()] == [11, 10, 13]

    # Stored mart read back by the report
    files.write_mart(M.sales_by_month(src), f"{root}/marts", "mart_sales_by_month", ["sale_month"])
    rep = R.report_sales_by_month(files.read_mart(spark, f"{root}/marts", "mart_sales_by_month")).collect()
    assert [r.sale_month for r in rep] == ["2025-02", "2025-01", "2024-12", "2024-11"]


def test_seed_through_pricing_and_fact(spark):
    """S14 seed rows: P14 pricing, J3 fact build, M06 seller mart."""
    t = seed(spark)
    priced = U.price_purchases(t["purchases"], t["products"])
    got = {r.purchase_id: (r.price, r.full_price) for r in priced.collect()}
    assert got == {1: (Decimal("19.99"), Decimal("39.98")), 2: (Decimal("29.99"), Decimal("29.99"))}
    purchases = priced.select(*schemas.PURCHASE_COLS)
    fact = S.fact_purchases(purchases, t["clients"], t["products"])
    sellers = {r.seller_name: r.total_revenue for r in M.sales_by_seller(M.MartSource.from_fact(fact), t["sellers"]).collect()}
    assert sellers == {"Alice Williams": Decimal("39.98"), "Charlie Brown": Decimal("29.99")}
