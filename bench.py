"""Bench: the nightly snowflake build, all fifteen marts, the dashboard reports,
top-10 lists and the stock allocation, at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.
Cold JVM for the first step; later steps run warm in the same session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tillroll.session import local_session, scratch_path

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="tillroll-bench")
    from tillroll.operators import reports as R
    from tillroll.operators.marts import ROLLUPS, MartSource
    from tillroll.plans import jobs
    from tillroll.plans.registry import all_queries
    from tillroll.sources.fixtures import Fixture

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    out_dir = scratch_path(spark, "bench")
    fx = Fixture(spark, sf_dir)
    paths = timed("snowflake_build", lambda: jobs.build_snowflake(fx, f"{out_dir}/snowflake"))
    tables = jobs.read_snowflake(spark, paths)
    marts = timed("marts_all_15", lambda: jobs.build_all_marts(tables, f"{out_dir}/marts"))
    # the same fifteen marts, each straight from the fact, and once more through the roll-ups (both warm now)
    extra: dict[str, float | int] = {}

    def also(name, fn):
        t0 = time.perf_counter()
        out = fn()
        extra[name] = round(time.perf_counter() - t0, 3)
        return out

    also("marts_direct", lambda: jobs.build_all_marts(tables, f"{out_dir}/marts_direct", rollups=()))
    also("marts_day_rollup", lambda: jobs.build_all_marts(tables, f"{out_dir}/marts_again"))
    also("marts_direct_again", lambda: jobs.build_all_marts(tables, f"{out_dir}/marts_direct2", rollups=()))
    also("marts_day_rollup_again", lambda: jobs.build_all_marts(tables, f"{out_dir}/marts_again2"))
    also("marts_all_rollups", lambda: jobs.build_all_marts(tables, f"{out_dir}/marts_all", rollups=tuple(ROLLUPS)))
    extra["fact_rows"] = tables["fact_purchases"].count()
    src = MartSource.shared(tables["fact_purchases"], storage=None, rollups=tuple(ROLLUPS))
    extra |= {f"{name}_rows": r.count() for name, r in src.rollups.items()}

    for mart_name, (rname, fn) in R.REPORTS.items():
        timed(rname, lambda fn=fn, m=mart_name: fn(marts[m]).write.format("noop").mode("overwrite").save())
    tops = {
        "top10_products": (R.report_sales_by_product, "mart_sales_by_product", "product_id", False),
        "top10_clients": (R.report_sales_by_client, "mart_sales_by_client", "client_id", False),
        "top10_sellers": (R.report_sales_by_seller, "mart_sales_by_seller", "seller_id", False),
        "top10_products_latest_year": (R.report_products_by_year, "mart_top_products_by_year", "product_id", True),
        "top10_clients_latest_year": (R.report_clients_by_year, "mart_top_clients_by_year", "client_id", True),
        "top10_loyal_clients": (R.report_client_frequency, "mart_client_purchase_frequency", "client_id", False),
    }
    for k, (fn, m, idc, latest) in tops.items():
        def run(fn=fn, m=m, idc=idc, latest=latest):
            r = fn(marts[m])
            return R.top_k(R.latest_year(r) if latest else r, "total_revenue", idc).collect()
        timed(k, run)

    # Single registered queries end to end from the raw tables (fixture → fact → mart → report).
    qs = all_queries()
    for k in ("mart_sales_by_seller", "mart_unique_clients_per_day", "top10_clients_latest_year",
              "allocate_stock", "dedup_purchases"):
        if k in qs:
            timed("q_" + k, lambda k=k: qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save())

    # Not in the total, which covers the same steps in every round.
    for k in ("stream_land", "csv_load", "insert_products", "audit_constraints", "update_products"):
        also("q_" + k, lambda k=k: qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save())

    total = round(sum(times.values()), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_job_seconds", "value": total, "unit": "sec", "queries": times, "extra": extra,
        "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus, "state": "cold JVM, first step includes warm-up",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
