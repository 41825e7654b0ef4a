"""Job entry points for ``spark-submit`` (the master and cluster sizing come from submit).

    spark-submit --py-files tillroll.zip tillroll/__main__.py stage   --jdbc-url URL --user U --password P --stage ROOT
    spark-submit --py-files tillroll.zip tillroll/__main__.py land    --bootstrap HOST:PORT --topic purchases \
                                                              --landing ROOT --checkpoint DIR
    spark-submit --py-files tillroll.zip tillroll/__main__.py compact --landing ROOT
    spark-submit --py-files tillroll.zip tillroll/__main__.py nightly --stage ROOT --landing ROOT --out DIR
    spark-submit --py-files tillroll.zip tillroll/__main__.py marts   --snowflake DIR --out DIR
    spark-submit --py-files tillroll.zip tillroll/__main__.py refresh --stage ROOT --landing ROOT --state DIR

(``python -m tillroll …`` works the same with a local session.)

Paths should be on storage shared by the cluster. Each job is re-runnable: stage
and snowflake outputs are new versions or overwrites, the landing is idempotent
per micro-batch, marts are overwritten.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillroll.session import configure


def _session(app: str) -> SparkSession:
    return configure(SparkSession.builder.appName(app).getOrCreate())


def _stage(a) -> None:
    from tillroll.plans import jobs
    from tillroll.sources.jdbc import JdbcPartitioning, read_jdbc

    spark = _session("tillroll-stage")
    props = {"user": a.user, "password": a.password}
    if a.driver:
        props["driver"] = a.driver
    sources = {}
    for table, key in (("clients", "client_id"), ("sellers", "seller_id"), ("products", "product_id"),
                       ("purchases", "purchase_id")):
        part = None
        if a.partitions > 1:
            bounds = read_jdbc(spark, a.jdbc_url, f"(SELECT min({key}) lo, max({key}) hi FROM {table}) b", props).first()
            if bounds and bounds["lo"] is not None:
                part = JdbcPartitioning(key, int(bounds["lo"]), int(bounds["hi"]) + 1, a.partitions)
        sources[table] = read_jdbc(spark, a.jdbc_url, table, props, part)
    print(jobs.stage_snapshots(sources, a.stage))


def _land(a) -> None:
    from tillroll.streaming import landing as L

    spark = _session("tillroll-land")
    values = L.purchase_stream(spark, "kafka", {"kafka.bootstrap.servers": a.bootstrap, "subscribe": a.topic})
    L.start_landing(values, a.landing, a.checkpoint, available_now=a.available_now).awaitTermination()


def _compact(a) -> None:
    from tillroll.streaming import compaction

    spark = _session("tillroll-compact")
    print(compaction.compact(spark, a.landing, a.fan))
    if a.vacuum_hours is not None:
        print(compaction.vacuum(spark, a.landing, a.vacuum_hours * 3600))


def _refresh(a) -> None:
    from tillroll.plans import jobs

    print(jobs.refresh_marts(_session("tillroll-refresh"), a.stage, a.landing, a.state))


def _nightly(a) -> None:
    from tillroll.plans import jobs

    spark = _session("tillroll-nightly")
    print(jobs.snowflake_from_stage(spark, a.stage, a.landing, a.out))


def _marts(a) -> None:
    from tillroll.plans import jobs

    spark = _session("tillroll-marts")
    tables = jobs.read_snowflake(spark, a.snowflake)
    jobs.build_all_marts(tables, a.out, checkpoint=a.checkpoint)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tillroll")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("stage", help="source tables over JDBC → stage snapshots")
    s.add_argument("--jdbc-url", required=True)
    s.add_argument("--user", default="")
    s.add_argument("--password", default="")
    s.add_argument("--driver", default=None)
    s.add_argument("--partitions", type=int, default=16)
    s.add_argument("--stage", required=True)
    s.set_defaults(fn=_stage)
    s = sub.add_parser("land", help="purchase topic → landed events (data / tombstones / corrupt)")
    s.add_argument("--bootstrap", required=True)
    s.add_argument("--topic", default="purchases")
    s.add_argument("--landing", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true")
    s.set_defaults(fn=_land)
    s = sub.add_parser("compact", help="landed micro-batches → files by day")
    s.add_argument("--landing", required=True)
    s.add_argument("--fan", type=int, default=4)
    s.add_argument("--vacuum-hours", type=float, default=None, help="remove what has not been live for so long")
    s.set_defaults(fn=_compact)
    s = sub.add_parser("refresh", help="what landed since the last run → fact and marts, incrementally")
    s.add_argument("--stage", required=True)
    s.add_argument("--landing", required=True)
    s.add_argument("--state", required=True)
    s.set_defaults(fn=_refresh)
    s = sub.add_parser("nightly", help="stage snapshots + landed events → dims and fact")
    s.add_argument("--stage", required=True)
    s.add_argument("--landing", required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=_nightly)
    s = sub.add_parser("marts", help="dims and fact → the fifteen marts")
    s.add_argument("--snowflake", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", action="store_true", help="checkpoint the shared base instead of persisting it")
    s.set_defaults(fn=_marts)
    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main()
