"""Sources, sinks and the stream landing on hand-made inputs."""

import os

import pytest
from pyspark.sql import functions as F

from tillroll.session import scratch_path
from tillroll.sources import csv_drops, files, jdbc
from tillroll.streaming import landing as L


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_routes_and_replay(spark):
    """ST4 + ST5: data / tombstone / corrupt routing; replay on one checkpoint adds nothing."""
    root = scratch_path(spark, "t-stream")
    topic = f"{root}/topic"
    _write_lines(topic, "a.json", [
        '{"purchase_id":1,"client_id":1,"product_id":1,"purchased_at":"2025-03-01T12:00:00","price":15.00,'
        '"full_price":15.00,"quantity":1}',
        '{"purchase_id":2,"client_id":2,"product_id":2,"purchased_at":"2025-03-02T12:00:00+03:00","price":"7.1",'
        '"full_price":59.970000000000006,"quantity":2}',
        '{"purchase_id":1,"deleted":true}',
        'not json',
        '[]',
        '{"purchase_id":3,"client_id":3,"product_id":3,"purchased_at":"bad-date","price":1,"full_price":1,"quantity":1}',
        '{"Purchase_ID":4,"client_id":3,"product_id":3,"purchased_at":"2025-03-02T12:00:00","price":1,'
        '"full_price":1,"quantity":1}',
    ])
    out, ck = f"{root}/out", f"{root}/ck"
    for _ in range(2):
        L.start_landing(L.purchase_stream(spark, "text", path=topic), out, ck, available_now=True).awaitTermination()
    data = L.read_route(spark, out, "data").orderBy("purchase_id").collect()
    assert [r.purchase_id for r in data] == [1, 2]
    assert str(data[1].price) == "7.10" and str(data[1].full_price) == "59.97"
    assert str(data[1].purchased_at) == "2025-03-02 09:00:00"  # offset converted to UTC wall clock
    assert [r.purchase_id for r in L.read_route(spark, out, "tombstones").collect()] == [1]
    lines = {r.raw for r in L.read_route(spark, out, "corrupt").collect()}
    assert len(lines) == 4 and any("bad-date" in x for x in lines) and any("Purchase_ID" in x for x in lines)  # whole text
    # the checkpoint is lost, another file arrives, and the query restarts under the same path: nothing is overwritten
    os.rename(ck, ck + "-lost")
    os.rename(f"{topic}/a.json", f"{root}/a.json")
    _write_lines(topic, "b.json", ['{"purchase_id":3000000000,"client_id":1,"product_id":1,"purchased_at":"2025-03-01T12:00:00",'
                                   '"price":15.00,"full_price":15.00,"quantity":1}'])
    L.start_landing(L.purchase_stream(spark, "text", path=topic), out, ck, available_now=True).awaitTermination()
    assert sorted(r.purchase_id for r in L.read_route(spark, out, "data").collect()) == [1, 2, 3_000_000_000]


def test_csv_drops_reject_bad_file_and_skip_loaded(spark):
    """A file with any bad row is rejected whole; files in the ledger are skipped."""
    root = scratch_path(spark, "t-csv")
    header = "seller_id,name,price,quantity,created_at"
    _write_lines(f"{root}/in", "good.CSV", [header, "1,Widget,9.99,50,2025-05-09T12:00:00Z",
                                            "2,Gadget,19.50,,2025-05-08T09:30:00Z"])
    _write_lines(f"{root}/in", "bad.csv", [header, "1,Ok,1.00,1,2025-05-09T12:00:00Z", "x,Broken,abc,1,nope"])
    _write_lines(f"{root}/in", "notes.txt", ["ignored"])
    acc, rej, ledger = csv_drops.load_csv_drops(spark, f"{root}/in", f"{root}/ledger", "2025-06-01 00:00:00")
    rows = sorted((r.name, r.quantity) for r in acc.collect())
    assert rows == [("Gadget", 1), ("Widget", 50)]  # quantity defaults to 1
    assert [r.filename for r in rej.collect()] == ["bad.csv"]
    files.write_parquet(ledger, f"{root}/ledger", mode="append")
    acc2, _, _ = csv_drops.load_csv_drops(spark, f"{root}/in", f"{root}/ledger", "2025-06-02 00:00:00")
    assert acc2.count() == 0


def test_csv_file_of_a_header_alone_is_loaded(spark):
    root = scratch_path(spark, "t-csv-header")
    header = "seller_id,name,price,quantity,created_at"
    _write_lines(f"{root}/in", "empty.csv", [header])
    _write_lines(f"{root}/in", "one.csv", [header, "1,Widget,9.99,50,2025-05-09T12:00:00Z"])
    rejected = csv_drops.load_and_record(spark, f"{root}/in", f"{root}/ledger", f"{root}/out", "2025-06-01 00:00:00")
    assert rejected.isEmpty()
    assert sorted(r.filename for r in csv_drops.read_ledger(spark, f"{root}/ledger").collect()) == ["empty.csv", "one.csv"]
    acc, rej, ledger = csv_drops.load_csv_drops(spark, f"{root}/in", f"{root}/ledger", "2025-06-02 00:00:00")
    assert acc.isEmpty() and rej.isEmpty() and ledger.isEmpty()


def test_csv_names_and_ledger(spark):
    """A file name with a space or a plus is the same in the listing, the rows and the ledger; other errors surface."""
    root = scratch_path(spark, "t-csv3")
    _write_lines(f"{root}/in", "my file+1.csv", ["seller_id,name,price,quantity,created_at", "1,W,9.99,5,2025-05-09T12:00:00Z"])
    for _ in range(2):
        csv_drops.load_and_record(spark, f"{root}/in", f"{root}/ledger", f"{root}/out", "2025-06-01 00:00:00")
    assert [r.filename for r in csv_drops.read_ledger(spark, f"{root}/ledger").collect()] == ["my file+1.csv"]
    assert spark.read.parquet(f"{root}/out").count() == 1
    _write_lines(f"{root}/broken", "x.parquet", ["no parquet"])
    with pytest.raises(Exception):
        csv_drops.read_ledger(spark, f"{root}/broken").collect()


def test_tables_published_together(spark):
    """One manifest: a reader sees both new tables or both old ones, and publishing one keeps the other."""
    from tillroll.plans import jobs

    root = scratch_path(spark, "t-publish")
    jobs.publish({"a": spark.range(1), "b": spark.range(2)}, root)
    old = files.current_version(spark, root, "a")
    jobs.publish({"a": spark.range(3), "b": spark.range(4)}, root)
    assert files.read_stage(spark, root, "a").count() == 3 and files.read_stage(spark, root, "b").count() == 4
    files.write_stage(spark.range(7), root, "b")
    assert files.read_stage(spark, root, "a").count() == 3 and files.read_stage(spark, root, "b").count() == 7
    assert spark.read.parquet(old).count() == 1  # a reader of the old version is not disturbed


def test_stage_versions_and_json(spark):
    root = scratch_path(spark, "t-stage")
    files.write_stage(spark.range(3), root, "t")
    files.write_stage(spark.range(5), root, "t")
    assert files.read_stage(spark, root, "t").count() == 5
    p = f"{root}/j"
    _write_lines(p, "x.json", ['{"purchase_id":1,"price":59.970000000000006}', "garbage"])
    rows = files.read_purchase_json(spark, p).orderBy(F.col("purchase_id").asc_nulls_last()).collect()
    assert str(rows[0].price) == "59.97" and rows[1]._corrupt_record == "garbage"


def test_jdbc_options():
    o = jdbc.read_options("jdbc:x", "t", {"user": "u"}, jdbc.JdbcPartitioning("id", 0, 100, 4))
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["user"] == "u"
    w = jdbc.write_options("jdbc:x", "t", cascade=True)
    assert w["truncate"] == "true" and w["cascadeTruncate"] == "true"


def test_nightly_stage_to_snowflake(spark, fx):
    """Stage snapshots + landed stream → dims and fact equal to the fixture views minus tombstones."""
    from tillroll.plans import io as IO
    from tillroll.plans import jobs
    from tillroll.operators import rules as U
    from tillroll.sources import requests as RQ

    root = scratch_path(spark, "t-nightly")
    d = fx.data_dir
    jobs.stage_snapshots({"clients": fx.clients_raw, "sellers": fx.sellers, "products": fx.products,
                          "purchases": fx.purchases}, f"{root}/stage")
    L.write_ndjson(IO.topic_lines(spark, d), f"{root}/topic")
    L.start_landing(L.purchase_stream(spark, "text", path=f"{root}/topic"), f"{root}/landing", f"{root}/ck",
                    available_now=True).awaitTermination()
    paths = jobs.snowflake_from_stage(spark, f"{root}/stage", f"{root}/landing", f"{root}/out")
    got = spark.read.parquet(paths["fact_purchases"])
    want = U.purchases_not_deleted(fx.fact, RQ.purchase_deletes(spark, d))
    assert got.schema == want.schema
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert spark.read.parquet(paths["dim_clients"]).exceptAll(fx.clients).count() == 0


def test_cli_nightly_and_marts(spark, fx):
    """The job entry points: nightly (stage + landing → snowflake), then marts from its output."""
    from tillroll.__main__ import main
    from tillroll.plans import io as IO
    from tillroll.plans import jobs
    from tillroll.operators import marts as M

    root = scratch_path(spark, "t-cli")
    jobs.stage_snapshots({"clients": fx.clients_raw, "sellers": fx.sellers, "products": fx.products,
                          "purchases": fx.purchases}, f"{root}/stage")
    L.write_ndjson(IO.topic_lines(spark, fx.data_dir), f"{root}/topic")
    L.start_landing(L.purchase_stream(spark, "text", path=f"{root}/topic"), f"{root}/landing", f"{root}/ck",
                    available_now=True).awaitTermination()
    main(["nightly", "--stage", f"{root}/stage", "--landing", f"{root}/landing", "--out", f"{root}/snowflake"])
    main(["marts", "--snowflake", f"{root}/snowflake", "--out", f"{root}/marts"])
    t = jobs.read_snowflake(spark, f"{root}/snowflake")
    for name in M.MARTS:
        got = files.read_mart(spark, f"{root}/marts", name)
        want = M.build_mart(name, M.MartSource.from_fact(t["fact_purchases"]), {
            "clients": t["dim_clients"], "sellers": t["dim_sellers"], "products": t["dim_products"]})
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def test_csv_reload_is_idempotent(spark):
    """A file loaded twice (ledger lost) replaces its own rows instead of duplicating them."""
    root = scratch_path(spark, "t-csv2")
    _write_lines(f"{root}/in", "a.csv", ["seller_id,name,price,quantity,created_at", "1,W,9.99,5,2025-05-09T12:00:00Z"])
    _write_lines(f"{root}/in", "b.csv", ["seller_id,name,price,quantity,created_at", "2,G,1.50,3,2025-05-09T12:00:00Z"])
    csv_drops.load_and_record(spark, f"{root}/in", f"{root}/ledger1", f"{root}/out", "2025-06-01 00:00:00")
    csv_drops.load_and_record(spark, f"{root}/in", f"{root}/ledger2", f"{root}/out", "2025-06-01 00:00:00")
    assert spark.read.parquet(f"{root}/out").count() == 2
