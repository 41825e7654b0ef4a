"""Snapshot differences, signed changes, incremental marts, mergeable distinct sets."""

import datetime as dt
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.operators import dedup as D
from tillroll.operators import increments as I
from tillroll.operators import marts as M
from tillroll.operators import star as S
from tillroll.plans.refresh import MartState
from tillroll.session import scratch_path

T0 = dt.datetime(2025, 1, 30, 12)


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(tuple, a.select(*cols).collect()), key=key) == sorted(map(tuple, b.select(*cols).collect()), key=key)


def test_diff_and_old_make_new(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, 2), (4, "", None), (None, "n", 1), (6, "x", 6)], "id bigint, s string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 2), (3, "", 2), (4, None, None), (5, "e", 1), (None, "m", 1)], "id bigint, s string, n int")
    diff = I.snapshot_diff(old, new, "id")
    assert {(r.change, r.id) for r in diff.collect()} == {("update", 2), ("update", 3), ("update", 4), ("insert", 5), ("delete", 6), ("update", None)}
    assert same(I.apply_diff(old, diff, "id"), new)
    assert I.snapshot_diff(new, new, "id").isEmpty()
    assert same(I.apply_diff(new, I.snapshot_diff(new, old, "id"), "id"), old)


def test_values_that_change_places_are_a_change(spark):
    a = spark.createDataFrame([(1, None, "x")], "id int, s string, t string")
    b = spark.createDataFrame([(1, "x", None)], "id int, s string, t string")
    assert [r.change for r in I.snapshot_diff(a, b, "id").collect()] == ["update"]


def _purchases(spark, rows):
    return spark.createDataFrame(rows, schemas.PURCHASES)


def _row(pid, client, product, qty, day, price="2.00"):
    full = None if qty is None or price is None else Decimal(price) * qty
    return (pid, client, product, qty, None if price is None else Decimal(price), full, None if day is None else T0 + dt.timedelta(days=day))


def _dims(spark, clients, products):
    return {
        "clients": spark.createDataFrame([(c, f"F{c}", "L", f"{c}@x.io", T0) for c in clients], schemas.CLIENTS),
        "sellers": spark.createDataFrame([(s, f"S{s}", "L", "C", f"{s}@y.io", T0) for s in (70, 71)], schemas.SELLERS),
        "products": spark.createDataFrame([(p, s, f"p{p}", Decimal("2.00"), 9, T0) for p, s in products.items()], schemas.PRODUCTS),
    }


def _rebuild(spark, events, tombs, dims):
    gone = spark.createDataFrame([(t,) for t in tombs], "purchase_id bigint")
    kept = D.dedup_purchases(_purchases(spark, events).join(gone, "purchase_id", "left_anti"))
    fact = S.fact_purchases(kept, dims["clients"], dims["products"])
    return fact, M.build_marts(M.MartSource.from_fact(fact), dims)


def _check(spark, state, events, tombs, dims):
    fact, marts = _rebuild(spark, events, tombs, dims)
    assert same(state.fact(), fact)
    got = state.marts()
    assert set(got) == set(marts)
    for name in marts:
        assert got[name].dtypes == marts[name].dtypes, name
        assert same(got[name], marts[name]), name


def test_increments_equal_a_rebuild(spark):
    """A tombstone, a late duplicate that loses, one that wins, an event after its tombstone, a client that appears,
    one that vanishes, a product that changes its seller, NULLs, a month that empties."""
    state = MartState(spark, scratch_path(spark, "test-state"))
    runs = [
        ([_row(1, 5, 10, 3, 0), _row(1, 5, 10, 2, -1), _row(2, 6, 11, 1, 0), _row(3, None, 12, None, 1), _row(4, 8, 99, 4, 2, None),
          _row(5, 5, 10, 7, 60), _row(6, 5, 11, 1, None)], [9], [5, 6], {10: 70, 11: 71}),
        ([_row(1, 5, 10, 9, -5), _row(2, 6, 10, 5, 3), _row(9, 5, 10, 1, 0), _row(7, 8, 12, 2, 1)], [5, 77], [5, 8], {10: 71, 11: 71, 12: 70}),
        ([_row(5, 5, 10, 7, 90), _row(1, 5, 10, 3, 0), _row(10, 5, 10, 1, 0), _row(10, 5, 10, 1, 0)], [], [5, 8], {10: 71, 11: 71, 12: 70}),
    ]
    events, tombs = [], []
    for batch, gone, clients, products in runs:
        events, tombs = events + batch, tombs + gone
        dims = _dims(spark, clients, products)
        state.apply(_purchases(spark, batch), spark.createDataFrame([(t,) for t in gone], "purchase_id bigint"), dims)
        _check(spark, state, events, tombs, dims)
    months = state.manifest()["months"]["day"]
    assert "2025-03" not in months and len(set(months.values())) > 1  # an emptied month is gone, others were kept
    state.compact()
    assert len(state.manifest()["log"]) == 1
    _check(spark, state, events, tombs, dims)


def test_random_increments(spark):
    rng = random.Random(4)
    state = MartState(spark, scratch_path(spark, "test-state"))
    events, tombs = [], []
    for _ in range(3):
        batch = [_row(rng.randrange(40), rng.choice([None, 5, 6, 7, 2**40, -3]), rng.randrange(10, 16), rng.choice([None, 1, 2]), rng.randrange(-40, 40)) for _ in range(60)]
        gone = rng.sample(range(40), 4)
        events, tombs = events + batch, tombs + gone
        dims = _dims(spark, rng.sample([5, 6, 7, 2**40, -3], 3), {p: rng.choice([70, 71]) for p in rng.sample(range(10, 16), 4)})
        state.apply(_purchases(spark, batch), spark.createDataFrame([(t,) for t in gone], "purchase_id bigint"), dims)
    _check(spark, state, events, tombs, dims)
    fact, _ = _rebuild(spark, events, tombs, dims)
    got = state.distinct("client_days", F.date_format("sale_date", "yyyy-MM").alias("m"), "n").collect()
    want = fact.where("client_id is not null").groupBy(F.date_format("purchased_at", "yyyy-MM").alias("m")).agg(F.countDistinct("client_id").alias("n")).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}


def test_a_failed_run_is_not_seen(spark):
    state = MartState(spark, scratch_path(spark, "test-state"))
    dims = _dims(spark, [5], {10: 70})
    none = spark.createDataFrame([], "purchase_id bigint")
    state.apply(_purchases(spark, [_row(1, 5, 10, 3, 0)]), none, dims)
    broken = _purchases(spark, [_row(2, 5, 10, 3, 0)]).withColumn("quantity", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        state.apply(broken, none, dims)
    _check(spark, state, [_row(1, 5, 10, 3, 0)], [], dims)


def test_refresh_takes_what_landed_since(spark):
    """Two refreshes over a landing area that grows equal the nightly job over all of it."""
    from tillroll.plans import jobs
    from tillroll.streaming import landing as L

    root = scratch_path(spark, "test-refresh")
    dims = _dims(spark, [5, 6], {10: 70, 11: 71})
    lines = ['{"purchase_id":%d,"client_id":%d,"product_id":10,"purchased_at":"2025-01-0%dT10:00:00","price":2.00,"full_price":4.00,"quantity":2}' % x
             for x in ((1, 5, 1), (2, 6, 2), (3, 9, 3))]
    later = ['{"purchase_id":1,"deleted":true}', lines[1].replace("02T", "05T"), lines[2].replace(":3,", ":4,")]
    for batch in (lines, later):
        spark.createDataFrame([(x,) for x in batch], "value string").coalesce(1).write.mode("append").text(f"{root}/topic")
        L.start_landing(L.purchase_stream(spark, "text", path=f"{root}/topic"), f"{root}/landing", f"{root}/_ck", available_now=True).awaitTermination()
        jobs.stage_snapshots(dims, f"{root}/stage")
        state = jobs.refresh_marts(spark, f"{root}/stage", f"{root}/landing", f"{root}/state")
    assert len(state["log"]) == 2
    made = MartState(spark, f"{root}/state")
    assert jobs.refresh_marts(spark, f"{root}/stage", f"{root}/landing", f"{root}/state")["landed"] == state["landed"]
    paths = jobs.snowflake_from_stage(spark, f"{root}/stage", f"{root}/landing", f"{root}/out")
    fact = spark.read.schema(schemas.FACT).parquet(paths["fact_purchases"])
    assert same(made.fact(), fact) and fact.count() == 3
    marts = M.build_marts(M.MartSource.from_fact(fact), dims)
    assert all(same(df, marts[name]) for name, df in made.marts().items())


def test_bitmaps_are_made_where_their_ids_are(spark):
    """No map task makes 4 KB for each of its few ids: the ids are dealt by day and bucket first."""
    rows = spark.range(100_000).select((F.col("id") % 70_000).alias("c"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int") % 3)).alias("purchased_at"))
    made = I.day_bitmaps(rows, "c")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "partial_bitmap_construct_agg" not in plan[plan.index("Exchange"):]
    assert I.distinct_ids(made, F.year("sale_date").alias("y"), "n").collect()[0].n == 70_000


def test_a_purchase_without_id_and_changed_dimensions(spark):
    """NULL is a purchase id like any other; rows that only a client or only a product concerns are resolved again."""
    state = MartState(spark, scratch_path(spark, "test-state"))
    runs = [
        ([_row(None, 5, 10, 3, 0), _row(None, 5, 10, 2, 1), _row(0, 6, 10, 1, 0), _row(1, 5, 11, 1, 2), _row(2, 8, 12, 4, 3)], [0], [5, 6], {10: 70, 11: 71}),
        ([_row(3, 5, 11, 1, 4)], [], [5, 6, 8], {10: 71, 11: 71, 12: 70}),
        ([_row(None, 6, 11, 8, 9), _row(0, 5, 10, 1, 1)], [2], [6], {10: 70, 12: 70}),
    ]
    events, tombs = [], []
    for batch, gone, clients, products in runs:
        events, tombs = events + batch, tombs + gone
        dims = _dims(spark, clients, products)
        state.apply(_purchases(spark, batch), spark.createDataFrame([(t,) for t in gone], "purchase_id bigint"), dims)
        assert same(state.fact(), _rebuild(spark, events, tombs, dims)[0])
        got = state.distinct("product_days", F.col("sale_date"), "n").collect()
        want = state.fact().groupBy(F.to_date("purchased_at").alias("d")).agg(F.countDistinct("product_id").alias("n")).collect()
        assert {tuple(r) for r in got} == {tuple(r) for r in want}


def test_a_run_leaves_the_state_alone_on_disk(spark, tmp_path, monkeypatch):
    """A run's scratch and shuffle files are gone when it ends; the input may go when the events are taken."""
    from tillroll import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    was = shuffles()
    state, setting = MartState(spark, f"{tmp_path}/state"), spark.conf.get(session.DROP_SHUFFLES)
    for day in (0, 1):
        rows = _purchases(spark, [_row(i + 2 * day, 5, 10 + i % 3, 1, day) for i in range(40)])
        rows.write.parquet(f"{tmp_path}/input")
        kept = spark.read.schema(schemas.PURCHASES).parquet(f"{tmp_path}/input")
        none = spark.createDataFrame([], "purchase_id bigint")
        state.apply(kept, none, _dims(spark, [5], {10: 70, 11: 71}), taken=lambda: session.drop(spark, f"{tmp_path}/input"))
    until = time.time() + 20
    while shuffles() - was and time.time() < until:  # dropped by the block managers in their own time
        time.sleep(0.2)
    assert not shuffles() - was
    assert [p.name for p in tmp_path.iterdir()] == ["state"]
    assert spark.conf.get(session.DROP_SHUFFLES) == setting
    assert state.fact().count() == 42


def test_log_rows_are_dealt_once(spark, tmp_path):
    """Whole log rows move by purchase alone; the purchases of changed clients and products are found by id."""
    dims = _dims(spark, [5], {10: 70})
    other = _dims(spark, [5, 6], {10: 71})
    rows = S.fact_purchases(_purchases(spark, [_row(1, 5, 10, 3, 0), _row(2, 6, 10, 3, 0)]), dims["clients"], dims["products"])
    log = rows.withColumn("_client", F.when(F.col("purchase_id") == 1, 5).otherwise(6).cast("bigint")).withColumn("_sign", F.lit(1))
    none = spark.createDataFrame([], "purchase_id bigint")
    before, after = I.changed_rows(log, _purchases(spark, []), none, none, dims, other, str(tmp_path))
    assert {(r.purchase_id, r.client_id, r.seller_id) for r in before.collect()} == {(1, 5, 70), (2, None, 70)}
    assert {(r.purchase_id, r.client_id, r.seller_id) for r in after.collect()} == {(1, 5, 71), (2, 6, 71)}
    assert {(r.purchase_id, r._sign) for r in I.signed_changes(before, after).collect()} == {(1, 1), (1, -1), (2, 1), (2, -1)}


def test_ids_of_signed_rows(spark):
    """A log's rows as they are: an id is there where more of its rows have come than gone."""
    rows = spark.createDataFrame([(5, T0, 1), (5, T0, 1), (5, T0, -1), (6, T0, 1), (6, T0, -1), (None, T0, 1), (7, None, 1)], "c bigint, purchased_at timestamp_ntz, _sign int")
    made = I.distinct_ids(I.day_bitmaps(rows, "c"), F.col("sale_date"), "n").collect()
    assert {tuple(r) for r in made} == {(T0.date(), 1), (None, 1)}
