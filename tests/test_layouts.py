"""Landing compaction, bucketed tables, as-of join, checks while writing, VARIANT events, allocation on micro-batches."""

import bisect
import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillroll import schemas
from tillroll.operators import asof, audit, dedup, stock
from tillroll.plans import layouts
from tillroll.session import scratch_path
from tillroll.sources import bucketed, files, landed, variants
from tillroll.sources.fixtures import Fixture
from tillroll.streaming import allocation, compaction
from tillroll.streaming import landing as L

T0 = dt.datetime(2025, 1, 1, 12)


def _events(spark, ids, day):
    rows = [(i, 1, 1, None if day is None else T0 + dt.timedelta(days=day), Decimal("1.00"), Decimal("1.00"), 1) for i in ids]
    return spark.createDataFrame(rows, schemas.LANDED)


def _land(spark, root, run, batch, frames):
    for f in frames:
        f.write.mode("append").parquet(f"{root}/data/run={run}/batch_id={batch}")


def _ids(spark, root, days=None):
    return Counter(r.purchase_id for r in landed.read_live(spark, root, "data", days).collect())


def test_every_event_once_through_compactions(spark, monkeypatch):
    root = scratch_path(spark, "test-landing")
    assert _ids(spark, root) == Counter() and compaction.compact(spark, root) == {"data": 0, "tombstones": 0, "corrupt": 0}
    _land(spark, root, "a", 0, [_events(spark, [1, 2, 2], 0)])
    _land(spark, root, "a", 1, [_events(spark, [3], 1)])
    _land(spark, root, "b", 0, [_events(spark, [4], None)])
    unfinished = f"{root}/data/run=a/batch_id=2"
    _events(spark, [99], 0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(unfinished)
    want = Counter({1: 1, 2: 2, 3: 1, 4: 1})
    assert _ids(spark, root) == want  # a batch that is being written is not read

    with monkeypatch.context() as m:  # killed before the manifest is replaced: nothing changed
        m.setattr(files, "_replace_text", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            compaction.compact(spark, root)
    assert _ids(spark, root) == want
    before = landed.live(spark, root)["data"]
    assert compaction.compact(spark, root)["data"] == 3 and _ids(spark, root) == want
    # a reader that began with the old manifest still reads every event once
    old = landed.finished(spark, root, "data", before["through"])
    assert Counter(r.purchase_id for r in landed.read_paths(spark, "data", [p for *_, p in old]).collect()) == want
    # a replay writes batch 1 again under the same name; it is not taken twice
    _events(spark, [3], 1).write.mode("overwrite").parquet(f"{root}/data/run=a/batch_id=1")
    assert _ids(spark, root) == want and compaction.compact(spark, root)["data"] == 0
    _events(spark, [5, 6], 0).write.mode("overwrite").parquet(unfinished)
    want += Counter([5, 6])
    assert _ids(spark, root) == want  # compacted and new ones together
    assert _ids(spark, root, days=["2025-01-02"]) == Counter([3, 5, 6])  # one day's files, and what is not compacted
    compaction.compact(spark, root)
    assert _ids(spark, root) == want and _ids(spark, root, days=["2025-01-01"]) == Counter([1, 2, 2, 5, 6])
    assert _ids(spark, root, days=["none"]) == Counter([4])


def test_days_with_many_generations_are_merged(spark):
    root = scratch_path(spark, "test-landing")
    for i in range(5):
        _land(spark, root, "a", i, [_events(spark, [i], 0)] + ([_events(spark, [100], 9)] if i == 0 else []))
        compaction.compact(spark, root, fan=3)
    days = landed.live(spark, root)["data"]["days"]
    assert len(days["2025-01-01"]) <= 2 and len(days["2025-01-10"]) == 1
    assert _ids(spark, root) == Counter([0, 1, 2, 3, 4, 100])
    assert compaction.vacuum(spark, root, min_age_s=3600) == 0
    assert compaction.vacuum(spark, root, min_age_s=-1) >= 5
    assert _ids(spark, root) == Counter([0, 1, 2, 3, 4, 100])


def test_bucketed_nightly_has_no_exchange_on_the_key(spark):
    root, fx = scratch_path(spark, "test-buckets"), Fixture(spark, SF_SMALL)
    layouts.write_buckets(fx, root)
    plan = layouts.nightly_from_buckets(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(purchase_id" not in plan and "Bucketed: true" in plan and "WindowGroupLimit" in plan
    plain = dedup.dedup_purchases(fx.purchase_events)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(purchase_id" in plain
    # a session that does not know the table declares it from the stored layout
    version = files.current_version(spark, root, "events").rpartition("=")[2]
    spark.sql(f"DROP TABLE bucketed_{version}")
    again = bucketed.read_bucketed(spark, root, "events", schemas.PURCHASES)
    assert again.count() == fx.purchase_events.count()
    assert "hashpartitioning" not in dedup.dedup_purchases(again)._jdf.queryExecution().executedPlan().toString()


def test_asof_join_equals_brute_force_with_a_hot_key(spark):
    """One product holds a third of the rows (many at one time); ties, NULLs, rows before any version."""
    rng = random.Random(6)
    at = lambda: T0 + dt.timedelta(hours=rng.randrange(0, 400))
    versions = [(rng.randrange(8), at(), rng.choice([None, 1, 2, 3])) for _ in range(150)] + [(0, T0 + dt.timedelta(hours=h), h) for h in range(50, 90)]
    versions += [(None, T0, 7), (3, None, 8)]
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 3, 8, None]), rng.choice([at(), T0 + dt.timedelta(hours=70), None])) for i in range(1500)]
    rows += rows[:20]
    left = spark.createDataFrame(rows, "id int, product_id bigint, at timestamp_ntz")
    right = spark.createDataFrame(versions, "product_id bigint, since timestamp_ntz, price int")
    got = asof.asof_join(left, right, "product_id", "at", "since", ["price", "since"], num_partitions=8)
    assert got.columns == ["id", "product_id", "at", "price", "since"]
    kept = {}
    for p, t, v in versions:
        if p is not None and t is not None:
            kept.setdefault(p, []).append((t, -1 if v is None else v))
    kept = {p: sorted(v) for p, v in kept.items()}

    def want(p, t):
        mine = kept.get(p, []) if t is not None else []
        k = bisect.bisect_right([x for x, _ in mine], t) if mine else 0
        return (None if mine[k - 1][1] < 0 else mine[k - 1][1], mine[k - 1][0]) if k else (None, None)

    assert Counter(map(tuple, got.collect())) == Counter((i, p, t, *want(p, t)) for i, p, t in rows)
    assert asof.asof_join(left, right.limit(0), "product_id", "at", "since", ["price"]).where("price is not null").isEmpty()


def test_checks_are_counted_while_a_table_is_written(spark):
    fx, root = Fixture(spark, SF_SMALL), scratch_path(spark, "test-observed")
    tables = {"sellers_raw": fx.sellers_raw, "products_raw": fx.products_raw, "clients": fx.clients}
    got = audit.write_observed(tables, lambda name, t: t.write.parquet(f"{root}/{name}"))
    want = audit.audit_constraints(tables).where("check_name in ('not_null', 'too_long')")
    key = lambda df: sorted(map(tuple, df.select("table_name", "check_name", "violations").collect()))
    assert key(got) == key(want) and any(r.violations for r in got.collect())
    assert spark.read.parquet(f"{root}/sellers_raw").count() == fx.sellers_raw.count()


def test_dead_letters_and_unknown_fields_stay(spark):
    rows = [("purchase_created", '{"purchase_id":5,"new":{"a":[1,2.5,"x"]},"price":2.50}'), ("client_deleted", '{"client_id":7'),
            ("x", "[1,2]"), ("x", None), ("x", '"text"'), ("product_created", '{"name":"é"}')]
    path = scratch_path(spark, "test-variants")
    variants.write_events(spark.createDataFrame(rows, "kind string, value string"), path)
    back = variants.read_events(spark, path)
    assert Counter(r.kind for r in back.collect()) == Counter({"dead_letter": 4, "purchase_created": 1, "product_created": 1})
    one = back.where("kind = 'purchase_created'").select(variants.field("purchase_id", "bigint"), variants.field("new.a[1]", "double"), variants.field("price", "decimal(12,2)"), variants.field("name", "string")).first()
    assert tuple(one) == (5, 2.5, Decimal("2.50"), None)
    text = {r[0] for r in back.where("kind = 'dead_letter'").select(F.try_variant_get("body", "$", "string")).collect()}
    assert text == {'{"client_id":7', "[1,2]", '"text"', None}


def test_stream_in_batches_with_restarts_equals_the_batch_job(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, 4, 9]), rng.choice([0, 1, 2, 5, None]), T0 + dt.timedelta(minutes=i // 2)) for i in range(600)]
    root = scratch_path(spark, "test-answers")
    kinds = schemas.PRODUCTS
    files.write_stage(spark.createDataFrame([(p, 1, "p", Decimal("1.00"), q, T0) for p, q in ((1, 300), (2, 9), (3, None), (4, 0))], kinds), root, "products")
    products = files.read_stage(spark, root, "products", kinds)
    for lo, hi in ((0, 250), (250, 260), (260, 600)):
        spark.createDataFrame(rows[lo:hi], allocation.REQUESTS).coalesce(1).write.mode("append").json(f"{root}/in")
        q = allocation.start_answering(allocation.request_stream(spark, f"{root}/in"), products, f"{root}/out", f"{root}/ck", available_now=True)
        q.awaitTermination()
    got = {r.purchase_id: (r.product_id, r.quantity, r.accepted, r.remaining, r.reason) for r in spark.read.schema(allocation.ANSWERS).parquet(f"{root}/out").collect()}
    assert len(got) == 600
    batch = stock.allocate(spark.createDataFrame(rows, allocation.REQUESTS), products, num_partitions=4).collect()
    assert {r.purchase_id: (r.product_id, r.quantity, r.accepted, r.reason) for r in batch} == {k: (*v[:3], v[4]) for k, v in got.items() if v[0] != 9}
    assert all(got[r.purchase_id][3] == r.remaining for r in batch if r.accepted)
    assert {v[4] for v in got.values() if v[0] == 9} == {"not found"}


def test_a_shelf_of_products_and_a_batch_of_many_files(spark):
    """Products that share a state value keep their own stock; all files of a part are one batch, whatever their order."""
    rng = random.Random(3)
    stocks = {p: rng.choice([None, 3, 40]) for p in (*range(-3, 4), 255, 256, 2**40, 2**40 + 1)}
    rows = [(i, rng.choice([*stocks, 7, 2**40 + 5]), rng.choice([1, 2, None]), T0 + dt.timedelta(minutes=i // 2)) for i in range(400)]
    root, kinds = scratch_path(spark, "test-shelves"), schemas.PRODUCTS
    files.write_stage(spark.createDataFrame([(p, 1, "p", Decimal("1.00"), q, T0) for p, q in stocks.items()], kinds), root, "products")
    products = files.read_stage(spark, root, "products", kinds)
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part[::-1], allocation.REQUESTS).repartition(5).write.mode("append").json(f"{root}/in")
        asked = allocation.request_stream(spark, f"{root}/in", whole=True)
        allocation.start_answering(asked, products, f"{root}/out", f"{root}/ck", available_now=True).awaitTermination()
    got = {r.purchase_id: tuple(r)[1:] for r in spark.read.schema(allocation.ANSWERS).parquet(f"{root}/out").collect()}
    batch = stock.allocate(spark.createDataFrame(rows, allocation.REQUESTS), products, num_partitions=4).collect()
    assert {r.purchase_id: tuple(r)[1:] for r in batch} == {k: v for k, v in got.items() if v[4] != "not found"}
    assert {k for k, v in got.items() if v[4] == "not found"} == {r[0] for r in rows if r[1] not in stocks}


def test_buckets_follow_the_size_of_the_input(spark, tmp_path, monkeypatch):
    from tillroll import session

    (tmp_path / "lineitem.parquet").write_bytes(b"x" * 995)
    monkeypatch.setattr(session, "BYTES_A_PARTITION", 10)
    assert session.input_parts(spark, str(tmp_path)) == 100


def test_landing_writes_a_batch_once_and_reads_both_layouts(spark):
    """One folder a batch, by route; a batch of the earlier layout that is replayed counts once; vacuum takes it."""
    root = scratch_path(spark, "test-routed")
    line = '{"purchase_id":%d,"client_id":1,"product_id":1,"purchased_at":"2025-01-02T03:04:05","price":1.50,"full_price":3.00,"quantity":2}'
    lines = [line % 1, line % 2, '{"purchase_id":9,"deleted":true}', "{cut", '{"client_id":4}']
    L.write_ndjson(spark.createDataFrame([(x,) for x in lines], "value string"), f"{root}/topic")
    L.start_landing(L.purchase_stream(spark, "text", path=f"{root}/topic"), f"{root}/out", f"{root}/ck", available_now=True).awaitTermination()
    (run, batch, path), = landed.finished(spark, f"{root}/out", "data", {})
    assert path.endswith(f"/routed/run={run}/batch_id={batch}/route=data")
    assert not files.exists(spark, f"{root}/out/data") and not files.exists(spark, f"{root}/out/corrupt")
    _events(spark, [1], 0).write.parquet(f"{root}/out/data/run={run}/batch_id={batch}")  # what an earlier version left of it
    _events(spark, [7], 0).write.parquet(f"{root}/out/data/run=old/batch_id=0")
    assert _ids(spark, f"{root}/out") == Counter([1, 2, 7])
    assert {r.raw for r in L.read_route(spark, f"{root}/out", "corrupt").collect()} == {"{cut", '{"client_id":4}'}
    assert compaction.compact(spark, f"{root}/out") == {"data": 2, "tombstones": 1, "corrupt": 1}
    assert _ids(spark, f"{root}/out") == Counter([1, 2, 7])
    assert compaction.vacuum(spark, f"{root}/out", min_age_s=-1) == 5
    assert _ids(spark, f"{root}/out") == Counter([1, 2, 7]) and compaction.compact(spark, f"{root}/out")["data"] == 0


def test_compacted_topic_is_built_once(spark, monkeypatch):
    """The lines come from one write; a part without a line is an empty drop."""
    from tillroll.plans import io as IO
    from tillroll.plans import layouts

    writes, write = [], L.write_ndjson
    monkeypatch.setattr(L, "write_ndjson", lambda df, path, **k: writes.append(path) or write(df, path, **k))
    line = '{"purchase_id":5,"client_id":1,"product_id":1,"purchased_at":"2025-01-02T03:04:05","price":1.50,"full_price":3.00,"quantity":2}'
    monkeypatch.setattr(IO, "topic_lines", lambda s, d: s.createDataFrame([(line,)] * 3, "value string"))
    root = layouts._compacted(spark, "-")
    assert len(writes) == 1 and _ids(spark, root) == Counter({5: 3})
