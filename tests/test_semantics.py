"""Semantics unit tests on small hand-made inputs."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.buckets import display_name
from tillroll.operators import access as A
from tillroll.operators import dedup as D
from tillroll.operators import ledger
from tillroll.operators import marts as M
from tillroll.operators import reports as R
from tillroll.operators import rules as U
from tillroll.operators import star as S
from tillroll.operators import stock

T0 = dt.datetime(2025, 3, 1, 12, 0)


def _purchases(spark, rows):
    return spark.createDataFrame(rows, schemas.PURCHASES)


def test_dedup_latest_wins_deterministic(spark):
    """Q4: latest timestamp wins, ties broken by the other columns, regardless of partitioning."""
    rows = [(1, 1, 5, 2, Decimal("1.00"), Decimal("2.00"), T0),
            (1, 1, 6, 2, Decimal("1.00"), Decimal("2.00"), T0),            # same time, higher product wins
            (1, 1, 9, 2, Decimal("1.00"), Decimal("2.00"), T0 - dt.timedelta(days=1)),
            (2, 2, 1, 1, Decimal("3.00"), Decimal("3.00"), T0)]
    for parts in (1, 3):
        out = D.dedup_purchases(_purchases(spark, rows).repartition(parts)).orderBy("purchase_id").collect()
        assert [(r.purchase_id, r.product_id) for r in out] == [(1, 6), (2, 1)]


def test_fact_orphan_asymmetry(spark):
    """Q5: unknown client → NULL; unknown product keeps its id; its seller is NULL."""
    p = _purchases(spark, [(1, 10, 100, 1, Decimal("1.00"), Decimal("1.00"), T0),
                           (2, 99, 999, 1, Decimal("1.00"), Decimal("1.00"), T0)])
    clients = spark.createDataFrame([(10, "A", "B", "a@b.c", T0)], schemas.CLIENTS)
    products = spark.createDataFrame([(100, 7, "n", Decimal("1.00"), 5, T0)], schemas.PRODUCTS)
    out = {r.purchase_id: r for r in S.fact_purchases(p, clients, products).collect()}
    assert (out[1].client_id, out[1].product_id, out[1].seller_id) == (10, 100, 7)
    assert (out[2].client_id, out[2].product_id, out[2].seller_id) == (None, 999, None)


def test_null_group_and_name(spark):
    """Q6 + P6: the NULL client is its own mart group with a NULL name; a NULL name part gives NULL."""
    fact = spark.createDataFrame(
        [(1, None, 1, 1, 2, Decimal("1.00"), Decimal("2.00"), T0),
         (2, None, 1, 1, 3, Decimal("1.00"), Decimal("3.00"), T0),
         (3, 5, 1, 1, 1, Decimal("1.00"), Decimal("1.00"), T0)], schemas.FACT)
    clients = spark.createDataFrame([(5, "Ann", None, "a@b.c", T0)], schemas.CLIENTS)
    rows = {r.client_id: r for r in M.sales_by_client(M.MartSource.from_fact(fact), clients).collect()}
    assert rows[None].total_quantity == 5 and rows[None].client_name is None
    assert rows[5].client_name is None  # concat, not concat_ws
    assert spark.range(1).select(display_name(F.lit("A"), F.lit("B")).alias("n")).first().n == "A B"


def test_shared_source_equals_direct(spark, fx):
    """All fifteen marts: the roll-ups give the same rows as the fact itself."""
    dims = {"clients": fx.clients, "sellers": fx.sellers, "products": fx.products}
    direct = M.build_marts(M.MartSource.from_fact(fx.fact), dims)
    for checkpoint, rollups in ((True, ("day",)), (False, tuple(M.ROLLUPS))):
        shared_src = M.MartSource.shared(fx.fact, checkpoint=checkpoint, rollups=rollups)
        for r in shared_src.rollups:
            shared_src.materialise(r)
        shared = M.build_marts(shared_src, dims)
        for name in M.MARTS:
            a, b = direct[name], shared[name]
            assert a.schema == b.schema, name
            assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr), name
        shared_src.release()


def test_measure_invariants(fx):
    """Σrevenue and Σquantity agree across marts; partition count does not change results."""
    src = M.MartSource.from_fact(fx.fact.repartition(5))
    dims = {"clients": fx.clients, "sellers": fx.sellers, "products": fx.products}
    marts = M.build_marts(src, dims)
    rev = {n: marts[n].agg(F.sum("total_revenue")).first()[0] for n in marts if "total_revenue" in marts[n].columns}
    qty = {n: marts[n].agg(F.sum("total_quantity")).first()[0] for n in marts if "total_quantity" in marts[n].columns}
    assert len(set(rev.values())) == 1, rev
    assert len(set(qty.values())) == 1, qty
    orders = {n: marts[n].agg(F.sum("total_orders")).first()[0] for n in marts if "total_orders" in marts[n].columns}
    assert len(set(orders.values())) == 1


def test_topk_tie_break_by_id(spark):
    """Q10: equal revenue → ascending id; NULL id last."""
    df = spark.createDataFrame([(13, Decimal("450")), (8, Decimal("450")), (2, Decimal("120")),
                                (6, Decimal("120")), (None, Decimal("120"))], "id int, total_revenue decimal(20,2)")
    assert [r.id for r in R.top_k(df, "total_revenue", "id", 4).collect()] == [8, 13, 2, 6]


def test_latest_year_and_aov(spark):
    df = spark.createDataFrame([(2024, 1, Decimal("5.00"), 0), (2025, 2, Decimal("6.00"), 3)],
                               "sale_year int, id int, total_revenue decimal(20,2), total_orders bigint")
    assert [r.sale_year for r in R.latest_year(df).collect()] == [2025]
    aov = {r.sale_year: r.avg_order_value for r in R.with_avg_order_value(df).collect()}
    assert aov[2024] is None and aov[2025] == pytest.approx(2.0)


def test_filter_zero_is_a_key(spark):
    """Q11: None means no filter; 0 is a real key."""
    df = spark.createDataFrame([(0, 1), (1, 1), (2, 0)], "client_id int, product_id int")
    assert A.filter_optional(df, client_id=0, product_id=None).count() == 1
    assert A.filter_optional(df, client_id=None, product_id=None).count() == 3
    assert A.filter_optional(df, product_id=0).count() == 1


def test_page_and_keyset(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "k")
    assert [r.k for r in A.page(df, "k", 100, 5).collect()] == [100, 101, 102, 103, 104]
    assert [r.k for r in A.page_after(df, "k", 247, 5).collect()] == [248, 249]


def test_patch_presence(spark):
    """Explicit null sets NULL, absent keeps, unknown key is rejected."""
    clients = spark.createDataFrame([(1, "A", "B", "a@x.io", T0), (2, "C", "D", "c@x.io", T0)], schemas.CLIENTS)
    patches = spark.createDataFrame([(1, '{"email":null}'), (2, '{"first_name":"Z"}'), (3, '{"last_name":"Q"}')],
                                    "client_id int, patch string").withColumn("seq", F.lit(1))
    ok, rej = U.apply_patches(clients, patches, "client_id", ["first_name", "last_name", "email"], order="seq")
    got = {r.client_id: r for r in ok.collect()}
    assert got[1].email is None and got[1].first_name == "A"
    assert got[2].first_name == "Z" and got[2].email == "c@x.io"
    assert [r.client_id for r in rej.collect()] == [3]


def test_assign_ids_dense_in_order(spark):
    """New ids continue after the max, dense and in arrival order, across partitions."""
    existing = spark.createDataFrame([(5,), (9,)], "client_id int")
    reqs = spark.createDataFrame([(i, f"n{i}") for i in random.Random(1).sample(range(1000), 300)],
                                 "request_id int, name string").repartition(7)
    out = U.assign_ids(reqs, existing, "client_id", ["request_id"]).collect()
    by_req = sorted(out, key=lambda r: r.request_id)
    assert [r.client_id for r in by_req] == list(range(10, 310))


def test_validation_reasons(spark):
    df = spark.createDataFrame([(1, "A", "B", "a@b.co"), (2, None, "B", "bad"), (3, "x" * 101, "B", None)],
                               "request_id int, first_name string, last_name string, email string")
    got = {r.request_id: r.reason for r in U.with_reasons(df, U.client_rules()).collect()}
    assert got == {1: None, 2: "first_name missing;email invalid", 3: "first_name too long;email missing"}


def test_classify_and_restock(spark):
    clients = spark.createDataFrame([(1, "A", "B", "a@b.c", T0)], schemas.CLIENTS)
    products = spark.createDataFrame([(10, 1, "p", Decimal("2.00"), 3, T0)], schemas.PRODUCTS)
    reqs = spark.createDataFrame([(1, 1, 10, 2), (2, 7, 10, 1), (3, 1, 11, 1), (4, 1, 10, 5)],
                                 "request_id int, client_id int, product_id int, quantity int")
    got = {r.request_id: r.reason for r in U.classify_purchases(reqs, clients, products).collect()}
    assert got == {1: None, 2: U.CLIENT_NOT_FOUND, 3: U.PRODUCT_NOT_FOUND, 4: U.NOT_ENOUGH}
    gone = spark.createDataFrame([(10, 2), (10, 1)], "product_id int, quantity int")
    assert U.restock(products, gone).first().quantity == 6


def test_deletes_and_guards(spark):
    clients = spark.createDataFrame([(1, "A", "B", "a@b.c", T0), (2, "C", "D", "c@d.e", T0)], schemas.CLIENTS)
    purchases = spark.createDataFrame([(1,)], "client_id int")
    deletes = spark.createDataFrame([(1,), (2,), (3,)], "client_id int")
    assert [r.client_id for r in U.deletable_clients(deletes, clients, purchases).collect()] == [2]
    products = spark.createDataFrame([(1, 7), (2, 8)], "product_id int, seller_id int")
    assert [r.product_id for r in U.cascade_delete_products(products, spark.createDataFrame([(7,)], "seller_id int")).collect()] == [2]


def test_unique_email_first_in_batch(spark):
    clients = spark.createDataFrame([(1, "A", "B", "taken@x.io", T0)], schemas.CLIENTS)
    reqs = spark.createDataFrame([(5, "new@x.io"), (3, "new@x.io"), (4, "taken@x.io")], "request_id int, email string")
    assert [r.request_id for r in U.new_clients_unique_email(reqs, clients).collect()] == [3]


# ---- U4 stock fold -------------------------------------------------------------------------

def _python_fold(stock_by_product, requests):
    left = dict(stock_by_product)
    out = {}
    for pid, product, qty, _ts in sorted(requests, key=lambda r: (r[3], r[0])):
        ok = qty <= left[product]
        if ok:
            left[product] -= qty
        out[pid] = (ok, left[product])
    return out


def test_stock_golden(spark):
    """Stock 7, requests 5, 4, 2 → accepted, refused, accepted; 0 left."""
    products = spark.createDataFrame([(1, 1, "p", Decimal("1.00"), 7, T0)], schemas.PRODUCTS)
    reqs = spark.createDataFrame([(1, 1, 5, T0), (2, 1, 4, T0 + dt.timedelta(1)), (3, 1, 2, T0 + dt.timedelta(2))],
                                 "purchase_id int, product_id int, quantity int, purchased_at timestamp_ntz")
    got = {r.purchase_id: (r.accepted, r.remaining) for r in stock.allocate(reqs, products).collect()}
    assert got == {1: (True, 2), 2: (False, 2), 3: (True, 0)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(1, 9), st.integers(0, 30)), min_size=1, max_size=60),
       st.integers(1, 12), st.integers(0, 80))
def test_stock_matches_sequential_fold(spark, reqs, parts, hot):
    """Exact against a sequential fold, with products split over many range partitions
    (``hot`` extra requests on product 0 make it span several tasks)."""
    stock_by_product = {p: 10 + 3 * p for p in range(5)}
    products = spark.createDataFrame([(p, 1, "p", Decimal("1.00"), s, T0) for p, s in stock_by_product.items()],
                                     schemas.PRODUCTS)
    reqs = reqs + [(0, 1 + (i * 7) % 4, 31 + i) for i in range(hot)]
    rows = [(i, p, q, T0 + dt.timedelta(hours=h)) for i, (p, q, h) in enumerate(reqs)]
    df = spark.createDataFrame(rows, "purchase_id int, product_id int, quantity int, purchased_at timestamp_ntz")
    out = stock.allocate(df, products, num_partitions=parts)
    got = {r.purchase_id: (r.accepted, r.remaining) for r in out.collect()}
    assert got == _python_fold(stock_by_product, rows)


@pytest.mark.parametrize("on_hand", [500, 1_000_000])
def test_hot_product_is_split(spark, on_hand):
    """A product with most of the requests is decided by several tasks, exactly, for any stock."""
    products = spark.createDataFrame([(0, 1, "p", Decimal("1.00"), on_hand, T0), (1, 1, "q", Decimal("1.00"), 5, T0),
                                      (2, 1, "r", Decimal("1.00"), None, T0)], schemas.PRODUCTS)
    rng = random.Random(7)
    rows = [(i, 0 if i % 10 else 1, rng.randint(1, on_hand // 80), T0 + dt.timedelta(minutes=i)) for i in range(3000)]
    extra = [(5000, 2, 1, T0), (5001, 0, None, T0), (5002, 0, 0, T0)]
    df = spark.createDataFrame(rows + extra, "purchase_id bigint, product_id bigint, quantity bigint, purchased_at timestamp_ntz")
    out = stock.allocate(df, products, num_partitions=8)
    per_task = out.where("product_id = 0").groupBy(F.spark_partition_id().alias("t")).count().count()
    assert per_task >= 4
    got = {r.purchase_id: r for r in out.collect()}
    assert {i: (r.accepted, r.remaining) for i, r in got.items() if i < 5000} == _python_fold({0: on_hand, 1: 5}, rows)
    assert [(got[i].accepted, got[i].reason) for i in (5000, 5001, 5002)] == [
        (False, stock.NO_STOCK), (False, stock.BELOW_ONE), (False, stock.BELOW_ONE)]


def test_report_equals_mart_and_topk_subset(fx):
    """§5.4: every report equals its mart (mart keys are unique); top-k rows are report rows;
    shuffling the input does not change a report."""
    dims = {"clients": fx.clients, "sellers": fx.sellers, "products": fx.products}
    src = M.MartSource.from_fact(fx.fact)
    for mart_name, (_, report) in R.REPORTS.items():
        m = M.build_mart(mart_name, src, dims)
        r = report(m)
        cols = m.columns
        assert r.select(*cols).exceptAll(m).count() == 0 and m.exceptAll(r.select(*cols)).count() == 0, mart_name
    rep = R.report_sales_by_client(M.build_mart("mart_sales_by_client", src, dims))
    top = R.top_k(rep, "total_revenue", "client_id")
    assert top.count() == 10 and top.exceptAll(rep).count() == 0
    shuffled = M.MartSource.from_fact(fx.fact.orderBy(F.rand(7)).repartition(3))
    rep2 = R.report_sales_by_client(M.build_mart("mart_sales_by_client", shuffled, dims))
    assert rep2.exceptAll(rep).count() == 0 and rep.exceptAll(rep2).count() == 0
    assert [tuple(x) for x in R.top_k(rep2, "total_revenue", "client_id").collect()] == [tuple(x) for x in top.collect()]


def test_stock_ledger_with_cancellations(spark):
    """Stock 5: buy 4 (accepted, 1 left), buy 3 (refused), cancel the first (restocked, 5),
    buy 3 (accepted, 2), cancel the refused one (ignored)."""
    products = spark.createDataFrame([(1, 1, "p", Decimal("1.00"), 5, T0)], schemas.PRODUCTS)
    reqs = spark.createDataFrame([(10, 1, 4, T0), (11, 1, 3, T0 + dt.timedelta(1)), (12, 1, 3, T0 + dt.timedelta(3))],
                                 "purchase_id int, product_id int, quantity int, purchased_at timestamp_ntz")
    cancels = spark.createDataFrame([(10, T0 + dt.timedelta(2)), (11, T0 + dt.timedelta(4))],
                                    "purchase_id int, cancelled_at timestamp_ntz")
    out = ledger.allocate_ledger(reqs, cancels, products).collect()
    got = [(r.event, r.purchase_id, r.effect, r.remaining) for r in out]
    assert got == [("purchase", 10, "accepted", 1), ("purchase", 11, "refused", 1), ("cancel", 10, "restocked", 5),
                   ("purchase", 12, "accepted", 2), ("cancel", 11, "ignored", 2)]


def _ledger_fold(stock_of, events):
    """Sequential fold of (product, purchase, kind, quantity) in order: {(kind, purchase): [(effect, remaining)]}."""
    left, open_, out = dict(stock_of), {}, {}
    for product, pid, kind, qty in events:
        r = left[product]
        if kind == 0:
            effect = "accepted" if r is not None and qty is not None and qty <= r else "refused"
            if effect == "accepted":
                r -= qty
                open_[pid] = qty
        else:
            effect = "restocked" if pid in open_ else "ignored"
            r = r + open_.pop(pid) if effect == "restocked" else r
        left[product] = r
        out.setdefault((kind, pid), []).append((effect, r))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stock_ledger_splits_a_hot_product(spark, seed):
    """One product with most events, over several blocks, cancellations across blocks, twice, and before their
    purchase: equal to the sequential fold; products without stock refuse everything."""
    rng = random.Random(seed)
    events, buys = [], []
    for i in range(1500):
        product = 0 if rng.random() < 0.8 else rng.randrange(1, 6)
        t = T0 + dt.timedelta(minutes=i)
        if buys and rng.random() < 0.45:
            p, pid, qty = rng.choice(buys[-60:] if rng.random() < 0.5 else buys)
            events.append((t, 1, p, pid, qty))
        else:
            buys.append((product, i, rng.choice([1, 2, 3, 7, 20])))
            events.append((t, 0, product, i, buys[-1][2]))
            if rng.random() < 0.02:
                events.append((t - dt.timedelta(days=1), 1, product, i, buys[-1][2]))
    on_hand = {0: 60, 1: 5, 2: 0, 3: 1000, 4: 12, 5: None}
    products = spark.createDataFrame([(k, 1, "p", Decimal("1.00"), v, T0) for k, v in on_hand.items()], schemas.PRODUCTS)
    reqs = spark.createDataFrame([(pid, p, q, t) for t, kind, p, pid, q in events if kind == 0],
                                 "purchase_id bigint, product_id bigint, quantity bigint, purchased_at timestamp_ntz")
    cancels = spark.createDataFrame([(pid, t) for t, kind, _, pid, _ in events if kind == 1],
                                    "purchase_id bigint, cancelled_at timestamp_ntz")
    out = ledger.allocate_ledger(reqs, cancels, products, num_partitions=8)
    want = _ledger_fold(on_hand, [(p, pid, kind, q) for t, kind, p, pid, q in sorted(events)])
    got = {}
    for r in out.collect():
        got.setdefault((int(r.event == "cancel"), r.purchase_id), []).append((r.effect, r.remaining))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    laid = ledger._events(reqs, cancels, products, "purchased_at", "cancelled_at", 8)
    assert laid.where("product_id = 0").select("_blk").distinct().count() >= 4


def test_patches_apply_in_order_and_bad_ones_are_rejected(spark):
    """Several patches per key merge field by field, the latest value wins; bad patches change nothing."""
    clients = spark.createDataFrame([(1, "A", "B", "a@x.io", T0), (2, "C", "D", "c@x.io", T0)], schemas.CLIENTS)
    patches = [(1, '{"first_name":"Old"}', 1), (1, '{"first_name":"New"}', 2), (1, '{"last_name":"Z"}', 3), (1, "oops", 4),
               (1, '{"first_name":null}', 5), (1, '{"email":"c@x.io"}', 6), (2, '{"email":"nobody"}', 7), (9, '{}', 8),
               (2, '{"email":"new@x.io"}', 9), (1, '{"email":"new@x.io"}', 10), (2, '["list"]', 11)]
    df = spark.createDataFrame(patches, "client_id bigint, patch string, seq int")
    ok, rej = U.apply_patches(clients, df, "client_id", ["first_name", "last_name", "email"], order="seq")
    got = {r.client_id: (r.first_name, r.last_name, r.email) for r in ok.collect()}
    assert got == {1: ("New", "Z", "a@x.io"), 2: ("C", "D", "new@x.io")}
    assert {r.seq: r.reason for r in rej.collect()} == {
        4: U.PATCH_NOT_OBJECT, 5: "first_name missing", 6: U.EMAIL_TAKEN, 7: "email invalid", 8: U.NOT_FOUND,
        10: U.EMAIL_TAKEN, 11: U.PATCH_NOT_OBJECT}
    products = spark.createDataFrame([(1, 1, "p", Decimal("1.00"), 5, T0)], schemas.PRODUCTS)
    df = spark.createDataFrame([(1, '{"quantity":"-5"}', 1), (1, '{"quantity":"abc"}', 2), (1, '{"price":"0"}', 3),
                                (1, '{"quantity":null}', 4), (1, '{"quantity":7}', 5)], "product_id bigint, patch string, seq int")
    ok, rej = U.apply_patches(products, df, "product_id", ["name", "price", "quantity"], order="seq")
    assert ok.first().quantity == 7
    assert {r.seq: r.reason for r in rej.collect()} == {1: "quantity below 1", 2: "quantity invalid", 3: "price must be positive",
                                                        4: "quantity missing"}


def test_guarded_deletes_and_null_emails(spark):
    products = spark.createDataFrame([(1, 7, "p", Decimal("1.00"), 5, T0), (2, 8, "q", Decimal("1.00"), 5, T0)], schemas.PRODUCTS)
    sellers = spark.createDataFrame([(s, "F", "L", "C", f"{s}@x.io", T0) for s in (7, 8, 9)], schemas.SELLERS)
    bought = _purchases(spark, [(10, 1, 1, 2, Decimal("1.00"), Decimal("2.00"), T0), (11, 1, 1, 1, Decimal("1.00"), Decimal("1.00"), T0)])
    asked = spark.createDataFrame([(1,), (2,), (3,)], "product_id bigint")
    ok = U.deletable_products(asked, products, bought)
    assert [r.product_id for r in ok.collect()] == [2]
    refused = U.refused_deletes(asked, ok, products, "product_id", U.PRODUCT_HAS_PURCHASES)
    assert {r.product_id: r.reason for r in refused.collect()} == {1: U.PRODUCT_HAS_PURCHASES, 3: U.NOT_FOUND}
    asked = spark.createDataFrame([(7,), (8,), (9,)], "seller_id bigint")
    assert sorted(r.seller_id for r in U.deletable_sellers(asked, sellers, products, bought).collect()) == [8, 9]
    left, restocked = U.delete_purchases(bought, products, spark.createDataFrame([(10,)], "purchase_id bigint"))
    assert [r.purchase_id for r in left.collect()] == [11]
    assert {r.product_id: r.quantity for r in restocked.collect()} == {1: 7, 2: 5}
    reqs = spark.createDataFrame([(1, None), (2, None), (3, "n@x.io"), (4, "n@x.io")], "request_id bigint, email string")
    clients = spark.createDataFrame([(1, "A", "B", "a@x.io", T0)], schemas.CLIENTS)
    assert sorted(r.request_id for r in U.new_clients_unique_email(reqs, clients).collect()) == [1, 2, 3]


def test_ids_beyond_32_bits(spark):
    """An event with a large id is conformed, deduplicated and resolved like any other."""
    big = 3_000_000_000
    rows = spark.createDataFrame([(str(big + i % 2), str(big), "5", "1", "2.00", "2.00", "2025-03-01T12:00:00") for i in range(4)],
                                 "purchase_id string, client_id string, product_id string, quantity string, price string, "
                                 "full_price string, purchased_at string")
    from tillroll.functions.casts import conform_purchases
    out = D.dedup_purchases(conform_purchases(rows))
    assert sorted(r.purchase_id for r in out.collect()) == [big, big + 1]
    clients = spark.createDataFrame([(big, "A", "B", "a@x.io", T0)], schemas.CLIENTS)
    products = spark.createDataFrame([(5, 1, "p", Decimal("2.00"), 5, T0)], schemas.PRODUCTS)
    assert {r.client_id for r in S.fact_purchases(out, clients, products).collect()} == {big}


def test_product_validation(spark):
    df = spark.createDataFrame([(1, 7, "ok", Decimal("1.00"), 1), (2, None, "n", Decimal("0.00"), 0),
                                (3, 7, "x" * 201, None, 5)],
                               "request_id int, seller_id int, name string, price decimal(12,2), quantity int")
    got = {r.request_id: r.reason for r in U.with_reasons(df, U.product_rules()).collect()}
    assert got == {1: None, 2: "seller_id missing;price must be positive;quantity below 1",
                   3: "name too long;price missing"}


def test_product_months_are_summed_in_parts_of_one_length(spark, fx):
    """M12 and its report: as many parts as asked for, one exchange for both sums, no join; the fact's result."""
    from tillroll.operators import marts as M
    from tillroll.plans import analytics as A

    rows = spark.range(2000).selectExpr(
        "id AS purchase_id", "id % 5 AS client_id", "nullif(id % 7, 0) AS product_id", "CAST(NULL AS BIGINT) AS seller_id", "id % 3 AS quantity",
        "CAST(1 AS DECIMAL(10,2)) AS price", "CAST(2 AS DECIMAL(10,2)) AS full_price",
        "CASE WHEN id % 11 > 0 THEN timestamp_ntz'2024-01-31' + make_dt_interval(CAST(id % 60 AS INT)) END AS purchased_at")
    in_parts = M.product_quantity_sold_by_month(M.MartSource.from_fact(rows, parts=13))
    assert in_parts.rdd.getNumPartitions() == 13
    whole = M.product_quantity_sold_by_month(M.MartSource.from_fact(rows))
    assert sorted(map(str, in_parts.collect())) == sorted(map(str, whole.collect()))
    report = A.QUERIES["report_product_month"](spark, fx.data_dir)
    plan = report._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "customer" not in plan and "supplier" not in plan
    want = A.R.report_product_month(M.product_quantity_sold_by_month(M.MartSource.from_fact(fx.fact)))
    assert sorted(map(str, report.collect())) == sorted(map(str, want.collect()))
