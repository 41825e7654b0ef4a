"""Registered source / sink / stream queries (S2–S12, ST1–ST5).

Each is a round trip through files in the shared folder (``spark.checkpoint.dir``):
fixture view → written by the operator → read back by the operator, so the
oracle is the fixture view's SQL. Streams run with ``availableNow`` and are
read back as batch DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import casts as C
from tillroll.operators import dedup as D
from tillroll.operators import marts as M
from tillroll.operators import rules as U
from tillroll.plans import jobs
from tillroll.plans.oracle import with_views
from tillroll.session import scratch_path
from tillroll.sources import csv_drops, files, landed
from tillroll.sources.fixtures import Fixture
from tillroll.sources.tables import read_table
from tillroll.streaming import landing as L

QUERIES = {}
SQL = {}

# Fixed value: the load time recorded in the CSV ledger by the registered round trip.
LOADED_AT = "2025-01-01 00:00:00"


def reg(key, sql):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = with_views(sql)
        return fn
    return deco


def fx(spark, d) -> Fixture:
    return Fixture(spark, d)


# ---- S2 S7 S8 stage snapshots ----------------------------------------------------------

@reg("sink_stage", "SELECT * FROM clients")
def _sink_stage(s, d):
    root = scratch_path(s, "stage")
    files.write_stage(fx(s, d).clients_raw, root, "clients")      # first version
    files.write_stage(fx(s, d).clients, root, "clients")          # replaced atomically
    return files.read_stage(s, root, "clients")


@reg("src_stage", "SELECT * FROM products")
def _src_stage(s, d):
    root = scratch_path(s, "stage")
    files.write_stage(fx(s, d).products, root, "products")
    return files.read_stage(s, root, "products")


# ---- S6 NDJSON ---------------------------------------------------------------------------

@reg("src_json", "SELECT * FROM purchases")
def _src_json(s, d):
    path = scratch_path(s, "json")
    L.write_ndjson(C.event_json(fx(s, d).purchases), path)
    ev = files.read_purchase_json(s, path)
    return C.conform_purchases(ev.select(*schemas.PURCHASE_COLS))


# ---- S5 CSV drops ------------------------------------------------------------------------

def _rename_one(spark: SparkSession, folder: str, to: str) -> None:
    """Give one CSV part file of ``folder`` a plain name (a drop as a person would name it)."""
    fs, p = files._hadoop_fs(spark, folder)
    part = sorted(x.getPath().toString() for x in fs.listStatus(p) if x.getPath().getName().endswith(".csv"))[0]
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(part), spark._jvm.org.apache.hadoop.fs.Path(to))


@reg("csv_load", """
SELECT CAST((SELECT max(product_id) FROM products)
            + row_number() OVER (ORDER BY seller_id, name, price, quantity, created_at) AS BIGINT) AS product_id,
       seller_id, name, price, quantity, created_at
FROM products""")
def _csv_load(s, d):
    """S5 + U2: drops (one named with a space, one with a bad row) → loaded rows → products with generated ids."""
    root = scratch_path(s, "drops")
    f = fx(s, d)
    p = f.products.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    csv_drops.write_drops(p, f"{root}/in")
    _rename_one(s, f"{root}/in", f"{root}/in/spring offers 100+.CSV")
    csv_drops.write_drops(p.withColumn("price", F.lit("free")), f"{root}/bad", n_files=1)
    _rename_one(s, f"{root}/bad", f"{root}/in/bad rows.csv")
    out = f"{root}/loaded"
    rejected = csv_drops.load_and_record(s, f"{root}/in", f"{root}/ledger", out, LOADED_AT)
    if [r.filename for r in rejected.collect()] != ["bad rows.csv"]:
        raise ValueError("the file with bad rows must be rejected, and no other")
    # a second run finds every good file in the ledger and loads nothing more
    csv_drops.load_and_record(s, f"{root}/in", f"{root}/ledger", out, LOADED_AT)
    loaded = s.read.parquet(out).drop("filename")
    return U.assign_ids(loaded, f.products, "product_id", ["seller_id", "name", "price", "quantity", "created_at"]).select(
        *schemas.PRODUCT_COLS)


# ---- S9 S10 S11 sinks ------------------------------------------------------------------------

@reg("sink_dim", "SELECT * FROM clients")
def _sink_dim(s, d):
    """Two publishes under one name: the second replaces the first for readers."""
    root = scratch_path(s, "dims")
    jobs.publish({"dim_clients": fx(s, d).clients_raw, "dim_sellers": fx(s, d).sellers_raw}, root)
    jobs.publish({"dim_clients": fx(s, d).clients, "dim_sellers": fx(s, d).sellers}, root)
    return s.read.schema(schemas.CLIENTS).parquet(files.current_version(s, root, "dim_clients"))


@reg("sink_fact", "SELECT * FROM fact")
def _sink_fact(s, d):
    """The fact published over an earlier, smaller version."""
    root = scratch_path(s, "fact")
    fact = fx(s, d).fact
    jobs.publish({"fact_purchases": fact.where("seller_id is null")}, root)
    jobs.publish({"fact_purchases": fact.sortWithinPartitions("purchased_at", "purchase_id")}, root)
    return s.read.schema(schemas.FACT).parquet(files.current_version(s, root, "fact_purchases"))


@reg("sink_mart", "SELECT * FROM mart_seller_revenue_by_month")
def _sink_mart(s, d):
    root = scratch_path(s, "mart")
    m = M.seller_revenue_by_month(M.MartSource.from_fact(fx(s, d).fact))
    files.write_mart(m, root, "mart_seller_revenue_by_month", M.MARTS["mart_seller_revenue_by_month"][2])
    return files.read_mart(s, root, "mart_seller_revenue_by_month")


# ---- streams ----------------------------------------------------------------------------------

def topic_lines(spark: SparkSession, d: str) -> DataFrame:
    """The purchase topic as text lines, derived from the driver tables (FIXTURES.md §6):
    one event per line item, a tombstone per returned item, and two corrupt lines (cut
    off; incomplete) per order in status P."""
    f = fx(spark, d)
    events = C.event_json(f.purchase_events)
    tomb = (read_table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
            .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("purchase_id"))
            .distinct()
            .select(F.to_json(F.struct("purchase_id", F.lit(True).alias("deleted"))).alias("value")))
    order = read_table(spark, d, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").cast("string").alias("k"))
    # a cut-off line, and an object with a bad time and a field of its own
    junk = order.select(F.explode(F.array(
        F.concat(F.lit('{"purchase_id":'), "k", F.lit(',"client')),
        F.concat(F.lit('{"purchase_id":'), "k", F.lit(',"purchased_at":"yesterday","x":1}')))).alias("value"))
    return events.unionByName(tomb).unionByName(junk)


def _landed(spark: SparkSession, d: str, runs: int = 1, lost_checkpoint: bool = False) -> str:
    root = scratch_path(spark, "landing")
    src = L.write_ndjson(topic_lines(spark, d), f"{root}/topic")
    ckpt = f"{root}/_checkpoint"

    def land():
        L.start_landing(L.purchase_stream(spark, "text", path=src), f"{root}/out", ckpt, available_now=True).awaitTermination()

    for _ in range(runs):
        land()
    if lost_checkpoint:  # the same path, without what was in it
        fs, p = files._hadoop_fs(spark, ckpt)
        fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(ckpt + "_lost"))
        land()
    return f"{root}/out"


@reg("stream_source", "SELECT * FROM purchase_events")
def _stream_source(s, d):
    """ST1/S4: the text source feeding a file sink; read back and parsed in batch."""
    root = scratch_path(s, "source")
    src = L.write_ndjson(C.event_json(fx(s, d).purchase_events), f"{root}/topic")
    q = (L.purchase_stream(s, "text", path=src).writeStream.format("parquet")
         .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start(f"{root}/raw"))
    q.awaitTermination()
    parsed = C.parse_events(s.read.parquet(f"{root}/raw"))
    return C.conform_purchases(parsed.select(*schemas.PURCHASE_COLS))


@reg("stream_parse", "SELECT * FROM purchase_events")
def _stream_parse(s, d):
    """ST2: parse + timestamp inside the stream, file sink, read back."""
    root = scratch_path(s, "parse")
    src = L.write_ndjson(C.event_json(fx(s, d).purchase_events), f"{root}/topic")
    parsed = L.parse_stream(L.purchase_stream(s, "text", path=src)).select(*schemas.PURCHASE_COLS)
    q = (parsed.writeStream.format("parquet").option("checkpointLocation", f"{root}/_ck")
         .trigger(availableNow=True).start(f"{root}/parsed"))
    q.awaitTermination()
    return s.read.schema(schemas.PURCHASES).parquet(f"{root}/parsed")


@reg("stream_land", "SELECT * FROM purchase_events")
def _stream_land(s, d):
    """ST3/S12: data route of the landing."""
    return L.read_route(s, _landed(s, d), "data")


@reg("src_landed", "SELECT * FROM purchase_events")
def _src_landed(s, d):
    """S3: the landed events through the batch reader."""
    return landed.read_landed(s, _landed(s, d)).select(*[f.name for f in schemas.LANDED])


@reg("stream_route", """
SELECT 'tombstone' AS route, purchase_id, CAST(NULL AS VARCHAR) AS raw FROM purchase_deletes
UNION ALL
SELECT 'corrupt', NULL, '{"purchase_id":' || o_orderkey || ',"client' FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT 'corrupt', NULL, '{"purchase_id":' || o_orderkey || ',"purchased_at":"yesterday","x":1}' FROM orders WHERE o_orderstatus = 'P'""")
def _stream_route(s, d):
    """ST4: tombstones and corrupt lines (their whole text) routed away from the data."""
    out = _landed(s, d)
    t = L.read_route(s, out, "tombstones").select(F.lit("tombstone").alias("route"), "purchase_id", F.lit(None).cast("string").alias("raw"))
    c = L.read_route(s, out, "corrupt").select(F.lit("corrupt").alias("route"), F.lit(None).cast("bigint").alias("purchase_id"), "raw")
    return t.unionByName(c)


@reg("stream_replay", """
SELECT * FROM purchases p WHERE NOT EXISTS (SELECT 1 FROM purchase_deletes x WHERE x.purchase_id = p.purchase_id)""")
def _stream_replay(s, d):
    """ST5 + J9: two runs on one checkpoint (the second adds nothing) and a run after the
    checkpoint was lost (everything again, under the same path); dedup and tombstones give the batch result."""
    out = _landed(s, d, runs=2, lost_checkpoint=True)
    data = D.dedup_purchases(L.read_route(s, out, "data"))
    tombs = L.read_route(s, out, "tombstones")
    return data.join(tombs, "purchase_id", "left_anti")


@reg("nightly_fact", """
SELECT * FROM fact f WHERE NOT EXISTS (SELECT 1 FROM purchase_deletes x WHERE x.purchase_id = f.purchase_id)""")
def _nightly_fact(s, d):
    """The nightly job end to end: stage snapshots (S7) and the landed stream (S12) →
    dims and fact (D1–D4, P3, J9, J3) written and read back."""
    f = fx(s, d)
    root = scratch_path(s, "nightly")
    jobs.stage_snapshots({"clients": f.clients_raw, "sellers": f.sellers, "products": f.products,
                          "purchases": f.purchases}, f"{root}/stage")
    src = L.write_ndjson(topic_lines(s, d), f"{root}/topic")
    L.start_landing(L.purchase_stream(s, "text", path=src), f"{root}/landing", f"{root}/_ck",
                    available_now=True).awaitTermination()
    paths = jobs.snowflake_from_stage(s, f"{root}/stage", f"{root}/landing", f"{root}/out")
    return s.read.schema(schemas.FACT).parquet(paths["fact_purchases"])
