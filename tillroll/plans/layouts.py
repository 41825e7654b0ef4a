"""Registered queries of the storage layouts and stateful jobs: compacted landing, bucketed tables, as-of prices,
checks while writing, VARIANT events, allocation on micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import envelopes
from tillroll.operators import asof, audit, dedup, star
from tillroll.plans import io as IO
from tillroll.plans import model as MODEL
from tillroll.plans.oracle import with_views
from tillroll.session import input_parts, scratch_path
from tillroll.sources import bucketed, files, landed, variants
from tillroll.sources import requests as RQ
from tillroll.sources.fixtures import Fixture
from tillroll.sources.tables import read_table
from tillroll.streaming import allocation, compaction
from tillroll.streaming import landing as L

QUERIES, SQL = {}, {}


def reg(key: str, sql: str, complete: bool = False):
    """``complete``: the SQL has its views already."""
    def deco(fn):
        QUERIES[key], SQL[key] = fn, sql if complete else with_views(sql)
        return fn
    return deco


# ---- S3 / ST3: landing area, compacted while it grows -------------------------------------------

def _compacted(spark: SparkSession, d: str) -> str:
    """The topic in three parts, written once, each landed by a run of its own when it has been moved to the topic;
    compactions after the first and the second."""
    root = scratch_path(spark, "compacted")
    parts = IO.topic_lines(spark, d).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3)))
    L.write_ndjson(parts, f"{root}/parts", by="part", most=3)
    files.ensure_namespace(spark, f"{root}/topic")
    fs, _ = files._hadoop_fs(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for i in range(3):
        files.ensure_namespace(spark, f"{root}/parts/part={i}")  # it may be that no line fell into this part
        if not fs.rename(path(f"{root}/parts/part={i}"), path(f"{root}/topic/drop-{i}")):
            raise OSError(f"part {i} was not moved to the topic")
        L.start_landing(L.purchase_stream(spark, "text", path=f"{root}/topic/*"), f"{root}/out", f"{root}/_checkpoint", available_now=True).awaitTermination()
        if i < 2:
            compaction.compact(spark, f"{root}/out", fan=2)
    return f"{root}/out"


reg("landed_compacted", "SELECT * FROM purchase_events")(lambda s, d: landed.read_landed(s, _compacted(s, d)))
reg("landed_tombstones", "SELECT purchase_id FROM purchase_deletes")(lambda s, d: landed.read_live(s, _compacted(s, d), "tombstones"))


@reg("landed_days", """
SELECT * FROM purchase_events WHERE CAST(purchased_at AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-06-30'""")
def _landed_days(s, d):
    """Everything compacted; only the files of the wanted days are read."""
    root = _compacted(s, d)
    compaction.compact(s, root)
    days = [r[0] for r in s.range(122).select(F.date_add(F.lit("1995-03-01").cast("date"), F.col("id").cast("int")).cast("string")).collect()]
    return landed.read_live(s, root, "data", days)


# ---- S9, S10, J3, D4: bucketed tables -------------------------------------------------------------

def nightly_from_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The fact from bucketed events and tombstones: removal (J9) and dedup (D4) stay inside their buckets."""
    events = bucketed.read_bucketed(spark, root, "events", schemas.PURCHASES)
    gone = bucketed.read_bucketed(spark, root, "tombstones", landed.ROUTES["tombstones"])
    purchases = dedup.dedup_purchases(events.join(gone, "purchase_id", "left_anti"))
    return star.fact_purchases(purchases, files.read_stage(spark, root, "clients", schemas.CLIENTS), files.read_stage(spark, root, "products", schemas.PRODUCTS))


def write_buckets(fx: Fixture, root: str, n_buckets: int | None = None) -> None:
    """Buckets for the size of the input, eight at least; a bucket is one task."""
    n_buckets = n_buckets or max(8, input_parts(fx.spark, fx.data_dir))
    bucketed.write_bucketed(fx.purchase_events.select(*schemas.PURCHASE_COLS), root, "events", "purchase_id", n_buckets, ["purchased_at"])
    bucketed.write_bucketed(RQ.purchase_deletes(fx.spark, fx.data_dir), root, "tombstones", "purchase_id", n_buckets)
    files.write_stage(fx.clients, root, "clients")
    files.write_stage(fx.products, root, "products")


@reg("nightly_fact_bucketed", "SELECT * FROM fact WHERE purchase_id NOT IN (SELECT purchase_id FROM purchase_deletes)")
def _nightly_bucketed(s, d):
    root = scratch_path(s, "bucketed")
    write_buckets(Fixture(s, d), root)
    return nightly_from_buckets(s, root)


# ---- P14: the price that was valid ----------------------------------------------------------------

def price_versions(spark: SparkSession, d: str) -> DataFrame:
    """One to four staged prices a product, at different times (FIXTURES.md §7)."""
    p = read_table(spark, d, "part").select("p_partkey", "p_retailprice", F.explode(F.sequence(F.lit(0), F.col("p_partkey") % 4)).alias("k"))
    days = F.col("p_partkey") * 37 % 500 + 420 * F.col("k")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("product_id"), F.date_add(F.lit("1992-06-01").cast("date"), days.cast("int")).cast("timestamp_ntz").alias("since"),
        (F.col("p_retailprice").cast("decimal(12,2)") + F.col("k")).cast("decimal(12,2)").alias("valid_price"))


@reg("price_at_purchase", """
WITH versions AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, CAST(DATE '1992-06-01' + CAST(p_partkey * 37 % 500 + 420 * k AS INTEGER) AS TIMESTAMP) AS since,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) + k AS DECIMAL(12,2)) AS valid_price
  FROM (SELECT *, unnest(range(0, CAST(p_partkey % 4 + 1 AS BIGINT))) AS k FROM part))
SELECT p.purchase_id, p.product_id, p.purchased_at, v.valid_price, v.since
FROM purchases p ASOF LEFT JOIN versions v ON p.product_id = v.product_id AND p.purchased_at >= v.since""")
def _price_at(s, d):
    bought = Fixture(s, d).purchases.select("purchase_id", "product_id", "purchased_at")
    return asof.asof_join(bought, price_versions(s, d), "product_id", "purchased_at", "since", ["valid_price", "since"])


# ---- V2 while writing, P15 as VARIANT --------------------------------------------------------------

@reg("audit_on_write", f"SELECT * FROM ({MODEL._AUDIT_SQL}) WHERE check_name IN ('not_null', 'too_long')")
def _audit_on_write(s, d):
    root = scratch_path(s, "observed")
    return audit.write_observed(MODEL.audited_tables(s, d), lambda name, t: t.write.parquet(f"{root}/{name}"))


@reg("events_variant", f"""
SELECT *, CASE WHEN kind = 'client_created' THEN 'c' || client_id END AS tag FROM ({MODEL.SQL['event_envelopes']})""", complete=True)
def _events_variant(s, d):
    """Every event kind in one table and read back; a field that no schema names is kept."""
    root = scratch_path(s, "variants")
    events = MODEL.rendered_events(s, d)
    tagged = F.regexp_replace("value", r'^\{"client_id":(\d+)', r'{"tag":"c$1","client_id":$1')
    events = events.withColumn("value", F.when(F.col("kind") == "client_created", tagged).otherwise(F.col("value")))
    back = variants.read_events(s, variants.write_events(events, root))
    times = dict.fromkeys(("purchased_at", "created_at", "signup_date"), "timestamp_ntz")
    wide = dict(x.split(" ") for x in envelopes.PAYLOAD.split(", ")) | times
    return back.select("kind", *[variants.field(n, t).alias(n) for n, t in wide.items()], variants.field("tag", "string").alias("tag"))


# ---- V3 + U4 on micro-batches ----------------------------------------------------------------------

@reg("stream_allocate", MODEL.SQL["allocate_stock"] + """
UNION ALL
SELECT purchase_id, product_id, quantity, false, NULL, 'not found' FROM purchases WHERE product_id NOT IN (SELECT product_id FROM products)""", complete=True)
def _stream_allocate(s, d):
    """Requests in three parts by time, each of many files and one micro-batch; the query is started again for each,
    on one checkpoint."""
    fx, root = Fixture(s, d), scratch_path(s, "stream-allocate")
    files.write_stage(fx.products, f"{root}/stage", "products")
    products = files.read_stage(s, f"{root}/stage", "products", schemas.PRODUCTS)
    fx.purchases.select("purchase_id", "product_id", "quantity", "purchased_at").write.parquet(f"{root}/asked")
    asked = s.read.schema(allocation.REQUESTS).parquet(f"{root}/asked")
    for lo, hi in (("1900", "1994"), ("1994", "1996"), ("1996", "2100")):
        part = asked.where(f"purchased_at >= timestamp_ntz'{lo}-01-01' and purchased_at < timestamp_ntz'{hi}-01-01'")
        part.write.mode("append").json(f"{root}/requests")
        allocation.start_answering(allocation.request_stream(s, f"{root}/requests", whole=True), products, f"{root}/answers", f"{root}/_checkpoint", available_now=True).awaitTermination()
    return s.read.schema(allocation.ANSWERS).parquet(f"{root}/answers")
