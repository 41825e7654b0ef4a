"""Purchase event stream: source (S4/ST1), parse (ST2), route (ST4), landing (S12/ST3).

Each micro-batch is parsed once and written by one job, partitioned by route: data rows, tombstones
(``{"purchase_id": N, "deleted": true}``, SURVEY Q1) and corrupt lines (not a JSON
object, or a required landing column NULL after parsing, Q2). It goes
to ``<root>/routed/run=<run>/batch_id=<n>/route=<route>`` with overwrite, so

* a replayed batch (same checkpoint) rewrites the same folder: idempotent;
* each checkpoint has a random run id of its own, kept in the checkpoint folder: a lost
  or emptied checkpoint gets a new ``run``, even under the same path, so it can never
  overwrite earlier batches — it only adds duplicates, which the fact build's dedup (D4)
  removes (Q3, ST5).

Corrupt lines keep their original text, so an event can be repaired. A continuous run
has a trigger interval, so that a batch, and with it a file, is not made for every few lines; finished batches are
compacted by day (``streaming.compaction``).

There is no watermark: the reference drops nothing for lateness, so dedup stays
in the batch fact build instead of ``dropDuplicatesWithinWatermark``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.casts import parse_events, to_ts
from tillroll.sources import files, landed

ROUTES = ("data", "tombstones", "corrupt")
REQUIRED = ["purchase_id", "client_id", "product_id", "purchased_at", "price", "full_price", "quantity"]


def purchase_stream(spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None,
                    path: str | None = None) -> DataFrame:
    """The purchase topic as a stream of text ``value``s.

    ``fmt="kafka"`` needs the Kafka connector on the classpath (not present
    here); ``fmt="text"`` reads a directory of NDJSON files (tests, replays).
    """
    defaults = {"startingOffsets": "earliest", "failOnDataLoss": "false"} if fmt == "kafka" else {}
    reader = spark.readStream.format(fmt).options(**{**defaults, **(options or {})})
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


def parse_stream(values: DataFrame) -> DataFrame:
    """ST2: JSON → fixed event columns, ``purchased_at`` parsed (stateless); ``_raw`` is the line itself."""
    ev = parse_events(values, keep="_raw")
    return ev.withColumn("purchased_at", to_ts(F.col("purchased_at")))


def route(parsed: DataFrame) -> DataFrame:
    """ST4: adds ``_route`` ∈ {data, tombstones, corrupt}."""
    tomb = F.coalesce(F.col("deleted"), F.lit(False)) & F.col("purchase_id").isNotNull()
    missing = F.lit(False)
    for c in REQUIRED:
        missing = missing | F.col(c).isNull()
    corrupt = F.col("_corrupt_record").isNotNull() | missing
    return parsed.withColumn(
        "_route", F.when(tomb, F.lit("tombstones")).when(corrupt, F.lit("corrupt")).otherwise(F.lit("data")))


RUN_FILE = "_run_id"


def run_id_for(spark: SparkSession, checkpoint: str) -> str:
    """The run id kept in the checkpoint folder; a folder without Spark's metadata gets a new one."""
    base = checkpoint.rstrip("/")
    known = files._read_text(spark, f"{base}/{RUN_FILE}") if files.exists(spark, f"{base}/metadata") else None
    if known:
        return known
    run = uuid.uuid4().hex
    files.ensure_namespace(spark, base)
    files._replace_text(spark, f"{base}/{RUN_FILE}", run)
    return run


def land_batch(root: str, run: str):
    """The ``foreachBatch`` writer (one pass, one write; every route's file is open at once, so nothing is sorted)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(len(ROUTES)))  # the stream's own session
        raw = F.when(F.col("_route") == "corrupt", F.col("_raw")).alias("raw")  # the text is kept of corrupt lines alone
        rows = route(batch).select(*[f.name for f in schemas.LANDED], raw, F.col("_route").alias("route"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route") \
            .parquet(landed.batch_path(root, run, batch_id))

    return write


def start_landing(values: DataFrame, root: str, checkpoint: str, available_now: bool = False,
                  interval: str = "1 minute"):
    """ST3: start the landing query (append, foreachBatch, checkpointed)."""
    run = run_id_for(values.sparkSession, checkpoint)
    w = parse_stream(values).writeStream.foreachBatch(land_batch(root, run)) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def read_route(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Batch view of one landed route: all finished batches of all runs, compacted or not."""
    return landed.read_live(spark, root, name)


def write_ndjson(df: DataFrame, path: str, by: str | None = None, most: int = 0) -> str:
    """Write rows as compressed NDJSON text files (test and replay input for the text source); ``by`` names a column
    of at most ``most`` values, each with a folder of its own, whose files a task writes at the same time, unsorted."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    was = conf.get(key)
    conf.set(key, str(most))
    try:
        df.write.mode("overwrite").option("compression", "lz4").partitionBy(*[by] if by else []).text(path)
    finally:
        conf.set(key, was)
    return path
