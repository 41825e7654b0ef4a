"""As-of join: for each row the latest version that began at or before its time (P14: the price when it was bought).

A range join would pair a row with every version before it. Instead rows and versions of a key are laid out in one
time order, and the last version before a row is carried along:

1. rows and versions are range-partitioned by (key, time); the sample cuts a hot key into many blocks by time. The
   layout is written once.
2. Each (block, key) hands on its last version; the blocks of a key are few, and a running last over them says which
   version a block starts with. One row for each key and block.
3. Inside a block a running last over the block's own rows finishes it.

A version at the very time of a row counts. Of versions with one key and time the largest by the other columns wins.
Rows without a key, a time, or a version before them get NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import scratch_path


def asof_join(rows: DataFrame, versions: DataFrame, key: str, at: str, since: str, values: Sequence[str],
              num_partitions: int | None = None) -> DataFrame:
    """``rows`` with ``values`` of the version of ``key`` that was valid ``at`` the row's time (``since`` or later)."""
    spark = rows.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = F.struct(*[F.col(c) for c in rows.columns])
    value = F.struct(*[F.col(c) for c in values])
    kind = rows.schema[at].dataType
    left = rows.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), kept.alias("_row"), F.xxhash64(*rows.columns).alias("_tie"))
    left = left.withColumn("_version", F.lit(None).cast(versions.select(value.alias("v")).schema["v"].dataType))
    right = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).cast(rows.schema[key].dataType).alias("_key"), F.col(since).cast(kind).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.lit(0).cast("bigint").alias("_tie"), value.alias("_version"))
    timed = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    order = ["_key", "_at", "_kind", "_tie"]
    laid = left.where(timed).unionByName(right).repartitionByRange(n, *order).withColumn("_blk", F.spark_partition_id())
    path = scratch_path(spark, "asof")
    laid.write.parquet(path)
    laid = spark.read.schema(laid.schema).parquet(path)

    last = F.max_by("_version", F.when(F.col("_kind") == 0, F.struct("_at", "_version")))
    ends = laid.groupBy("_key", "_blk").agg(last.alias("_last"), F.max("_kind").alias("_has_rows"))
    earlier = Window.partitionBy("_key").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("_start", F.last("_last", ignorenulls=True).over(earlier)).where("_has_rows = 1").select("_key", "_blk", "_start")
    own = Window.partitionBy("_key", "_blk").orderBy("_at", "_kind", "_version").rowsBetween(Window.unboundedPreceding, 0)
    found = laid.withColumn("_own", F.last("_version", ignorenulls=True).over(own)).where("_kind = 1")
    found = found.join(starts, ["_key", "_blk"], "left").withColumn("_found", F.coalesce("_own", "_start"))
    untimed = left.where(~timed).withColumn("_found", F.col("_version"))
    out = found.select("_row", "_found").unionByName(untimed.select("_row", "_found"))
    return out.select("_row.*", *[F.col("_found")[c].alias(c) for c in values])
