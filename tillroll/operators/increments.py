"""Changes instead of rewrites: snapshot differences, signed fact rows, mergeable roll-ups and distinct sets.

* ``snapshot_diff`` compares two versions of a keyed table by 128-bit row fingerprints (narrow full outer join); only
  rows that changed are read whole. ``apply_diff`` turns the old version into the new one.
* ``changed_rows`` and ``signed_changes`` say what a batch of events, tombstones and changed dimensions does to the
  fact: rows that go with sign -1, rows that come with +1; rows that stay cancel out before the log is written.
* Additive measures of signed rows are summed into roll-ups (``merge_rollup``). Every measure keeps how many values
  made it, so a sum without values is NULL again and a group without rows disappears.
* Distinct ids of a day are bitmaps over buckets of 32,768 ids (``day_bitmaps``); they merge by OR into any longer
  period, exactly. A set cannot lose an id by OR, so days that lost rows are built again from the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.buckets import sale_date
from tillroll.operators import dedup as D
from tillroll.operators import star as S
from tillroll.schemas import FACT_COLS, PURCHASE_COLS
from tillroll.session import scratch_folder

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def fingerprint(cols: Sequence[str]) -> Column:
    """128 bits of a row; NULL and the columns' order count (``xxhash64`` skips NULLs, so they are hashed as flags)."""
    nulls = [F.col(c).isNull() for c in cols]
    return F.struct(F.xxhash64(F.lit(0), *cols, *nulls).alias("a"), F.xxhash64(F.lit(1), *nulls, *cols).alias("b"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of two versions (one row per key) that differ: ``change`` (insert, update, delete), the key, and
    the new values (NULL for a delete). NULL is a key like any other."""
    cols = [c for c in new.columns if c != key]
    was = old.select(F.col(key).alias("_old_key"), fingerprint(cols).alias("_was"))
    now = new.select(F.col(key).alias("_new_key"), fingerprint(cols).alias("_now"))
    both = was.join(now, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full")
    change = F.when(F.col("_was").isNull(), INSERT).when(F.col("_now").isNull(), DELETE).when(F.col("_was") != F.col("_now"), UPDATE)
    changed = both.withColumn("change", change).where(F.col("change").isNotNull())
    changed = changed.select("change", F.when(F.col("_now").isNull(), F.col("_old_key")).otherwise(F.col("_new_key")).alias("_key"))
    rows = changed.join(new, (F.col("_key").eqNullSafe(F.col(key))) & (F.col("change") != DELETE), "left")
    return rows.select("change", F.col("_key").alias(key), *cols)


def apply_diff(old: DataFrame, diff: DataFrame, key: str) -> DataFrame:
    """The new version: ``old`` without the changed keys, and the inserted and updated rows."""
    gone = diff.select(F.col(key).alias("_key"))
    kept = old.join(gone, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return kept.unionByName(diff.where(F.col("change") != DELETE).select(*old.columns))


# ---- signed fact rows ---------------------------------------------------------------------

#: A live purchase as the log keeps it: the fact row and the client id as sent.
LOG_COLS = [*FACT_COLS, "_client"]


def live_rows(log: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Rows of a log of signed rows that have come and not gone; ``more``: columns that follow from the row."""
    return log.groupBy(*LOG_COLS, *more).agg(F.sum("_sign").alias("_n")).where("_n > 0").drop("_n")


def _kept(rows: DataFrame, path: str) -> DataFrame:
    """The rows, written and read again: the shuffles behind them are over."""
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _moved_keys(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keys of a dimension whose row appeared, vanished, or changed in ``cols``."""
    return snapshot_diff(old.select(key, *cols), new.select(key, *cols), key).select(key).where(F.col(key).isNotNull())


def changed_rows(log: DataFrame, events: DataFrame, tombstones: DataFrame, new_tombstones: DataFrame,
                 old_dims: dict[str, DataFrame], new_dims: dict[str, DataFrame], scratch: str) -> tuple[DataFrame, DataFrame]:
    """(LOG_COLS) twice, as tables under ``scratch``: the fact rows that a batch concerns as they are, and as they have to be.

    ``log``: signed rows so far; ``events``: conformed purchases (P3) of the batch, duplicates and late ones
    included; ``tombstones``: all of them, the new ones among them. D4 is the maximum of an order, so the latest of
    (live row, new events) is the latest of all events. Purchases of a client that appeared or vanished, or of a
    product whose seller changed, are resolved again. The purchases concerned are found by their ids alone; whole
    log rows are dealt once, by purchase, and only those concerned are grouped. Each step is written, so that the
    disk holds the shuffle of one step at a time.
    """
    spark = log.sparkSession
    ids = events.select("purchase_id").unionByName(new_tombstones.select("purchase_id"))
    clients = _moved_keys(old_dims["clients"], new_dims["clients"], "client_id", [])
    products = _moved_keys(old_dims["products"], new_dims["products"], "product_id", ["seller_id"])
    of_client = log.join(clients.select(F.col("client_id").alias("_client")), "_client", "left_semi").select("purchase_id")
    of_product = log.join(products, "product_id", "left_semi").select("purchase_id")
    # NULL is an id like any other; as two columns that are never NULL it is joined and grouped without another exchange
    key = {"_id": F.coalesce("purchase_id", F.lit(0)), "_no_id": F.col("purchase_id").isNull()}
    concerned = ids.withColumn("_t", F.lit(True)).unionByName(of_client.unionByName(of_product).withColumn("_t", F.lit(False)))
    concerned = concerned.withColumns(key).groupBy(*key).agg(F.max("_t").alias("_t"))
    with scratch_folder(spark, "mart-concerned") as path:
        noted = log.withColumns(key).join(_kept(concerned, path), [*key])
        before = _kept(live_rows(noted, [*key, "_t"]).drop(*key), f"{scratch}/before")  # read four times
    touched, again = before.where("_t").drop("_t"), before.where("not _t").drop("_t")
    as_sent = lambda rows: rows.select(*[F.col("_client").alias(c) if c == "client_id" else F.col(c) for c in PURCHASE_COLS])
    late = D.dedup_purchases(as_sent(touched).unionByName(events.select(*PURCHASE_COLS)))
    after = late.join(tombstones, "purchase_id", "left_anti").unionByName(as_sent(again))
    # the fact rows (J1–J3), with the client id as sent
    with scratch_folder(spark, "mart-sent") as sent, scratch_folder(spark, "mart-known") as known:
        after = S.resolve_client(_kept(after.withColumn("_client", F.col("client_id")), sent), new_dims["clients"])
        after = _kept(S.resolve_seller(_kept(after, known), new_dims["products"]).select(*LOG_COLS), f"{scratch}/after")
    return before.drop("_t"), after


def signed_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(LOG_COLS, ``_sign``): what goes from and what comes to the fact, for ``changed_rows``."""
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    return signed.groupBy(*LOG_COLS).agg(F.sum("_sign").cast("int").alias("_sign")).where("_sign <> 0")


# ---- roll-ups -----------------------------------------------------------------------------

#: Measures of a roll-up (see ``operators.marts``), the values behind each sum, and the rows of the group.
MEASURES = {"_qty": "bigint", "_rev": "decimal(20,2)", "_orders": "bigint", "_n_qty": "bigint", "_n_rev": "bigint", "_rows": "bigint"}


def signed_measures(signed: DataFrame, keys: Sequence[str], monthly: bool) -> DataFrame:
    """(sale_date, keys, MEASURES) of each signed fact row, for ``merge_rollup`` to sum."""
    day = F.trunc(sale_date("purchased_at"), "month") if monthly else sale_date("purchased_at")
    sign, known = F.col("_sign").cast("bigint"), lambda c: F.col(c).isNotNull().cast("bigint")
    of_row = {
        "_qty": sign * F.coalesce("quantity", F.lit(0)),
        "_rev": sign * F.coalesce(F.col("full_price"), F.lit(0).cast("decimal(10,2)")),
        "_orders": sign * known("purchase_id"), "_n_qty": sign * known("quantity"), "_n_rev": sign * known("full_price"), "_rows": sign,
    }
    return signed.select(day.alias("sale_date"), *keys, *[of_row[m].cast(t).alias(m) for m, t in MEASURES.items()])


def signed_rollup(signed: DataFrame, keys: Sequence[str], monthly: bool) -> DataFrame:
    """(sale_date, keys, MEASURES) of signed fact rows."""
    sums = [F.sum(m).cast(t).alias(m) for m, t in MEASURES.items()]
    return signed_measures(signed, keys, monthly).groupBy("sale_date", *keys).agg(*sums)


def merge_rollup(state: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The roll-up after the changes; groups without rows are gone."""
    both = state.unionByName(delta)
    sums = [F.sum(m).cast(t).alias(m) for m, t in MEASURES.items()]
    return both.groupBy("sale_date", *keys).agg(*sums).where("_rows <> 0")


def as_measures(state: DataFrame) -> DataFrame:
    """A roll-up as ``operators.marts`` reads it: a sum without values is NULL."""
    shown = {"_qty": F.when(F.col("_n_qty") > 0, F.col("_qty")), "_rev": F.when(F.col("_n_rev") > 0, F.col("_rev"))}
    return state.withColumns(shown).drop("_n_qty", "_n_rev", "_rows")


# ---- exact mergeable distinct sets (M08, M09) ---------------------------------------------

def day_bitmaps(rows: DataFrame, id_col: str) -> DataFrame:
    """(sale_date, bucket, ids): the ids of a day as bitmaps; any 64-bit id has one place. The pairs (day, id) are
    dealt to their bitmap before it is made: a bitmap has 4 KB even for one id, and half-made ones in every map task
    would be many times the rows. Rows with a ``_sign``, a whole log's: a pair is there if more of its rows have come
    than gone, so the log's rows need not be grouped first."""
    sign = F.col("_sign") if "_sign" in rows.columns else F.lit(1)
    ids = rows.where(F.col(id_col).isNotNull()).select(sale_date("purchased_at").alias("sale_date"), F.col(id_col).alias("_id"), sign.alias("_sign"))
    live = ids.groupBy("sale_date", "_id").agg(F.sum("_sign").alias("_n")).where("_n > 0")
    pairs = live.select("sale_date", F.bitmap_bucket_number("_id").alias("bucket"), F.bitmap_bit_position("_id").alias("_bit"))
    return pairs.repartition("sale_date", "bucket").groupBy("sale_date", "bucket").agg(F.bitmap_construct_agg("_bit").alias("ids"))


def merge_bitmaps(bitmaps: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """One bitmap for each day and bucket. ``dealt_by``: columns that follow from the day, by which (and the bucket)
    the rows are dealt already; they move no more then."""
    merged = bitmaps.groupBy(*dealt_by, "sale_date", "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.drop(*dealt_by)


def distinct_ids(bitmaps: DataFrame, period: Column, name: str) -> DataFrame:
    """(period, ``name``): distinct ids over any period of whole days, from the days' bitmaps."""
    merged = bitmaps.groupBy(period, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    first = merged.columns[0]
    return merged.groupBy(first).agg(F.sum(F.bitmap_count("ids")).cast("bigint").alias(name))
