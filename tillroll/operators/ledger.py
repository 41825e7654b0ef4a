"""U4 + U5 as one ledger: purchases and cancellations interleaved, folded in parallel and exactly.

In time order per product, a purchase is accepted when the stock covers it; cancelling an accepted purchase puts its
quantity back (U5) and later requests can use it; cancelling a refused or unknown purchase, or one a second time,
changes nothing. What an event does depends on all earlier decisions, so no prefix sum expresses it.

A product's events are split over range blocks, and the blocks are folded at the same time from guessed entry states:

1. ``repartitionByRange(product, time)`` gives each event a block; the sample splits a hot product over many. Which
   cancellation counts for which purchase (its first one after it) is known without any decision, by one join.
2. A block's entry state is the stock on hand when it begins, and whether the earlier purchases that it cancels were
   accepted. Every block of a split product is folded from a guess; it returns by how much the stock changed and the
   decisions that later blocks ask for.
3. The entry states that follow from these results are compared with the guesses; blocks that were guessed wrong are
   folded again. A block is right as soon as those before it are, so this ends, and at the end every block was folded
   from the state that the block before it left: the sequential fold's result. A long run of purchases that leaves the
   stock where it was, or empties it, makes later guesses right at once.
4. One pass writes all effects. Products inside one block (all but a few) are folded in that pass alone.

Tables of blocks of split products have at most two rows a partition (a block boundary splits one product); decisions
asked for by other blocks stay distributed. A task holds one block's open purchases. A product without a stock figure
refuses every purchase. Purchases are unique by id (D4).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import scratch_path

PURCHASE, CANCEL = 0, 1
LEDGER_SCHEMA = "product_id bigint, purchase_id bigint, event string, quantity bigint, effect string, remaining bigint"
_ROUND = "product_id bigint, _blk int, _in bigint, _out bigint, purchase_id bigint, _cancel_blk int, _acc boolean"
_KEY = ["product_id", "_blk"]


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fold(full: bool):
    """Fold blocks, sorted by place; ``full`` returns every event's effect, else the block's change of the stock
    and the decisions on purchases that another block cancels."""
    names = [c.split()[0] for c in (LEDGER_SCHEMA if full else _ROUND).split(", ")]
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds = [types[c.split()[1]] for c in (LEDGER_SCHEMA if full else _ROUND).split(", ")]

    def run(batches):
        block, entry, left, open_ = None, 0, 0, {}
        columns = ("product_id", "_blk", "purchase_id", "quantity", "_kind", "_in", "_from", "_cancel_blk", "_acc")
        for b in batches:
            out: list[tuple] = []
            for product, blk, pid, qty, kind, start, origin, cancel_blk, acc in zip(*(b.column(c).to_pylist() for c in columns)):
                if (product, blk) != block:
                    if block is not None and not full:
                        out.append((*block, entry, left, None, None, None))
                    block, entry, left, open_ = (product, blk), start, start, {}
                if kind == PURCHASE:
                    effect = "accepted" if qty is not None and left is not None and qty <= left else "refused"
                    if effect == "accepted":
                        left -= qty
                    if cancel_blk == blk:
                        open_[pid] = effect == "accepted"
                    elif cancel_blk is not None and not full:
                        out.append((product, blk, None, None, pid, cancel_blk, effect == "accepted"))
                else:
                    taken = origin is not None and (open_.pop(pid) if origin == blk else acc)
                    effect = "restocked" if taken else "ignored"
                    if taken:
                        left += qty
                if full:
                    out.append((product, pid, "purchase" if kind == PURCHASE else "cancel", qty, effect, left))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
        if block is not None and not full:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*block, entry, left, None, None, None), kinds)], names=names)

    return run


def _events(requests: DataFrame, cancellations: DataFrame, products: DataFrame, ts: str, cancel_ts: str, n: int) -> DataFrame:
    """Events with their block and place; ``_from``: block of the purchase that a cancellation undoes (NULL: none);
    ``_cancel_blk``: block of the cancellation that undoes a purchase."""
    stock = products.select("product_id", F.col("quantity").cast("bigint").alias("_stock"))
    own = requests.select(F.col("purchase_id").cast("bigint").alias("purchase_id"), F.col("product_id").cast("bigint").alias("product_id"),
                          F.col("quantity").cast("bigint").alias("quantity"), F.col(ts).alias("_ts"))
    buys = own.withColumn("_kind", F.lit(PURCHASE))
    undone = cancellations.select(F.col("purchase_id").cast("bigint").alias("purchase_id"), F.col(cancel_ts).alias("_ts"))
    undone = undone.join(own.drop("_ts"), "purchase_id").withColumn("_kind", F.lit(CANCEL))
    order = ["_ts", "_kind", "purchase_id"]
    both = buys.unionByName(undone).join(stock, "product_id")
    laid = _saved(both.repartitionByRange(n, "product_id", *order).withColumn("_blk", F.spark_partition_id()), "ledger-blocks")
    place = F.struct("_blk", F.row_number().over(Window.partitionBy(*_KEY).orderBy(*order)).alias("_row"))
    laid = _saved(laid.select(*_KEY, place.alias("_pos"), "purchase_id", "quantity", "_kind", "_stock"), "ledger-laid")
    bought = laid.where(F.col("_kind") == PURCHASE).select("purchase_id", F.col("_pos").alias("_bought"))
    links = laid.where(F.col("_kind") == CANCEL).select("purchase_id", "_pos").join(bought, "purchase_id").where("_pos > _bought")
    links = links.groupBy("purchase_id").agg(F.min("_pos").alias("_undone"), F.min("_bought").alias("_bought"))
    linked = laid.join(links, "purchase_id", "left")
    counts = (F.col("_kind") == CANCEL) & (F.col("_pos") == F.col("_undone"))
    return _saved(linked.select(
        *_KEY, "_pos", "purchase_id", "quantity", "_kind", "_stock", F.when(counts, F.col("_bought._blk")).alias("_from"),
        F.when(F.col("_kind") == PURCHASE, F.col("_undone._blk")).alias("_cancel_blk")), "ledger-events")


def _folded(events: DataFrame, entries: DataFrame, decisions: DataFrame | None, full: bool) -> DataFrame:
    """Fold the blocks of ``entries`` (product_id, _blk, _in) with the decisions of other blocks."""
    rows = events.join(entries, _KEY)
    if decisions is None:  # first guess: every purchase was accepted
        rows = rows.withColumn("_acc", F.lit(True))
    else:
        known = decisions.select(F.col("purchase_id").alias("_of"), "_acc")
        rows = rows.join(known, (F.col("_of") == F.col("purchase_id")) & (F.col("_from") < F.col("_blk")), "left").drop("_of")
    rows = rows.repartition(*_KEY).sortWithinPartitions(*_KEY, "_pos")
    return rows.mapInArrow(_fold(full), LEDGER_SCHEMA if full else _ROUND)


def allocate_ledger(requests: DataFrame, cancellations: DataFrame, products: DataFrame, ts: str = "purchased_at",
                    cancel_ts: str = "cancelled_at", num_partitions: int | None = None) -> DataFrame:
    """Effect and remaining stock of every event: product_id, purchase_id, event, quantity, effect, remaining."""
    spark = requests.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = _events(requests, cancellations, products, ts, cancel_ts, n)
    wanted = F.when(F.col("_kind") == PURCHASE, -F.col("quantity")).when(F.col("_from").isNotNull(), F.col("quantity"))
    blocks = _saved(events.groupBy(*_KEY).agg(F.max("_stock").alias("_stock"), F.sum(wanted).alias("_wanted")), "ledger-keys")
    of_product = Window.partitionBy("product_id")
    split = blocks.withColumn("_n", F.count("*").over(of_product)).where("_n > 1").drop("_n")  # at most two rows a partition
    before = of_product.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)

    def entry(change: str):
        start = F.greatest(F.col("_stock") + F.coalesce(F.sum(change).over(before), F.lit(0)), F.least(F.col("_stock"), F.lit(0)))
        return F.when(F.col("_stock").isNotNull(), start)

    state = _saved(split.select(*_KEY, "_stock", entry("_wanted").alias("_in")), "ledger-state")
    todo, results, decisions = state, None, None
    inside = _saved(events.join(F.broadcast(state.select("product_id").distinct()), "product_id", "left_semi"), "ledger-split")
    while not todo.isEmpty():
        made = _saved(_folded(inside, F.broadcast(todo.select(*_KEY, "_in")), decisions, full=False), "ledger-round")
        changes, told = made.where("purchase_id is null").select(*_KEY, "_in", "_out"), made.where("purchase_id is not null")
        told = told.select(*_KEY, "purchase_id", "_cancel_blk", "_acc")
        if results is not None:
            again = F.broadcast(todo.select(*_KEY))
            changes = _saved(results.join(again, _KEY, "left_anti").unionByName(changes), "ledger-results")
            told = _saved(decisions.join(again, _KEY, "left_anti").unionByName(told), "ledger-decisions")
        then = state.drop("_in").join(changes.withColumn("_by", F.col("_out") - F.col("_in")).select(*_KEY, "_by"), _KEY)
        then = _saved(then.select(*_KEY, "_stock", entry("_by").alias("_in")), "ledger-state")
        old = told.select("purchase_id", F.lit(True).alias("_was")) if decisions is None else decisions.select("purchase_id", F.col("_acc").alias("_was"))
        turned = told.join(old, "purchase_id").where("_acc <> _was").select("product_id", F.col("_cancel_blk").alias("_blk"))
        moved = then.join(changes.select(*_KEY, F.col("_in").alias("_used")), _KEY).where(~F.col("_in").eqNullSafe(F.col("_used"))).select(*_KEY)
        results, decisions = changes, told
        todo = then.join(moved.unionByName(turned).distinct(), _KEY, "left_semi")
        state = then
    single = blocks.join(state, _KEY, "left_anti").select(*_KEY, F.col("_stock").alias("_in"))
    return _folded(events, single.unionByName(state.select(*_KEY, "_in")), decisions, full=True)
