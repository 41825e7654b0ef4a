"""U4 stock allocation: in arrival order per product, a request is accepted when
the remaining stock covers it, and then the stock goes down; a refused request
consumes nothing.

A running sum cannot express this (a refused request must not count): it is an ordered fold. It runs in one pass for
all products that lie inside one range block, and in parallel over the blocks of a hot one, as the ledger with
cancellations does (``operators.ledger``), which is this fold with more state:

1. ``repartitionByRange(product, arrival)`` gives each request a block; the sample splits a hot product over many
   blocks. The blocks are written to the shared folder.
2. The blocks of a split product (at most two rows a partition, since a boundary splits one product) are folded
   from guessed entry stocks; they return how much they took. Blocks whose entry stock turns out to be another one
   are folded again, until none is: block by block at worst, and in two or three rounds as a rule, because a block
   takes its units whether a few more or less are left, or finds none.
3. One pass folds every block from its entry stock and returns all requests.

A fold streams over sorted rows and keeps one number; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import scratch_path

# Reasons of refused requests (NOT_ENOUGH is the reference's message).
NOT_ENOUGH = "Not enough quantity available"
NO_STOCK = "Stock unknown"
BELOW_ONE = "quantity below 1"

_BLOCK = ["product_id", "_blk"]


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _answer(batches):
    """Every request with its answer; rows sorted by block (its entry stock first) and arrival."""
    names = ["purchase_id", "product_id", "quantity", "accepted", "remaining", "reason"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
    left = None
    for b in batches:
        out = []
        for product, pid, qty, head, start in zip(*(b.column(c).to_pylist() for c in ("product_id", "purchase_id", "quantity", "_head", "_in"))):
            if head:
                left = start
                continue
            reason = NO_STOCK if left is None else BELOW_ONE if (qty or 0) < 1 else NOT_ENOUGH if qty > left else None
            if reason is None:
                left -= qty
            out.append((pid, product, qty, reason is None, left, reason))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)


def _take(batches):
    """(product_id, _blk, _in, _out): each block's entry stock and what is left at its end."""
    block, start, left = None, 0, 0

    def row():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*block, start, left), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=[*_BLOCK, "_in", "_out"])

    for b in batches:
        for product, blk, qty, head, entry in zip(*(b.column(c).to_pylist() for c in (*_BLOCK, "quantity", "_head", "_in"))):
            if head:
                if block is not None:
                    yield row()
                block, start, left = (product, blk), entry, entry
            elif left is not None and qty is not None and 1 <= qty <= left:
                left -= qty
    if block is not None:
        yield row()


def _folded(rows: DataFrame, entries: DataFrame, order: Sequence[str], n: int, fold, schema: str) -> DataFrame:
    """Fold blocks; each block's entry stock travels as its first row, so the requests move once."""
    rest = [c for c in rows.columns if c not in _BLOCK]
    heads = entries.select(*_BLOCK, *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rest], F.lit(True).alias("_head"), "_in")
    both = rows.select(*_BLOCK, *rest, F.lit(False).alias("_head"), F.lit(None).cast("bigint").alias("_in")).unionByName(heads)
    return both.repartition(n, *_BLOCK).sortWithinPartitions(*_BLOCK, F.desc("_head"), *order).mapInArrow(fold, schema)


def allocate(requests: DataFrame, products: DataFrame,
             order: Sequence[str] = ("purchased_at", "purchase_id"), num_partitions: int | None = None) -> DataFrame:
    """Accept/refuse every request for a known product (unknown products are V3's rejects).

    Columns: purchase_id, product_id, quantity, accepted, remaining (stock left after the
    request), reason. A request for a product without a stock figure, or of less than one
    unit, is refused with that reason and changes nothing.
    """
    spark = requests.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = lambda c: F.col(c).cast("bigint").alias(c)
    more = [c for c in order if c not in ("purchase_id", "product_id", "quantity")]
    p = products.select("product_id", F.col("quantity").cast("bigint").alias("_stock"))
    j = requests.select(long("purchase_id"), long("product_id"), long("quantity"), *more).join(p, "product_id")
    rows = _saved(j.repartitionByRange(n, "product_id", *order).withColumn("_blk", F.spark_partition_id()), "stock-blocks")

    wanted = F.when(F.col("quantity") >= 1, F.col("quantity"))
    of_product = Window.partitionBy("product_id")
    earlier = of_product.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.greatest(F.col("_stock") - F.coalesce(F.sum(c).over(earlier), F.lit(0)), F.least(F.col("_stock"), F.lit(0)))
    entry = lambda c: F.when(F.col("_stock").isNotNull(), before(c)).alias("_in")
    blocks = rows.groupBy(*_BLOCK).agg(F.max("_stock").alias("_stock"), F.sum(wanted).alias("_wanted"))
    blocks = blocks.withColumn("_n", F.count("*").over(of_product))
    state = _saved(blocks.select(*_BLOCK, "_stock", "_n", entry("_wanted")), "stock-entries")
    split = state.where("_n > 1")
    inside = rows.join(F.broadcast(split.select("product_id").distinct()), "product_id", "left_semi").drop("_stock")
    todo, taken = split, None
    while not todo.isEmpty():
        again = F.broadcast(todo.select(*_BLOCK))
        made = _folded(inside.join(again, _BLOCK, "left_semi"), todo.select(*_BLOCK, "_in"), order, n, _take, "product_id bigint, _blk int, _in bigint, _out bigint")
        if taken is not None:
            made = taken.join(again, _BLOCK, "left_anti").unionByName(made)
        taken = _saved(made, "stock-taken")
        now = split.select(*_BLOCK, "_stock").join(taken.select(*_BLOCK, F.col("_in").alias("_used"), (F.col("_in") - F.col("_out")).alias("_took")), _BLOCK)
        split = _saved(now.select(*_BLOCK, "_stock", "_used", entry("_took")), "stock-entries")
        todo = split.where(~F.col("_in").eqNullSafe(F.col("_used")))
    entries = state.where("_n = 1").select(*_BLOCK, F.col("_stock").alias("_in")).unionByName(split.select(*_BLOCK, "_in"))
    answers = "purchase_id bigint, product_id bigint, quantity bigint, accepted boolean, remaining bigint, reason string"
    return _folded(rows.drop("_stock"), entries, order, n, _answer, answers)
