"""Operator 6, sharding: k-d tree partitioning on document metadata.

The tree splits the table recursively at weighted medians (weight: bytes) along the widest metadata dimension
until it has as many leaves as shards, or until leaves reach the target bytes. Dimensions are 63-bit integer
coordinates: 31 bits of the value (logarithm of the size; a hash position for source and language) and below
them 32 bits of a row hash, so a value that holds a third of all rows can still be cut exactly in two.

A median is found by histogram refinement: each round is one aggregate over narrow rows (node, bin -> bytes)
that returns at most ``BINS`` rows a node, and the next round looks inside the bin that holds the median. Only
the splits (one number each) live on the driver. A document's shard is then an expression on its own columns:
texts are never shuffled. Slots number each shard without gaps: row numbers inside small hash buckets plus the
bucket's offset, so no shard is ordered by one task.

Defined results: a NULL text has size 1 (no bytes plus 1); NULL metadata are one value of their dimension;
repeated rows are rows of their own and get different slots; an empty table gives an empty result. If the
input has a column of the name that ``with_shards`` adds, the new one takes the next free name (``shard_1``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

#: Histogram bins of a node in one round.
BINS = 1024
#: A split is exact enough when at most this share of a leaf's bytes lies in the bin of the median.
TOLERANCE = 0.0005
#: Rows of a slot bucket, on average.
SLOT_ROWS = 20_000


@dataclass
class Node:
    """A leaf (``shard``), or a split: coordinates of ``dim`` up to ``cut`` go left."""

    leaves: int
    shard: int = 0
    dim: str | None = None
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def coordinates(text: Column, id_: Column, metadata: Sequence[Column]) -> dict[str, Column]:
    """``d0``: logarithm of the size; ``d1`` ...: hash position of each metadata column; ties cut by a row hash."""
    fine = F.shiftrightunsigned(F.xxhash64(F.lit("kd"), id_, F.crc32(F.coalesce(text, F.lit("")).cast("binary"))), 32)
    values = [F.floor(F.log2(text_size(text).cast("double")) * (1 << 25)).cast("bigint")]
    values += [F.coalesce(F.shiftrightunsigned(F.xxhash64(F.lit("value"), m), 33), F.lit(0)) for m in metadata]
    return {f"d{i}": F.shiftleft(v, 32).bitwiseOR(fine) for i, v in enumerate(values)}


def _expression(node: Node, dims: dict[str, Column], leaf) -> Column:
    if node.dim is None:
        return F.lit(leaf(node))
    return F.when(dims[node.dim] <= F.lit(node.cut), _expression(node.left, dims, leaf)).otherwise(_expression(node.right, dims, leaf))


def _leaves(node: Node) -> list[Node]:
    return [node] if node.dim is None else _leaves(node.left) + _leaves(node.right)


def _weighted_quantiles(rows: DataFrame, at: Column, coordinate: Column, wanted: dict[int, tuple[int, int, float, float]]) -> dict[int, int]:
    """For each open node its cut: the largest bin edge reached while the bytes up to it stay nearest the target.

    ``wanted``: node -> (lowest, highest coordinate, target bytes, bytes that may stay undecided)."""
    below = {k: 0.0 for k in wanted}
    span = {k: (lo, hi) for k, (lo, hi, _, _) in wanted.items()}
    cuts: dict[int, int] = {}
    while span:
        lo = hi = step = F.lit(None).cast("bigint")
        for k, (a, z) in span.items():
            own = F.col("node") == k
            lo, hi = F.when(own, F.lit(a)).otherwise(lo), F.when(own, F.lit(z)).otherwise(hi)
            step = F.when(own, F.lit((z - a) // BINS + 1)).otherwise(step)
        x = F.col("x")
        bins = (
            rows.select(at.alias("node"), coordinate.alias("x"), "size")
            .where(F.col("node").isin(list(span)) & (x >= lo) & (x <= hi))
            .groupBy("node", F.floor((x - lo) / step).alias("bin"))
            .agg(F.sum("size").alias("w"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .collect()
        )
        following = {}
        for k in span:
            target, slack = wanted[k][2], wanted[k][3]
            edge = span[k][0] - 1
            for b in sorted((b for b in bins if b["node"] == k), key=lambda b: b["lo"]):
                if below[k] + b["w"] <= target:
                    below[k], edge = below[k] + b["w"], b["hi"]
                    continue
                if b["lo"] == b["hi"] or b["w"] <= slack:
                    # the bin stays whole: on the nearer side
                    cuts[k] = b["hi"] if below[k] + b["w"] - target < target - below[k] else edge
                else:
                    cuts[k] = edge
                    following[k] = (b["lo"], b["hi"])
                break
            else:
                cuts[k] = edge
        span = following
    return cuts


def build_tree(rows: DataFrame, dims: Sequence[str], n_shards: int | None = None, target_bytes: int | None = None) -> Node:
    """``rows``: narrow table with ``size`` and the coordinates ``dims``."""
    if n_shards is None:
        total = rows.agg(F.sum("size").alias("w")).first()["w"] or 0
        n_shards = max(1, -(-total // target_bytes))
    root = Node(n_shards)
    of = {d: F.col(d) for d in dims}
    scale: dict[str, int] = {}
    while open_ := [n for n in _leaves(root) if n.leaves > 1]:
        number = {id(n): i for i, n in enumerate(open_)}
        at = _expression(root, of, lambda n: number.get(id(n), -1))
        stats = rows.groupBy(at.alias("node")).agg(
            F.sum("size").alias("w"), *(f(d).alias(f"{k}_{d}") for d in dims for k, f in (("lo", F.min), ("hi", F.max)))
        ).where("node >= 0").collect()
        by = {r["node"]: r for r in stats}
        wide = lambda r, d: (r[f"hi_{d}"] >> 32) - (r[f"lo_{d}"] >> 32)  # noqa: E731  of the values, without the row hash
        scale = scale or {d: max(1, wide(by[0], d)) if 0 in by else 1 for d in dims}
        wanted, widest = {}, {}
        for i, n in enumerate(open_):
            if i not in by:  # no rows: any cut will do
                n.dim, n.cut = dims[0], 0
                continue
            r = by[i]
            d = max(dims, key=lambda d: (wide(r, d) / scale[d], -dims.index(d)))
            widest[i] = d
            wanted[i] = (r[f"lo_{d}"], r[f"hi_{d}"], r["w"] * (n.leaves // 2) / n.leaves, TOLERANCE * r["w"] / n.leaves)
        if wanted:
            coordinate = F.lit(None).cast("bigint")
            for i, d in widest.items():
                coordinate = F.when(at == i, of[d]).otherwise(coordinate)
            cuts = _weighted_quantiles(rows, at, coordinate, wanted)
            for i, n in enumerate(open_):
                if i in cuts:
                    n.dim, n.cut = widest[i], cuts[i]
        for n in open_:
            n.left, n.right = Node(n.leaves // 2), Node(n.leaves - n.leaves // 2)
    for i, n in enumerate(_leaves(root)):
        n.shard = i
    return root


def _narrow(docs: DataFrame, id_col: str, text_col: str, metadata: Sequence[str]) -> DataFrame:
    text, id_ = docs[text_col], docs[id_col]
    dims = coordinates(text, id_, [docs[m] for m in metadata])
    return docs.select(
        id_.alias("doc_id"), text_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), *(c.alias(d) for d, c in dims.items())
    )


def kd_shards(
    docs: DataFrame, n_shards: int | None = 16, target_bytes: int | None = None, metadata: Sequence[str] = ("source", "lang"), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One narrow row per document: size, checksum, shard and slot."""
    rows = C.saved(_narrow(docs, id_col, text_col, metadata), "kd-rows")
    dims = [c for c in rows.columns if c.startswith("d") and c[1:].isdigit()]
    tree = build_tree(rows, dims, n_shards, target_bytes)
    shard = _expression(tree, {d: F.col(d) for d in dims}, lambda n: n.shard)
    buckets = max(1, rows.count() // (SLOT_ROWS * len(_leaves(tree))))
    placed = rows.select("doc_id", "size", "text_crc32", shard.alias("shard"), F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).alias("bucket"))
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("rank", F.row_number().over(own) - 1)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = offsets.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("rank")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def with_shards(
    docs: DataFrame, n_shards: int | None = 16, target_bytes: int | None = None, metadata: Sequence[str] = ("source", "lang"), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with a shard number; the tree is built from narrow rows, the texts stay where they are."""
    rows = C.saved(_narrow(docs, id_col, text_col, metadata), "kd-rows")
    dims = [c for c in rows.columns if c.startswith("d") and c[1:].isdigit()]
    tree = build_tree(rows, dims, n_shards, target_bytes)
    own = coordinates(docs[text_col], docs[id_col], [docs[m] for m in metadata])
    name = next(x for x in ["shard", *(f"shard_{i}" for i in range(1, len(docs.columns) + 2))] if x not in docs.columns)
    return docs.select("*", _expression(tree, own, lambda n: n.shard).alias(name))


def op6_kd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(C.read_documents(spark, sf_dir))
