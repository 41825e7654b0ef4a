"""Operator 8, mixing sources to target weights: temperature mixing.

A source with token share ``p`` gets weight ``p ** a / sum(p ** a)``. The exponent ``a`` is found by bisection (in
sections of ``SECTIONS``: each round is one aggregate over the source table) so that either the weights have a
given entropy, or no source is repeated more than ``max_repeats`` times. A source of ``T`` tokens is then shown
``r = budget * weight / T`` times: ``floor(r)`` whole blocks, each a permutation of its documents, and the prefix
of one more permutation that fits the rest of its token budget. Without a budget the smallest one is taken
that shows every source at least once, so no document is lost.

The prefix is cut by a permutation key: token sums by (source, key bucket) are aggregated, the bucket in which
the budget ends is found on those sums, and only that bucket's rows are summed one by one. A source that holds
a third of all rows is therefore never in one task. Documents meet their source's row (blocks, cut) in an
equi-join: the engine broadcasts the source table if it measures small and splits the hot source otherwise.

Defined results: a NULL source is a source of its own; a NULL or empty text has no tokens and is shown as often
as its source's blocks say; rows repeated under one id stand at one place of a permutation and are cut
together; a table without tokens gets one block a source; an empty table gives an empty result. Added
columns are prefixed and dropped again, so other columns may have any names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

SECTIONS = 32
ROUNDS = 7
#: Key buckets of a source's permutation; a bucket holds this share of its documents.
BUCKETS = 1 << 16


@dataclass(frozen=True)
class Mixture:
    """Either a limit on repetitions or a target entropy (bits) of the weights."""

    max_repeats: float | None = 2.0
    entropy_bits: float | None = None
    budget_tokens: float | None = None
    seed: int = 17


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("bigint")


def source_tokens(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    return docs.groupBy(docs[source_col].alias("source")).agg(F.sum(n_tokens(docs[text_col])).alias("tokens"))


def _measures(shares: DataFrame, exponents: list[float]) -> list[dict]:
    """For each exponent: sum of p^a, of p^a log2 p, and the largest p^(a-1) and p^(1-a)."""
    a = F.col("a")
    rows = (
        shares.select("p", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
        .groupBy("a")
        .agg(
            F.sum(F.pow("p", a)).alias("z"),
            F.sum(F.pow("p", a) * F.log2("p")).alias("l"),
            F.max(F.pow("p", a - 1)).alias("up"),
            F.max(F.pow("p", 1 - a)).alias("down"),
        )
    )
    return sorted((r.asDict() for r in rows.collect()), key=lambda r: r["a"])


def _entropy(m: dict) -> float:
    return math.log2(m["z"]) - m["a"] * m["l"] / m["z"]


def _repeats(m: dict, scale: float | None) -> float:
    """Largest number of times a source is shown; ``scale``: budget in corpus sizes, None: least that shows all."""
    return m["up"] / m["z"] * (scale if scale is not None else m["z"] * m["down"])


def solve_exponent(shares: DataFrame, mix: Mixture, total: float) -> tuple[float, float]:
    """(exponent, budget in corpus sizes). The least exponent in [0, 1] (for an entropy: [0, 32]) that keeps to the
    limit; both limits are monotone in it. A limit that no exponent meets gets the nearest: the range's end."""
    scale = mix.budget_tokens / total if mix.budget_tokens is not None else None
    met = (lambda m: _entropy(m) <= mix.entropy_bits) if mix.entropy_bits is not None else (lambda m: _repeats(m, scale) <= mix.max_repeats)
    lo, hi = 0.0, 32.0 if mix.entropy_bits is not None else 1.0
    best = None
    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * i / SECTIONS for i in range(SECTIONS + 1)]
        ms = _measures(shares, grid)
        first = next((i for i, m in enumerate(ms) if met(m)), len(ms) - 1)
        best = ms[first]
        if first == 0:
            break
        lo, hi = ms[first - 1]["a"], ms[first]["a"]
    return best["a"], scale if scale is not None else best["z"] * best["down"]


def _key(seed: int, epoch: Column, id_: Column) -> Column:
    """Place of a document in its source's permutation of one epoch."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("bigint"), id_), 1)


def plan_mixture(docs: DataFrame, mix: Mixture, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per source: tokens, weight, whole blocks, and the last key of the partial block (-1: none)."""
    rows = C.saved(docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), n_tokens(docs[text_col]).alias("n")), "mix-rows")
    sources = C.saved(rows.groupBy("source").agg(F.sum("n").alias("tokens")), "mix-sources")
    total = sources.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    if total == 0:
        return sources.select("source", "tokens", F.lit(None).cast("double").alias("weight"), F.lit(1).cast("bigint").alias("blocks"), F.lit(-1).cast("bigint").alias("cut"))
    shares = sources.where("tokens > 0").select("source", "tokens", (F.col("tokens") / F.lit(float(total))).alias("p"))
    exponent, scale = solve_exponent(shares, mix, float(total))
    z = _measures(shares, [exponent])[0]["z"]
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent)) / z)
    shown = F.col("weight") * F.lit(scale * total) / F.col("tokens")
    # a number of repetitions within rounding of a whole one is that
    near = F.when(F.abs(shown - F.round(shown)) < 1e-6, F.round(shown)).otherwise(shown)
    table = sources.withColumn("weight", weight).withColumn("shown", F.coalesce(near, F.lit(1.0)))
    table = table.withColumn("blocks", F.floor("shown")).withColumn("rest", (F.col("shown") - F.col("blocks")) * F.col("tokens"))
    table = C.saved(table, "mix-weights")

    open_ = table.where("rest > 0").select(F.col("source").alias("s"), "blocks", "rest")
    keyed = rows.join(open_, F.col("source").eqNullSafe(F.col("s"))).select("s", "rest", "n", _key(mix.seed, F.col("blocks"), F.col("id")).alias("key"))
    bucket = F.shiftrightunsigned("key", 63 - int(math.log2(BUCKETS)))
    keyed = C.saved(keyed.withColumn("bucket", bucket), "mix-keys")
    sums = keyed.groupBy("s", "bucket").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"), F.max("key").alias("last"))
    upto = Window.partitionBy("s").orderBy("bucket")
    sums = C.saved(sums.withColumn("upto", F.sum("n").over(upto)), "mix-buckets")
    whole = sums.where("upto <= rest").groupBy("s").agg(F.max("last").alias("cut"))
    edge = sums.where("upto > rest").groupBy("s").agg(F.min(F.struct("bucket", F.col("upto") - F.col("n"), "rest")).alias("e"))
    edge = edge.select("s", F.col("e.bucket").alias("bucket"), F.col("e.col2").alias("before"), F.col("e.rest").alias("rest"))
    right = edge.select(F.col("s").alias("es"), F.col("bucket").alias("eb"), "before", F.col("rest").alias("left_over"))
    last = keyed.join(right, F.col("s").eqNullSafe(F.col("es")) & (F.col("bucket") == F.col("eb")))
    last = last.withColumn("so_far", F.col("before") + F.sum("n").over(Window.partitionBy("s").orderBy("key")))
    inside = last.where("so_far <= left_over").groupBy("s").agg(F.max("key").alias("cut"))
    cuts = whole.unionByName(inside).groupBy("s").agg(F.max("cut").alias("cut"))
    return table.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "tokens", "weight", "blocks", F.coalesce("cut", F.lit(-1)).cast("bigint").alias("cut"))


def mixed(docs: DataFrame, mix: Mixture = Mixture(), id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", place: bool = False) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture shows it. With ``place``: also its block number and its
    place key in the block (``block``, ``block_key``)."""
    plan = C.saved(plan_mixture(docs, mix, id_col, source_col, text_col), "mix-plan")
    own = plan.select(F.col("source").alias("__mix_source"), F.col("blocks").alias("__mix_blocks"), F.col("cut").alias("__mix_cut"))
    both = docs.join(own, docs[source_col].eqNullSafe(F.col("__mix_source")))
    times = F.col("__mix_blocks") + (_key(mix.seed, F.col("__mix_blocks"), docs[id_col]) <= F.col("__mix_cut")).cast("bigint")
    shown = both.where(times > 0).withColumn("__mix_block", F.explode(F.sequence(F.lit(0).cast("bigint"), times - 1)))
    columns = [docs[c] for c in docs.columns]
    if place:
        columns += [F.col("__mix_block").alias("block"), _key(mix.seed, F.col("__mix_block"), docs[id_col]).alias("block_key")]
    return shown.select(*columns)


def op8_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(C.read_documents(spark, sf_dir), place=True).select("doc_id", "source", "block", "block_key")
