"""Operator 12, approximate nearest neighbours: randomly rotated one-bit codes with error bounds.

Index. Vectors are dealt to cells around centres (k-means on a bounded sample, see ``AnnRules.sample_rows``; every
vector is indexed). A vector's offset from its centre is projected by a fixed random matrix with orthonormal columns
to ``bits_per_dim`` numbers a dimension, of which only the signs are kept, packed into bytes. Two scalars go with a
code: the offset's length, and how well the signs point along the offset (``fit``: their cosine).

Estimate. For a query ``q``, the inner product with ``v = centre + offset`` is
``q.centre + |offset| * (rotated q . signs) / fit``. The error is about normal with deviation
``|q| |offset| sqrt((1 / fit**2 - 1) / (n_bits - 1))``; ``sigmas`` such deviations are the bound. Only vectors whose upper
bound reaches the query's threshold are reranked by the exact inner product in double precision.

Search, in two passes over the same join. First each query meets its most promising cell; its ``k``-th best exact
score there is its threshold. Then it meets every other cell whose largest possible inner product,
``q.centre + spread * |q| * radius``, reaches the threshold. With ``spread`` 1 (the default) that is the Cauchy-Schwarz
bound, and no neighbour is lost to a cell; clustered vectors skip most cells, vectors without clusters none. A lower
``spread`` visits fewer. What can be missed otherwise is an error beyond ``sigmas`` deviations.

Work at scale. Cells are cut into parts of about ``part_rows`` vectors and the queries of a cell into blocks of about
``block_rows``, by a salt kept in the table and by hash, so a hot cell or a vector that occurs a million times is many tasks of bounded size; a
task meets one part with one block (a co-group) and returns at most ``k`` rows for each query of it. Centres, radii and
counts of cells are at most ``max_cells`` rows; only those and the sample reach the driver.

Defined results: vectors that are NULL, zero, hold NULL or non-finite components, have no id, or have not the table's
commonest number of components (ties: the smaller) take no part; the query's own id is never its neighbour; rows that
repeat an id count as one, with the best of their scores; equal scores are ordered by id; fewer than ``k`` candidates
are all returned; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Pairs of a query and a vector that are estimated at once, and reranked at once (bounds of a task's memory).
STEP_PAIRS, STEP_ROWS = 1 << 19, 1 << 14


@dataclass(frozen=True)
class AnnRules:
    k: int = 20
    bits_per_dim: int = 4
    sigmas: float = 4.0
    spread: float = 1.0
    #: k-means: sample, steps and size of a cell.
    sample_rows: int = 16_384
    steps: int = 8
    cell_rows: int = 8_192
    max_cells: int = 1_024
    part_rows: int = 8_192
    block_rows: int = 4_096
    seed: int = 12


@dataclass(frozen=True)
class Cells:
    """What a task needs of the index; ``max_cells`` rows at most."""

    centres: np.ndarray
    rules: AnnRules
    radii: np.ndarray = field(default_factory=lambda: np.zeros(0))
    n_rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


@lru_cache(maxsize=4)
def rotation(dim: int, n_bits: int, seed: int) -> np.ndarray:
    """(dim, n_bits) with orthonormal rows: a random rotation of the vector padded with zeros."""
    normal = np.random.default_rng(seed).standard_normal((n_bits, dim))
    return np.linalg.qr(normal)[0].T


def fit_centres(sample: np.ndarray, n_cells: int, rules: AnnRules) -> np.ndarray:
    """Lloyd's steps on the sample; a cell that runs empty keeps its centre."""
    rng = np.random.default_rng(rules.seed)
    centres = sample[rng.choice(len(sample), min(n_cells, len(sample)), replace=False)]
    for _ in range(rules.steps):
        own = nearest_centre(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(1) / 2
    step = max(1, STEP_PAIRS // len(centres))
    return np.concatenate([np.argmax(vectors[i : i + step] @ centres.T - half, axis=1) for i in range(0, max(len(vectors), 1), step)])


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) doubles of a list column whose lists all have ``dim`` numbers."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def codes(offsets: np.ndarray, rules: AnnRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, lengths, fits) of offsets; an offset of length 0 fits any code."""
    n_bits = rules.bits_per_dim * offsets.shape[1]
    turned = offsets @ rotation(offsets.shape[1], n_bits, rules.seed)
    length = np.sqrt((offsets**2).sum(1))
    # the signs scaled to length 1 are +-1/sqrt(n_bits), so the cosine is the mean size of the numbers
    fit = np.where(length > 0, np.abs(turned).sum(1) / np.sqrt(n_bits) / np.where(length > 0, length, 1), 1.0)
    return np.packbits(turned > 0, axis=1), length, np.minimum(fit, 1.0)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total = total + a[:, i] * b[:, i]
    return total


def usable(vector: Column) -> Column:
    """Not NULL, not zero, all components there and finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda x: x != 0)


def _dimension(vectors: DataFrame) -> int:
    """The commonest number of components, 0 if there is no vector."""
    sizes = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return sizes[0]["d"] if sizes else 0


def build(vectors: DataFrame, rules: AnnRules, id_col: str, vector_col: str) -> tuple[DataFrame, Cells, int] | None:
    """The index table (cell, id, v, code, length, fit, salt), its cells and the number of components."""
    read = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("v")).where(F.col("id").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False)))
    dim = _dimension(read)
    if not dim:
        return None
    read = read.where(F.size("v") == dim)
    n = read.count()
    # rows by the hash of their id: a share that makes about sample_rows, and never twice as many
    share = min(1.0, rules.sample_rows / n)
    unit = (F.xxhash64("id", "v") / float(1 << 63) + 1) / 2
    sample = matrix(read.where(unit <= share).select("v").limit(2 * rules.sample_rows).toArrow()["v"].combine_chunks(), dim)
    n_cells = int(np.clip(-(-n // rules.cell_rows), 1, rules.max_cells))
    if not len(sample):
        sample = np.zeros((1, dim))
    cells = Cells(fit_centres(sample, n_cells, rules), rules)
    sent = read.sparkSession.sparkContext.broadcast(cells.centres)

    def run(batches):
        seen = TaskContext.get().partitionId() << 40
        for b in batches:
            if not b.num_rows:
                continue
            v = matrix(b.column("v"), dim)
            salt = C.mix64(np.arange(seen, seen + len(v), dtype=np.uint64)) >> np.uint64(33)
            seen += len(v)
            own = nearest_centre(v, sent.value)
            packed, length, fit = codes(v - sent.value[own], rules)
            columns = [pa.array(own.astype(np.int32)), b.column("id"), b.column("v"), pa.array(list(map(bytes, packed)), pa.binary()), pa.array(length), pa.array(fit), pa.array(salt.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "id", "v", "code", "length", "fit", "salt"])

    kinds = dict(read.dtypes)
    index = C.saved(read.mapInArrow(run, f"cell int, id {kinds['id']}, v {kinds['v']}, code binary, length double, fit double, salt int"), "ann-index")
    stats = index.groupBy("cell").agg(F.max("length").alias("radius"), F.count(F.lit(1)).alias("n")).toArrow()
    radii, n_rows = np.zeros(len(cells.centres)), np.zeros(len(cells.centres), np.int64)
    radii[stats["cell"].to_numpy()], n_rows[stats["cell"].to_numpy()] = stats["radius"].to_numpy(), stats["n"].to_numpy()
    return index, Cells(cells.centres, rules, radii, n_rows), dim


def _visits(queries: DataFrame, cells: Cells, dim: int, first: bool) -> DataFrame:
    """(id, v, threshold, cell) of the cells that each query (id, v, threshold, seen) meets in a pass."""
    sent = queries.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        c = sent.value
        there = np.flatnonzero(c.n_rows > 0)
        for b in batches:
            step = max(1, STEP_PAIRS // len(there))
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                v = matrix(part.column("v"), dim)
                most = v @ c.centres[there].T + c.rules.spread * np.sqrt((v**2).sum(1))[:, None] * c.radii[there]
                if first:
                    row, cell = np.arange(len(v)), there[np.argmax(most, axis=1)]
                else:
                    # the bound is a sum of rounded products: a hair of slack keeps ties with the threshold
                    meets = most * (1 + 1e-9 * np.sign(most)) + 1e-12 >= part.column("threshold").to_numpy()[:, None]
                    meets &= there != part.column("seen").to_numpy()[:, None]
                    row, at = np.nonzero(meets)
                    cell = there[at]
                rows = part.select(["id", "v", "threshold"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cell.astype(np.int32))], names=["id", "v", "threshold", "cell"])

    kinds = dict(queries.dtypes)
    return queries.select("id", "v", "threshold", "seen").mapInArrow(run, f"id {kinds['id']}, v {kinds['v']}, threshold double, cell int")


def best_pairs(vectors: dict[str, np.ndarray], queries: dict[str, np.ndarray], centre: np.ndarray, rules: AnnRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, exact score) of at most k vectors for each query, none below its threshold."""
    dim = vectors["v"].shape[1]
    ids, one_each = np.unique(vectors["id"], return_index=True)
    n = len(ids)
    n_bits = rules.bits_per_dim * dim
    signs = (np.unpackbits(vectors["code"], axis=1, count=n_bits).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(n_bits))
    length, fit = vectors["length"], vectors["fit"]
    scale = length / fit
    slack = length * (rules.sigmas * np.sqrt(np.maximum(1 / fit**2 - 1, 0) / max(n_bits - 1, 1)) + 1e-6)
    out = []
    step = max(1, STEP_PAIRS // len(length))
    for lo in range(0, len(queries["v"]), step):
        q = queries["v"][lo : lo + step]
        size = np.sqrt((q**2).sum(1))
        turned = ((q / size[:, None]) @ rotation(dim, n_bits, rules.seed)).astype(np.float32)
        guess = (turned @ signs.T) * (size[:, None] * scale)
        bound = size[:, None] * slack
        near = (q @ centre)[:, None]
        least = queries["threshold"][lo : lo + step]
        if n > rules.k:
            # one row for each id, and the query's own may be among them
            sure = guess - bound if n == len(length) else (guess - bound)[:, one_each]
            sure = np.partition(sure, n - rules.k - 1, axis=1)[:, n - rules.k - 1] + near[:, 0]
            least = np.maximum(least, sure)
        row, col = np.nonzero(guess + bound + 1e-9 * np.abs(near) >= least[:, None] - near)
        score = np.concatenate([exact(q[row[i : i + STEP_ROWS]], vectors["v"][col[i : i + STEP_ROWS]]) for i in range(0, max(len(row), 1), STEP_ROWS)])
        other = (queries["id"][lo + row] != vectors["id"][col]) & (score >= queries["threshold"][lo + row])
        row, col, score = row[other], col[other], score[other]
        order = np.lexsort((vectors["id"][col], -score, row))
        row, col, score = row[order], col[order], score[order]
        if n < len(length):  # of the rows of one id the best stays
            best = np.sort(np.unique(row * np.int64(n) + np.searchsorted(ids, vectors["id"][col]), return_index=True)[1])
            row, col, score = row[best], col[best], score[best]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < rules.k
        out.append((lo + row[keep], col[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _met(index: DataFrame, visits: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(query_id, vec_id, score): for each query of a block and each part of its cell, the best k that pass."""
    rules = cells.rules
    visits = C.saved(visits, "ann-visits")
    asked = np.zeros(len(cells.centres), np.int64)
    for r in visits.groupBy("cell").count().collect():  # at most max_cells rows
        asked[r["cell"]] = r["count"]
    parts, blocks = -(-cells.n_rows // rules.part_rows), -(-asked // rules.block_rows)
    spark = index.sparkSession
    table = [(int(c), int(parts[c]), int(blocks[c])) for c in np.flatnonzero((parts > 0) & (blocks > 0))]
    grid = F.broadcast(spark.createDataFrame(table, "cell int, parts int, blocks int"))  # at most max_cells rows
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    data = index.join(grid, "cell").withColumn("part", F.pmod("salt", "parts")).select("cell", "part", every("blocks").alias("block"), "id", "v", "code", "length", "fit")
    asks = visits.join(grid, "cell").withColumn("block", F.pmod(F.xxhash64("id", "v", F.lit(7)), F.col("blocks")).cast("int")).select("cell", every("parts").alias("part"), "block", "id", "v", "threshold")
    sent = spark.sparkContext.broadcast(cells.centres)
    id_type = dict(index.dtypes)["id"]

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            code = np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(left.num_rows, -1)
            place = np.unique(np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()]), return_inverse=True)[1]  # ids of any type, by order
            v = {"id": place[: left.num_rows], "v": matrix(left["v"].combine_chunks(), dim), "code": code, "length": left["length"].to_numpy(), "fit": left["fit"].to_numpy()}
            q = {"id": place[left.num_rows :], "v": matrix(right["v"].combine_chunks(), dim), "threshold": right["threshold"].to_numpy()}
            row, col, score = best_pairs(v, q, sent.value[key[0].as_py()], rules)
        else:
            row, col, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table({"query_id": right["id"].take(pa.array(row)), "vec_id": left["id"].take(pa.array(col)), "score": pa.array(score)})

    keys = ["cell", "part", "block"]
    return data.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(meet, f"query_id {id_type}, vec_id {id_type}, score double")


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k of each query, one row for each vector."""
    each = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, rules: AnnRules = AnnRules(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the largest inner product for each query row of the table.
    ``is_query`` is a condition on ``id``."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    built = build(vectors, rules, id_col, vector_col)
    if built is None:
        return vectors.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    index, cells, dim = built
    queries = index.where(is_query).select("id", "v").distinct()
    start = queries.withColumns({"threshold": F.lit(float("-inf")), "seen": F.lit(-1)})
    first = C.saved(_visits(start, cells, dim, first=True), "ann-first")
    found = C.saved(_met(index, first, cells, dim), "ann-found")
    full = _top(found, rules.k).where(F.col("rank") == rules.k).select(F.col("query_id").alias("id"), F.col("score").alias("threshold"))
    again = first.select("id", "v", F.col("cell").alias("seen")).join(full, "id", "left").withColumn("threshold", F.coalesce("threshold", F.lit(float("-inf"))))
    return _top(found.unionByName(_met(index, _visits(again, cells, dim, first=False), cells, dim)), rules.k)


def op12_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.pmod(F.col("id"), F.lit(20)) == 0)


OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         max(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda x, y: x + y)) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
  GROUP BY ALL)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM pairs
QUALIFY rank <= 20
"""
