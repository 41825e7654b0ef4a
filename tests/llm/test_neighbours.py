import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import neighbours as N

SF = "/root/testdata/sf0.001"
KIND = "vec_id bigint, embedding array<float>, label int, id string, cell string"


def brute(rows, is_query, k=20):
    """[(query_id, rank, vec_id, score)] over (id, vector) rows, by the definition."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = []
    for q, a in {(i, tuple(v)) for i, v in rows if is_query(i)}:
        best = {}
        for i, b in rows:
            if i != q:
                s = 0.0
                for x, y in zip(a, b):
                    s += x * y
                best[i] = max(best.get(i, -np.inf), s)
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


def frame(spark, rows, kind=KIND):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", "y") for i, v in rows], kind)


def stored(rows):
    """The rows as the float column keeps them."""
    return [(i, np.array(v, np.float32).astype(np.float64).tolist()) for i, v in rows]


def every_20th(i):
    return i % 20 == 0


def test_codes_estimate_within_their_bound():
    rng = np.random.default_rng(1)
    rules = N.AnnRules()
    x, q = rng.standard_normal((4000, 64)), rng.standard_normal((50, 64))
    packed, length, fit = N.codes(x, rules)
    assert packed.shape == (4000, 32) and packed.dtype == np.uint8 and np.allclose(length, np.linalg.norm(x, axis=1))
    signs = (np.unpackbits(packed, axis=1) * 2.0 - 1) / 16
    guess = q @ N.rotation(64, 256, rules.seed) @ signs.T * length / fit
    deviation = np.linalg.norm(q, axis=1)[:, None] * length * np.sqrt((1 / fit**2 - 1) / 255)
    off = (guess - q @ x.T) / deviation
    assert abs(off.mean()) < 0.05 and 0.7 < off.std() < 1.1 and (np.abs(off) < rules.sigmas).mean() > 0.9999


def test_rotation_keeps_inner_products():
    turn = N.rotation(17, 68, 3)
    assert np.allclose(turn @ turn.T, np.eye(17))


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = N.op12_one_bit_codes(spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect())) == brute(rows, every_20th)


@pytest.mark.parametrize("shape", ["uniform", "clustered", "lengths"])
def test_recall_and_exact_scores_over_many_cells_and_parts(spark, shape):
    rng = np.random.default_rng(7)
    rows = rng.standard_normal((3000, 24))
    if shape == "clustered":
        rows = 4 * rng.standard_normal((12, 24))[rng.integers(0, 12, 3000)] + 0.3 * rows
    if shape == "lengths":
        rows *= rng.lognormal(0, 1.5, (3000, 1))
    rows = stored(list(enumerate(rows)))
    rules = N.AnnRules(cell_rows=150, part_rows=60, block_rows=5, sample_rows=800)
    got = sorted(map(tuple, N.nearest(frame(spark, rows), F.col("id") % 20 == 0, rules).collect()))
    want = brute(rows, every_20th)
    found = {(q, i) for q, _, i, _ in got}
    assert len(got) == len(want) and len(found & {(q, i) for q, _, i, _ in want}) >= 0.995 * len(want)
    score = {(q, i): s for q, _, i, s in want}
    assert all(score.get((q, i), s) == s for q, _, i, s in got)


def test_hot_vector_and_ties(spark):
    """A third of the rows are one vector: equal scores are ordered by id, and no task meets them all."""
    rng = np.random.default_rng(2)
    hot = rng.standard_normal(16)
    rows = stored([(i, hot if i % 3 == 0 else rng.standard_normal(16)) for i in range(1500)])
    rules = N.AnnRules(cell_rows=100, part_rows=50, block_rows=10)
    got = sorted(map(tuple, N.nearest(frame(spark, rows), F.col("id") % 20 == 0, rules).collect()))
    assert got == brute(rows, every_20th)


def test_rows_that_repeat_an_id_count_as_one(spark):
    """100 equal rows of an id, 100 different vectors of another (a query): neither hides other neighbours."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(8)) for i in range(300)] + [(7, np.ones(8))] * 100 + [(20, rng.standard_normal(8) * 3) for _ in range(100)]
    got = N.nearest(frame(spark, rows), F.col("id") % 20 == 0, N.AnnRules(cell_rows=120, part_rows=40, block_rows=16)).collect()
    best = {}
    for q, _, i, s in brute(stored(rows), every_20th, 500):
        best[q, i] = max(best.get((q, i), -np.inf), s)
    want = []
    for q in sorted({q for q, _ in best}):
        near = sorted(((s, i) for (a, i), s in best.items() if a == q), key=lambda x: (-x[0], x[1]))[:20]
        want += [(q, n + 1, i, s) for n, (s, i) in enumerate(near)]
    assert sorted(map(tuple, got)) == want


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1, 2]), (20, [0.5, -1]), (40, None), (60, [0, 0]), (80, [nan, 1]), (100, [inf, 1]), (120, [1, None]), (140, [1, 2, 3]),
        (160, []), (None, [5, 5]), (1, [3, 3]), (1, [3, 3]), (2, [-1, 1]), (2, [9, 9]), (20, [0.5, -1]), (-20, [1, 2]), (3, [1e30, 1]),
    ]
    good = [(i, v) for i, v in rows if i is not None and v and len(v) == 2 and None not in v and np.isfinite(v).all() and any(v)]
    got = sorted(map(tuple, N.nearest(frame(spark, rows), F.col("id") % 20 == 0).collect()))
    assert got == brute(stored(good), every_20th) and {r[0] for r in got} == {0, 20, -20}
    assert N.nearest(frame(spark, []), F.col("id") % 20 == 0).count() == 0
    assert N.nearest(frame(spark, [(1, None), (0, [0.0])]), F.col("id") % 20 == 0).count() == 0
    assert N.nearest(frame(spark, [(0, [1.0])]), F.col("id") % 20 == 0).count() == 0


def test_string_ids_and_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(f"v{i:03}", rng.standard_normal(8).tolist()) for i in range(200)]
    kind = KIND.replace("vec_id bigint", "vec_id string").replace("float", "double")
    got = sorted(map(tuple, N.nearest(frame(spark, rows, kind), F.col("id") < "v010", N.AnnRules(k=3)).collect()))
    assert got == brute(rows, lambda i: i < "v010", 3)
