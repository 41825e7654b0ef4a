import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import resampling as R

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, most=3):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, buckets=10_000, percent=5, min_words=20):
    """(doc_id, n_features, weight, score, rank) by the definition."""
    bucket = lambda f: crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for i, text in docs:
        fs = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text)) >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r[:4], drawn.get(id(r))) for r in rows]


@given(st.binary(max_size=300), st.binary(max_size=5000))
@settings(max_examples=100, deadline=None)
def test_shift_cancels_the_part_before(before, run):
    crc = np.array([crc32(before)], np.uint32)
    assert crc32(before + run) ^ int(R.shifted(crc, np.array([len(run)]))[0]) == crc32(run)


def test_shift_of_long_runs():
    for n in (63, 64, 65, 127, 128, 4095, 4096, 1_000_003, 5 << 20):
        run = bytes(range(251)) * (n // 251) + b"x" * (n % 251)
        assert crc32(b"before " + run) ^ int(R.shifted(np.array([crc32(b"before ")], np.uint32), np.array([n]))[0]) == crc32(run)


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 \t\n-_.@[`{\x7f\x80éß😀", max_size=60)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_runs_are_the_features(texts):
    scan = R.Scan(texts)
    assert scan.n_words.tolist() == [len(words_of(t)) for t in texts]
    found = Counter((int(i), int(c)) for n in (1, 2, 3) for i, c in zip(*scan.runs(n)))
    assert found == Counter((i, crc32(f.encode())) for i, t in enumerate(texts) for f in features(t))


def test_query_equals_brute_force(spark, docs):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute([(r.doc_id, r.text) for r in docs.collect()], target)
    got = R.op13_prefix_crc(spark, SF)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    key = lambda r: (r[0], r[3], r[4] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(r[4] is not None for r in want) > 0


def test_ranks_over_many_partitions_and_ties(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([5, 5, 5, rng.randrange(1000)])) for i in range(5000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, score bigint").repartition(13)
    got = R.ranked(frame, [F.desc("score"), F.asc_nulls_first("doc_id")], 1700).collect()
    want = {i: k + 1 for k, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert all(r["rank"] == (want[r.doc_id] if want[r.doc_id] <= 1700 else None) for r in got) and len(got) == 5000


def test_target_like_documents_are_drawn(spark):
    rng = random.Random(5)
    near, far = [f"t{i}" for i in range(60)], [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(near if i % 10 == 0 else far, k=60))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(rng.choices(near, k=80)),) for _ in range(30)], "text string")
    got = R.importance_resample(spark.createDataFrame(rows, "doc_id bigint, text string"), target)
    drawn = [r.doc_id for r in got.where("rank is not null").collect()]
    assert len(drawn) == 20 and all(i % 10 == 0 for i in drawn)


def test_edges(spark, edge_docs, no_docs):
    target = spark.createDataFrame([("some words", 1), (None, 2), ("", 3)], "text string, n_words int")
    got = R.importance_resample(edge_docs, target, R.ResamplingRules(percent=50))
    rows = got.collect()
    want = brute([(r.doc_id, r.text) for r in edge_docs.collect()], ["some words", None, ""], percent=50)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4] or 0)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows), key=key) == sorted(want, key=key)
    assert R.importance_resample(no_docs, target).count() == 0
    nothing = R.importance_resample(edge_docs, no_docs).collect()
    assert len(nothing) == len(rows) and all(r.weight == 0 for r in nothing if r.n_features == 0)


def test_ids_of_any_type(spark):
    text = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(f"id{i}", text + f" x{i}") for i in range(40)] + [(None, text)], "doc_id string, text string")
    got = R.importance_resample(frame, frame)
    assert dict(got.dtypes)["doc_id"] == "string" and sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2]
