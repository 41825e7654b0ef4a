import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tillroll.llm import common as C
from tillroll.llm import sharding as S


def check(df, n=16, **params):
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    got = S.kd_shards(df, n, **params).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < (n or 10**9)
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    return size, got


def test_sizes_near_equal(docs, edge_docs, no_docs):
    size, got = check(docs)
    total, largest = sum(size.values()), max(r["size"] for r in got)
    assert len(size) == 16 and max(size.values()) - min(size.values()) <= 2 * largest + 0.01 * total / 16
    check(edge_docs)
    assert S.kd_shards(no_docs).count() == 0


def test_hot_value_and_equal_sizes_are_cut(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("one").alias("source"), F.lit(None).cast("string").alias("lang"))
    size, _ = check(rows, 7)
    assert len(size) == 7 and max(size.values()) - min(size.values()) <= 14 * 8 + 0.01 * sum(size.values()) / 7


def test_shard_of_a_document_equals_the_narrow_table(docs, edge_docs, no_docs):
    for df in (docs, edge_docs):
        narrow = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in S.kd_shards(df).collect()}
        rows = S.with_shards(df)
        name = [c for c in rows.columns if c not in df.columns]
        assert name == (["shard"] if "shard" not in df.columns else ["shard_1"])
        for r in rows.collect():
            assert narrow[r["doc_id"], zlib.crc32((r["text"] or "").encode())] == r[name[0]]
    assert S.with_shards(no_docs).count() == 0


def test_target_bytes(docs):
    size, _ = check(docs, None, target_bytes=20_000)
    assert len(size) == -(-sum(size.values()) // 20_000)


def test_widest_dimension_is_cut_first(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id % 50 as int))").alias("text"), F.lit("one").alias("source"), F.lit("en").alias("lang"))
    narrow = C.saved(S._narrow(rows, "doc_id", "text", ("source", "lang")), "kd-test")
    assert S.build_tree(narrow, ["d1", "d0", "d2"], 2).dim == "d0"  # one source, one language


def brute_tree(rows, shards, first=0):
    """{row: shard} by recursive weighted medians along the widest dimension, on exact coordinates."""
    if shards == 1:
        return {r["row"]: first for r in rows}
    dims = [c for c in rows[0].asDict() if c.startswith("d") and c[1:].isdigit()] if rows else []
    spread = lambda d: ((max(r[d] for r in rows) >> 32) - (min(r[d] for r in rows) >> 32)) / brute_tree.scale[d]
    d = max(dims, key=lambda d: (spread(d), -dims.index(d)))
    order, want, seen, cut = sorted(rows, key=lambda r: r[d]), sum(r["size"] for r in rows) * (shards // 2) / shards, 0, 0
    while cut < len(order) and seen + order[cut]["size"] <= want:
        seen, cut = seen + order[cut]["size"], cut + 1
    if cut < len(order) and seen + order[cut]["size"] - want < want - seen:
        cut += 1
    return brute_tree(order[:cut], shards // 2, first) | brute_tree(order[cut:], shards - shards // 2, first + shards // 2)


def test_shards_are_those_of_a_recursive_tree(spark, docs, monkeypatch):
    monkeypatch.setattr(S, "TOLERANCE", 0.0)  # refine to the exact median
    rows = S._narrow(docs, "doc_id", "text", ["source", "lang"]).withColumn("row", S.F.monotonically_increasing_id()).collect()
    dims = [c for c in rows[0].asDict() if c.startswith("d") and c[1:].isdigit()]
    brute_tree.scale = {d: max(1, (max(r[d] for r in rows) >> 32) - (min(r[d] for r in rows) >> 32)) for d in dims}
    want = brute_tree(rows, 16)
    got = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in S.kd_shards(docs).collect()}
    assert got == {(r["doc_id"], r["text_crc32"]): want[r["row"]] for r in rows}
