from collections import Counter, defaultdict

import corpus_pipeline as P
from pyspark.sql import functions as F
from tillroll.llm import decontaminate as D
from tillroll.llm import minhash as M
from tillroll.llm import mixing as X
from tillroll.llm import quality as Q

from .conftest import SF
from .test_decontaminate import brute as leaks
from .test_minhash import brute as near
from .test_mixing import brute as shown
from .test_quality import brute as judged


def kept_by_brute_force(spark, rows):
    """(doc_id, source) -> times shown after the first four stages."""
    rows = [r for r in rows if judged(r["text"], Q.RepetitionRules())["kept"]]
    group = {i: c for i, _, c in near([(r["doc_id"], r["text"]) for r in rows], 5, 80)}
    rows = [r for r in rows if group[r["doc_id"]] == r["doc_id"]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {d for d, _ in leaks([(r["doc_id"], r["text"]) for r in rows], items, D.TemplateRules())}
    rows = [r for r in rows if r["doc_id"] not in gone]
    mix = X.Mixture()
    ids = spark.createDataFrame([(r["doc_id"],) for r in rows], "doc_id bigint")
    keys = ids.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("e")).withColumn("k", X._key(mix.seed, F.col("e"), F.col("doc_id")))
    at = {(r["e"], r["doc_id"]): r["k"] for r in keys.collect()}
    return shown([(r["doc_id"], r["source"], r["text"]) for r in rows], lambda e, i: at[e, i], mix)


def test_run_equals_brute_force(spark, docs):
    got = P.run(spark, SF)
    assert got.columns == [*docs.columns, "shard"]
    rows = got.collect()
    assert Counter((r["doc_id"], r["source"]) for r in rows) == kept_by_brute_force(spark, docs.collect())
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] == text[r["doc_id"]] for r in rows)
    size, of = Counter(), defaultdict(set)
    for r in rows:
        size[r["shard"]] += len((r["text"] or "").encode()) + 1
        of[r["doc_id"]].add(r["shard"])
    largest = 2 * max(len(t.encode()) + 1 for t in text.values())
    assert len(size) == 16 and max(size.values()) - min(size.values()) <= 2 * largest + 0.01 * sum(size.values()) / 16
    assert all(len(s) == 1 for s in of.values())


def test_stages_pass_edge_cases(spark, edge_docs, no_docs):
    for start in (edge_docs, no_docs):
        df = start
        for name, stage in P.STAGES:
            after = stage(spark, df, SF)
            assert after.schema == df.schema if name != "sharding" else after.columns == [*df.columns, "shard_1"]
            df = after
        ids = [r["doc_id"] for r in df.collect()]
        assert set(ids) == ({3} if start is edge_docs else set())
