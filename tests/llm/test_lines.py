import hashlib
import re
from collections import Counter, defaultdict

import duckdb

from tillroll.llm import lines as L

STRIP = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(STRIP).translate(UPPER)


def brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(L.NO_ID if i is None else i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        me = L.NO_ID if i is None else i
        stay = [x for x in ls if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == me]
        out.append((i, len(ls), len(ls) - len(stay), "\n".join(stay)))
    return out


def check(df, **params):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows))
    got = [tuple(r) for r in L.line_report(df, **params).collect()]
    assert Counter(got) == want
    kept = L.dedup_lines(df, **params)
    assert kept.schema == df.schema
    assert Counter((r["doc_id"], r["text"] or "") for r in kept.collect()) == Counter((i, t) for i, _, _, t in brute(rows))
    return got


SHARED = [
    (None, "A line that several documents share\n x"),
    (None, "\tA LINE that several documents share \r\nown line of a document without id"),
    (1, "  a line that several documents share\x0b\nshort\nÉcole des lignes partagées partout"),
    (2, "école des lignes partagées partout\nA line that several documents share\na line that several documents SHARE"),
    (3, "École des lignes partagées partout\nshort\n\n"),
    (4, "École des lignes partagées partout"),
    (4, "École des lignes partagées partout"),
    (5, "only two documents hold this line\nshort"),
    (6, "only two documents hold this line\nshort"),
    (7, None),
    (8, ""),
]


def test_equal_brute_force(spark, docs, edge_docs, no_docs):
    got = check(docs)
    assert sum(r[2] for r in got) > 0
    df = spark.createDataFrame(SHARED, "doc_id bigint, text string")
    for n in (1, 3, 6):  # any batches, with and without compaction
        got = check(df, n_batches=n)
    assert sum(r[2] for r in got) == 5
    check(edge_docs)
    assert L.line_report(no_docs).count() == 0 and L.dedup_lines(no_docs).count() == 0


def test_runs_hold_each_key_once(docs):
    keys = L.line_keys(docs, 1).withColumn("b", L.F.pmod("doc", L.F.lit(7)))
    index = L.LineRuns(fan_out=2)
    for b in range(7):
        index.add(keys.where(L.F.col("b") == b).drop("b"))
        every = L._union(index.runs())
        assert every.count() == every.select("h1", "h2").distinct().count()
    assert len(index.levels) > 1 and all(len(x) <= 2 for x in index.levels)
    want = keys.groupBy("h1", "h2").agg(L.F.countDistinct("doc").alias("n"), L.F.max("doc").alias("last")).where("n >= 2")
    assert sorted(map(tuple, index.frequent(2).collect())) == sorted((r["h1"], r["h2"], r["last"]) for r in want.collect())


def test_sql(docs):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(con.sql(L.OP5_SQL).fetchall()) == sorted(tuple(r) for r in L.line_report(docs).collect())


def test_runs_are_merged_where_they_lie(spark, docs):
    """The join of a batch with a run and the compaction of runs shuffle nothing of the index."""
    keys = L.line_keys(docs, 1)
    index = L.LineRuns(n_buckets=4)
    for b in range(2):
        index.add(keys.where(L.F.pmod("doc", L.F.lit(2)) == b))
    plan = index.hits[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan
    assert all(r.inputFiles() and len(r.inputFiles()) <= 4 for r in index.runs())


def test_a_text_of_many_lines(spark):
    """Three documents of 60,000 equal lines: linear in the lines."""
    text = "\n".join(f"this is the line number {i} of the text" for i in range(60_000))
    df = spark.createDataFrame([(i, text + f"\nown line of document number {i}") for i in range(3)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in L.line_report(df).collect()}
    assert got == {0: (60_001, 60_000), 1: (60_001, 60_000), 2: (60_001, 0)}
