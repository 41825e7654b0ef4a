import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import infill


@given(st.lists(st.integers(0, 9), max_size=400), st.sampled_from([2, 4, 8]))
@settings(max_examples=150, deadline=None)
def test_every_rank_is_reached_exactly(widths, fan):
    skip = infill.SkipList(np.array(widths, np.int64), fan)
    assert [skip.points_before(r) for r in range(len(widths) + 1)] == [sum(widths[:r]) for r in range(len(widths) + 1)]


def test_lanes_keep_the_widths_and_thin_out():
    widths = np.arange(100_000) % 13
    skip = infill.SkipList(widths)
    assert all(sum(u) == 100_000 and sum(p) == widths.sum() for u, p, _ in skip.lanes)
    sizes = [len(u) for u, _, _ in skip.lanes]
    assert all(b < a / 2 for a, b in zip(sizes, sizes[1:]) if a > 100) and sizes[-1] <= 4
    assert skip.points_before(77_777) == int(widths[:77_777].sum())


def brute(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, len(units), "plain", None, None, sha(text), sha(text))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, len(units), form, len(prefix), len(middle), sha(out), sha(text))


def test_query_equals_brute_force(spark, docs):
    got = infill.op11_indexable_skip_list(spark, "/root/testdata/sf0.001").collect()
    want = [brute(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got)) == sorted(want)
    assert {"psm", "spm"} <= {r.form for r in got}


def test_edges(spark, edge_docs, no_docs):
    rows = infill.fill_in_middle(edge_docs).collect()
    source = {(r.doc_id, r.text) for r in edge_docs.collect()}
    assert len(rows) == edge_docs.count() and infill.fill_in_middle(no_docs).count() == 0
    for r in rows:
        whole = r.prefix if r.form == "plain" else r.prefix + r.middle + r.suffix
        assert (r.doc_id, whole) in {(i, t or "") for i, t in source}
        assert (r.form == "plain") == (whole == "") == (r.middle is None)
    assert len({tuple(r) for r in rows if r.doc_id == 5}) == 1


def test_sentinels_in_the_text_and_at_its_edges(spark):
    texts = ["a<P>b\nc", "<S>\n", "<M>", "<\nS>\n<\nP>\n<", "<<<\n<<\n<P\n<S\n<M\n>\n", "é<\n😀<S\n\n\n", "\n\n\n", "no break"]
    frame = spark.createDataFrame([(i, t) for t in texts for i in range(40)], "doc_id bigint, text string")
    made = infill.fill_in_middle(frame)
    back = made.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    for r in back:
        whole = r.prefix if r.form == "plain" else r.prefix + r.middle + r.suffix
        assert r.back == whole and whole in texts
        assert (r.form == "plain") == any(s in whole for s in ("<P>", "<S>", "<M>"))


@pytest.mark.parametrize("ids", ["string", "int"])
def test_ids_of_any_type_rates_and_other_units(spark, ids):
    frame = spark.createDataFrame([(i, "one two  three four") for i in range(200)], "doc_id bigint, text string").withColumn("doc_id", F.col("doc_id").cast(ids))
    made = infill.fill_in_middle(frame, rate_pct=30, spm_pct=100, units=r"\S+\s*")
    rows = made.collect()
    assert dict(made.dtypes)["doc_id"] == ids and {r.n for r in rows} == {4}
    assert {r.form for r in rows} == {"plain", "spm"} and 30 <= sum(r.form == "spm" for r in rows) <= 95
    assert all(len(re.findall(r"\S+\s*", r.prefix)) == len(r.prefix.split()) for r in rows if r.form == "spm")


def test_a_text_of_many_lines(spark):
    text = "".join(f"line {i} é\n" for i in range(200_000))
    frame = spark.createDataFrame([(1, text), (2, text + "end")], "doc_id bigint, text string")
    rows = infill.fill_in_middle(frame).collect()
    assert [r.n for r in rows] == [200_000, 200_001]
    assert all((r.prefix + r.middle + r.suffix).startswith(text) for r in rows)
