import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tillroll.llm import repeats as R

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def paragraphs(text, n):
    at = 0
    for line in (text or "").split("\n"):
        ws = [(at + m.start(), at + m.end(), m[0].translate(UPPER)) for m in WORD.finditer(line)]
        if len(ws) >= n:
            yield ws[0][0], ws[-1][1], tuple(x for _, _, x in ws)
        at += len(line) + 1


def brute_paragraphs(rows, n=20):
    """All pairs of different paragraphs: {(doc, kept, a, z)}."""
    every = [(R.NO_ID if d is None else d, a, z, w) for d, t in rows for a, z, w in paragraphs(t, n)]
    kinds = sorted({w for *_, w in every})
    sets = [frozenset(w[i : i + 5] for i in range(len(w) - 4)) for w in kinds]
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                shared[j] += 1
            holders[x].append(k)
        for j, c in shared.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                parent[find(k)] = find(j)
    number = {w: k for k, w in enumerate(kinds)}
    kept = {}
    for d, _, _, w in every:
        c = find(number[w])
        kept[c] = min(d, kept.get(c, d))
    return {(d, kept[find(number[w])], a, z) for d, a, z, w in every if d != kept[find(number[w])]}


def brute_shared(rows, n):
    """Character ranges of documents that lie in n-word windows shared with another document."""
    where = defaultdict(set)
    for d, t in rows:
        ws = [(m.start(), m.end(), m[0].translate(UPPER)) for m in WORD.finditer(t or "")]
        for i in range(len(ws) - n + 1):
            where[tuple(x for _, _, x in ws[i : i + n])].add(R.NO_ID if d is None else d)
    return where


def check(df, n=20):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = {(r["doc"], r["kept_doc"], r["a"], r["z"]) for r in R.repeated_spans(df).collect()}
    want = brute_paragraphs(rows, n)
    assert want <= got
    texts = {(R.NO_ID if d is None else d): t for d, t in rows}
    where = brute_shared(rows, n)
    for d, k, a, z in got - want:  # the others are stretches of n words that the smaller document holds
        ws = tuple(w.translate(UPPER) for w in WORD.findall(texts[d][a:z]))
        assert len(ws) == n and k == min(where[ws]) and k < d
    return got


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, pairs, n = [], set(), 0
    for _ in range(40):  # a passage of over 50 words inside two texts, with a line break in it
        p = prose(rng.randrange(25, 60)) + "\n" + prose(rng.randrange(27, 60))
        for _ in range(2):
            rows.append((n, prose(rng.randrange(0, 50)) + " " + p + " " + prose(rng.randrange(0, 50))))
            n += 1
        pairs.add((n - 1, n - 2))
    clean = []
    for _ in range(30):
        rows.append((n, prose(200) + "\nLicensed to everybody under the usual terms of this place.\n" + prose(30)))
        clean.append(n)
        n += 1
    base = [word() for _ in range(60)]  # near copies of one paragraph
    for i in range(5):
        t = list(base)
        t[7 * i] = word()
        rows.append((n, prose(30) + "\n" + " ".join(t)))
        n += 1
    return spark.createDataFrame(rows, "doc_id bigint, text string"), pairs, clean, n


def test_passages_are_caught_and_clean_documents_left(planted):
    df, pairs, clean, n = planted
    check(df)
    got = {(r["doc_id"], r["kept_doc_id"]) for r in R.repeat_report(df).collect()}
    assert got == pairs | {(i, n - 5) for i in range(n - 4, n)}
    assert not {d for p in got for d in p} & set(clean)


def test_equal_brute_force(docs, edge_docs, no_docs):
    assert check(docs)
    assert (8, 3) in {(d, k) for d, k, _, _ in check(edge_docs)}
    assert R.repeat_report(no_docs).count() == 0


def test_text_without_repeats(planted, edge_docs, no_docs):
    df, pairs, _, _ = planted
    got = {r["doc_id"]: r["text"] for r in R.without_repeats(df).collect()}
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    for d, k in pairs:
        assert got[k] == text[k] and len(got[d]) < len(text[d])
    out = R.without_repeats(edge_docs)
    assert out.schema == edge_docs.schema and out.count() == edge_docs.count()
    assert R.without_repeats(no_docs).count() == 0


def test_anchors_cover_every_run():
    rng = np.random.default_rng(0)
    h = rng.integers(1, 2**60, 5000).astype(np.uint64)
    text = np.repeat([0, 1, 2], [3000, 20, 1980])
    got = set(R.anchors(h, text, 31).tolist())
    want = set()
    for i in range(len(h) - 30):
        if text[i] == text[i + 30]:
            want.add(i + int(np.argmin(h[i : i + 31])))
    assert got == want


def test_whole_passages_are_covered(planted):
    df, pairs, _, _ = planted
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    spans = {(r["doc_id"], r["kept_doc_id"]): [tuple(map(int, s.split(":"))) for s in r["spans"].split(",")] for r in R.repeat_report(df).collect()}
    where = brute_shared(text.items(), 20)
    for d, k in pairs:
        ws = [(m.start(), m.end(), m[0].translate(UPPER)) for m in WORD.finditer(text[d])]
        want = set()
        for i in range(len(ws) - 19):
            if k in where[tuple(x for _, _, x in ws[i : i + 20])]:
                want.update(range(ws[i][0], ws[i + 19][1]))
        assert want <= {c for a, z in spans[d, k] for c in range(a, z)}


def test_chunks_and_ranges_of_hashes_change_nothing(planted):
    df = planted[0].repartition(3)
    rows = lambda rules: sorted(map(tuple, R.repeat_report(df, rules).collect()))
    assert rows(R.RepeatRules()) == rows(R.RepeatRules(held=50, part_stretches=40))


def test_spans_are_joined_per_row():
    row = np.array([1, 0, 1, 1, 0, 1])
    a = np.array([5, 0, 30, 6, 4, 21])
    z = np.array([20, 3, 40, 8, 9, 25])
    assert [x.tolist() for x in R.joined(row, a, z)] == [[0, 1, 1], [0, 5, 30], [9, 25, 40]]
    assert R.without("abcdefgh", [{"a": 1, "z": 3}, {"a": 5, "z": 6}]) == "adegh"


def test_a_text_of_many_spans(spark):
    """20,000 repeated lines between own words: linear in the spans."""
    rng = random.Random(2)
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(20))
    shared = [line() for _ in range(20_000)]
    first = "\n".join(shared)
    second = "\n".join(f"own{i} words{i}\n{x}" for i, x in enumerate(shared))
    df = spark.createDataFrame([(1, first), (2, second)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in R.without_repeats(df).collect()}
    assert got[1] == first and got[2].split() == [w for i in range(20_000) for w in (f"own{i}", f"words{i}")]
