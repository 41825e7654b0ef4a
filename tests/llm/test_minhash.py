import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tillroll.llm import graph
from tillroll.llm import minhash as M

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(rows, n, pct):
    """All pairs, exact."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for k, (_, s) in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < k:
                    shared[j] += 1
        for j, c in shared.items():
            if 100 * c >= pct * (len(s) + len(sets[j][1]) - c):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), (least.get(find(k)) if s else i)) for k, (i, s) in enumerate(sets)]


def check(df, rules):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    want = sorted(brute([(r["doc_id"], r["text"]) for r in df.collect()], rules.shingle, rules.similarity_pct), key=key)
    got = M.near_duplicates(df, rules).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return got


@pytest.fixture(scope="module")
def families(spark):
    """Groups whose members are near the threshold, chains, shared passages, short texts, copies."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(120)]
        for _ in range(8):
            t = list(base)
            for _ in range(rng.randrange(0, 7)):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    chain = [word() for _ in range(200)]
    for _ in range(10):
        texts.append(" ".join(chain))
        chain = chain[4:] + [word() for _ in range(4)]
    passage = [word() for _ in range(60)]
    texts += [" ".join(passage + [word() for _ in range(60)]) for _ in range(15)]
    texts += ["a b", "A  b", "a", "a", "b a", "", None, "one two three four", "one two three four five six seven eight", "one two three four five six seven eight nine"]
    texts += ["the very same words in each of them " * 3] * 40
    rng.shuffle(texts)
    return spark.createDataFrame([(i * 3 - 50, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_links_equal_all_pairs(families, docs, edge_docs, no_docs):
    check(families, M.CONTRACT)
    check(docs, M.CONTRACT)
    check(edge_docs, M.CONTRACT)
    assert M.near_duplicates(no_docs).count() == 0


def test_stage_rules_without_sent_lists(families, monkeypatch):
    monkeypatch.setattr(M, "SALT_ROWS", 2)
    got = check(families, M.NearRules(n_bands=40, band_rows=5, max_sent_ids=0, centres=2))
    kept = M.keep_first(families)
    assert kept.schema == families.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["kept"])


def test_keep_first_edges(edge_docs, no_docs):
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in M.keep_first(edge_docs).collect())
    assert [i for null, i in ids if not null] == [-9, 1, 2, 3, 4, 5, 5, 7] and ids[-1][0]
    assert M.keep_first(no_docs).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    for size in (8, 60, 900):
        agree, true = [], []
        for _ in range(40):
            both = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            cut = max(1, size // 10)
            a, b = both[cut:], np.delete(both, rng.choice(len(both), cut, replace=False))
            agree.append(np.mean(M.signature(a, 192) == M.signature(b, 192)))
            true.append(len(np.intersect1d(a, b)) / len(both))
        assert abs(np.mean(agree) - np.mean(true)) < 0.05


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["v"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
