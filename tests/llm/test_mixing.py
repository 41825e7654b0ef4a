import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillroll.llm import mixing as M

WORD = re.compile("[^\x20\x09-\x0d]+")


def solve(shares, mix, total):
    """Plain bisection of the exponent."""
    def weights(a):
        z = sum(p**a for p in shares)
        return [p**a / z for p in shares]

    def scale(a):
        return mix.budget_tokens / total if mix.budget_tokens is not None else max(p / w for p, w in zip(shares, weights(a)))

    def met(a):
        w = weights(a)
        if mix.entropy_bits is not None:
            return -sum(x * math.log2(x) for x in w) <= mix.entropy_bits
        return max(scale(a) * x / p for x, p in zip(w, shares)) <= mix.max_repeats

    lo, hi = 0.0, 32.0 if mix.entropy_bits is not None else 1.0
    if met(lo):
        hi = lo
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if met(mid) else (mid, hi)
    return weights(hi), scale(hi)


def brute(rows, keys, mix):
    """(id, source) -> times shown."""
    tokens, members = Counter(), defaultdict(list)
    for i, s, t in rows:
        n = len(WORD.findall(t or ""))
        tokens[s] += n
        members[s].append((i, n))
    total = sum(tokens.values())
    own = [s for s in tokens if tokens[s]]
    w, scale = solve([tokens[s] / total for s in own], mix, total)
    out = Counter()
    for s in tokens:
        r = scale * total * w[own.index(s)] / tokens[s] if tokens[s] else 1.0
        r = round(r) if abs(r - round(r)) < 1e-6 else r
        whole, so_far = math.floor(r), 0
        rest = (r - whole) * tokens[s]
        by_key = defaultdict(list)
        for i, n in members[s]:
            by_key[keys(whole, i)].append((i, n))
            out[i, s] += whole
        for k in sorted(by_key):
            so_far += sum(n for _, n in by_key[k])
            if rest <= 0 or so_far > rest:
                break
            for i, _ in by_key[k]:
                out[i, s] += 1
    return +out


@pytest.mark.parametrize("mix", [M.Mixture(), M.Mixture(max_repeats=4, budget_tokens=150_000), M.Mixture(max_repeats=None, entropy_bits=3.0, budget_tokens=60_000), M.Mixture(max_repeats=1.0)])
def test_times_shown_equal_brute_force(spark, docs, mix):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    ids = docs.select("doc_id").distinct()
    cache = {(r["e"], r["doc_id"]): r["k"] for r in ids.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(400))).alias("e")).withColumn("k", M._key(mix.seed, F.col("e"), F.col("doc_id"))).collect()}
    got = M.mixed(docs, mix)
    assert got.schema == docs.schema
    assert Counter((r["doc_id"], r["source"]) for r in got.collect()) == brute(rows, lambda e, i: cache[e, i], mix)


def test_no_document_is_lost_without_a_budget(docs):
    got = M.mixed(docs, place=True).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()}
    assert max(Counter(r["doc_id"] for r in got).values()) <= 2
    blocks = Counter((r["source"], r["block"], r["block_key"]) for r in got)
    assert max(blocks.values()) == 1


def test_edge_cases(edge_docs, no_docs):
    got = Counter(r["doc_id"] for r in M.mixed(edge_docs).collect())
    assert set(got) == {r["doc_id"] for r in edge_docs.collect()} and got[5] >= 2
    assert M.mixed(edge_docs).schema == edge_docs.schema
    assert M.mixed(no_docs).count() == 0
    empty = edge_docs.where("text is null or text = ''")
    assert M.mixed(empty).count() == empty.count()
