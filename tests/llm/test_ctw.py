import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import common as C
from tillroll.llm import ctw as T

WORD = re.compile("[^\x20\x09-\x0d]+")


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sequence(text):
    return b"".join(w.encode() + b" " for w in WORD.findall(fold(text))) + b"\n"


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Tree:
    """Context-tree weighting by recursion over contexts (nearest byte first)."""

    def __init__(self, texts, depth, max_contexts):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        self.total, self.next = Counter(), defaultdict(set)
        size = 0
        for t in texts:
            s = b"\n" * depth + sequence(t)
            for i in range(depth, len(s)):
                size += 1
                for d in range(depth + 1):
                    c = s[i - d : i][::-1]
                    self.total[c] += 1
                    if d:
                        self.next[c[:-1]].add(c)
                    for j in range(8):
                        self.n[c, j, s[i] >> (8 - j)][(s[i] >> (7 - j)) & 1] += 1
        self.least = max(1, size // max_contexts)
        self.memo = {}

    def log_pw(self, c, j, p):
        if (c, j, p) not in self.memo:
            pe = kt(*self.n[c, j, p])
            if len(c) < self.depth:
                pe = np.logaddexp(pe, sum(self.log_pw(x, j, p) for x in self.next[c] if (x, j, p) in self.n)) - math.log(2)
            self.memo[c, j, p] = pe
        return self.memo[c, j, p]

    def one(self, context, j, p):
        """Probability that the next decision is 1."""
        kept = [context[:d][::1] for d in range(self.depth + 1)]
        s, r, out = 0.0, 1.0, 0.5
        for c in kept:
            if len(c) and self.total[c] < self.least or (c, j, p) not in self.n:
                break
            a, b = self.n[c, j, p]
            here = (b + 0.5) / (a + b + 1)
            out = s + r * here
            beta = 1.0 if len(c) == self.depth else math.exp(kt(a, b) - math.log(2) - self.log_pw(c, j, p))
            s, r = s + r * beta * here, r * (1 - beta)
        return out

    def score(self, text):
        s, total = b"\n" * self.depth + sequence(text), 0.0
        for i in range(self.depth, len(s)):
            context = s[i - self.depth : i][::-1]
            for j in range(8):
                p = self.one(context, j, s[i] >> (8 - j))
                total += math.log10(p if (s[i] >> (7 - j)) & 1 else 1 - p)
        return total


def split(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def base(rows):
    train = Counter()
    for i, t in rows:
        if not split(i):
            train.update(WORD.findall(fold(t)))
            train[None] += 1
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        tokens = [*WORD.findall(fold(t)), None]
        out.append((i, split(i), len(tokens), sum(train[x] > 0 for x in tokens), n, sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens)))
    return out


def check(df, rules=T.TreeRules(), tree=True):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = T.lm_scores(df, rules).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    want = sorted(base(rows), key=key)
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=key)
    assert [m[:5] for m in mine] == [w[:5] for w in want]
    np.testing.assert_allclose([m[5] for m in mine], [w[5] for w in want], rtol=1e-9)
    if tree:
        model = Tree([t for i, t in rows if not split(i)], rules.depth, rules.max_contexts)
        text = sorted(zip(want, sorted(((i, None, None, None, None, b[5], t) for (i, t), b in zip(rows, base(rows))), key=key)), key=lambda x: key(x[0]))
        np.testing.assert_allclose([m[6] for m in mine], [model.score(x[1][6]) for x in text], rtol=1e-5)
    return got


@pytest.mark.parametrize("rules", [T.TreeRules(depth=3, max_contexts=40), T.TreeRules(depth=2, max_contexts=1 << 16, max_sent_words=0)])
def test_equal_recursion(spark, docs, rules):
    check(docs.where("n_chars < 900").limit(12).selectExpr("doc_id", "text"), rules)


def test_base_and_edges(docs, edge_docs, no_docs):
    a = check(docs, T.TreeRules(), tree=False)
    b = check(docs, T.TreeRules(max_sent_words=0), tree=False)
    assert {(r["doc_id"], round(r["score"], 6)) for r in a} == {(r["doc_id"], round(r["score"], 6)) for r in b}
    check(edge_docs, tree=False)
    assert T.lm_scores(no_docs).count() == 0


def chunks(df, held_out):
    own = df.selectExpr("doc_id", f"{str(held_out).lower()} as held_out", "text")
    return C.saved(T.chunked(own, T.TreeRules()), "test-chunks")


def test_prediction_is_a_distribution_and_learns(spark):
    texts = [(i, "the cat sat on the mat and the dog sat on the log " * 5) for i in range(30)] + [(100 + i, "zq xv jw kf " * 20) for i in range(0, 40)]
    df = spark.createDataFrame([(i, t) for i, t in texts if not split(i) or i < 100], "doc_id bigint, text string")
    model, words = T.train(chunks(df.where("doc_id < 100"), False), T.TreeRules())
    assert abs((10.0 ** model.values.astype(float)).sum(axis=1) - 1).max() < 1e-4
    rules = T.TreeRules()
    probe = spark.createDataFrame([(1, True, "the dog sat on the mat"), (2, True, "zq xv jw kf zq xv jw k")], "doc_id bigint, held_out boolean, text string")
    s = {r["doc_id"]: r["score"] for r in T.score(chunks(probe, True), model, words, rules, "bigint").collect()}
    assert s[1] > -8 and s[2] < -30


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.5, 8, 100.5, 1e6, 1e12])
    np.testing.assert_allclose(T._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_stream_is_one_to_one():
    texts = ["A b\tc", "", None, " x ", "Ünï É"]
    w = C.Words(pa.array(texts), fold=True)
    data, text, places = T.stream(w, 3)
    assert [bytes(data[places[text == i]]) for i in range(len(texts))] == [sequence(t) for t in texts]
    assert all((data[places[text == i][0] - np.arange(1, 4)] == 10).all() for i in range(len(texts)))


def test_every_context_of_the_training_texts_is_used(spark):
    filler = "the cat sat on the mat and the dog sat on the log " * 3000
    train = [i for i in range(40) if not split(i)]
    probe = next(i for i in range(100, 200) if split(i))
    rows = [*((i, filler) for i in train[:3]), (train[3], "xylo quartz vex"), (probe, "xylo quartz vex")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    score = lambda rules: {r["doc_id"]: r["score"] for r in T.lm_scores(df, rules).collect()}[probe]
    every = score(T.TreeRules(max_contexts=1 << 62))
    assert score(T.TreeRules()) == every > score(T.TreeRules(max_contexts=1 << 16)) + 1


def test_chunks_give_the_same_scores(docs):
    some = docs.where("n_chars < 900").limit(12).selectExpr("doc_id", "text")
    rules = T.TreeRules(depth=3, max_contexts=1 << 62, chunk_bytes=700)
    assert T.chunked(some.withColumn("held_out", T.held_out(some.doc_id)), rules).select("chunk").distinct().count() > 3
    check(some, rules)


def test_default_depth_equals_recursion(docs):
    check(docs.where("n_chars between 100 and 700").limit(8).selectExpr("doc_id", "text"), T.TreeRules(max_contexts=1 << 62))


def test_default_depth_sees_six_bytes(spark):
    """What follows is told by the sixth byte back only."""
    train = [i for i in range(60) if not split(i)][:40]
    probe = [i for i in range(100, 300) if split(i)][:2]
    rows = [(i, ("a" if n % 2 else "b") + "zzzzz" + ("c" if n % 2 else "d")) for n, i in enumerate(train)]
    rows += [(probe[0], "azzzzzc"), (probe[1], "azzzzzd")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    s = {r["doc_id"]: r["score"] for r in T.lm_scores(df).collect()}
    assert s[probe[0]] > s[probe[1]] + 0.5
