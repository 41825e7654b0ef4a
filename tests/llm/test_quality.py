import re

from tillroll.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text, rules):
    t = text or ""
    words = [(m.start(), m.end()) for m in WORD.finditer(t)]
    toks = [t[a:b] for a, b in words]

    def windows(n):
        return [tuple(toks[i : i + n]) for i in range(len(toks) - n + 1)]

    def first_and_later(n):
        ws, count, seen, both, later = windows(n), {}, set(), set(), set()
        for x in ws:
            count[x] = count.get(x, 0) + 1
        for i, x in enumerate(ws):
            if count[x] > 1:
                both.update(range(i, i + n))
            if x in seen:
                later.update(range(i, i + n))
            seen.add(x)
        return both, later

    out = {"n_words": len(toks), "word_chars": sum(map(len, toks)), "n_symbols": sum(c in "#*$%&|<>" for c in t)}
    seen, dup, dup_chars = set(), 0, 0
    for line in t.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup += 1
                dup_chars += sum(len(x) for x in WORD.findall(line))
            seen.add(line)
    out["n_dup_lines"], out["dup_line_chars"] = dup, dup_chars
    out["n_repeat_words"] = len(first_and_later(8)[0])
    out["base_failed"] = len(toks) < 20 or 100 * out["n_repeat_words"] > 30 * len(toks)
    bad = dup_chars > rules.max_dup_line_chars * out["word_chars"]
    for n, limit in rules.ngram_chars.items():
        out[f"dup_{n}gram_chars"] = sum(len(toks[i]) for i in first_and_later(n)[1])
        bad |= out[f"dup_{n}gram_chars"] > limit * out["word_chars"]
    out["kept"] = not (out["base_failed"] or bad)
    return out


def same(df, rules=Q.RepetitionRules()):
    got = sorted(((r["doc_id"], r) for r in Q.repetition_quality(df).collect()), key=lambda x: (x[0] is None, x[0] or 0))
    want = sorted(((r["doc_id"], brute(r["text"], rules)) for r in df.collect()), key=lambda x: (x[0] is None, x[0] or 0))
    assert [g[0] for g in got] == [w[0] for w in want]
    for (i, g), (_, w) in zip(got, want):
        assert {k: g[k] for k in w} == w, i


def test_measures_equal_brute_force(docs):
    same(docs)


def test_edge_cases(edge_docs):
    same(edge_docs)


def test_kept_rows_are_whole(edge_docs, no_docs):
    kept = Q.keep_documents(edge_docs)
    assert kept.schema == edge_docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 8]
    assert Q.keep_documents(no_docs).count() == 0 and Q.repetition_quality(no_docs).count() == 0


def test_repetition_is_rejected_and_prose_kept(spark):
    prose = " ".join(f"word{i} of{i % 7} text{i * 31 % 97}" for i in range(60))
    rows = [(1, prose), (2, "buy now today " * 40), (3, "\n".join(["a repeated line of boilerplate text"] * 20))]
    got = {r["doc_id"]: r["kept"] for r in Q.repetition_quality(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: True, 2: False, 3: False}
