import hashlib
import math
import re

from pyspark.sql import functions as F

from tillroll.llm import pii as P

WORD = re.compile("[^\x20\x09-\x0d]+")


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (1 + i % 2)
        s += x // 10 + x % 10
    return s % 10 == 0


def base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def entity(k, s):
    return (k, s.lower() if k == 0 else s if k == 1 else re.sub("[^0-9]", "", s))


def fold(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def brute(rows, window=8, alpha=0.75, support=3):
    near, df_e, df_t, c = [], {}, {}, {}
    for text in rows:
        t = text or ""
        spans = base(t)
        words = [(m.start(), m.end()) for m in WORD.finditer(t)]
        for w in {fold(t[a:z]) for a, z in words}:
            df_t[w] = df_t.get(w, 0) + 1
        mine = []
        for a, k, z in spans:
            # words that do not touch the span's own word, nearest first
            left = [w for w in words if w[1] < a][-window:]
            right = [w for w in words if w[0] > z][:window]
            for s, e in left + right:
                if not any(s < z2 and a2 < e for a2, _, z2 in spans):
                    mine.append((entity(k, t[a:z]), fold(t[s:e]), s, e))
        near.append((spans, mine))
        for e in {x[0] for x in mine}:
            df_e[e] = df_e.get(e, 0) + 1
        for p in {x[:2] for x in mine}:
            c[p] = c.get(p, 0) + 1
    n, out = len(rows), []
    for spans, mine in near:
        extra = set()
        for e, w, s, z in mine:
            info = math.log2(n / df_e[e])
            if c[e, w] >= support and info > 0 and math.log2(n * c[e, w] / (df_e[e] * df_t[w])) >= alpha * info:
                extra.add((s, 4, z))
        text = ",".join(f"{P.KINDS[k]}:{a}:{z}" for a, k, z in spans)
        every = ",".join(f"{(*P.KINDS, 'term')[k]}:{a}:{z}" for a, k, z in sorted([*spans, *extra]))
        out.append(([sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(text.encode()).hexdigest(), every))
    return out


def check(df, **params):
    rows = df.collect()
    got = P.find_personal_data(df, **params).collect()
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1:]))
    mine = sorted(((r["doc_id"], [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]], r["base_sha256"], r["spans"]) for r in got), key=key)
    want = sorted(((r["doc_id"], *b) for r, b in zip(rows, brute([r["text"] for r in rows]))), key=key)
    assert mine == want
    return mine


EXAMPLES = [
    "a.b@c.d@e.f x@y z@q.r. <A@B-c.de> @no.pe .@a.b. é@x.yz",
    "1.2.3.4.5.6.7.8 256.1.1.1 10.0.0.1a 999999.1.1.1.2 01.02.003.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 378282246310005 1 2 3 12345678901234567890123 4012888888881881",
    "+1 (415) 555-0100 +49-30-1234567890 +12 +1234567890123456 x+1 (2)3",
    None,
    "",
    "0" * 400 + "1.2.3.4 " + "0" * 4000 + "." + "0" * 300 + "256.1.1 1.2.3.0000255 1.2.3.256 1.2.3.1000",
]


def test_rules_equal_brute_force(spark, docs, edge_docs, no_docs):
    check(spark.createDataFrame(list(enumerate(EXAMPLES)), "doc_id bigint, text string"))
    check(docs)
    check(edge_docs)
    assert P.find_personal_data(no_docs).count() == 0


def test_terms_that_reveal_an_entity(spark):
    rows = [(i, f"please ask zarquon the keeper at zar@quon.org about document n{i} " + "filler words of any kind " * 3) for i in range(5)]
    rows += [(100 + i, f"please ask anybody at office{i}@example.org about document m{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = check(df)
    terms = {t for _, _, _, s in found for t in s.split(",") if t.startswith("term")}
    assert "term:11:18" in terms  # zarquon
    assert not any("term" in s for i, _, _, s in found if i >= 100)
    assert check(df, max_sent_terms=0) == found  # the other way to the same counts
    clean = {r["doc_id"]: r["text"] for r in P.sanitised(df, P.find_personal_data(df)).collect()}
    assert "zarquon" not in clean[0] and "[EMAIL]" in clean[0] and clean[100].startswith("please ask anybody at [EMAIL] about")


def test_long_words_and_blanks_beside_an_entity(spark):
    """600 blanks, a word of 600 characters: both are seen."""
    word = "q" * 600
    rows = [(i, f"{word} jones" + " " * 600 + f"jo@nes.org\n\n{word[:-1]} n{i}") for i in range(4)]
    rows += [(100 + i, f"nobody at office{i}@example.org m{i}") for i in range(40)]
    found = check(spark.createDataFrame(rows, "doc_id bigint, text string"))
    mine = [s for i, _, _, s in found if i < 4]
    assert all("term:0:600" in s and "term:601:606" in s and s.count("term") == 3 for s in mine)


def test_many_addresses_in_one_text():
    """100,000 addresses: in time linear in their number."""
    text = " ".join(f"n{i} a{i}@b{i % 7}.org" for i in range(100_000))
    spans = P.rule_spans(text)
    beside = P._beside(text, spans, 8)
    assert len(spans) == 100_000 and len(beside[50_000]) == 8
