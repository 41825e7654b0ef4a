"""Operator 7, personal data: information-theoretic sanitisation.

Rules find e-mail addresses, IP addresses, card and phone numbers; these values are the protected entities.
Corpus co-occurrence then estimates how strongly the words around an entity reveal it: over all documents,
``df(e)`` is the number that hold the entity, ``df(t)`` the number that hold the term, and ``c(e, t)`` the number
where the term stands within ``window`` words of the entity. A term discloses the entity if
``PMI(e, t) = log2(N * c / (df(e) * df(t)))`` reaches ``alpha`` times the entity's information ``log2(N / df(e))``,
that is if knowing the term leaves at most ``(1 - alpha)`` of the bits that hide the entity, and the pair occurs
in at least ``min_support`` documents. Disclosing terms beside an entity become spans of kind ``term``.

Work at scale: one pass finds spans and emits narrow rows (entity occurrences with the hashes of the words
around); counts are partial aggregates on (entity, term) and on term; joins are plain equi-joins, so a hot
entity or term is split by the engine. Document frequencies are counted for the terms with enough support
only: their hashes go to the tasks if there are at most ``MAX_SENT_TERMS`` of them, otherwise the words of all
documents are joined with them by shuffle. Both ways give the same counts.

Defined results: NULL and empty texts have no spans; rows repeated in the table count as documents of their
own and get equal results; a NULL doc_id is carried through; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.ASCII)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Hashes of so many terms (8 bytes each) may be sent to every task; beyond it the counts come from a join.
MAX_SENT_TERMS = 1_000_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the address pattern, found from each ``@`` outwards (linear in the text)."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def small(digits: str) -> bool:
    """A part of an IP address: at most 255, with any number of zeros in front."""
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of the rule matches, code points, end exclusive."""
    found = [(a, 0, z) for a, z in emails(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(small(p) for p in m.groups())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, k, z in spans)


def _entity(kind: int, text: str) -> str:
    """What is protected: the value itself, in one spelling."""
    return f"{KINDS[kind]}:{text.lower() if kind == 0 else text if kind == 1 else re.sub('[^0-9]', '', text)}"


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)


_WORDS = re.compile(C.WORD)


def _beside(text: str, spans: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int]]]:
    """For each span, the words up to ``window`` before and after it that touch no span, however long they and the
    white space between them are; linear in the text and the spans."""
    if not spans:
        return []
    words = [m.span() for m in _WORDS.finditer(text)]
    starts, ends = [s for s, _ in words], [e for _, e in words]
    begin, end = _united(spans)

    def free(s: int, e: int) -> bool:
        i = bisect_left(begin, e) - 1
        return i < 0 or end[i] <= s

    out = []
    for a, _, z in spans:
        before, after = bisect_left(ends, a), bisect_right(starts, z)  # a word glued to the span is neither
        out.append([w for w in (*words[max(0, before - window) : before], *words[after : after + window]) if free(*w)])
    return out


def _united(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of sorted spans, overlapping ones as one."""
    begin, end = [], []
    for a, _, z in spans:
        if end and a < end[-1]:
            end[-1] = max(end[-1], z)
        else:
            begin.append(a)
            end.append(z)
    return begin, end


_ROWS = "rid bigint, doc_id {id}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, base string, near array<struct<e: bigint, t: bigint, a: int, z: int>>"


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """One row per document: rule spans and, for each entity, the hashed words beside it."""
    schema = _ROWS.format(id=docs.schema["doc_id"].dataType.simpleString())
    near_type = pa.list_(pa.struct([("e", pa.int64()), ("t", pa.int64()), ("a", pa.int32()), ("z", pa.int32())]))
    names = [x.split()[0] for x in schema.split(", ")[:8]] + ["near"]

    def run(batches):
        rid = count(TaskContext.get().partitionId() << 40)
        for b in C.pieces(batches, "text"):
            rows: list[list] = [[] for _ in range(8)]
            for text in b.column("text").to_pylist():
                text = text or ""
                spans = rule_spans(text)
                base = joined([(a, KINDS[k], z) for a, k, z in spans])
                near, words, places = [], [], []
                for (a, k, z), beside in zip(spans, _beside(text, spans, window)):
                    e = _hash(_entity(k, text[a:z]))
                    words += [text[s:f] for s, f in beside]
                    places += [(e, s, f) for s, f in beside]
                if words:
                    hashes = C.as_signed(C.Words(pa.array(words), fold=True).hash)
                    near = [{"e": e, "t": int(t), "a": s, "z": f} for (e, s, f), t in zip(places, hashes)]
                values = [next(rid), *(sum(k == i for _, k, _ in spans) for i in range(4)), hashlib.sha256(base.encode()).hexdigest(), base, near]
                for column, v in zip(rows, values):
                    column.append(v)
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [near_type]
            made = [pa.array(r, t) for r, t in zip(rows, types)]
            yield pa.RecordBatch.from_arrays([made[0], b.column("doc_id"), *made[1:]], names=names)

    return docs.mapInArrow(run, schema)


def _term_counts_sent(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Documents that hold each of the given terms, looked up in the tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(terms))

    def run(batches):
        known = sent.value
        total = np.zeros(len(known), np.int64)
        for b in C.pieces(batches, "text"):
            w = C.Words(b.column("text"), fold=True)
            h = C.as_signed(w.hash)
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[at] == h
            once = np.unique(w.doc[hit].astype(np.int64) * len(known) + at[hit])  # a document counts a term once
            total += np.bincount(once % len(known), minlength=len(known))
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(known[some]), pa.array(total[some])], names=["t", "n"])

    return docs.select("text").mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("df_t"))


def _term_counts_joined(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The same by a shuffle join of every document's words with the terms."""

    def run(batches):
        for b in C.pieces(batches, "text"):
            w = C.Words(b.column("text"), fold=True)
            pairs = np.unique(np.stack([w.doc.astype(np.int64), C.as_signed(w.hash)]), axis=1) if len(w.hash) else np.zeros((2, 0), np.int64)
            t, n = np.unique(pairs[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(n.astype(np.int64))], names=["t", "n"])

    words = docs.select("text").mapInArrow(run, "t bigint, n bigint")
    return words.join(terms, "t", "left_semi").groupBy("t").agg(F.sum("n").alias("df_t"))


def find_personal_data(
    docs: DataFrame, window: int = 8, alpha: float = 0.75, min_support: int = 3, max_sent_terms: int = MAX_SENT_TERMS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: rule counts, digest of the rule spans, all spans (kind ``term`` for disclosing terms)."""
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows = C.saved(_scan(own, window), "pii-rows")
    near = rows.where(F.size("near") > 0).select("rid", F.explode("near").alias("x")).select("rid", "x.*")
    pairs = C.saved(
        near.select("rid", "e", "t").distinct().groupBy("e", "t").agg(F.count("*").alias("c")).where(F.col("c") >= min_support), "pii-pairs"
    )
    terms = pairs.select("t").distinct()
    few = [r["t"] for r in terms.limit(max_sent_terms + 1).collect()]
    if not few:
        disclosing = pairs.select("e", "t")
    else:
        df_t = _term_counts_sent(own, np.array(few, np.int64)) if len(few) <= max_sent_terms else _term_counts_joined(own, terms)
        df_e = near.select("rid", "e").distinct().groupBy("e").agg(F.count("*").alias("df_e"))
        n = rows.count()
        pmi = F.log2(F.lit(float(n)) * F.col("c") / (F.col("df_e") * F.col("df_t")))
        information = F.log2(F.lit(float(n)) / F.col("df_e"))
        disclosing = pairs.join(df_e, "e").join(df_t, "t").where((information > 0) & (pmi >= alpha * information)).select("e", "t")
    spans = near.join(disclosing, ["e", "t"]).groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("a", "z"))).alias("terms"))
    found = rows.drop("near").join(spans, "rid", "left")
    base = F.transform(
        F.filter(F.split("base", ","), lambda s: s != ""),
        lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("a"), F.array_position(F.array(*map(F.lit, KINDS)), F.split(s, ":")[0]).cast("int").alias("k"), s.alias("s")),
    )
    extra = F.transform(
        F.coalesce("terms", F.array().cast("array<struct<a:int,z:int>>")),
        lambda x: F.struct(x["a"].alias("a"), F.lit(len(KINDS) + 1).alias("k"), F.concat_ws(":", F.lit("term"), x["a"], x["z"]).alias("s")),
    )
    listed = F.array_join(F.transform(F.array_sort(F.concat(base, extra)), lambda x: x["s"]), ",")
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", listed.alias("spans"), F.coalesce(F.size("terms"), F.lit(0)).cast("bigint").alias("n_term")
    )


def sanitised(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (one row per id) with each span of ``find_personal_data`` replaced: rule spans by their kind in
    brackets, disclosing terms by ``[TERM]``. All columns keep their names and types."""
    marked = spans.select(F.col("doc_id").alias("__id"), F.col("spans").alias("__spans"))
    names = docs.columns
    both = docs.join(marked, docs[id_col].eqNullSafe(F.col("__id")), "left").drop("__id")

    def clean(text, listed):
        if text is None or not listed:
            return text
        out, done = [], 0
        for kind, a, z in (x.split(":") for x in listed.split(",")):
            if int(a) >= done:
                out += [text[done : int(a)], f"[{kind.upper()}]"]
            done = max(done, int(z))
        return "".join(out) + text[done:]

    def run(batches):
        for b in C.pieces(batches, text_col):
            texts = pa.array([clean(t, s) for t, s in zip(b.column(text_col).to_pylist(), b.column("__spans").to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([texts if x == text_col else b.column(x) for x in names], names=names)

    return both.mapInArrow(run, docs.schema)


def op7_information_theoretic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(C.read_documents(spark, sf_dir))
