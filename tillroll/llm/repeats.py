"""Operator 1, substring dedup: paragraph MinHash banding.

Paragraphs are lines of at least ``min_words`` words. Equal paragraphs (A-Z folded) are one class; classes get a
MinHash over 5-word shingles whose bands are tuned for recall (0.997 at the threshold). Paragraphs that collide
in a band are joined, the exact Jaccard similarity of their shingle sets is verified, and removals are clustered
by connected components: in each component the document with the smallest id keeps its paragraph.

A passage that repeats inside longer paragraphs leaves their similarity low, so each text also has embedded
paragraphs: stretches of ``min_words`` words that begin at anchors chosen by content (the smallest window hash
of every ``anchor_window`` consecutive windows), whatever the line breaks. Any passage of
``min_words + anchor_window - 1`` = 50 words or more that two texts share holds the same anchor in both. A shared
anchor is a candidate only: all stretches that begin within ``anchor_window - 1`` words of one are compared, which
are all of a shared passage (its anchors are no farther apart, its ends no farther from an anchor), so the whole
passage is found. Equal stretches are a class of their own; again the smallest id keeps them. A shared passage of
``min_words`` to 49 words that is no paragraph is found only if it holds an anchor of both texts. Stretches inside a
paragraph that equals one of a smaller id are left out: the paragraph is a removal already, and that id holds them too.

Work at scale: one pass makes narrow rows (hashes and offsets); classes and buckets are partial aggregates; a
removal list meets its paragraphs in an equi-join that the engine splits for a hot passage; candidate edges are
star-shaped; full sets are computed again for the classes with candidates only. Stretches move as packed arrays: a
chunk of texts asks once for each of its distinct stretches (sorted hashes with the smallest id of the chunk), a task
finds the smallest id of all chunks for a range of hashes, and one id for each asked stretch goes back to the chunk,
where runs of stretches become spans. A hot stretch is one entry a chunk.

Defined results: NULL and empty texts have no paragraphs; a passage repeated inside one document only is left;
rows repeated under one id are one document; rows without an id count as one document, smaller than all others;
an empty table gives an empty result; ``without_repeats`` passes other columns unchanged, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .minhash import NearRules, star_components

#: Smaller than any id, and in place of an id where a stretch has one holder.
NO_ID, NOT_SHARED = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class RepeatRules:
    min_words: int = 20
    anchor_window: int = 31
    #: Banding and verification of whole paragraphs: 1 - (1 - 0.8**3)**8 = 0.997.
    near: NearRules = NearRules(shingle=5, similarity_pct=80, n_bands=8, band_rows=3)
    #: Stretches that a chunk holds, and about so many (before chunks reduce them) that one range of hashes gets.
    held: int = 1_000_000
    part_stretches: int = 1 << 18


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each n consecutive values; the last n - 1 places are cut off."""
    if len(values) < n:
        return values[:0]
    width = 1
    while 2 * width <= n:
        values = pick(values[:-width], values[width:])
        width *= 2
    return pick(values[: len(values) - (n - width)], values[n - width :]) if n > width else values


def anchors(hashes: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """Indices of the windows that have the smallest hash of some n consecutive windows of one text."""
    least = _sliding(hashes, n, np.minimum)
    if not len(least):
        return np.zeros(0, np.int64)
    inside = text_of[: len(least)] == text_of[n - 1 :]
    least = np.where(inside, least, 0)
    # a window is chosen if it equals the minimum of a run that covers it; minima never exceed the window
    reach = _sliding(np.concatenate([np.zeros(n - 1, np.uint64), least, np.zeros(n - 1, np.uint64)]), n, np.maximum)
    return np.flatnonzero((reach == hashes) & (reach > 0))


class Paragraphs:
    """The long enough lines of a batch of texts: text, first word, words, hashes; shingles with their paragraph."""

    def __init__(self, w: C.Words, min_words: int):
        breaks = np.concatenate([[0], np.cumsum(w.data == 0x0A)])
        line = breaks[w.start]
        new = np.ones(len(w.start), bool)
        new[1:] = (w.doc[1:] != w.doc[:-1]) | (line[1:] != line[:-1])
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(w.start)))
        long = length >= min_words
        self.first, self.length = first[long], length[long]
        self.doc = w.doc[self.first]
        self.h1, self.h2 = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.of_word = np.full(len(w.start), -1, np.int64)
        if len(self.first):
            place = np.arange(self.length.sum()) - np.repeat(np.cumsum(self.length) - self.length, self.length)
            at = np.repeat(self.first, self.length) + place
            self.of_word[at] = np.repeat(np.arange(len(self.first)), self.length)
            starts = np.cumsum(self.length) - self.length
            powers = C._powers(int(self.length.max()))
            self.h1 = C.mix64(np.add.reduceat(w.hash[at] * powers[place], starts))
            self.h2 = C.mix64(np.add.reduceat(C.salted(w.hash[at], 1) * powers[place], starts))

    def shingles(self, w: C.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, paragraph of each) in order."""
        h, at = w.shingles(n)
        own = (self.of_word[at] >= 0) & (self.of_word[at] == self.of_word[at + n - 1])
        return h[own], self.of_word[at[own]]


def band_keys(hashes: np.ndarray, paragraph: np.ndarray, n_paragraphs: int, near: NearRules) -> np.ndarray:
    """(paragraphs, bands) bucket keys of the MinHash; every paragraph has a shingle."""
    if not n_paragraphs:
        return np.zeros((0, near.n_bands), np.uint64)
    starts = np.searchsorted(paragraph, np.arange(n_paragraphs))
    odd = C.mix64(np.arange(1, near.bins + 1, dtype=np.uint64)) | np.uint64(1)
    keys = np.zeros((n_paragraphs, near.n_bands), np.uint64) + np.arange(near.n_bands, dtype=np.uint64)
    for k in range(near.bins):
        least = np.minimum.reduceat(hashes * odd[k], starts)
        band = k // near.band_rows
        keys[:, band] = C.mix64(keys[:, band] * C._BASE + least)
    return keys


def _lists(counts: np.ndarray, columns: dict[str, pa.Array]) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(columns.values()), list(columns)))


def scan(docs: DataFrame, rules: RepeatRules) -> DataFrame:
    """``docs`` (doc, t, text) -> doc, t, paragraphs, stretches; offsets a to z in code points, end exclusive."""
    near = rules.near
    schema = (
        "doc bigint, t bigint, paragraphs array<struct<a: int, z: int, h1: bigint, h2: bigint, bands: array<bigint>>>, "
        "stretches array<struct<a: int, z: int, h1: bigint, h2: int>>"
    )

    def run(batches):
        for b in C.pieces(batches, "text"):
            w = C.Words(b.column("text"), fold=True)
            cp = w.code_points()
            base = cp[w.bounds[:-1]]
            a = (cp[w.start] - base[w.doc]).astype(np.int32)
            z = (cp[w.end] - base[w.doc]).astype(np.int32)
            p = Paragraphs(w, rules.min_words)
            sh, of = p.shingles(w, near.shingle)
            keys = band_keys(sh, of, len(p.first), near)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(p.first) + 1, dtype=np.int32) * near.n_bands), pa.array(C.as_signed(keys.reshape(-1))))
            last = p.first + p.length - 1
            paragraphs = _lists(
                np.bincount(p.doc, minlength=w.n_docs),
                {"a": pa.array(a[p.first]), "z": pa.array(z[last]), "h1": pa.array(C.as_signed(p.h1)), "h2": pa.array(C.as_signed(p.h2)), "bands": bands},
            )
            h, at = w.shingles(rules.min_words)
            chosen = anchors(h, w.doc[at], rules.anchor_window)
            at, h = at[chosen], h[chosen]
            check = _stretch_check(w, at, rules.min_words)
            stretches = _lists(
                np.bincount(w.doc[at], minlength=w.n_docs),
                {"a": pa.array(a[at]), "z": pa.array(z[at + rules.min_words - 1] if len(at) else a[:0]), "h1": pa.array(C.as_signed(h)), "h2": pa.array(check)},
            )
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("t"), paragraphs, stretches], names=["doc", "t", "paragraphs", "stretches"])

    return docs.mapInArrow(run, schema)


def _stretch_check(w: C.Words, at: np.ndarray, n: int) -> np.ndarray:
    return (C.salted(w.hash[at], 3) + C.salted(w.hash[at + n - 1], 4)).astype(np.uint32).view(np.int32) if len(at) else np.zeros(0, np.int32)


def _around(docs: DataFrame, rules: RepeatRules, bits: int) -> DataFrame:
    """All stretches that begin close to an anchor of ``docs`` (doc, t, text, places, copied), without those inside a
    copied paragraph. Two kinds of rows of a chunk: what it asks for, by the highest ``bits`` bits of the hash (part,
    base: place of its first stretch among the chunk's; h, c, lo, more), and what its texts hold (doc, t; a, z, at:
    place of each stretch among the chunk's)."""
    n, reach = rules.min_words, rules.anchor_window - 1
    names = ["chunk", "base", "part", "h", "c", "lo", "more", "doc", "t", "a", "z", "at"]

    def rows(chunk: int, **columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        all_ = {"chunk": pa.array(np.full(size, chunk))} | {x: columns[x] if x in columns else pa.nulls(size, kinds[x]) for x in names[1:]}
        return pa.RecordBatch.from_arrays(list(all_.values()), names=names)

    kinds = {x: pa.binary() for x in names} | dict.fromkeys(("chunk", "base", "doc", "t"), pa.int64()) | {"part": pa.int32()}

    def flush(chunk: int, held: list) -> Iterator[pa.RecordBatch]:
        h, c, doc = (np.concatenate([x[i] for x in held]) for i in range(3))
        order = np.lexsort((c, h))
        h, c, doc = h[order], c[order], doc[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
        at = np.empty(len(order), np.uint32)
        at[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        lo = np.minimum.reduceat(doc, starts)
        more = (np.maximum.reduceat(doc, starts) != lo).astype(np.uint8)
        h, c = h[starts], c[starts]
        part = (h >> np.uint64(64 - bits)).astype(np.int32)
        cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
        base = np.concatenate([[0], cuts])
        yield rows(chunk, base=pa.array(base), part=pa.array(part[base]), **{x: _packed(np.split(v, cuts), steps=x == "h") for x, v in (("h", h), ("c", c), ("lo", lo), ("more", more))})
        done = 0
        for _, _, _, ids, t, a, z, sizes in held:
            ends = np.cumsum(sizes)[:-1]
            own = at[done : done + len(a)]
            done += len(a)
            yield rows(chunk, doc=ids, t=t, a=_packed(np.split(a, ends), steps=True), z=_packed(np.split(z - a, ends)), at=_packed(np.split(own, ends)))

    def run(batches):
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for b in C.pieces(batches, "text"):
            w = C.Words(b.column("text"), fold=True)
            cp = w.code_points()
            base = cp[w.bounds[:-1]]
            a = (cp[w.start] - base[w.doc]).astype(np.int32)
            z = (cp[w.end] - base[w.doc]).astype(np.int32)
            h, at = w.shingles(n)
            doc = w.doc[at]
            place = lambda of, x: (of.astype(np.int64) << 32) | x
            places = place(doc, a[at])
            of = np.repeat(np.arange(w.n_docs), b.column("places").value_lengths().to_numpy())
            anchor = np.searchsorted(places, place(of, b.column("places").flatten().to_numpy()))
            mark = np.zeros(len(at) + 1, np.int64)
            np.add.at(mark, np.maximum(anchor - reach, np.searchsorted(doc, of)), 1)
            np.add.at(mark, np.minimum(anchor + reach + 1, np.searchsorted(doc, of, side="right")), -1)
            near = np.cumsum(mark)[:-1] > 0
            # stretches that begin in a copied paragraph at n words or more before its end
            spans = b.column("copied")
            of = np.repeat(np.arange(w.n_docs), spans.value_lengths().fill_null(0).to_numpy())
            spans = spans.flatten()
            first = np.searchsorted(places, place(of, spans.field("a").to_numpy()))
            past = np.searchsorted(place(doc, z[at + n - 1] if len(at) else a[:0]), place(of, spans.field("z").to_numpy()), side="right")
            mark = np.zeros(len(at) + 1, np.int64)
            np.add.at(mark, first, 1)
            np.add.at(mark, np.maximum(past, first), -1)
            near = np.flatnonzero(near & (np.cumsum(mark)[:-1] == 0))
            if not len(near):
                continue
            at, doc = at[near], doc[near]
            of, sizes = np.unique(doc, return_counts=True)
            ids = b.column("doc").to_numpy()
            held.append((h[near], _stretch_check(w, at, n).view(np.uint32).astype(np.uint16), ids[doc], b.column("doc").take(pa.array(of)), b.column("t").take(pa.array(of)), a[at], z[at + n - 1], sizes))
            size += len(at)
            if size >= rules.held:
                yield from flush(chunk, held)
                chunk, held, size = chunk + 1, [], 0
        if held:
            yield from flush(chunk, held)

    schema = "chunk bigint, base bigint, part int, h binary, c binary, lo binary, more binary, doc bigint, t bigint, a binary, z binary, at binary"
    return docs.select("doc", "t", "text", "places", "copied").mapInArrow(run, schema)


def _packed(arrays: list[np.ndarray], steps: bool = False) -> pa.Array:
    """One binary value for each array: its bytes place by place (the high ones of small numbers are a run of zeros),
    compressed. ``steps``: the differences of neighbours, for numbers in order."""
    values = [np.diff(x, prepend=x.dtype.type(0)) if steps else x for x in arrays]
    return pa.array([zlib.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1) for x in values], pa.binary())


def _unpacked(value: bytes, kind, steps: bool = False) -> np.ndarray:
    kind = np.dtype(kind)
    x = np.ascontiguousarray(np.frombuffer(zlib.decompress(value), np.uint8).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(x, dtype=kind) if steps else x


def _smallest_ids(asked: DataFrame) -> DataFrame:
    """(chunk, base, kept): for each stretch that a chunk asks for the smallest id that holds it, ``NOT_SHARED`` where
    no other id does. One task holds the distinct stretches of the chunks for one range of hashes."""

    def answer(table: pa.Table) -> pa.Table:
        read = lambda x, kind: [_unpacked(v, kind, steps=x == "h") for v in table[x].to_pylist()]
        h, c, lo, more = read("h", np.uint64), read("c", np.uint16), read("lo", np.int64), read("more", np.uint8)
        sizes = np.cumsum([len(x) for x in h])[:-1]
        h, c, lo, more = (np.concatenate(x) for x in (h, c, lo, more))
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
        starts = np.flatnonzero(new)
        least, most = np.minimum.reduceat(lo[order], starts), np.maximum.reduceat(lo[order], starts)
        shared = (least != most) | (np.maximum.reduceat(more[order], starts) > 0)
        kept = np.empty(len(order), np.int64)
        kept[order] = np.where(shared, least, NOT_SHARED)[np.cumsum(new) - 1]
        return pa.table({"chunk": table["chunk"], "base": table["base"], "kept": _packed(np.split(kept, sizes))})

    return asked.groupBy("part").applyInArrow(answer, "chunk bigint, base bigint, kept binary")


def _inside(around: DataFrame, whole: bool) -> DataFrame:
    """(doc, t, kept_doc, spans) of the shared stretches of ``around``'s texts; ``whole``: joined to runs."""
    asked = around.where("part IS NOT NULL")
    none = lambda *names: [F.lit(None).cast("binary" if x in ("a", "z", "at", "kept") else "bigint").alias(x) for x in names]
    answers = _smallest_ids(asked.select("chunk", "base", "part", "h", "c", "lo", "more")).select("chunk", "base", "kept", *none("doc", "t", "a", "z", "at"))
    texts = around.where("part IS NULL").select("chunk", *none("base", "kept"), "doc", "t", "a", "z", "at")
    met = answers.unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", F.col("base").asc_nulls_last())
    kind = pa.struct([("a", pa.int32()), ("z", pa.int32())])

    def run(batches):
        chunk, parts, kept = None, [], None
        for b in batches:
            out = []
            for key, base, part, doc, t, a, z, at in zip(*(b.column(x).to_pylist() for x in ("chunk", "base", "kept", "doc", "t", "a", "z", "at"))):
                if key != chunk:
                    chunk, parts, kept = key, [], None
                if part is not None:
                    parts.append(_unpacked(part, np.int64))
                    continue
                kept = np.concatenate(parts) if kept is None else kept
                of = kept[_unpacked(at, np.uint32)]
                own = np.flatnonzero((of != NOT_SHARED) & (of != doc))
                if len(own):
                    a = _unpacked(a, np.int32, steps=True)
                    z = a + _unpacked(z, np.int32)
                    own = own[np.argsort(of[own], kind="stable")]
                    for rows in np.split(own, np.flatnonzero(np.diff(of[own])) + 1):
                        out.append((doc, t, int(of[rows[0]]), *(joined(np.zeros(len(rows), np.int64), a[rows], z[rows])[1:] if whole else (a[rows], z[rows]))))
            if out:
                doc, t, kept_doc, a, z = zip(*out)
                spans = pa.StructArray.from_arrays([pa.array(np.concatenate(a), pa.int32()), pa.array(np.concatenate(z), pa.int32())], fields=list(kind))
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in a])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(t, pa.int64()), pa.array(kept_doc, pa.int64()), pa.ListArray.from_arrays(offsets, spans)], names=["doc", "t", "kept_doc", "spans"])

    return met.mapInArrow(run, "doc bigint, t bigint, kept_doc bigint, spans array<struct<a: int, z: int>>")


def _sets_of(docs: DataFrame, wanted: DataFrame, rules: RepeatRules) -> DataFrame:
    """(v, shingles) of the wanted paragraph classes (v, h1, h2, doc: a document that holds it)."""
    near, min_words, limit = rules.near, rules.min_words, rules.near.max_sent_ids
    few = wanted.limit(limit + 1).toArrow()
    sent = None
    if few.num_rows <= limit:
        sent = docs.sparkSession.sparkContext.broadcast((np.unique(few["doc"].to_numpy()), np.unique(few["h1"].to_numpy())))

    def run(batches):
        known = sent.value if sent is not None else None
        for b in C.pieces(batches, "text"):
            if known is not None:
                b = b.filter(pa.array(np.isin(b.column("doc").to_numpy(), known[0])))
            w = C.Words(b.column("text"), fold=True)
            p = Paragraphs(w, min_words)
            sh, of = p.shingles(w, near.shingle)
            h1, h2 = C.as_signed(p.h1), C.as_signed(p.h2)
            own = np.flatnonzero(np.isin(h1, known[1])) if known is not None else np.arange(len(h1))
            bounds = np.searchsorted(of, np.arange(len(h1) + 1))
            sets = [np.unique(sh[bounds[i] : bounds[i + 1]]) for i in own]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
            values = pa.array(C.as_signed(np.concatenate(sets) if sets else np.zeros(0, np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(h1[own]), pa.array(h2[own]), pa.ListArray.from_arrays(offsets, values)], names=["h1", "h2", "shingles"])

    found = docs.select("doc", "text").mapInArrow(run, "h1 bigint, h2 bigint, shingles array<bigint>")
    return found.join(wanted.select("h1", "h2", "v"), ["h1", "h2"]).groupBy("v").agg(F.first("shingles").alias("shingles"))


def _repeats(docs: DataFrame, rules: RepeatRules, id_col: str, text_col: str, whole: bool) -> DataFrame:
    """(doc, t, kept_doc, spans): what repeats a document with a smaller id, in paragraphs and in stretches."""
    own = docs.select(F.coalesce(docs[id_col].cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64(docs[text_col]).alias("t"), docs[text_col].alias("text"))
    rows = C.saved(scan(own, rules), "repeat-rows")
    key, text = ["h1", "h2"], ["doc", "t"]

    paragraphs = rows.select(*text, F.inline("paragraphs"))
    classes = paragraphs.groupBy(*key).agg(F.min("doc").alias("doc"), F.max("doc").alias("most"), F.min("bands").alias("bands"))
    classes = C.saved(classes.withColumn("v", F.monotonically_increasing_id()), "repeat-classes")
    labels = star_components(
        classes.select(F.explode("bands").alias("bucket"), "v"), lambda vs: _sets_of(own, vs.join(classes.select("v", "h1", "h2", "doc"), "v"), rules), rules.near
    )
    of_class = classes.select("v", "doc", "most", *key).join(labels, "v", "left").withColumn("component", F.coalesce("component", "v"))
    least = of_class.groupBy("component").agg(F.min("doc").alias("kept_doc"), F.max("most").alias("most")).where(F.col("kept_doc") < F.col("most"))
    cluster = of_class.select("component", "doc", *key).join(least.select("component", "kept_doc"), "component").select(*key, F.col("doc").alias("first"), "kept_doc")
    lost = paragraphs.select(*text, "a", "z", *key).join(C.saved(cluster, "repeat-clusters"), key).where(F.col("doc") != F.col("kept_doc"))
    lost = C.saved(lost.select(*text, "a", "z", "kept_doc", (F.col("doc") != F.col("first")).alias("copy")), "repeat-paragraphs")

    stretches = rows.select(*text, F.inline("stretches"))
    several = stretches.groupBy(*key).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select(*key)
    places = C.saved(stretches.join(several, key, "left_semi").groupBy(*text).agg(F.collect_set("a").alias("places")), "repeat-anchors")
    n_stretches = (places.agg(F.sum(F.size("places"))).first()[0] or 0) * (2 * rules.anchor_window - 1)
    bits = min(max(int(n_stretches // rules.part_stretches).bit_length(), 4), 30)
    copied = lost.where("copy").groupBy(*text).agg(F.collect_set(F.struct("a", "z")).alias("copied"))
    around = C.saved(_around(own.join(places.join(copied, text, "left"), text), rules, bits), "repeat-around")
    spans = F.array(F.struct("a", "z"))
    return lost.select(*text, "kept_doc", spans.alias("spans")).unionByName(_inside(around, whole))


def repeated_spans(docs: DataFrame, rules: RepeatRules = RepeatRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, t, kept_doc, a, z): each paragraph and each stretch that repeats one of a document with a smaller id,
    which keeps it. ``doc`` is the id (``NO_ID`` for NULL), ``t`` the hash of the text."""
    return _repeats(docs, rules, id_col, text_col, whole=False).select("doc", "t", "kept_doc", F.inline("spans")).distinct()


def joined(row: np.ndarray, a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, a, z) with overlapping and touching spans of a row joined, in order."""
    order = np.lexsort((a, row))
    row, a, z = row[order], a[order].astype(np.int64), z[order].astype(np.int64)
    if not len(row):
        return row, a, z
    far = np.maximum.accumulate(z + (row << 32)) - (row << 32)  # the farthest end of the row so far
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (a[1:] > far[:-1] + 1)]))
    return row[new], a[new], far[np.append(new[1:], len(row)) - 1]


def _spans_by(spans: DataFrame, *key: str) -> DataFrame:
    """(key, spans): all spans of a key, joined."""
    lists = spans.groupBy(*key).agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def run(batches):
        for b in batches:
            lists = b.column("spans")
            each = lists.flatten()
            row, a, z = joined(np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy()), *(each.field(x).to_numpy() for x in ("a", "z")))
            out = _lists(np.bincount(row, minlength=b.num_rows), {"a": pa.array(a.astype(np.int32)), "z": pa.array(z.astype(np.int32))})
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in key), out], names=[*key, "spans"])

    return lists.mapInArrow(run, ", ".join(f"{x} bigint" for x in key) + ", spans array<struct<a: int, z: int>>")


def repeat_report(docs: DataFrame, rules: RepeatRules = RepeatRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and the document that keeps what it repeats: spans (code points, end exclusive) and
    characters. Documents that repeat nothing are absent."""
    each = _spans_by(_repeats(docs, rules, id_col, text_col, whole=True), "doc", "kept_doc")
    id_ = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return each.select(
        id_("doc").alias("doc_id"),
        id_("kept_doc").alias("kept_doc_id"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["z"] - s["a"]).alias("n_chars"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["a"], s["z"])), ",").alias("spans"),
    )


def without_repeats(docs: DataFrame, rules: RepeatRules = RepeatRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the spans that repeat an earlier document."""
    spans = _spans_by(_repeats(docs, rules, id_col, text_col, whole=True), "doc", "t").toDF("__doc", "__t", "__spans")
    same = (F.coalesce(docs[id_col].cast("bigint"), F.lit(NO_ID)) == F.col("__doc")) & (F.xxhash64(docs[text_col]) == F.col("__t"))
    both = docs.join(spans, same, "left").drop("__doc", "__t")
    names = docs.columns

    def run(batches):
        for b in C.pieces(batches, text_col):
            texts = [t if s is None else without(t, s) for t, s in zip(b.column(text_col).to_pylist(), b.column("__spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if x == text_col else b.column(x) for x in names], names=names)

    return both.mapInArrow(run, docs.schema)


def without(text: str, spans: list[dict]) -> str:
    """``text`` without sorted spans that do not overlap."""
    ends = [0, *(s["z"] for s in spans)]
    return "".join(text[a:z] for a, z in zip(ends, [*(s["a"] for s in spans), len(text)]))


def op1_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(C.read_documents(spark, sf_dir))
