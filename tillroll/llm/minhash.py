"""Operator 4, MinHash near-dedup: one-permutation hashing with optimal densification.

One hash per shingle fills ``n_bands * band_rows`` bins with their smallest hash; an empty bin borrows from the
first non-empty bin of a fixed random walk of its own (optimal densification), so short texts get full
signatures. Rows of a signature form banded buckets. Texts with equal shingle sets are one class from the
start, so a group of exact copies, however large, is one vertex.

Candidate edges are star-shaped: each bucket has one centre, the member that is in most buckets, and the other
members are paired with it only. Pairs are confirmed on full sets. Links between two partners of a centre that
is not linked to both are then found exactly, by a prefix filter on the partners' differences from the centre,
whose buckets are small; in rounds, a few members outside a bucket's main component become centres and meet all
members of other components, until each bucket is in one component or each of its members has met all others.
So no link between different texts that share a band is lost, and pairs stay bounded by members times centres.

Work at scale: signatures need one pass without shuffle. Postings (bucket, class) are reduced to buckets with
two or more classes by partial aggregation. Full sets are computed for the classes that have a candidate, by a
second pass over the texts; the list of those goes to the tasks if it has at most ``MAX_SENT_IDS`` entries,
otherwise texts are joined with it. A centre with many partners is salted. Components are star contractions.

Defined results: a text without words (or NULL) is linked with nothing and is its own component; with fewer
words than a shingle the whole sequence is the one shingle; rows repeated under one id are one document; rows
without an id are linked like others and their component is the smallest id in it, NULL if there is none; an
empty table gives an empty result; ``keep_first`` passes all columns unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .graph import components

#: So many (id, hash, vertex) entries of 24 bytes may be sent to every task.
MAX_SENT_IDS = 1_000_000
#: Partners of a centre that one join group takes; beyond it the centre's set is repeated under salts.
SALT_ROWS = 4_000


@dataclass(frozen=True)
class NearRules:
    shingle: int = 5
    similarity_pct: int = 80
    n_bands: int = 32
    band_rows: int = 6
    #: Centres of a prefix bucket in the first round; 16 times as many in each following one.
    centres: int = 8
    max_sent_ids: int = MAX_SENT_IDS

    @property
    def bins(self) -> int:
        return self.n_bands * self.band_rows


#: At a similarity of 0.85 a pair shares no band with probability (1 - 0.85**6)**32 = 3e-7.
CONTRACT = NearRules(shingle=3, similarity_pct=85)
#: At 0.8: (1 - 0.8**5)**40 = 1e-7.
STAGE = NearRules(shingle=5, similarity_pct=80, n_bands=40, band_rows=5)


@lru_cache(maxsize=4)
def _walks(bins: int) -> np.ndarray:
    """For each bin the order in which it looks for a non-empty one; the same on every executor."""
    rng = np.random.default_rng(bins)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


@lru_cache(maxsize=4)
def _edges(bins: int) -> np.ndarray:
    return np.array([(i << 64) // bins for i in range(bins)], np.uint64)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    w = C.Words(texts, fold=True)
    hashes, at = w.shingles(n)
    bounds = np.searchsorted(w.doc[at], np.arange(w.n_docs + 1))
    out = []
    for i in range(w.n_docs):
        words = int(w.per_doc[i])
        if words >= n:
            out.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
        elif words:
            h = np.zeros(1, np.uint64)
            for x in w.hash[w.first_word[i] : w.first_word[i + 1]]:
                h = C.mix64(h * C._BASE + x + np.uint64(words))
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Smallest hash of each bin; empty bins borrow (``shingles``: sorted, not empty)."""
    edges = _edges(bins)
    first = np.searchsorted(shingles, edges)
    after = np.append(first[1:], len(shingles))
    full = first < after
    out = shingles[np.minimum(first, len(shingles) - 1)]
    if not full.all():
        empty = np.flatnonzero(~full)
        walks = _walks(bins)[empty]
        source = walks[np.arange(len(empty)), full[walks].argmax(axis=1)]
        out[empty] = out[source]
    return out


def band_keys(signatures: np.ndarray, rules: NearRules) -> np.ndarray:
    """(texts, bands): the bucket of each band."""
    rows = signatures.reshape(len(signatures), rules.n_bands, rules.band_rows)
    h = np.arange(rules.n_bands, dtype=np.uint64)[None, :] + np.zeros((len(rows), 1), np.uint64)
    for j in range(rules.band_rows):
        h = C.mix64(h * C._BASE + rows[:, :, j])
    return h


def _fingerprint(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one = np.array([np.add.reduce(C.mix64(s)) for s in sets], np.uint64)
    two = np.array([np.add.reduce(C.salted(s, 2)) for s in sets], np.uint64)
    return one, two


def signed_rows(docs: DataFrame, rules: NearRules) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n (set size), fingerprint h1, h2, bands (empty for empty sets)."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n bigint, h1 bigint, h2 bigint, bands array<bigint>"

    def run(batches):
        for b in C.pieces(batches, "text"):
            sets = shingle_sets(b.column("text"), rules.shingle)
            n = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(n)
            h1, h2 = _fingerprint(sets)
            bands = np.zeros((0, rules.n_bands), np.uint64)
            if len(some):
                bands = band_keys(np.stack([signature(sets[i], rules.bins) for i in some]), rules)
            offsets = np.concatenate([[0], np.cumsum((n > 0) * rules.n_bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(C.as_signed(bands.reshape(-1))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(C.as_signed(h1)), pa.array(C.as_signed(h2)), lists], names=["doc_id", "n", "h1", "h2", "bands"])

    return docs.mapInArrow(run, schema)


def _sets_of(docs: DataFrame, wanted: DataFrame, rules: NearRules) -> DataFrame:
    """(v, shingles) of the wanted classes (rep, h1, v), from the row of their smallest id."""
    shingle = rules.shingle
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches, known):
        for b in C.pieces(batches, "text"):
            ids = b.column("doc_id")
            if known is not None:
                own = ids.is_null().to_numpy(zero_copy_only=False) | np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), known[0])
                b = b.filter(pa.array(own))
            if b.num_rows:
                sets = shingle_sets(b.column("text"), shingle)
                h1 = C.as_signed(_fingerprint(sets)[0])
                yield b.column("doc_id"), h1, sets

    def packed(columns, sets):
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, pa.array(C.as_signed(values)))], names=["v", "shingles"])

    few = wanted.limit(rules.max_sent_ids + 1).toArrow()
    if few.num_rows <= rules.max_sent_ids:
        h1, v = few["h1"].to_numpy(), few["v"].to_numpy()
        order = np.argsort(h1, kind="stable")
        ids = few["rep"].drop_null().to_numpy().astype(np.int64)
        sent = docs.sparkSession.sparkContext.broadcast((np.sort(ids), h1[order], v[order]))

        def run(batches):
            known = sent.value
            for _, h1, sets in rows(batches, known):
                at = np.minimum(np.searchsorted(known[1], h1), max(0, len(known[1]) - 1))
                hit = np.flatnonzero(known[1][at] == h1) if len(known[1]) else np.zeros(0, np.int64)
                yield packed([pa.array(known[2][at[hit]])], [sets[i] for i in hit])

        found = docs.mapInArrow(run, "v bigint, shingles array<bigint>")
    else:
        reps = wanted.select(F.col("rep").alias("r"), F.col("h1").alias("rh"), "v")
        both = docs.join(reps, docs["doc_id"].eqNullSafe(F.col("r")))

        def run(batches):
            for b in C.pieces(batches, "text"):
                sets = shingle_sets(b.column("text"), shingle)
                hit = np.flatnonzero(C.as_signed(_fingerprint(sets)[0]) == b.column("rh").to_numpy())
                yield packed([b.column("v").take(pa.array(hit))], [sets[i] for i in hit])

        found = both.select("text", "rh", "v").mapInArrow(run, "v bigint, shingles array<bigint>")
    return found.groupBy("v").agg(F.first("shingles").alias("shingles"))


def paired(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (c, v) with both sets (of_c, of_v). A centre with many partners is repeated under salts."""
    counts = pairs.groupBy("c").agg(F.count("*").alias("__n"))
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col("__n") / SALT_ROWS))).cast("int")
    salted = pairs.join(counts, "c").withColumn("__level", level).withColumn("__salt", F.expr("pmod(xxhash64(v), shiftleft(1L, __level))"))
    centres = counts.withColumn("__level", level).join(sets.select(F.col("v").alias("c"), F.col("shingles").alias("of_c")), "c")
    centres = centres.withColumn("__salt", F.explode(F.expr("sequence(0L, shiftleft(1L, __level) - 1L)")))
    own = sets.select("v", F.col("shingles").alias("of_v"))
    return salted.join(own, "v").join(centres.select("c", "__salt", "of_c"), ["c", "__salt"]).drop("__n", "__level", "__salt")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(c, v, nc, nv, d): set sizes and the size of the symmetric difference, from the full sets."""
    both = paired(pairs, sets).withColumn("shared", F.size(F.array_intersect("of_v", "of_c")))
    nc, nv = F.size("of_c").cast("bigint"), F.size("of_v").cast("bigint")
    return both.select("c", "v", nc.alias("nc"), nv.alias("nv"), (nc + nv - 2 * F.col("shared")).alias("d"))


def similar(similarity_pct: int) -> Column:
    """100 * intersection >= pct * union, for rows of ``measured``."""
    total = F.col("nc") + F.col("nv")
    return 100 * (total - F.col("d")) >= similarity_pct * (total + F.col("d"))


def star_components(postings: DataFrame, sets_of: Callable[[DataFrame], DataFrame], rules: NearRules) -> DataFrame:
    """(v, component) of the vertices that share a bucket. ``postings``: (bucket, v); ``sets_of`` maps vertices (v) to
    their full sets (v, shingles)."""
    pct = rules.similarity_pct
    buckets = C.saved(postings.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "near-buckets")
    members = C.saved(postings.join(buckets, "bucket"), "near-members")
    # the centre of a bucket is its member in most buckets: the text most like the others
    degree = C.saved(members.groupBy("v").agg(F.count("*").alias("degree")), "near-degree")
    ranked = members.join(degree, "v").groupBy("bucket").agg(F.min(F.struct(-F.col("degree"), "v")).alias("x"))
    centres = C.saved(ranked.select("bucket", F.col("x.v").alias("c")), "near-centres")
    pairs = C.saved(members.join(centres, "bucket").where("v <> c").select("c", "v").distinct(), "near-pairs")
    sets = C.saved(sets_of(degree.select("v")), "near-sets")
    star = C.saved(measured(pairs, sets), "near-star")
    labels = degree.select("v").join(components(star.where(similar(pct)).select(F.col("c").alias("a"), F.col("v").alias("b"))), "v", "left")
    labels = C.saved(labels.select("v", F.coalesce("component", "v").alias("component")), "near-labels")

    # what the stars may have missed: partners of one centre that are in different components
    active = C.saved(difference_postings(partners_apart(star, labels, pct), sets, pct), "near-prefixes")
    slots_now = rules.centres
    while True:
        own = active.join(labels, "v")
        main = own.groupBy("bucket").agg(F.min("component").alias("main"), F.max("component").alias("other")).where("main <> other")
        own = C.saved(own.join(main.drop("other"), "bucket"), "near-active")
        slots = own.where("component <> main").groupBy("bucket", F.pmod(F.xxhash64("v"), F.lit(slots_now)).alias("slot"))
        chosen = C.saved(slots.agg(F.min(F.struct("v", "component", "n", "d", "s")).alias("x")).select("bucket", "x.*"), "near-chosen")
        if chosen.isEmpty():
            return labels
        other = chosen.select("bucket", *(F.col(x).alias(f"of_{x}") for x in ("v", "component", "n", "d", "s")))
        total = F.col("n") + F.col("of_n")
        # what their differences share at least, if they are similar, against what is left of each from this
        # shingle on; at the first shingle that they share that holds all they share
        common = (F.col("d") + F.col("of_d") - F.floor(total * (100 - pct) / (100 + pct) + 1e-9)) / 2
        possible = (F.least("s", "of_s") >= common) & (100 * F.least("n", "of_n") >= pct * F.greatest("n", "of_n"))
        met = own.join(other, "bucket").where((F.col("component") != F.col("of_component")) & possible)
        tested = C.saved(met.select(F.least("of_v", "v").alias("c"), F.greatest("of_v", "v").alias("v")).distinct(), "near-tested")
        found = C.saved(measured(tested, sets).where(similar(pct)).select(F.col("c").alias("a"), F.col("v").alias("b")), "near-links")
        if not found.isEmpty():
            # the components that the new links join
            of = lambda end: labels.select(F.col("v").alias(end), F.col("component").alias(f"of_{end}"))
            joined = components(found.join(of("a"), "a").join(of("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
            joined = joined.select(F.col("v").alias("component"), F.col("component").alias("now"))
            labels = C.saved(labels.join(joined, "component", "left").select("v", F.coalesce("now", "component").alias("component")), "near-labels")
        slots_now *= 16  # few members are left, so more of them can be centres at once
        active = C.saved(own.select("bucket", "v", "n", "d", "s").join(chosen.select("bucket", "v"), ["bucket", "v"], "left_anti"), "near-left")


def _most_apart(n: Column, pct: int) -> Column:
    """The largest symmetric difference of a set of n shingles and any similar one."""
    return F.floor(n * (100 - pct) * (100 + pct) / (pct * (100 + pct)) + 1e-9)


def partners_apart(star: DataFrame, labels: DataFrame, pct: int) -> DataFrame:
    """The pairs (c, v, nv, d) of centres whose partners may still have unseen links between components.

    Two similar sets differ from a third by sizes at most ``_most_apart`` apart."""
    of = lambda end: labels.select(F.col("v").alias(end), F.col("component").alias(f"of_{end}"))
    rows = star.join(of("v"), "v").join(of("c"), "c").withColumn("out", F.col("of_v") != F.col("of_c"))
    rows = C.saved(rows.select("c", "v", "nv", "d", "out"), "near-partners-of")
    groups = rows.groupBy("c").agg(
        F.count(F.when(F.col("out"), 1)).alias("n_out"), F.min(F.when(F.col("out"), F.col("d"))).alias("lo_out"), F.max(F.when(~F.col("out"), F.col("d"))).alias("hi_in")
    )
    groups = C.saved(groups.where("n_out > 0"), "near-groups")
    reach = _most_apart(F.col("nv"), pct)
    near_in = F.col("d") <= F.coalesce("hi_in", F.lit(0)) + reach
    near_out = F.col("lo_out") <= F.col("d") + reach
    return rows.join(groups, "c").where(F.when(F.col("out"), (F.col("n_out") > 1) | near_in).otherwise(near_out)).select("c", "v", "nv", "d")


def difference_postings(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """(bucket, v, n, d, s): buckets such that any two similar partners of one centre share one, unless both are
    linked to the centre itself; set size, size of the difference from the centre, and how many shingles of it, in
    the common order, are left from the bucket's on.

    Let D(x) be what differs between x and the centre. Similar sets x and y differ in at most
    (100 - pct) / (100 + pct) * (|x| + |y|) shingles, so D(x) and D(y) share at least half of
    |D(x)| + |D(y)| minus that: where one of them is too far from the centre to be linked, they share some. The
    join is a prefix filter on these differences, rarest shingles first. Texts that only descend from one source differ from it in shingles of
    their own, which fill the prefix and meet nothing."""
    both = paired(pairs, sets)
    apart = F.concat(F.array_except("of_v", "of_c"), F.array_except("of_c", "of_v"))
    each = both.select("c", "v", F.col("nv").alias("n"), "d", F.explode(apart).alias("shingle"))
    held = C.saved(each.groupBy("c", "shingle").agg(F.count("*").alias("held")).where("held > 1"), "near-shared")
    # shingles of one partner only come first in the order and meet nothing: it is enough to count them
    shared = each.join(held, ["c", "shingle"]).groupBy("c", "v").agg(F.array_sort(F.collect_list(F.struct("held", "shingle"))).alias("s"))
    rows = pairs.select("c", "v", F.col("nv").alias("n"), "d").join(shared, ["c", "v"], "left").withColumn("s", F.coalesce("s", F.array().cast("array<struct<held:bigint,shingle:bigint>>")))
    # a similar partner differs from the centre by at least d - reach, which bounds the overlap from below
    reach = _most_apart(F.col("n"), pct)
    overlap = F.ceil((F.col("d") + F.greatest(F.lit(1), F.col("d") - reach) - reach) / 2)
    left = F.col("d") - F.greatest(overlap, F.lit(1)) + 1 - (F.col("d") - F.size("s"))
    chosen = F.slice("s", F.lit(1), F.greatest(F.lit(0), left).cast("int"))["shingle"]
    # partners that may be similar without any shared difference all meet
    chosen = F.concat(chosen, F.when(overlap <= 0, F.array(F.lit(None).cast("bigint"))).otherwise(F.array().cast("array<bigint>")))
    each = rows.select("c", "v", "n", "d", F.size("s").cast("bigint").alias("size"), F.posexplode(chosen).alias("i", "x"))
    rest = F.when(F.col("x").isNull(), F.col("d")).otherwise(F.col("size") - F.col("i"))
    bucket = F.xxhash64("c", F.coalesce("x", F.lit(0)), F.col("x").isNull())
    return each.select(bucket.alias("bucket"), "v", "n", "d", rest.alias("s"))


def near_components(docs: DataFrame, rules: NearRules) -> tuple[DataFrame, DataFrame]:
    """``docs``: (doc_id, text). Per document (doc_id, n, h1, h2), and per class (h1, h2, component)."""
    rows = C.saved(signed_rows(docs, rules), "near-rows")
    classes = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("bands").alias("bands"))
    classes = C.saved(classes.withColumn("v", F.monotonically_increasing_id()), "near-classes")

    labels = star_components(
        classes.select(F.explode("bands").alias("bucket"), "v"),
        lambda vs: _sets_of(docs, vs.join(classes.select("v", "rep", "h1"), "v").select("rep", "h1", "v"), rules),
        rules,
    )
    of_class = labels.join(classes.select("v", "rep"), "v")
    least = of_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = of_class.join(least, "component").select("v", "component_id")
    return rows.select("doc_id", "n", "h1", "h2"), C.saved(
        classes.select("v", "h1", "h2", "rep").join(named, "v", "left").select("h1", "h2", F.coalesce("component_id", "rep").alias("component_id")), "near-components"
    )


def near_duplicates(docs: DataFrame, rules: NearRules = STAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: set size, component (its smallest id), whether the document is the one that stays."""
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows, named = near_components(own, rules)
    both = rows.join(named, ["h1", "h2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return both.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, rules: NearRules = STAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stays: of each component the smallest id, and every empty text."""
    verdict = near_duplicates(docs, rules, id_col, text_col).groupBy(F.col("doc_id").alias("__near_id")).agg(F.max("kept").alias("kept"))
    gone = C.saved(verdict.where(~F.col("kept")).select("__near_id"), "near-gone")
    return docs.join(gone, docs[id_col].eqNullSafe(F.col("__near_id")), "left_anti")


def op4_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.read_documents(spark, sf_dir), CONTRACT)
