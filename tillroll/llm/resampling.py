"""Operator 13, target-distribution importance resampling with prefix CRCs.

Features are all runs of one to ``max_words`` words, joined by one space, hashed by CRC-32 into buckets. A text is
normalised once (A-Z folded, every separator a space, words one space apart) and scanned once: the running CRC is
kept before and after each word. A CRC is linear over GF(2), so that of any run follows from two running ones,
``crc(run) = crc(up to its end) xor Z^n crc(up to its start)``, where ``Z`` is the shift by one zero byte and ``n`` the
run's bytes. ``Z^n`` is looked up: four tables of 256 words for every n below ``SHORT``, and for longer runs one more
for each binary digit above. Nothing is hashed twice and no run is ever built as a string.

Bucket counts of all documents and of all target texts are summed in each task (an array of ``n_buckets`` longs) and
then by one partial aggregate; a bucket's gain is a scaled log ratio, computed by SQL functions on exactly
``n_buckets`` rows, and those are sent to the tasks. A document's weight is the sum of its features' gains. A Gumbel
draw keyed by the id is added; the highest scores are a sample without replacement in proportion to the exponentiated
weights. Ranks come without a global window: range partitions in order, written once, with the row counts of the
partitions before; only ids and scores are sorted.

Defined results: a NULL text has no words; a document without features has weight 0; documents under ``min_words``
words are scored but never drawn; the draw of a NULL id is that of the bare salt; rows repeated under one id have equal
scores and follow one another in a fixed order; NULL ids come first among equal scores; empty tables give an empty
result or, for the target, gains against counts of 0; ids keep their type and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Reflected polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320
#: Runs below so many bytes have their shift in one table.
SHORT = 64

#: Bytes as they are scanned: letters folded, digits and all bytes of other code points kept, the rest separators.
_SCANNED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class ResamplingRules:
    n_buckets: int = 10_000
    max_words: int = 3
    min_words: int = 20
    #: Share of the documents with enough words that is drawn.
    percent: int = 5
    #: Gains and draws are logarithms times this, rounded down.
    scale: int = 1000
    salt: str = "42"


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """CRC step of each low byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), c >> np.uint32(1))
    return c


def _look_up(tables: np.ndarray, n: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    """The shift ``tables[n]`` of each CRC; a shift is four tables, one for each byte."""
    out = tables[n, 0, crc & 255]
    for k in range(1, 4):
        out = out ^ tables[n, k, (crc >> np.uint32(8 * k)) & 255]
    return out


@lru_cache(maxsize=1)
def short_shifts() -> np.ndarray:
    """(SHORT, 4, 256): the shift by each number of zero bytes, byte by byte of the CRC."""
    step, out = byte_table(), np.empty((SHORT, 4, 256), np.uint32)
    for k in range(4):
        crc = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(SHORT):
            out[n, k] = crc
            crc = step[crc & 255] ^ (crc >> np.uint32(8))
    return out


@lru_cache(maxsize=64)
def long_shift(digit: int) -> np.ndarray:
    """(1, 4, 256): the shift by ``SHORT * 2**digit`` zero bytes, by squaring."""
    if digit == 0:
        half = short_shifts()[SHORT // 2][None]
    else:
        half = long_shift(digit - 1)
    return np.stack([_look_up(half, 0, half[0, k]) for k in range(4)])[None]


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``Z^n`` of each CRC."""
    out = _look_up(short_shifts(), n % SHORT, crc)
    rest, digit = n // SHORT, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        if len(odd):
            out[odd] = _look_up(long_shift(digit), 0, out[odd])
        rest, digit = rest >> 1, digit + 1
    return out


class Scan:
    """The words of a batch of texts: running CRCs before and after each, and its place in the normalised text."""

    def __init__(self, texts: list[str | None]):
        words = [(t or "").encode().translate(_SCANNED).split() for t in texts]
        self.n_words = np.fromiter(map(len, words), np.int64, len(words))
        total = int(self.n_words.sum())
        self.text = np.repeat(np.arange(len(words)), self.n_words)
        size = np.fromiter((len(w) for ws in words for w in ws), np.int64, total)
        after = np.fromiter((c for ws in words for c in _running(ws)), np.uint32, total)
        first = np.zeros(total, bool)
        first[(np.cumsum(self.n_words) - self.n_words)[self.n_words > 0]] = True
        # the CRC after the space that follows the word before; nothing comes before a text's first word
        before = np.concatenate([[0], after[:-1]]).astype(np.uint32) if total else after
        stepped = ~before
        self.before = np.where(first, 0, ~(byte_table()[(stepped ^ np.uint32(0x20)) & 255] ^ (stepped >> np.uint32(8)))).astype(np.uint32)
        self.after, self.end = after, np.cumsum(size + 1)
        self.start = self.end - 1 - size

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, CRC-32) of all runs of n words."""
        m = max(len(self.text) - n + 1, 0)
        at = np.flatnonzero(self.text[:m] == self.text[n - 1 :][:m])
        last = at + n - 1
        return self.text[at], self.after[last] ^ shifted(self.before[at], self.end[last] - 1 - self.start[at])


def _running(words: list[bytes]) -> Iterator[int]:
    if not words:
        return iter(())
    rest = accumulate(words[1:], lambda crc, w: crc32(w, crc32(b" ", crc)), initial=crc32(words[0]))
    return rest


def bucket_counts(texts: Column, frame: DataFrame, rules: ResamplingRules = ResamplingRules()) -> DataFrame:
    """(bucket, n): features of all texts by bucket; a task sends at most one row for a bucket."""

    def run(batches):
        total = np.zeros(rules.n_buckets, np.int64)
        for b in C.pieces(batches, "text"):
            scan = Scan(b.column("text").to_pylist())
            for n in range(1, rules.max_words + 1):
                total += np.bincount(scan.runs(n)[1] % np.uint32(rules.n_buckets), minlength=rules.n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    return frame.select(texts.alias("text")).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, rules: ResamplingRules = ResamplingRules()) -> DataFrame:
    """(bucket, gain), one row for each bucket: how much likelier the target has it, with one count added to each."""
    both = source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("n").alias("t"))
    )
    every = frame_of_buckets(source.sparkSession, rules.n_buckets)
    counts = both.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    counts = C.saved(counts, "resampling-counts")
    all_s, all_t = (counts.select(F.sum(c)).scalar() for c in ("s", "t"))
    d = lambda c, more: (c + more).cast("double")
    ratio = d(F.col("t"), 1) * d(all_s, rules.n_buckets) / (d(F.col("s"), 1) * d(all_t, rules.n_buckets))
    return counts.select("bucket", F.floor(F.lit(float(rules.scale)) * F.ln(ratio)).cast("bigint").alias("gain"))


def frame_of_buckets(spark: SparkSession, n: int) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return spark.range(n).select(F.col("id").cast("int").alias("bucket"), zero.alias("s"), zero.alias("t"))


def weighted(docs: DataFrame, gains: DataFrame, rules: ResamplingRules = ResamplingRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the sum of a document's gains. ``gains`` has exactly one row a bucket."""
    table = gains.toArrow()  # n_buckets rows, whatever the corpus
    gain = np.zeros(rules.n_buckets, np.int64)
    gain[table["bucket"].to_numpy()] = table["gain"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in C.pieces(batches, "text"):
            scan = Scan(b.column("text").to_pylist())
            features, weight = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows + 1, np.int64)
            for n in range(1, rules.max_words + 1):
                text, crc = scan.runs(n)
                own = np.bincount(text, minlength=b.num_rows)
                features += own
                total = np.concatenate([[0], np.cumsum(sent.value[crc % np.uint32(rules.n_buckets)])])
                ends = np.cumsum(own)
                weight[:-1] += total[ends] - total[ends - own]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(scan.n_words), pa.array(features), pa.array(weight[:-1])], names=["doc_id", "n_words", "n_features", "weight"]
            )

    read = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return read.mapInArrow(run, f"doc_id {id_type}, n_words bigint, n_features bigint, weight bigint")


def drawn_score(weight: Column, doc_id: Column, rules: ResamplingRules = ResamplingRules()) -> Column:
    """The weight with the id's Gumbel draw added."""
    salted = F.concat(F.lit(f"{rules.salt}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("bigint")
    return weight + F.floor(F.lit(-float(rules.scale)) * F.ln(-F.ln((h.cast("double") + 0.5) / float(1 << 32)))).cast("bigint")


def ranked(rows: DataFrame, order: list[Column], n_drawn: int, name: str = "rank") -> DataFrame:
    """``rows`` with their place in ``order`` from 1, NULL after ``n_drawn``; no row moves to a single task."""
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    laid = C.saved(laid, "resampled-order")  # the layout is fixed by the table, also for tasks that run again
    counts = laid.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__row") - F.shiftleft(F.col("__part").cast("bigint"), 33) + 1
    joined = laid.join(F.broadcast(before), "__part")  # one row a partition
    return joined.withColumn(name, F.when(place <= n_drawn, place)).drop("__part", "__row", "__before")


def importance_resample(
    docs: DataFrame, target: DataFrame, rules: ResamplingRules = ResamplingRules(), id_col: str = "doc_id", text_col: str = "text", target_col: str = "text"
) -> DataFrame:
    """Every document's (doc_id, n_words, n_features, weight, score, rank); rank is NULL for those not drawn."""
    source = bucket_counts(docs[text_col], docs, rules)
    gains = C.saved(bucket_gains(source, bucket_counts(target[target_col], target, rules), rules), "resampling-gains")
    scored = weighted(docs, gains, rules, id_col, text_col)
    scored = C.saved(scored.withColumn("score", drawn_score(F.col("weight"), F.col("doc_id"), rules)), "resampling-scores")
    enough = F.col("n_words") >= rules.min_words
    able = scored.where(enough)
    n_drawn = rules.percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked(able, order, n_drawn).unionByName(rest)


def op13_prefix_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance_resample(C.read_documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")
