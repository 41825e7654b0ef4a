"""Helpers shared by the operators: shared-folder tables, bounded Arrow batches, vectorised word hashing.

Texts are read whole. A NULL text counts as the empty text. White space is the ASCII set
0x20, 0x09-0x0D; a word is a maximal run of other characters; only A-Z are folded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that one numpy step works on (a longer text is a step of its own).
STEP_BYTES = 1_000_000

#: ASCII white space as SQL trim characters, and the regex class of everything else.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back (cuts lineage; survives lost executors)."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, other letters unchanged (``lower`` would fold them too, so it is used on pure ASCII only)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def pieces(batches: Iterator[pa.RecordBatch], text_col: str, step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``step`` bytes of text, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends, lo = np.cumsum(size, dtype=np.int64), 0
        while lo < batch.num_rows:
            base = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + step, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string array as one byte array, and the n + 1 bounds of the texts in it."""
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    bounds = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


mix64 = _mix


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    return _mix(x ^ _mix(np.full(1, salt + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)
_POWERS = np.ones(1, np.uint64)
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1024), _BASE))])
    return _POWERS


def segment_hash(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit rolling hash of each segment; segments follow one another without gaps and are not empty."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    h = np.add.reduceat(_BYTE[data] * _powers(int(lengths.max()))[place], starts)
    return _mix(h ^ (lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


class Words:
    """The words of a batch of texts: document of each, byte start and end, hash; all as arrays."""

    def __init__(self, arr: pa.Array, fold: bool = False):
        self.data, self.bounds = text_bytes(arr)
        self.n_docs = len(self.bounds) - 1
        self.space = IS_SPACE[self.data]
        inside = ~self.space
        # the first byte of a text starts a word too, whatever the text before it ends with
        first = np.zeros(len(self.data) + 1, bool)
        first[self.bounds[:-1]] = True
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        self.start = np.flatnonzero(inside & (~before | first[:-1]))
        compact = self.data[inside]
        rank = np.cumsum(inside) - 1
        at = rank[self.start] if len(self.start) else np.zeros(0, np.int64)
        self.length = np.diff(np.append(at, len(compact)))
        self.end = self.start + self.length
        self.doc = np.searchsorted(self.bounds, self.start, side="right") - 1
        self.hash = segment_hash(FOLD[compact] if fold else compact, at, self.length)
        self.per_doc = np.bincount(self.doc, minlength=self.n_docs)
        self.first_word = np.concatenate([[0], np.cumsum(self.per_doc)])

    def code_points(self) -> np.ndarray:
        """Before each byte position (and at the end): code points since the start of the batch."""
        return np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows inside one text, and the index of each window's first word."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:m] == self.doc[n - 1 :])
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h = h * _BASE + self.hash[at + k]
        return _mix(h), at


def per_text_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
