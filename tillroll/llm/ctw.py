"""Operator 3, LM scoring: context-tree weighting over binary-decomposed bytes.

A text is the sequence of its words (A-Z folded), each followed by a space, and an end byte: one to one with its
tokens. A byte is eight binary decisions; each decision node of each context of 0 to ``depth`` bytes has a
Krichevsky-Trofimov estimate from its counts in the training texts, and contexts of all depths are mixed with
context-tree weights: a node's weight against its longer contexts is ``beta = Pe / (2 Pw)`` with
``Pw = (Pe + product of the children's Pw) / 2``, computed bottom-up over the whole tree of the training texts.

Texts are put into chunks of ``chunk_bytes``, kept compressed. A chunk sends each of its distinct (context, byte)
pairs once, with its count in the chunk's training texts: sorted keys as packed differences, dealt by the two last
context bytes, whose task thus holds a whole subtree. One job weights the subtrees and sends sums of contexts of two
bytes (at most 65,536, a constant) to the driver, which makes the contexts of no and one byte; a second one weights
them again and answers every pair that was asked for, with all contexts of the training texts: the model grows with
the corpus. The answers go back to the chunk, where its texts are scored. A decision that was never seen in a context stops at the longest context where it was, with that context's
own estimate in place of longer ones (``max_contexts`` also stops at contexts with less than that share of the
training bytes; not set by default). The result is a proper probability: each binary decision is a mixture of
two-way estimates.

The base score needs the count of every word: the counts go to the tasks if there are at most
``MAX_SENT_WORDS`` distinct ones, otherwise each text's words are joined with them by shuffle.

Defined results: NULL and empty texts are one end token; a NULL id counts as the empty string for the split; rows
repeated under one id are documents of their own; an empty training set gives 0.5 for every binary decision;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SPACE, END = 0x20, 0x0A
#: Distinct words whose counts (16 bytes each) may be sent to every task.
MAX_SENT_WORDS = 6_000_000
#: Bytes of text counted at once, and new counts that a task holds before they are merged.
COUNT_BYTES, HELD = 1_000_000, 1_000_000
_END_WORD = np.array([0x5EED], np.uint64).view(np.int64)[0]


@dataclass(frozen=True)
class TreeRules:
    depth: int = 6
    max_contexts: int | None = None
    max_sent_words: int = MAX_SENT_WORDS
    #: Bytes of text whose distinct pairs are asked for together.
    chunk_bytes: int = 64_000_000


def stream(w: C.Words, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, text of each byte, places that count): each text after ``pad`` end bytes."""
    sizes = np.bincount(w.doc, weights=w.length + 1, minlength=w.n_docs).astype(np.int64) + 1
    starts = np.cumsum(sizes + pad) - sizes  # of the counted bytes
    out = np.full(int((sizes + pad).sum()), END, np.uint8)
    before = np.concatenate([[0], np.cumsum(w.length + 1)])[:-1]
    first = before - before[np.minimum(w.first_word[:-1], max(0, len(before) - 1))][w.doc] + starts[w.doc] if len(before) else before
    inside = ~w.space
    out[np.repeat(first, w.length) + np.arange(int(w.length.sum())) - np.repeat(np.cumsum(w.length) - w.length, w.length)] = C.FOLD[w.data[inside]]
    out[first + w.length] = SPACE
    text = np.repeat(np.arange(w.n_docs), sizes)
    places = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return out, text, places


def gram_keys(out: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """c1 (the byte before), c2, ..., c_depth, then the byte itself, from the highest byte of the key down."""
    key = np.zeros(len(places), np.uint64)
    for j in range(1, depth + 1):
        key |= out[places - j].astype(np.uint64) << np.uint64(8 * (depth + 1 - j))
    return key | out[places].astype(np.uint64)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.diff(np.append(starts, len(keys))) if counts is None else np.add.reduceat(counts, starts)
    return keys[starts], total.astype(np.int64)


class Counter:
    """Counts by key: a sorted table, and new ones that are merged into it when there are ``HELD``."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.new.append((keys, counts))
        self.held += len(keys)
        if self.held >= HELD:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) of everything; the table is not sorted again, new keys are put in their places."""
        if self.new:
            keys, counts = counted(*(np.concatenate(x) for x in zip(*self.new)))
            self.new, self.held = [], 0
            at = np.searchsorted(self.keys, keys)
            seen = np.zeros(len(keys), bool)
            inside = at < len(self.keys)
            seen[inside] = self.keys[at[inside]] == keys[inside]
            self.counts[at[seen]] += counts[seen]
            self.keys = np.insert(self.keys, at[~seen], keys[~seen])
            self.counts = np.insert(self.counts, at[~seen], counts[~seen])
        return self.keys, self.counts


def chunked(docs: DataFrame, rules: TreeRules) -> DataFrame:
    """``docs`` (doc_id, held_out, text) as rows of chunks, of three kinds: texts (blob: compressed Arrow batches),
    distinct (context, byte) pairs by their two last context bytes (pair; base: place of the first among the chunk's; k,
    n: packed keys and training counts), and training words with their counts (word, n_word)."""
    names = ["chunk", "blob", "pair", "base", "k", "n", "word", "n_word"]
    kinds = dict(zip(names, [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]))
    depth, chunk_bytes = rules.depth, rules.chunk_bytes
    shift = np.uint64(8 * (depth - 1))

    def rows(chunk: int, size: int, /, **columns) -> pa.RecordBatch:
        known = {"chunk": pa.array(np.full(size, chunk))} | columns
        return pa.RecordBatch.from_arrays([known[x] if x in known else pa.nulls(size, kinds[x]) for x in names], names=names)

    def finished(chunk: int, grams: Counter, words: Counter):
        k, n = grams.merge()
        pair = (k >> shift).astype(np.int32)
        cuts = np.flatnonzero(pair[1:] != pair[:-1]) + 1
        base = np.concatenate([[0], cuts])
        keys, counts = _packed(np.split(k, cuts), steps=True), _packed(np.split(n, cuts))
        yield rows(chunk, len(base), pair=pa.array(pair[base]), base=pa.array(base), k=keys, n=counts)
        k, n = words.merge()
        if len(k):
            yield rows(chunk, len(k), word=pa.array(C.as_signed(k)), n_word=pa.array(n))

    def run(batches):
        chunk, grams, words, size = TaskContext.get().partitionId() << 32, Counter(), Counter(), 0
        for b in C.pieces(batches, "text", min(COUNT_BYTES, chunk_bytes)):
            w = C.Words(b.column("text"), fold=True)
            data, text, places = stream(w, depth)
            if size and size + len(places) > chunk_bytes:
                yield from finished(chunk, grams, words)
                chunk, grams, words, size = chunk + 1, Counter(), Counter(), 0
            size += len(places)
            train = ~b.column("held_out").to_numpy(zero_copy_only=False)
            keys, own = gram_keys(data, places, depth), train[text]
            grams.add(*counted(keys[own]))
            others, _ = counted(keys[~own])
            grams.add(others, np.zeros(len(others), np.int64))
            words.add(*counted(w.hash[train[w.doc]]))
            words.add(*counted(np.full(int(train.sum()), _END_WORD).view(np.uint64)))
            yield rows(chunk, 1, blob=pa.array([_blob(b)], pa.binary()))
        if size:
            yield from finished(chunk, grams, words)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "chunk bigint, blob binary, pair int, base bigint, k binary, n binary, word bigint, n_word bigint")


def _blob(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _packed(arrays: list[np.ndarray], steps: bool = False) -> pa.Array:
    """One binary value for each array: its bytes place by place, compressed; ``steps``: differences of neighbours."""
    values = [np.diff(x, prepend=x.dtype.type(0)) if steps else x for x in arrays]
    return pa.array([zlib.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1) for x in values], pa.binary())


def _unpacked(value: bytes, kind, steps: bool = False) -> np.ndarray:
    kind = np.dtype(kind)
    x = np.ascontiguousarray(np.frombuffer(zlib.decompress(value), np.uint8).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(x, dtype=kind) if steps else x


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x >= 0.5 (shifted Stirling series)."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(16):
        small = y < 16
        shift = np.where(small, shift + np.log(np.where(small, y, 1.0)), shift)
        y = np.where(small, y + 1, y)
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y - shift


_CACHE = _log_gamma(np.arange(1 << 16) / 2.0 + (np.arange(1 << 16) == 0) * 0.5)


def _lgamma_half(twice: np.ndarray) -> np.ndarray:
    """_log_gamma(twice / 2) for whole numbers, small ones by table."""
    big = twice >= len(_CACHE)
    out = _CACHE[np.where(big, 1, twice)]
    if big.any():
        out[big] = _log_gamma(twice[big] / 2.0)
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov block probability, natural logarithm."""
    return _lgamma_half(2 * n0 + 1) + _lgamma_half(2 * n1 + 1) - _lgamma_half(2 * (n0 + n1) + 2) - 1.1447298858494002


def shorter(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, byte) counts with the farthest context byte dropped."""
    return counted(((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255)), counts)


class Level:
    """The decision nodes of all contexts of one depth. Node ``nodes[j]``: context and the j bits decided so far."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, below: Level | None):
        self.keys, self.counts = keys, counts
        self.nodes, self.n0, self.n1, self.beta, self.log_pw = [], [], [], [], []
        for j in range(8):
            g = keys >> np.uint64(8 - j)
            starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
            bit = (keys >> np.uint64(7 - j)) & np.uint64(1) == 1
            total = np.add.reduceat(counts, starts) if len(g) else counts
            n1 = np.add.reduceat(np.where(bit, counts, 0), starts) if len(g) else counts
            node, log_pe = g[starts], log_kt(total - n1, n1)
            log_pw, beta = log_pe, np.ones(len(node))
            if below is not None:
                up = ((below.nodes[j] >> np.uint64(8 + j)) << np.uint64(j)) | (below.nodes[j] & np.uint64((1 << j) - 1))
                children = np.bincount(np.searchsorted(node, up), weights=below.log_pw[j], minlength=len(node))
                log_pw = np.logaddexp(log_pe, children) - np.log(2)
                beta = np.exp(log_pe - np.log(2) - log_pw)
            for column, v in zip((self.nodes, self.n0, self.n1, self.beta, self.log_pw), (node, total - n1, n1, beta, log_pw)):
                column.append(v)


def levels(keys: np.ndarray, counts: np.ndarray, depth: int, least: int) -> dict[int, Level]:
    """Weighted levels from ``depth`` up to ``least`` for the counts of the largest depth."""
    out: dict[int, Level] = {}
    below = None
    for d in range(depth, least - 1, -1):
        below = out[d] = Level(keys, counts, below)
        if d > least:
            keys, counts = shorter(keys, counts)
    return out


@dataclass
class Dense:
    """Contexts of one depth: key, and for each of 255 decision nodes the prediction that stops here and the
    parts (s, r) that longer contexts build on: p = s + r * (what they predict)."""

    contexts: np.ndarray
    stop: np.ndarray
    s: np.ndarray
    r: np.ndarray


def descend(parent: Dense, level: Level, min_count: int) -> Dense:
    """The contexts of ``level`` with at least ``min_count`` occurrences, below ``parent``'s."""
    context = level.keys >> np.uint64(8)
    starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
    total = np.add.reduceat(level.counts, starts) if len(starts) else np.zeros(0, np.int64)
    contexts = context[starts][total >= min_count]
    of = np.searchsorted(parent.contexts, contexts >> np.uint64(8))
    stop, s, r = parent.stop[of].copy(), parent.s[of].copy(), parent.r[of].copy()
    for j in range(8):
        own = level.nodes[j] >> np.uint64(j)
        row = np.minimum(np.searchsorted(contexts, own), max(0, len(contexts) - 1))
        hit = contexts[row] == own if len(contexts) else np.zeros(0, bool)
        row, column = row[hit], ((1 << j) | (level.nodes[j][hit] & np.uint64((1 << j) - 1)).astype(np.int64)) - 1
        kt = (level.n1[j][hit] + 0.5) / (level.n0[j][hit] + level.n1[j][hit] + 1.0)
        beta = level.beta[j][hit]
        stop[row, column] = s[row, column] + r[row, column] * kt
        s[row, column] += r[row, column] * beta * kt
        r[row, column] *= 1 - beta
    return Dense(contexts, stop, s, r)


def byte_log10(stop: np.ndarray) -> np.ndarray:
    """(contexts, 256): log10 probability of each byte from the 255 decisions."""
    out = np.zeros((len(stop), 256))
    y = np.arange(256)
    for j in range(8):
        node = ((1 << j) | (y >> (8 - j))) - 1
        p = stop[:, node]
        out += np.log10(np.where((y >> (7 - j)) & 1 == 1, p, 1 - p))
    return out.astype(np.float32)


ROOT = Dense(np.zeros(1, np.uint64), np.full((1, 255), 0.5), np.zeros((1, 255)), np.ones((1, 255)))


def full(one: Dense, root: Dense) -> Dense:
    """``one`` with a row for each of the 256 bytes: the root's where there is no such context."""
    rows = [np.repeat(x, 256, axis=0) for x in (root.stop, root.s, root.r)]
    for to, x in zip(rows, (one.stop, one.s, one.r)):
        to[one.contexts.astype(np.int64)] = x
    return Dense(np.arange(256, dtype=np.uint64), *rows)


def pruned(tree: dict[int, Level], min_count: int) -> dict[int, Level]:
    """``tree`` without the decision nodes of contexts with fewer than ``min_count`` occurrences."""
    if min_count > 1:
        for level in tree.values():
            context = level.keys >> np.uint64(8)
            starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            total, contexts = np.add.reduceat(level.counts, starts), context[starts]
            for j in range(8):
                own = total[np.searchsorted(contexts, level.nodes[j] >> np.uint64(j))] >= min_count
                for column in (level.nodes, level.n0, level.n1, level.beta):
                    column[j] = column[j][own]
    return tree


def predictions(keys: np.ndarray, tree: dict[int, Level], top: Dense, depth: int) -> np.ndarray:
    """log10 probability of the byte of each (context, byte) key, from ``top`` (contexts of one byte, see ``full``)
    and the levels of two and more bytes."""
    first, byte = (keys >> np.uint64(8 * depth)).astype(np.int64), keys & np.uint64(255)
    out = np.zeros(len(keys))
    for j in range(8):
        column = ((1 << j) | (byte >> np.uint64(8 - j)).astype(np.int64)) - 1
        stop, s, r = top.stop[first, column], top.s[first, column], top.r[first, column]
        alive = np.arange(len(keys))
        for d in range(2, depth + 1) if tree else ():
            level, k = tree[d], keys[alive]
            nodes = level.nodes[j]
            node = (((k >> np.uint64(8 * (depth - d + 1))) << np.uint64(8)) | (k & np.uint64(255))) >> np.uint64(8 - j)
            if not len(nodes):
                break
            at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
            hit = nodes[at] == node
            alive, at = alive[hit], at[hit]
            kt, beta = (level.n1[j][at] + 0.5) / (level.n0[j][at] + level.n1[j][at] + 1.0), level.beta[j][at]
            stop[alive] = s[alive] + r[alive] * kt
            s[alive] += r[alive] * beta * kt
            r[alive] *= 1 - beta
        out += np.log10(np.where((byte >> np.uint64(7 - j)) & np.uint64(1) == 1, stop, 1 - stop))
    return out


# --- the distributed model -------------------------------------------------------------------------------------


def _subtree(table: pa.Table, depth: int, least: int) -> tuple[list[np.ndarray], dict[int, Level]]:
    """The keys of each row of a pair, and the weighted levels of the training counts of all rows."""
    keys = [_unpacked(x, np.uint64, steps=True) for x in table["k"].to_pylist()]
    k, n = counted(np.concatenate(keys), np.concatenate([_unpacked(x, np.int64) for x in table["n"].to_pylist()]))
    seen = n > 0
    return keys, pruned(levels(k[seen], n[seen], depth, 2), least) if seen.any() else {}


def _top_sums(asked: DataFrame, depth: int) -> DataFrame:
    """For contexts of two bytes: (j, k, n, log_pw), the byte counts (j = -1) and the weighted nodes (j = 0 to 7)."""

    def sums(table: pa.Table) -> pa.Table:
        _, tree = _subtree(table, depth, 1)
        if not tree:
            return pa.Table.from_batches([_top_batch(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))])
        level = tree[2]
        out = [_top_batch(-1, level.keys, level.counts, np.zeros(len(level.keys)))]
        out += [_top_batch(j, level.nodes[j], np.zeros(len(level.nodes[j]), np.int64), level.log_pw[j]) for j in range(8)]
        return pa.Table.from_batches(out)

    return asked.groupBy("pair").applyInArrow(sums, "j tinyint, k bigint, n bigint, log_pw double")


def _top_batch(j: int, k: np.ndarray, n: np.ndarray, log_pw: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), j, np.int8)), pa.array(C.as_signed(k)), pa.array(n), pa.array(log_pw)], names=["j", "k", "n", "log_pw"])


def _top_levels(top) -> tuple[Level, Level]:
    """Levels of one and no context byte from the sums of two (``top``: Arrow)."""
    j, k, n, log_pw = (top[x].to_numpy() for x in ("j", "k", "n", "log_pw"))
    order = np.lexsort((k, j))  # keys of up to three bytes: no sign
    bounds = np.searchsorted(j[order], np.arange(-1, 9))
    part = lambda i, x: x[order[bounds[i + 1] : bounds[i + 2]]]
    two = Level.__new__(Level)
    two.nodes = [part(i, k).view(np.uint64) for i in range(8)]
    two.log_pw = [part(i, log_pw) for i in range(8)]
    keys, counts = shorter(part(-1, k).view(np.uint64), part(-1, n))
    one = Level(keys, counts, two)
    return one, Level(*shorter(keys, counts), one)


@dataclass(frozen=True)
class Model:
    """log10 byte probabilities of the contexts of no and one byte, their decisions, the training pairs (``chunked`` rows), the least count of a context
    that is used, and the word counts' sums."""

    values: np.ndarray
    top: Dense
    grams: DataFrame
    least: int
    n_words: int
    n_distinct: int


def train(chunks: DataFrame, rules: TreeRules) -> tuple[Model, DataFrame]:
    """The model of the training texts of ``chunks`` (a written table), and the word counts (k, n) as a table."""
    grams = chunks.where("pair IS NOT NULL").select("chunk", "base", "pair", "k", "n")
    words = chunks.where("word IS NOT NULL").groupBy(F.col("word").alias("k")).agg(F.sum("n_word").alias("n"))
    words = C.saved(words, "ctw-words")
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    sums = _top_sums(grams, rules.depth).toArrow()
    if not sums.num_rows:
        none = Dense(ROOT.contexts[:0], ROOT.stop[:0], ROOT.s[:0], ROOT.r[:0])
        return Model(byte_log10(ROOT.stop), full(none, ROOT), grams, 1, 0, 0), words
    one, root = _top_levels(sums)
    n_bytes = int(root.counts.sum())
    least = max(1, n_bytes // rules.max_contexts) if rules.max_contexts else 1
    first = descend(ROOT, root, 1)
    second = descend(first, one, least)
    return Model(np.concatenate([byte_log10(first.stop), byte_log10(second.stop)]), full(second, first), grams, least, totals["n"], totals["v"]), words


def _runs(of: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
    return list(zip(np.concatenate([[0], cuts]).tolist(), np.append(cuts, len(of)).tolist()))


def _answers(asked: DataFrame, model: Model, depth: int) -> DataFrame:
    """(chunk, base, k, v): log10 probability of each pair that a chunk of ``asked`` has. A row with training counts
    (``n``) builds the subtree; a row without ``chunk`` is only there for that."""
    sent = asked.sparkSession.sparkContext.broadcast(model.top)
    least = model.least

    def answer(table: pa.Table) -> pa.Table:
        keys, tree = _subtree(table, depth, least)
        wanted = np.flatnonzero(table["chunk"].is_valid().to_numpy(zero_copy_only=False))
        if not len(wanted):
            return _no_answers()
        asks = [keys[i] for i in wanted]
        own, back = np.unique(np.concatenate(asks), return_inverse=True)
        v = predictions(own, tree, sent.value, depth).astype(np.float32)[back]
        rows = table.take(pa.array(wanted))
        return pa.table({"chunk": rows["chunk"], "base": rows["base"], "k": rows["k"], "v": _packed(np.split(v, np.cumsum([len(x) for x in asks])[:-1]))})

    return asked.groupBy("pair").applyInArrow(answer, "chunk bigint, base bigint, k binary, v binary")


def _no_answers() -> pa.Table:
    return pa.table({"chunk": pa.nulls(0, pa.int64()), "base": pa.nulls(0, pa.int64()), "k": pa.nulls(0, pa.binary()), "v": pa.nulls(0, pa.binary())})


def _without_counts(asked: DataFrame) -> DataFrame:
    """Rows of pairs whose counts are all 0."""

    def run(batches):
        for b in batches:
            n = _packed([np.zeros(len(_unpacked(x, np.int64)), np.int64) for x in b.column("n").to_pylist()])
            yield b.set_column(b.schema.get_field_index("n"), "n", n)

    return asked.mapInArrow(run, asked.schema)


def _token_sum(c: np.ndarray, n_words: int, n_distinct: int) -> np.ndarray:
    return np.log10((c + 0.5) / (n_words + 0.5 * (n_distinct + 1)))


def score(chunks: DataFrame, model: Model, words: DataFrame, rules: TreeRules, id_type: str) -> DataFrame:
    """The texts of ``chunks`` with tokens, known tokens, base and model score. Chunks that the model was not trained
    on are answered by its subtrees too: their own counts are left out."""
    depth = rules.depth
    context = chunks.sparkSession.sparkContext
    asked = chunks.where("pair IS NOT NULL").select("chunk", "base", "pair", "k", "n")
    if not asked.sameSemantics(model.grams):
        trained = model.grams.withColumns({"chunk": F.lit(None).cast("bigint"), "base": F.lit(None).cast("bigint")})
        asked = _without_counts(asked).unionByName(trained)
    answers = _answers(asked, model, depth).withColumn("blob", F.lit(None).cast("binary"))
    missing = {"base": F.lit(None).cast("bigint"), "k": F.lit(None).cast("binary"), "v": F.lit(None).cast("binary")}
    texts = chunks.where("blob IS NOT NULL").select("chunk", "blob").withColumns(missing)
    met = answers.unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", F.col("base").asc_nulls_last())
    n_words, n_distinct = model.n_words, model.n_distinct
    known = None
    if model.n_distinct <= rules.max_sent_words:
        few = words.toArrow()
        order = np.argsort(few["k"].to_numpy())
        known = context.broadcast((few["k"].to_numpy()[order], few["n"].to_numpy()[order]))
        del few, order

    def scored(batches):
        """(texts, their words, their scores); a chunk's answers come before its texts."""
        chunk, keys, values, parts = None, None, None, []
        for b in batches:
            for own, blob, k, v in zip(*(b.column(x).to_pylist() for x in ("chunk", "blob", "k", "v"))):
                if own != chunk:
                    chunk, keys, parts = own, None, []
                if blob is None:
                    parts.append((_unpacked(k, np.uint64, steps=True), _unpacked(v, np.float32)))
                    continue
                if keys is None:
                    keys, values = (np.concatenate(x) for x in zip(*parts))
                    parts = []
                for piece in pa.ipc.open_stream(blob).read_all().to_batches():
                    w = C.Words(piece.column("text"), fold=True)
                    data, text, places = stream(w, depth)
                    asked, back = np.unique(gram_keys(data, places, depth), return_inverse=True)
                    each = values[np.searchsorted(keys, asked)][back]
                    yield piece, w, np.bincount(text, weights=each, minlength=w.n_docs)

    def batch(columns):
        return pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns.values()], names=list(columns))

    if known is not None:

        def run(batches):
            k, n = known.value
            for b, w, s in scored(batches):
                distinct, back = np.unique(C.as_signed(np.append(w.hash, _END_WORD.view(np.uint64))), return_inverse=True)
                c = np.zeros(len(distinct), np.int64)
                if len(k):
                    at = np.minimum(np.searchsorted(k, distinct), len(k) - 1)
                    c = np.where(k[at] == distinct, n[at], 0)
                each, is_known = _token_sum(c, n_words, n_distinct)[back], (c > 0)[back]
                base = np.bincount(w.doc, weights=each[:-1], minlength=w.n_docs) + each[-1]
                n_known = np.bincount(w.doc, weights=is_known[:-1], minlength=w.n_docs).astype(np.int64) + int(is_known[-1])
                yield batch({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "n_tokens": w.per_doc + 1, "n_known": n_known, "base_score": base, "score": s})

        found = met.mapInArrow(run, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    else:

        def run(batches):
            rid = count(TaskContext.get().partitionId() << 40)
            for b, w, s in scored(batches):
                order = np.lexsort((w.hash, w.doc))
                doc, h = w.doc[order], w.hash[order]
                new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])) if len(doc) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(doc)))
                per = np.bincount(doc[new], minlength=w.n_docs)
                offsets = pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32))
                pairs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(C.as_signed(h[new])), pa.array(times.astype(np.int64))], ["k", "times"]))
                ids = np.array([next(rid) for _ in range(b.num_rows)], np.int64)
                yield batch({"rid": ids, "doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "n_tokens": w.per_doc + 1, "score": s, "words": pairs})

        schema = f"rid bigint, doc_id {id_type}, held_out boolean, n_tokens bigint, score double, words array<struct<k: bigint, times: bigint>>"
        rows = C.saved(met.mapInArrow(run, schema), "ctw-scored")
        end = F.struct(F.lit(int(_END_WORD)).alias("k"), F.lit(1).cast("bigint").alias("times"))
        each = rows.select("rid", F.inline(F.concat("words", F.array(end)))).join(words, "k", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        value = F.log10((F.col("n") + 0.5) / (model.n_words + 0.5 * (model.n_distinct + 1)))
        sums = each.groupBy("rid").agg(F.sum(F.col("times") * value).alias("base_score"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_known"))
        found = rows.drop("words").join(sums, "rid")
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n_words).cast("bigint").alias("train_tokens"), "base_score", "score",
        (-F.col("score") * float(np.log2(10.0))).alias("bits"),
    )


def held_out(id_: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds == fold


def lm_scores(docs: DataFrame, rules: TreeRules = TreeRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: split, tokens, base score, and the model's log10 probability and bits."""
    own = docs.select(docs[id_col].alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].alias("text"))
    chunks = C.saved(chunked(own, rules), "ctw-chunks")
    model, words = train(chunks, rules)
    return score(chunks, model, words, rules, dict(own.dtypes)["doc_id"])


def op3_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(C.read_documents(spark, sf_dir))
