"""Operator 9, quality rules: repetition coverage.

For each text, the share of its word characters that lies inside duplicated word n-grams (several lengths)
and inside duplicated lines, from 64-bit rolling hashes in numpy, vectorised over a batch of texts. A
document is one row; nothing is shuffled, and a task holds a few MB of text at a time.

Defined results: a NULL or empty text has no words and fails the word minimum; repeated rows are judged
alike; an empty table gives an empty result; other columns pass through ``keep_documents`` unchanged,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as C

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict, as shares of a text's word characters (or words, for the base rule)."""

    min_words: int = 20
    repeat_window: int = 8
    max_repeat_pct: int = 30
    #: n-gram length -> largest share of characters inside n-grams that occur before in the text
    ngram_chars: dict[int, float] = field(default_factory=lambda: {4: 0.50, 6: 0.40, 10: 0.30})
    max_dup_line_chars: float = 0.50


def _again(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(occurs at least twice in its text, occurs before in its text) for each key."""
    keys = C.mix64(keys ^ C.mix64(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.zeros(len(keys), bool)
    either = np.zeros(len(keys), bool)
    later[order[1:]] = same
    either[order[1:]] |= same
    either[order[:-1]] |= same
    return either, later


def _covered(first_words: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Words inside at least one of the n-word windows that start at ``first_words``."""
    edge = np.zeros(n_words + 1, np.int64)
    edge += np.bincount(first_words, minlength=n_words + 1)
    edge -= np.bincount(first_words + n, minlength=n_words + 1)
    return np.cumsum(edge)[:n_words] > 0


def measure(texts: pa.Array, rules: RepetitionRules) -> dict[str, np.ndarray]:
    """All measures and the verdict for a batch of texts."""
    w = C.Words(texts)
    cp = w.code_points()
    chars = (cp[w.end] - cp[w.start]).astype(np.int64)
    n_docs, n_words = w.n_docs, w.per_doc.astype(np.int64)
    by_doc = lambda mask, weight: np.bincount(w.doc[mask], weights=weight[mask], minlength=n_docs).astype(np.int64)
    every = np.ones(len(chars), bool)
    word_chars = by_doc(every, chars)
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": C.per_text_sum(SYMBOLS[w.data], w.bounds)}

    # lines: exact text, from one line break (or text start) to the next; empty ones have no word
    breaks = np.flatnonzero(w.data == 0x0A)
    starts = np.union1d(w.bounds[:-1], breaks)  # a line's segment includes the break before it
    starts = starts[starts < len(w.data)]
    lengths = np.diff(np.append(starts, len(w.data)))
    line_doc = np.searchsorted(w.bounds, starts, side="right") - 1
    data = w.data
    if len(starts):
        # a text's first line has no break before it: compare lines without it
        lead = (data[starts] == 0x0A).astype(np.int64)
        # the first line of a text that begins with a break is empty; its segment is the second line
        keep = np.ones(len(data), bool)
        keep[starts[lead == 1]] = False
        full = (lengths - lead) > 0
        body = data[keep]
        at = np.concatenate([[0], np.cumsum(lengths - lead)])[:-1]
        line_hash = np.zeros(len(starts), np.uint64)
        line_hash[full] = C.segment_hash(body, at[full], (lengths - lead)[full])
        has_word = np.bincount(np.searchsorted(starts, w.start, side="right") - 1, minlength=len(starts)) > 0
        idx = np.flatnonzero(has_word)
        _, later = _again(line_hash[idx], line_doc[idx])
        dup = np.zeros(len(starts), bool)
        dup[idx[later]] = True
        out["n_dup_lines"] = np.bincount(line_doc[dup], minlength=n_docs).astype(np.int64)
        in_dup = dup[np.searchsorted(starts, w.start, side="right") - 1] if len(w.start) else np.zeros(0, bool)
        out["dup_line_chars"] = by_doc(in_dup, chars)
    else:
        out["n_dup_lines"] = np.zeros(n_docs, np.int64)
        out["dup_line_chars"] = np.zeros(n_docs, np.int64)

    keys, at = w.shingles(rules.repeat_window)
    either, _ = _again(keys, w.doc[at])
    out["n_repeat_words"] = by_doc(_covered(at[either], rules.repeat_window, len(chars)), np.ones(len(chars)))
    out["base_failed"] = (n_words < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_pct * n_words)

    bad = out["dup_line_chars"] > rules.max_dup_line_chars * word_chars
    for n, limit in rules.ngram_chars.items():
        keys, at = w.shingles(n)
        _, later = _again(keys, w.doc[at])
        inside = by_doc(_covered(at[later], n, len(chars)), chars)
        out[f"dup_{n}gram_chars"] = inside
        bad |= inside > limit * word_chars
    out["kept"] = ~(out["base_failed"] | bad)
    return out


def repetition_quality(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, coverage by n-gram length, verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *(f"dup_{n}gram_chars" for n in rules.ngram_chars), "dup_line_chars"]
    flags = ["base_failed", "kept"]
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{x} bigint" for x in names) + ", " + ", ".join(f"{x} boolean" for x in flags)

    def run(batches):
        for b in C.pieces(batches, "text"):
            m = measure(b.column("text"), rules)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(m[x]) for x in names + flags)], names=["doc_id", *names, *flags])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def keep_documents(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns unchanged."""

    def run(batches):
        for b in C.pieces(batches, text_col):
            yield b.filter(pa.array(measure(b.column(text_col), rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def op9_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_quality(C.read_documents(spark, sf_dir))
