"""Operator 2, benchmark decontamination: template canonicalisation.

Words are reduced to their letters and digits, A-Z folded; numbers, names and units become typed placeholders, so
that a question with other numbers or names has the same template. Windows of template words are hash-joined
between benchmark and documents. The values that stand at the placeholders (slots) are compared in the windows
that match: in a re-parameterised question each slot value of the item is replaced by one value throughout, in
a chance match of templates it is not. A document is contaminated by an item if enough of the item's windows
match and the slots are consistent, in the whole document or in one occurrence: the matches at one distance
between document and item position, or at neighbouring distances (a replacement may have more words). So a document
that holds an item twice with different values is contaminated too; the figures are those of the whole document if
it passes, otherwise of the best occurrence.

A number is a word with a digit, or a run of number words, hyphens or not ("twenty-one", "one hundred and five" but for
its "and"); digits are parted from letters that follow ("5kg"); a unit is a word of ``UNITS`` after a number; a name
is a capitalised word that does not begin a sentence. A window needs ``min_literals`` words that are no placeholders.
An item shorter than a window is one window of its own length. An item without any window of enough literals (many
numbers or names) is matched by its exact words instead; one of less than ``min_item_words`` words too, and only
where it stands alone: between starts and ends of sentences, lines or the text.

A window that more than ``max_holders`` different templates of the benchmark hold (instructions, answer formats)
identifies no item: evidence is counted on an item's other windows, and only those are joined, so boilerplate convicts
nobody and a hit list is at most ``max_holders`` templates long. Items with one template are one holder. An item that has
no other windows needs all of its windows.

Work at scale: one pass over the documents keeps only windows whose hash the benchmark has (its hashes go to the
tasks if there are at most ``MAX_SENT_WINDOWS``; otherwise the documents' windows are joined by shuffle); the
hits are joined with the items by hash and counted by (document, item) with partial aggregation.

Defined results: NULL and empty texts and items match nothing; rows repeated under one id are one document; an
item listed twice under one id is one item; empty tables give an empty result; ``without_contaminated`` passes
all columns unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds "
    "ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents mph kmh degree degrees celsius fahrenheit watt watts kw volt volts amp amps joule joules"
).split()
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
#: Window hashes (8 bytes each) that may be sent to every task.
MAX_SENT_WINDOWS = 2_000_000

_BYTES = np.arange(256)
_DIGIT = (_BYTES >= ord("0")) & (_BYTES <= ord("9"))
_UPPER = (_BYTES >= ord("A")) & (_BYTES <= ord("Z"))
_LOWER = (_BYTES >= ord("a")) & (_BYTES <= ord("z"))
_CONTENT = _DIGIT | _UPPER | _LOWER | (_BYTES >= 0x80)
_ENDS = np.isin(_BYTES, list(b".!?:"))
#: Windows of template words, of exact words, of exact words that stand alone.
TEMPLATE, EXACT, ALONE = 0, 1, 2
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (11, 13, 17))


@dataclass(frozen=True)
class TemplateRules:
    window: int = 8
    min_literals: int = 5
    min_item_words: int = 5
    #: Contaminated: this share of an item's windows matches, or this many windows, ...
    min_coverage: float = 0.5
    min_windows: int = 13
    #: ... and at least this share of the slots fits one substitution of the item's slot values.
    min_consistency: float = 0.9
    #: A window of more templates than this is nobody's.
    max_holders: int = 5
    #: Matches of one occurrence: distances between document and item position that differ by at most this.
    max_drift: int = 3
    max_sent_windows: int = MAX_SENT_WINDOWS


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.sort(C.Words(pa.array(words)).hash)


_UNIT_HASHES, _NUMBER_HASHES = _word_hashes(UNITS), _word_hashes(NUMBERS)
_HYPHEN = "(?i)\\b(" + "|".join(NUMBERS[20:28]) + ")-(" + "|".join(NUMBERS[1:10]) + ")\\b"


def parted(texts: pa.Array) -> pa.Array:
    """Texts with a space between a digit and a letter after it, and in hyphenated number words."""
    texts = pc.replace_substring_regex(texts, "([0-9])([A-Za-z])", r"\1 \2")
    return pc.replace_substring_regex(texts, _HYPHEN, r"\1 \2")


class Template:
    """Template words of a batch of texts: text of each, value hash, template hash, placeholder flag."""

    def __init__(self, texts: pa.Array):
        w = C.Words(parted(texts))
        at = np.flatnonzero(_CONTENT[w.data])
        of = np.searchsorted(w.start, at, side="right") - 1  # every content byte is inside a word
        n = np.bincount(of, minlength=len(w.start))
        some = np.flatnonzero(n)
        first = np.concatenate([[0], np.cumsum(n)])[:-1][some]
        body = w.data[at]
        self.n_docs = w.n_docs
        self.doc = w.doc[some]
        self.value = C.segment_hash(C.FOLD[body], first, n[some])
        digits = np.bincount(of, weights=_DIGIT[body], minlength=len(w.start))[some] > 0
        spelled = np.isin(self.value, _NUMBER_HASHES)
        number = digits | spelled
        same = np.concatenate([[False], self.doc[1:] == self.doc[:-1]]) if len(some) else np.zeros(0, bool)
        unit = np.isin(self.value, _UNIT_HASHES) & same & np.concatenate([[False], number[:-1]]) if len(some) else np.zeros(0, bool)
        # a capital that is not the first of a sentence: the word before ends no sentence, no line break between
        ends = _ENDS[w.data[w.end[some] - 1]] if len(some) else np.zeros(0, bool)
        breaks = np.concatenate([[0], np.cumsum(w.data == 0x0A)])
        opens = np.ones(len(some), bool)
        if len(some):
            opens[1:] = ends[:-1] | (breaks[w.start[some][1:]] != breaks[w.start[some][:-1]]) | ~same[1:]
        second = np.minimum(first + 1, max(0, len(body) - 1))
        capital = _UPPER[body[first]] & _LOWER[body[second]] & (n[some] > 1) if len(some) else np.zeros(0, bool)
        name = capital & ~opens & ~number
        self.slot = number | unit | name
        self.opens = opens
        self.hash = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, self.value)))
        # a run of number words is one number: its first word stays, with a value of the whole run
        first_of = np.flatnonzero(~(spelled & same & np.concatenate([[False], spelled[:-1]]))) if len(some) else np.zeros(0, np.int64)
        if len(first_of) < len(some):
            place = np.arange(len(some)) - np.repeat(first_of, np.diff(np.append(first_of, len(some))))
            whole = np.add.reduceat(np.where(place > 0, C.mix64(self.value + place.astype(np.uint64)), self.value), first_of)
            self.doc, self.value, self.slot, self.opens, self.hash = self.doc[first_of], whole, self.slot[first_of], self.opens[first_of], self.hash[first_of]

    def windows(self, n: int, min_literals: int, kind: int = TEMPLATE) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of each window of n words of ``kind`` inside one text; template ones with enough literals."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        ok = self.doc[:m] == self.doc[n - 1 :]
        if kind == TEMPLATE:
            literals = np.concatenate([[0], np.cumsum(~self.slot)])
            ok &= literals[n:] - literals[:m] >= min(min_literals, n)
        elif kind == ALONE:  # the first word of a text opens
            ok &= self.opens[:m] & np.append(self.opens, True)[n:]
        at = np.flatnonzero(ok)
        return self.windows_at(at, n, kind), at

    def windows_at(self, at: np.ndarray, n: int, kind: int) -> np.ndarray:
        words = self.hash if kind == TEMPLATE else self.value
        h = np.full(len(at), n + (kind << 32), np.uint64)
        for k in range(n):
            h = C.mix64(h * C._BASE + words[at + k])
        return h

    def slots(self, at: np.ndarray, n: int) -> list[list[int]]:
        signed = C.as_signed(self.value)
        return [[int(signed[i]) for i in range(a, a + n) if self.slot[i]] for a in at]


def item_windows(benchmark: DataFrame, rules: TemplateRules, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(h, n, kind, item_id, pos, slots, n_windows) of each window of each item."""
    id_type = benchmark.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in C.pieces(batches, "text"):
            t = Template(b.column("text"))
            words = np.bincount(t.doc, minlength=t.n_docs)
            ids = b.column("item_id").to_pylist()
            first = np.concatenate([[0], np.cumsum(words)])
            rows: list[list] = [[] for _ in range(7)]
            length = np.minimum(words, rules.window)
            found = np.zeros(t.n_docs, bool)
            for kind in (TEMPLATE, EXACT, ALONE):
                may = (words > 0) & (words < rules.min_item_words) if kind == ALONE else words >= rules.min_item_words
                may &= ~found
                for n in np.unique(length[may]).tolist():
                    # an item is its own text: in an ALONE window nothing stands beside it
                    h, at = t.windows(n, rules.min_literals, EXACT if kind == ALONE else kind)
                    own = (may & (length == n))[t.doc[at]] if len(at) else np.zeros(0, bool)
                    at = at[own]
                    h = C.as_signed(t.windows_at(at, n, kind))
                    total = np.bincount(t.doc[at], minlength=t.n_docs)
                    found |= total > 0
                    for x, a, s in zip(h, at, t.slots(at, n) if kind == TEMPLATE else [[]] * len(at)):
                        d = int(t.doc[a])
                        for column, v in zip(rows, (int(x), n, kind, ids[d], int(a - first[d]), s, int(total[d]))):
                            column.append(v)
            types = [pa.int64(), pa.int32(), pa.int32(), b.schema.field("item_id").type, pa.int32(), pa.list_(pa.int64()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(r, t_) for r, t_ in zip(rows, types)], names=["h", "n", "kind", "item_id", "pos", "slots", "n_windows"])

    own = benchmark.select(benchmark[id_col].alias("item_id"), benchmark[text_col].alias("text"))
    return own.mapInArrow(run, f"h bigint, n int, kind int, item_id {id_type}, pos int, slots array<bigint>, n_windows int")


def identifying(windows: DataFrame, rules: TemplateRules) -> DataFrame:
    """The windows that identify an item, with their number (``n_windows``); all windows of an item that has none
    (``common``)."""
    windows = windows.withColumn("rid", F.struct("item_id", "kind")).dropDuplicates(["rid", "h", "pos"])  # an item may be listed twice
    windows = C.saved(windows, "template-windows")
    each = windows.groupBy("rid").agg(F.sort_array(F.collect_set("h")).alias("all"))
    template = each.select(F.col("rid").alias("r"), F.xxhash64("all").alias("template"))
    held = windows.join(template, F.col("rid").eqNullSafe(F.col("r"))).groupBy("h").agg(F.countDistinct("template").alias("holders"))
    marked = windows.join(held, "h").withColumn("own", (F.col("holders") <= rules.max_holders).cast("int"))
    of_item = Window.partitionBy("rid")  # an item's windows
    marked = marked.withColumn("n_own", F.sum("own").over(of_item)).where((F.col("own") == 1) | (F.col("n_own") == 0))
    return marked.withColumns({"n_windows": F.count("*").over(of_item).cast("int"), "common": F.col("n_own") == 0}).drop("rid", "holders", "own", "n_own")


def _document_windows(docs: DataFrame, lengths: list[tuple[int, int]], known: np.ndarray | None, rules: TemplateRules) -> DataFrame:
    """(rid, doc_id, h, place, values) of the documents' windows; with ``known`` only those."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(known)) if known is not None else None

    def run(batches):
        rid = count(TaskContext.get().partitionId() << 40)
        hashes = sent.value if sent is not None else None
        for b in C.pieces(batches, "text"):
            t = Template(b.column("text"))
            first = np.concatenate([[0], np.cumsum(np.bincount(t.doc, minlength=t.n_docs))])
            ids = np.array([next(rid) for _ in range(b.num_rows)], np.int64)
            for n, kind in lengths:
                h, at = t.windows(n, rules.min_literals, kind)
                h = C.as_signed(h)
                if hashes is not None and len(h):
                    hit = hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
                    h, at = h[hit], at[hit]
                doc = t.doc[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[doc]), b.column("doc_id").take(pa.array(doc)), pa.array(h), pa.array(at - first[doc]), pa.array(t.slots(at, n) if kind == TEMPLATE else [[]] * len(at), pa.list_(pa.int64()))],
                    names=["rid", "doc_id", "h", "place", "values"],
                )

    return docs.mapInArrow(run, f"rid bigint, doc_id {id_type}, h bigint, place bigint, values array<bigint>")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rules: TemplateRules = TemplateRules(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per contaminated document and item: matching windows, the item's windows, coverage, consistency."""
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    items = C.saved(identifying(item_windows(benchmark, rules, item_col, item_text_col), rules), "template-items")
    lengths = sorted((r["n"], r["kind"]) for r in items.select("n", "kind").distinct().collect())
    some = items.select("h").distinct().limit(rules.max_sent_windows + 1).toArrow()["h"].to_numpy()
    if not len(some):
        known = np.zeros(1, np.int64)
    else:
        known = some if len(some) <= rules.max_sent_windows else None
    windows = _document_windows(own, lengths, known, rules)
    if known is None:
        windows = windows.join(items.select("h").distinct(), "h", "left_semi").select("rid", "doc_id", "h", "place", "values")
    windows = C.saved(windows, "template-hits")
    hits = windows.join(items, "h").withColumn("shift", F.col("place") - F.col("pos"))
    by_shift = Window.partitionBy("rid", "item_id").orderBy("shift")
    hits = hits.withColumn("new", (F.col("shift") - F.lag("shift").over(by_shift) > rules.max_drift).cast("bigint"))
    hits = hits.withColumn("run", F.coalesce(F.sum("new").over(by_shift), F.lit(0).cast("bigint")))
    # the whole document, each run of neighbouring shifts, each shift
    one = lambda level, c: F.struct(F.lit(level).alias("level"), c.alias("place"))
    hits = hits.withColumn("occurrence", F.explode(F.array(one(0, F.lit(0).cast("bigint")), one(1, F.col("run")), one(2, F.col("shift")))))
    key = ["rid", "item_id", "occurrence"]
    matched = hits.groupBy(*key, "doc_id", "pos").agg(F.max("n_windows").alias("n_windows"), F.max("common").alias("common")).groupBy(*key, "doc_id")
    matched = matched.agg(F.count("*").alias("n_matched"), F.max("n_windows").alias("n_windows"), F.max("common").alias("common"))
    # each slot value of the item: how often its most frequent replacement stands there
    slots = hits.where(F.size("slots") > 0).select(*key, F.explode(F.arrays_zip("slots", "values")).alias("s"))
    fits = slots.groupBy(*key, F.col("s.slots").alias("slot"), F.col("s.values").alias("value")).agg(F.count("*").alias("n"))
    fits = fits.groupBy(*key, "slot").agg(F.max("n").alias("best"), F.sum("n").alias("n")).groupBy(*key)
    fits = fits.agg((F.sum("best") / F.sum("n")).alias("consistency"))
    fits = fits.select(F.col("rid").alias("r"), F.col("item_id").alias("i"), F.col("occurrence").alias("o"), "consistency")
    both = matched.join(fits, (F.col("rid") == F.col("r")) & F.col("item_id").eqNullSafe(F.col("i")) & (F.col("occurrence") == F.col("o")), "left")
    coverage = F.col("n_matched") / F.col("n_windows")
    consistency = F.coalesce("consistency", F.lit(1.0))
    whole = (F.col("occurrence.level") == 0).alias("whole")
    found = both.select("doc_id", "item_id", whole, "common", "n_matched", "n_windows", coverage.alias("coverage"), consistency.alias("consistency"))
    enough = F.when(F.col("common"), F.col("coverage") >= 1).otherwise((F.col("coverage") >= rules.min_coverage) | (F.col("n_matched") >= rules.min_windows))
    found = found.where(enough & (F.col("consistency") >= rules.min_consistency))
    best = F.max(F.struct("whole", "n_matched", "n_windows", "coverage", "consistency")).alias("best")
    found = found.groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", *(f"best.{x}" for x in ("n_matched", "n_windows", "coverage", "consistency")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rules: TemplateRules = TemplateRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document no item contaminates."""
    gone = C.saved(contaminated(docs, benchmark, rules, id_col, text_col).select(F.col("doc_id").alias("__leak_id")).distinct(), "template-gone")
    return docs.join(gone, docs[id_col].eqNullSafe(F.col("__leak_id")), "left_anti")


def read_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op2_template_canonicalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(C.read_documents(spark, sf_dir), read_benchmark(spark, sf_dir))
