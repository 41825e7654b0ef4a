"""Operator 11, fill-in-middle transformation: two cuts per text, found with an indexable skip list.

A text is a sequence of units (lines by default; any pattern that covers the text). An indexable skip list keeps two
widths on every link of every lane: how many units the link passes, and how many code points. A cut is a unit rank;
descending the lanes by accumulated unit widths reaches the rank exactly, and the point widths summed on the way are
the place of the cut in code points, in an expected number of steps that grows with the logarithm of the units. Which
units rise to a lane is a fixed coin of the unit's index, so a text has one list, wherever it is built.

The two ranks and the form (prefix-suffix-middle, suffix-prefix-middle, or plain) come from a salted hash of the id,
so a rerun or a retried task repeats them. One document is one row and nothing is shuffled; a task holds about 1 MB of
text at once (a longer text by itself). ``restored`` takes an output apart again with SQL functions alone.

Defined results: a NULL text counts as empty; empty texts, and texts that hold a sentinel, stay plain with NULL cut
widths; the salt of a NULL id ends after the colon; repeated rows give repeated results; an empty table gives an empty
result; ids keep their type and other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Sentinels of prefix, suffix and middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A line with its break, or the rest after the last break.
LINES = r"[^\n]*\n|[^\n]+"
#: One unit in so many rises from a lane to the next.
FAN = 4


class SkipList:
    """Units in order with express lanes; each link has a unit width and a point width."""

    def __init__(self, points: np.ndarray, fan: int = FAN):
        units = np.ones(len(points), np.int64)
        points = np.asarray(points, np.int64)
        #: bottom lane first: unit widths, point widths, and where each link's node stands in the lane below
        self.lanes = [(units.tolist(), points.tolist(), None)]
        node = np.arange(len(points), dtype=np.uint64)
        while len(node) > fan:
            coin = C.salted(node, len(self.lanes)) % np.uint64(fan) == 0
            coin[0] = True  # the head stands in every lane
            up = np.flatnonzero(coin)
            if len(up) == len(node):
                break
            units, points, node = np.add.reduceat(units, up), np.add.reduceat(points, up), node[up]
            self.lanes.append((units.tolist(), points.tolist(), up.tolist()))

    def points_before(self, rank: int) -> int:
        """Code points in the first ``rank`` units."""
        at = passed = place = 0
        for units, points, below in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed += units[at]
                place += points[at]
                at += 1
            if passed == rank:
                return place
            at = below[at] if below else at
        return place


def unit_widths(text: str, units: re.Pattern) -> np.ndarray:
    """Code points of each unit; what the pattern leaves out belongs to the unit before it."""
    ends = np.fromiter((m.start() for m in units.finditer(text)), np.int64)
    return np.diff(np.append(ends, len(text)), prepend=0)[1:] if len(ends) else np.zeros(0, np.int64)


def draws(salt: str, doc_id) -> list[int]:
    """The first four 32-bit numbers of the salted hash of an id."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def split(text: str, doc_id, salt: str, units: re.Pattern, rate_pct: int, spm_pct: int) -> tuple[int, str, str, str, str]:
    """(units, form, prefix, middle, suffix) of one text; a plain text is all prefix."""
    widths = unit_widths(text, units)
    n, (h1, h2, h3, h4) = len(widths), draws(salt, doc_id)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate_pct:
        return n, "plain", text, "", ""
    ranks = sorted((h1 % (n + 1), h2 % (n + 1)))
    skip = SkipList(widths)
    a, b = (skip.points_before(r) for r in ranks)
    return n, "spm" if h4 % 100 < spm_pct else "psm", text[:a], text[a:b], text[b:]


def arranged(form: Column, prefix: Column, middle: Column, suffix: Column) -> Column:
    """The output of a form."""
    return (
        F.when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(form == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(prefix)
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No part holds a sentinel, so the first one found ends its part."""
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    first = F.split_part(body, second, F.lit(1))
    rest = F.substr(body, F.char_length(first) + len(PREFIX) + 1)
    other = F.split_part(rest, F.lit(MIDDLE), F.lit(1))
    middle = F.substr(rest, F.char_length(other) + len(MIDDLE) + 1)
    return F.when(form == "psm", F.concat(first, middle, other)).when(form == "spm", F.concat(other, middle, first)).otherwise(output)


def fill_in_middle(
    docs: DataFrame, salt: str = "7", rate_pct: int = 100, spm_pct: int = 50, units: str = LINES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n, form, prefix, middle, suffix, output): the parts in the text's order and the sequence to train on.

    ``rate_pct`` of the documents are transformed, ``spm_pct`` of those with the suffix first. A plain document's
    whole text is its prefix, with NULL for the other parts."""
    pattern = re.compile(units)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in C.pieces(batches, "text"):
            ids = b.column("doc_id")
            rows = [split(t or "", i, salt, pattern, rate_pct, spm_pct) for t, i in zip(b.column("text").to_pylist(), b.column("key").to_pylist())]
            n, form, prefix, middle, suffix = zip(*rows) if rows else ([],) * 5
            cut = [f != "plain" for f in form]
            parts = [prefix, [m if c else None for m, c in zip(middle, cut)], [s if c else None for s, c in zip(suffix, cut)]]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), *(pa.array(p, pa.string()) for p in parts)],
                names=["doc_id", "n", "form", "prefix", "middle", "suffix"],
            )

    read = docs.select(docs[id_col].alias("doc_id"), docs[id_col].cast("string").alias("key"), docs[text_col].alias("text"))
    cut = read.mapInArrow(run, f"doc_id {id_type}, n bigint, form string, prefix string, middle string, suffix string")
    return cut.withColumn("output", arranged(F.col("form"), F.col("prefix"), F.col("middle"), F.col("suffix")))


def op11_indexable_skip_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(C.read_documents(spark, sf_dir))
    cut = F.col("form") != "plain"
    return made.select(
        "doc_id", "n", "form",
        F.when(cut, F.char_length("prefix")).cast("bigint").alias("prefix_chars"),
        F.when(cut, F.char_length("middle")).cast("bigint").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u
  FROM documents),
r AS (
  SELECT doc_id, t, u, len(u) AS n,
         ('0x' || substr(h, 1, 8))::UBIGINT::BIGINT % (len(u) + 1) AS r1, ('0x' || substr(h, 9, 8))::UBIGINT::BIGINT % (len(u) + 1) AS r2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(h, 17, 8))::UBIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::UBIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, t, n, form,
         array_to_string(u[1:least(r1, r2)], '') AS prefix,
         array_to_string(u[least(r1, r2) + 1:greatest(r1, r2)], '') AS middle,
         array_to_string(u[greatest(r1, r2) + 1:n], '') AS suffix
  FROM r)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
