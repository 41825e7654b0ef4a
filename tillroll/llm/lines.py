"""Operator 5, line dedup: levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space at both ends, A-Z lower-cased. The index of keys seen so
far is a set of runs: bucketed tables of 128-bit key hashes, sorted inside their buckets, each key in exactly one
run, with the number of documents that hold it and the largest of their ids. A new batch is reduced to its own
sorted, bucketed table of keys and merge-anti-joined with one run after the other: keys not seen before become a run of
level 0; keys already seen become a small table of hits (documents to add, larger id). All of them have the same
buckets, so the runs are read in place and never shuffled again. When a level has more than ``fan_out`` runs they are
compacted into one run of the next level; since keys are unique over all runs that is a rewrite bucket by bucket,
no aggregation. A key's totals are its run entry plus its hits.

Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose their lines except in
the document with the largest id. Documents meet the places of their lost lines in one join on id and text; texts of
documents without lost lines pass unchanged. A text is cut at its places by set difference and lookup by index, in time
linear in its lines. Batches are slices of the ids, so a document's lines are in one batch.

Everything is DataFrame operations. A hot line is reduced by partial aggregation before any shuffle and its
rows are split by the engine's skew join; nothing is gathered by key.

Defined results: a NULL or empty text is one empty line; rows repeated under one id are one document for the
counts and are rewritten alike; rows without an id count together as one document, smaller than all others; an
empty table gives an empty result; other columns pass through ``dedup_lines`` unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common as C

#: Smaller than any id.
NO_ID = -(1 << 63)
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(line: Column) -> Column:
    key = C.lower_ascii(F.trim(line, F.lit(C.SPACES)))
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


def line_keys(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, t, place, h1, h2): the long enough lines of each document; ``t`` is the hash of the text."""
    own = docs.select(F.coalesce(docs[id_col].cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64(docs[text_col]).alias("t"), F.posexplode(lines_of(docs[text_col])).alias("place", "line"))
    stripped = own.withColumn("line", F.trim("line", F.lit(C.SPACES))).where(F.char_length("line") >= min_chars)
    return stripped.select("doc", "t", "place", _hashes(F.col("line")).alias("key")).select("doc", "t", "place", "key.*")


@dataclass
class LineRuns:
    """The index: runs by level, and the hits of keys seen again. Tables lie in the shared folder, all with
    ``n_buckets`` buckets (the session's shuffle partitions if not given)."""

    fan_out: int = 2
    n_buckets: int | None = None
    levels: list[list[DataFrame]] = field(default_factory=list)
    hits: list[DataFrame] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add(self, keys: DataFrame) -> None:
        """Take in a batch of (doc, h1, h2); its documents must not be in an earlier batch."""
        batch = self._bucketed(keys.select("doc", *KEY).distinct().groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc").alias("last")), "line-batch")
        if not self.runs():
            self._put(0, batch)
            return
        fresh = batch
        for run in self.runs():
            seen = run.select(*KEY).hint("merge")
            fresh = fresh.join(seen, KEY, "left_anti")
            self.hits.append(batch.join(seen, KEY, "left_semi"))
        self._put(0, self._bucketed(fresh, "line-run"))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) > self.fan_out:
            merged, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._bucketed(_union(merged), f"line-run-level{level + 1}"))

    def _bucketed(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table in the shared folder, one sorted file a bucket, its buckets known to the planner."""
        self.n_buckets = self.n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_path(df.sparkSession, name)
        table = path.rpartition("/")[2].replace("-", "_")
        dealt = df.repartition(self.n_buckets, *KEY)
        dealt.write.bucketBy(self.n_buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(table, format="parquet")
        return df.sparkSession.table(table)

    def frequent(self, min_docs: int) -> DataFrame:
        """(h1, h2, last): keys in at least ``min_docs`` documents, and the largest id that holds each."""
        runs = _union(self.runs())
        if not self.hits:
            return runs.where(F.col("n") >= min_docs).select(*KEY, "last")
        more = _union(self.hits).groupBy(*KEY).agg(F.sum("n").alias("more"), F.max("last").alias("later"))
        both = runs.join(more.hint("merge"), KEY, "left")
        total = F.col("n") + F.coalesce("more", F.lit(0))
        return both.where(total >= min_docs).select(*KEY, F.greatest("last", F.coalesce("later", "last")).alias("last"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lost_lines(docs: DataFrame, min_chars: int, min_docs: int, n_batches: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, t, lost): places of the lines that a text loses; texts that lose none are absent."""
    keys = line_keys(docs, min_chars, id_col, text_col)
    keys = C.saved(keys.withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(n_batches)).cast("int")), "line-keys", "batch")
    index = LineRuns()
    for b in range(n_batches):
        index.add(keys.where(F.col("batch") == b).drop("batch"))
    frequent = C.saved(index.frequent(min_docs), "line-frequent")
    lost = keys.drop("batch").join(frequent, KEY).where(F.col("doc") != F.col("last"))
    return lost.groupBy("doc", "t").agg(F.collect_set("place").alias("lost"))


def _rewritten(docs: DataFrame, lost: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column, Column, Column]:
    """Documents beside their lost lines; number of lines, of dropped lines, and the text that stays."""
    own = lost.select(F.col("doc").alias("__doc"), F.col("t").alias("__t"), F.col("lost").alias("__lost"))
    same = (F.coalesce(docs[id_col].cast("bigint"), F.lit(NO_ID)) == F.col("__doc")) & (F.xxhash64(docs[text_col]) == F.col("__t"))
    both = docs.join(own, same, "left")
    text = F.coalesce(docs[text_col], F.lit(""))
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    some = F.col("__lost").isNotNull()
    # the generator makes the lines once a row; an expression would be made again for each line looked up
    both = both.select("*", F.explode(F.array(F.when(some, lines_of(text)))).alias("__lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__lost"))
    stay = F.array_join(F.transform(places, lambda i: F.get("__lines", i)), "\n")
    dropped = F.when(some, F.size("__lost")).otherwise(F.lit(0))
    return both, n_lines.cast("bigint"), dropped.cast("bigint"), F.when(some, stay).otherwise(text)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, n_batches: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts that stay (NULL texts stay NULL)."""
    both, _, _, text = _rewritten(docs, lost_lines(docs, min_chars, min_docs, n_batches, id_col, text_col), id_col, text_col)
    kept = F.when(docs[text_col].isNotNull(), text)
    return both.select(*(kept.alias(c) if c == text_col else docs[c] for c in docs.columns))


def line_report(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, n_batches: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: lines, dropped lines, digest of the text that stays."""
    both, n_lines, dropped, text = _rewritten(docs, lost_lines(docs, min_chars, min_docs, n_batches, id_col, text_col), id_col, text_col)
    return both.select(docs[id_col].alias("doc_id"), n_lines.alias("n_lines"), dropped.alias("n_dropped"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


def op5_levelled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(C.read_documents(spark, sf_dir))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT doc_id, line, i, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.line, k.i, f.key IS NOT NULL AND k.doc_id <> f.last AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
