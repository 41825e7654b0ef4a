"""The training-data pipeline over ``documents``: each stage is written as Parquet and reread as the next one's input.

1. quality rules: documents that the repetition rules reject go (operator 9);
2. near-dedup: of each group of near duplicates the document with the smallest id stays (operator 4, five words, 0.8);
3. decontamination: documents that hold a benchmark item's template go (operator 2);
4. mixing: sources are repeated to temperature weights, at most twice, none less than once (operator 8);
5. sharding: a k-d tree shard number is added (operator 6).

NULLs, empty and repeated rows and clashing column names have the results that each operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import common as C
from tillroll.llm import decontaminate, minhash, mixing, quality, sharding


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, decontaminate.read_benchmark(spark, sf_dir))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.with_shards(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", source_mixing),
    ("sharding", shards),
]

#: Near-duplicate components, the bisected exponent and the tree have no SQL form; tests compare the run with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read_documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = C.saved(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
