"""Bucketed, sorted tables (S9, S10): rows dealt by a key once, when they are written, so that later deduplication and
joins on that key need no exchange.

``write_bucketed`` publishes a version as ``sources.files`` does (versioned folder, manifest replaced by rename) and
keeps the bucketing beside it; ``read_bucketed`` declares the current version as an external table of the session's
catalog, which is how Spark learns the layout, and never infers a schema. Tables that meet on a key need the same number of
buckets: at scale about the bytes of the largest one / 200 MB.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillroll.sources import files

LAYOUT = "_LAYOUT"


def _name(version: str) -> str:
    return f"bucketed_{version}"


def write_bucketed(df: DataFrame, root: str, name: str, key: str, n_buckets: int, sort: Sequence[str] = ()) -> str:
    """Publish a version of ``name`` dealt into ``n_buckets`` by ``key``, sorted by key and ``sort`` inside each."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    files.ensure_namespace(spark, f"{root.rstrip('/')}/{name}")
    order = [key, *[c for c in sort if c != key]]
    # one task a bucket, so that each bucket is one sorted file
    dealt = df.repartition(n_buckets, key)
    writer = dealt.write.format("parquet").bucketBy(n_buckets, key).sortBy(*order).option("path", files.version_path(root, name, version))
    writer.saveAsTable(_name(version))
    files._replace_text(spark, f"{root.rstrip('/')}/{name}/{LAYOUT}-{version}", json.dumps({"key": key, "n": n_buckets, "sort": order}))
    files.set_current(spark, root, {name: version})
    return files.version_path(root, name, version)


def read_bucketed(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """The current version, with its buckets known to the planner."""
    path = files.current_version(spark, root, name)
    version = path.rpartition("=")[2]
    if not spark.catalog.tableExists(_name(version)):
        layout = json.loads(files._read_text(spark, f"{root.rstrip('/')}/{name}/{LAYOUT}-{version}"))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        order = ", ".join(f"`{c}`" for c in layout["sort"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(version)} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`) "
                  f"SORTED BY ({order}) INTO {layout['n']} BUCKETS LOCATION '{path}'")
    return spark.table(_name(version))
