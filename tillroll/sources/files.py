"""File sources and sinks: Parquet snapshots, NDJSON purchases, mart tables.

S2 ``read_stage`` / S7 ``write_stage`` use versioned folders: a snapshot is written
to ``<root>/<name>/v=<id>``, and then the root's manifest (which version of each table
is current) is replaced by renaming a complete new file over it. A reader sees the old
or the new manifest, never a part of one, and a job may read the current version
while writing the next. Tables published together (dims and fact, the marts) change
in one replacement (SURVEY Q7: never expose a half-written table). S6 reads NDJSON
with the fixed event schema. S11 writes a mart sorted by its key within partitions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas

MANIFEST = "_MANIFEST"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_mart(df: DataFrame, root: str, name: str, sort_key: list[str]) -> str:
    """Publish a new version of a mart, rows sorted by the mart's key inside each file."""
    return write_stage(df.sortWithinPartitions(*sort_key), root, name)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return fs.exists(p)


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a whole new file beside ``path`` and rename it over the old one."""
    fs, p = _hadoop_fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(p, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    jvm, hadoop = spark._jvm, spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(p), target, overwrite)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    line = reader.readLine()
    reader.close()
    return line


def ensure_namespace(spark: SparkSession, root: str) -> str:
    """Create the stage folder if missing."""
    fs, p = _hadoop_fs(spark, root)
    fs.mkdirs(p)
    return root


def version_path(root: str, name: str, version: str) -> str:
    return f"{root.rstrip('/')}/{name}/v={version}"


def write_version(df: DataFrame, root: str, name: str) -> str:
    """Write a new version of a table; readers do not see it before ``set_current``."""
    version = uuid.uuid4().hex
    df.write.mode("errorifexists").parquet(version_path(root, name, version))
    return version


def _manifest(spark: SparkSession, root: str) -> dict[str, str]:
    return json.loads(_read_text(spark, f"{root.rstrip('/')}/{MANIFEST}") or "{}")


def set_current(spark: SparkSession, root: str, versions: dict[str, str]) -> None:
    """Make the given versions current, all at once (one writer per root)."""
    _replace_text(spark, f"{root.rstrip('/')}/{MANIFEST}", json.dumps(_manifest(spark, root) | versions))


def write_stage(df: DataFrame, root: str, name: str) -> str:
    """Create-or-replace a snapshot (new version folder, then the manifest)."""
    spark = df.sparkSession
    ensure_namespace(spark, root)
    version = write_version(df, root, name)
    set_current(spark, root, {name: version})
    return version_path(root, name, version)


def current_version(spark: SparkSession, root: str, name: str) -> str:
    """Path of the current version of a published table."""
    version = _manifest(spark, root).get(name)
    if version is None:
        raise FileNotFoundError(f"no published table {name} under {root}")
    return version_path(root, name, version)


def read_stage(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """Scan the current version of a staged snapshot (or any published table)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(current_version(spark, root, name))


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Point a report at the current version of a stored mart."""
    return read_stage(spark, root, name)


def read_purchase_json(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON purchase events with the fixed reader schema (no inference).

    Malformed lines are kept with ``_corrupt_record`` set (PERMISSIVE).
    """
    return (spark.read.schema(schemas.EVENT)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(path))

