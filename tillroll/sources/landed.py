"""S3: reading the landing area, compacted or not.

A landing root has raw micro-batches, ``routed/run=<run>/batch_id=<n>/route=<route>`` (an earlier layout,
``<route>/run=<run>/batch_id=<n>``, is read too), and compacted files by day, ``_compacted/<route>/g=<generation>/_day=<day>``. One manifest says which generations are live for each day and up to
which batch of each run they go; it is replaced by rename. A reader takes the live generations and the finished
batches (Spark's ``_SUCCESS`` marker) beyond them: each event once, also while a compaction runs, after one was killed,
and when a batch is written again by a replay after it was compacted. The schemas are declared, so a route without
a batch is an empty table and a day's files are found without opening any.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas
from tillroll.sources import files

MANIFEST = "_LIVE"
#: Route → schema of its rows.
ROUTES = {"data": schemas.LANDED, "tombstones": schemas._s(("purchase_id", schemas.LONG)), "corrupt": schemas._s(("raw", schemas.STR))}


def live(spark: SparkSession, root: str) -> dict:
    """route → {"through": {run: last compacted batch}, "days": {day: [generation]}}."""
    known = json.loads(files._read_text(spark, f"{root.rstrip('/')}/{MANIFEST}") or "{}")
    return {r: known.get(r, {"through": {}, "days": {}}) for r in ROUTES}


def batch_path(root: str, run: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/routed/run={run}/batch_id={batch_id}"


def finished(spark: SparkSession, root: str, route: str, through: dict[str, int]) -> list[tuple[str, int, str]]:
    """(run, batch, path) of the finished batches beyond ``through`` that have the route, in order; three listings.
    A batch that is there in both layouts (replayed since) counts as it was written last."""
    base, found = root.rstrip("/"), {}

    def listed(glob: str) -> list[str]:
        fs, pattern = files._hadoop_fs(spark, f"{base}/{glob}")
        return [status.getPath().getParent().toString() for status in fs.globStatus(pattern) or []]

    routed = set(listed("routed/run=*/batch_id=*/_SUCCESS"))
    paths = listed(f"{route}/run=*/batch_id=*/_SUCCESS")
    paths += [f"{p}/route={route}" for p in listed(f"routed/run=*/batch_id=*/route={route}") if p in routed]
    for path in paths:
        run, batch = re.search(r"/run=([^/]+)/batch_id=(\d+)(?:/route=[^/]+)?$", path).groups()
        if int(batch) > through.get(run, -1):
            found[run, int(batch)] = path
    return sorted((run, batch, path) for (run, batch), path in found.items())


def day_paths(root: str, route: str, days: dict[str, list[str]], wanted: Iterable[str] | None = None) -> list[str]:
    keep = None if wanted is None else set(wanted)
    base = f"{root.rstrip('/')}/_compacted/{route}"
    return [f"{base}/g={g}/_day={d}" for d, gs in sorted(days.items()) if keep is None or d in keep for g in gs]


def read_paths(spark: SparkSession, route: str, paths: list[str]) -> DataFrame:
    reader = spark.read.schema(ROUTES[route])
    return reader.parquet(*paths) if paths else spark.createDataFrame([], ROUTES[route])


def read_live(spark: SparkSession, root: str, route: str, days: Iterable[str] | None = None) -> DataFrame:
    """Every landed row of a route once. ``days`` limits the compacted files to those days (``yyyy-MM-dd``; rows
    without a time are under ``none``); batches that are not compacted yet are always read."""
    state = live(spark, root)[route]
    paths = day_paths(root, route, state["days"], days) + [p for *_, p in finished(spark, root, route, state["through"])]
    return read_paths(spark, route, paths)


def read_landed(spark: SparkSession, landing_root: str) -> DataFrame:
    """S3: landed purchase events."""
    return read_live(spark, landing_root, "data")
