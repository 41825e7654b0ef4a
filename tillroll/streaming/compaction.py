"""ST3: compaction of landed micro-batches into files by day (see ``sources.landed`` for the layout and its readers).

A run takes the finished batches that no generation holds and writes them as one new generation, each day in files of
the size that AQE rebalances to (a hot day is several files, small days share a task). A day that has gathered
``fan`` generations is merged into the new one, so a row is written again a few times at most, as in levelled runs.
Then the manifest is replaced. Whatever happens before that leaves files that nobody reads; whatever happens after it
finds the batches done. Replayed batches are written under the same name and are not taken again. One compaction at
a time; landing and readers go on meanwhile. ``vacuum`` removes what the manifest has not named for a while.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import files, landed


def _with_day(rows: DataFrame) -> DataFrame:
    day = F.date_format("purchased_at", "yyyy-MM-dd") if "purchased_at" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("_day", F.coalesce(day, F.lit("none")))


def compact(spark: SparkSession, root: str, fan: int = 4) -> dict[str, int]:
    """Compact every route; returns the number of batches taken."""
    state, taken = landed.live(spark, root), {}
    for route, known in state.items():
        batches = landed.finished(spark, root, route, known["through"])
        taken[route] = len(batches)
        if batches:
            state[route] = _compact_route(spark, root, route, known, batches, fan)
    if any(taken.values()):
        files._replace_text(spark, f"{root.rstrip('/')}/{landed.MANIFEST}", json.dumps(state))
    return taken


def _compact_route(spark: SparkSession, root: str, route: str, known: dict, batches: list, fan: int) -> dict:
    fresh = landed.read_paths(spark, route, [p for *_, p in batches])
    days = [r[0] for r in _with_day(fresh).select("_day").distinct().collect()]  # days of the new batches
    full = [d for d in days if len(known["days"].get(d, [])) + 1 >= fan]
    rows = fresh.unionByName(landed.read_paths(spark, route, landed.day_paths(root, route, known["days"], full)))
    generation = uuid.uuid4().hex
    dealt = _with_day(rows).hint("rebalance", "_day").sortWithinPartitions("_day", rows.columns[0])
    dealt.write.partitionBy("_day").parquet(f"{root.rstrip('/')}/_compacted/{route}/g={generation}")
    through = dict(known["through"])
    for run, batch, _ in batches:
        through[run] = max(batch, through.get(run, -1))
    held = {d: [generation] if d in full else [*known["days"].get(d, []), generation] for d in days}
    return {"through": through, "days": known["days"] | held}


def _held(path: str, through: dict[str, int]) -> bool:
    m = re.search(r"run=([^/]+)/batch_id=(\d+)(/route=[^/]+)?$", path)
    return bool(m) and int(m[2]) <= through.get(m[1], -1)


def vacuum(spark: SparkSession, root: str, min_age_s: float = 24 * 3600) -> int:
    """Remove batches that generations hold and generations that are not live, if older than ``min_age_s`` (longer
    than any reader takes). Returns how many folders went."""
    state, gone = landed.live(spark, root), 0
    before = (time.time() - min_age_s) * 1000
    for route, known in state.items():
        base, in_use = root.rstrip("/"), {g for gs in known["days"].values() for g in gs}
        for glob, done in (
            (f"{base}/{route}/run=*/batch_id=*", lambda p, t=known["through"]: _held(p, t)),
            (f"{base}/routed/run=*/batch_id=*/route={route}", lambda p, t=known["through"]: _held(p, t)),
            (f"{base}/_compacted/{route}/g=*", lambda p, u=in_use: p.rpartition("/g=")[2] not in u),
        ):
            fs, pattern = files._hadoop_fs(spark, glob)
            for status in fs.globStatus(pattern) or []:
                if status.getModificationTime() <= before and done(status.getPath().toString()):
                    gone += bool(fs.delete(status.getPath(), True))
    return gone
