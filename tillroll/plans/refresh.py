"""Incremental refresh of fact and marts (Q16): the cost of a run follows what changed.

State under one root, all of it found through one manifest that is replaced by rename at the end of a run, so a reader
sees the run before or the run after, and a failed run leaves nothing visible:

* a log of signed fact rows, one generation a run (``operators.increments.signed_changes``); the live rows are those
  whose signs sum to one. A generation is written once; ``compact`` folds them into one.
* tombstones, one generation a run, and the current version of the dimensions;
* three roll-ups (day; product and seller by month; client by month) and two tables of day bitmaps (clients,
  products), each one folder a month; a run writes the months it touches and keeps the others' folders.

The thirteen additive marts are the functions of ``operators.marts`` on the roll-ups; the two distinct counts come
from the bitmaps.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.functions.buckets import month_of_day, sale_date
from tillroll.operators import dedup as D
from tillroll.operators import increments as I
from tillroll.operators import marts as M
from tillroll.session import scratch_folder, shuffles_dropped
from tillroll.sources import files

STATE = "_STATE"
#: Files of the state are written once and read now and then.
CODEC = "zstd"
LOG = T.StructType([*schemas.FACT.fields, T.StructField("_client", T.LongType()), T.StructField("_sign", T.IntegerType())])
_BITMAPS = "sale_date date, bucket bigint, ids binary"
_SETS = {"client_days": "client_id", "product_days": "product_id"}
#: Marts of distinct counts: the bitmaps they read, and their column.
_DISTINCT = {"mart_unique_clients_per_day": ("client_days", "unique_clients"), "mart_unique_products_per_day": ("product_days", "unique_products")}
_DIMS = {"clients": schemas.CLIENTS, "sellers": schemas.SELLERS, "products": schemas.PRODUCTS}


def _rollup_schema(name: str) -> str:
    keys = ", ".join(f"{k} bigint" for k in M.ROLLUPS[name][0])
    return ", ".join(x for x in ("sale_date date", keys, ", ".join(f"{m} {t}" for m, t in I.MEASURES.items())) if x)


def _month(day: str) -> Column:
    return F.coalesce(month_of_day(day), F.lit("none"))


class MartState:
    """Fact, roll-ups and distinct sets under ``root``, refreshed by batches of changes (one writer at a time)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- reading

    def manifest(self) -> dict:
        empty = {"log": [], "tombstones": [], "dims": {}, "months": {}}
        return json.loads(files._read_text(self.spark, f"{self.root}/{STATE}") or json.dumps(empty))

    def _read(self, schema, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(schema)
        # limit(0): the planner sees that it is empty and leaves out what joins or merges with it
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema).limit(0)

    def _log(self, m: dict) -> DataFrame:
        return self._read(LOG, [f"{self.root}/log/{g}" for g in m["log"]])

    def _tombstones(self, m: dict) -> DataFrame:
        return self._read("purchase_id bigint", [f"{self.root}/tombstones/{g}" for g in m["tombstones"]])

    def _dims(self, m: dict) -> dict[str, DataFrame]:
        return {n: self._read(s, [f"{self.root}/{n}/{m['dims'][n]}"] if n in m["dims"] else []) for n, s in _DIMS.items()}

    def _months(self, m: dict, name: str, months: list[str] | None = None) -> DataFrame:
        """A roll-up or a set of bitmaps, of all or of the given months."""
        there = m["months"].get(name, {})
        paths = [f"{self.root}/{name}/{there[x]}/_month={x}" for x in (sorted(there) if months is None else months) if x in there]
        return self._read(_BITMAPS if name in _SETS else _rollup_schema(name), paths)

    def fact(self) -> DataFrame:
        return I.live_rows(self._log(self.manifest())).select(*schemas.FACT_COLS)

    def mart(self, name: str) -> DataFrame:
        """One of M01–M15 from the state."""
        m = self.manifest()
        if name in _DISTINCT:
            table, column = _DISTINCT[name]
            found = self.distinct(table, F.col("sale_date"), column).withColumnRenamed("sale_date", "_day")
            days = self._months(m, "day").select("sale_date")
            return days.join(found, F.col("_day").eqNullSafe(F.col("sale_date")), "left").select(
                "sale_date", F.coalesce(column, F.lit(0).cast("bigint")).alias(column))
        read = [r for r, names in M.MART_ROLLUP.items() if name in names]
        rollups = {r: I.as_measures(self._months(m, r)) for r in read}
        grain = next(iter(rollups.values()))
        return M.build_mart(name, M.MartSource(grain, grain, rollups), self._dims(m))

    def marts(self) -> dict[str, DataFrame]:
        """M01–M15 from the state."""
        return {name: self.mart(name) for name in M.MARTS}

    def distinct(self, name: str, period: Column, column: str) -> DataFrame:
        """Distinct clients (``client_days``) or products (``product_days``) over a period of days."""
        return I.distinct_ids(self._months(self.manifest(), name), period, column)

    # -- writing

    def _write(self, df: DataFrame, name: str) -> str:
        generation = uuid.uuid4().hex
        df.write.option("compression", CODEC).parquet(f"{self.root}/{name}/{generation}")
        return generation

    def _write_months(self, df: DataFrame, name: str) -> tuple[str, list[str]]:
        """A generation by month, and the months that it has. Roll-ups with keys stay as their merge dealt them: each
        task has rows of all months either way."""
        generation = uuid.uuid4().hex
        path = f"{self.root}/{name}/{generation}"
        by_month = df.withColumn("_month", _month("sale_date"))
        by_month = by_month.repartition("_month") if name == "day" else by_month
        by_month.write.option("compression", CODEC).partitionBy("_month").parquet(path)
        kind = self.spark.read.schema(by_month.schema).parquet(path)
        return generation, [r[0] for r in kind.select("_month").distinct().collect()]

    def apply(self, events: DataFrame, tombstones: DataFrame, dims: dict[str, DataFrame], landed: dict | None = None,
              taken: Callable[[], None] | None = None) -> dict:
        """One run: new events (conformed, in any order, duplicates included), new tombstones, current dimensions.
        ``landed``: where the caller's input now stands; kept in the same manifest, so input and result move together.
        ``taken`` is called when the events are read no more. A run's shuffles and scratch go as soon as they are used."""
        with shuffles_dropped(self.spark):
            return self._apply(events, tombstones, dims, landed, taken)

    def _apply(self, events: DataFrame, tombstones: DataFrame, dims: dict[str, DataFrame], landed: dict | None,
               taken: Callable[[], None] | None) -> dict:
        m = self.manifest()
        files.ensure_namespace(self.spark, self.root)
        old_dims = self._dims(m)
        m["dims"] = {n: self._write(dims[n].select(*_DIMS[n].names), n) for n in _DIMS}
        fresh = tombstones.select(F.col("purchase_id").cast("bigint").alias("purchase_id")).where("purchase_id is not null").distinct()
        m["tombstones"].append(self._write(fresh, "tombstones"))
        latest = self._read("purchase_id bigint", [f"{self.root}/tombstones/{m['tombstones'][-1]}"])
        with scratch_folder(self.spark, "mart-rows") as rows:
            with scratch_folder(self.spark, "mart-events") as kept:
                # the events are often a long plan, and read twice: kept once, one row a purchase (D4 is the maximum of an order)
                come = events.select(*schemas.PURCHASE_COLS)
                D.dedup_purchases(come).write.option("compression", CODEC).parquet(kept)
                if taken:
                    taken()
                come = self.spark.read.schema(come.schema).parquet(kept)
                before, after = I.changed_rows(self._log(m), come, self._tombstones(m), latest, old_dims, self._dims(m), rows)
            m["log"].append(self._write(I.signed_changes(before, after), "log"))
        signed = self._read(LOG, [f"{self.root}/log/{m['log'][-1]}"])
        months = [r[0] for r in signed.select(_month(sale_date("purchased_at")).alias("_month")).distinct().collect()]
        for name, (keys, monthly) in M.ROLLUPS.items():
            merged = I.merge_rollup(self._months(m, name, months), I.signed_measures(signed, keys, monthly), keys)
            self._replace(m, name, merged, months)
        lost = signed.where("_sign < 0").select(sale_date("purchased_at").alias("_day")).distinct()
        same_day = lambda day: day.eqNullSafe(F.col("_day"))
        again = self._log(m).join(F.broadcast(lost), same_day(sale_date("purchased_at")), "left_semi")
        come = signed.where("_sign > 0").join(F.broadcast(lost), same_day(sale_date("purchased_at")), "left_anti")
        for name, id_col in _SETS.items():
            kept = self._months(m, name, months).join(F.broadcast(lost), same_day(F.col("sale_date")), "left_anti")
            both = kept.unionByName(I.day_bitmaps(again.unionByName(come), id_col)).withColumn("_month", _month("sale_date"))
            # a bucket's days of a month together: longer periods merge them before they move
            merged = I.merge_bitmaps(both.repartition("_month", "bucket"), ["_month"])
            self._replace(m, name, merged, months)
        if landed is not None:
            m["landed"] = landed
        files._replace_text(self.spark, f"{self.root}/{STATE}", json.dumps(m))
        return m

    def _replace(self, m: dict, name: str, rows: DataFrame, months: list[str]) -> None:
        generation, written = self._write_months(rows, name)
        kept = {k: v for k, v in m["months"].get(name, {}).items() if k not in months}
        m["months"][name] = kept | {x: generation for x in written}

    def compact(self) -> None:
        """Fold the log's generations into one, and the tombstones' too; readers of the old manifest are not disturbed."""
        m = self.manifest()
        live = I.live_rows(self._log(m)).withColumn("_sign", F.lit(1))
        m["log"], m["tombstones"] = [self._write(live, "log")], [self._write(self._tombstones(m).distinct(), "tombstones")]
        files._replace_text(self.spark, f"{self.root}/{STATE}", json.dumps(m))
