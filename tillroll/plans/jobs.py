"""Batch jobs: snowflake build (dims + fact) and the mart job.

Each job reads, transforms and writes with DataFrame actions only; outputs go
to new version folders so that no plan ever overwrites a path it reads (S7).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.casts import conform_purchases, ts_normalise
from tillroll.operators import dedup as D
from tillroll.operators import marts as M
from tillroll.operators import star as S
from tillroll.sources import files, landed
from tillroll.sources.fixtures import Fixture
from tillroll.streaming import landing as L

STAGE_TABLES = {
    "clients": (schemas.CLIENT_COLS, ["signup_date"]),
    "sellers": (schemas.SELLER_COLS, ["created_at"]),
    "products": (schemas.PRODUCT_COLS, ["created_at"]),
    "purchases": (["purchase_id", "client_id", "product_id", "quantity", "purchased_at"], ["purchased_at"]),
}


def stage_snapshots(sources: dict[str, DataFrame], stage_root: str) -> dict[str, str]:
    """Batch ingest: source tables (e.g. ``sources.jdbc.read_jdbc``) → P1 projection, P2
    timestamps → one atomic snapshot each (S7, S8). The staged purchases are kept
    but not read downstream: the fact comes from the landed events (SURVEY Q13)."""
    out = {}
    for name, df in sources.items():
        cols, ts_cols = STAGE_TABLES[name]
        out[name] = files.write_stage(ts_normalise(df.select(*cols), ts_cols), stage_root, name)
    return out


def snowflake_from_stage(spark: SparkSession, stage_root: str, landing_root: str, out_dir: str,
                         parallel_writes: int = 4) -> dict[str, str]:
    """Stage → snowflake: dims deduplicated (D1–D3), landed events conformed (P3),
    tombstoned purchases removed (J9), deduplicated (D4), keys resolved (J3); the
    four outputs published together (S9, S10) under ``out_dir``."""
    clients = D.dedup_clients(files.read_stage(spark, stage_root, "clients").select(*schemas.CLIENT_COLS))
    sellers = D.dedup_sellers(files.read_stage(spark, stage_root, "sellers").select(*schemas.SELLER_COLS))
    products = D.dedup_products(files.read_stage(spark, stage_root, "products").select(*schemas.PRODUCT_COLS))
    landed = conform_purchases(L.read_route(spark, landing_root, "data"))
    tombstones = L.read_route(spark, landing_root, "tombstones").where(F.col("purchase_id").isNotNull())
    purchases = D.dedup_purchases(landed.join(tombstones, "purchase_id", "left_anti"))
    return _publish_snowflake({"dim_clients": clients, "dim_sellers": sellers, "dim_products": products}, purchases,
                              out_dir, parallel_writes)


def refresh_marts(spark: SparkSession, stage_root: str, landing_root: str, state_root: str) -> dict:
    """Stage → marts, incrementally: the batches that landed since the last run and the staged dimensions of now
    change the state under ``state_root`` (``plans.refresh``). A run that fails takes the same batches again."""
    from tillroll.plans.refresh import MartState

    state = MartState(spark, state_root)
    dims = {
        "clients": D.dedup_clients(files.read_stage(spark, stage_root, "clients").select(*schemas.CLIENT_COLS)),
        "sellers": D.dedup_sellers(files.read_stage(spark, stage_root, "sellers").select(*schemas.SELLER_COLS)),
        "products": D.dedup_products(files.read_stage(spark, stage_root, "products").select(*schemas.PRODUCT_COLS)),
    }
    seen = state.manifest().get("landed", {})
    fresh, through = {}, {}
    for name in ("data", "tombstones"):
        batches = landed.finished(spark, landing_root, name, seen.get(name, {}))
        fresh[name] = landed.read_paths(spark, name, [p for *_, p in batches])
        through[name] = seen.get(name, {}) | {run: batch for run, batch, _ in batches}
    return state.apply(conform_purchases(fresh["data"]), fresh["tombstones"], dims, landed=through)


def build_snowflake(fx: Fixture, out_dir: str, parallel_writes: int = 4) -> dict[str, str]:
    """Publish dims and fact under ``out_dir`` and return their version paths."""
    dims = {"dim_clients": fx.clients, "dim_sellers": fx.sellers, "dim_products": fx.products}
    return _publish_snowflake(dims, fx.purchases, out_dir, parallel_writes)


def _publish_snowflake(dims: dict[str, DataFrame], purchases: DataFrame, out_dir: str, parallel_writes: int) -> dict[str, str]:
    """Write the dimensions (deduplicated once), resolve the fact's keys against the written ones (J3), and make
    all four current together. The fact is sorted within partitions by (purchased_at, purchase_id), the landing
    table's order, so row-group statistics prune time filters."""
    spark = purchases.sparkSession
    versions = _write_versions(dims, out_dir, parallel_writes)
    written = {n: spark.read.schema(SNOWFLAKE_SCHEMAS[n]).parquet(files.version_path(out_dir, n, v)) for n, v in versions.items()}
    fact = S.fact_purchases(purchases, written["dim_clients"], written["dim_products"])
    versions |= _write_versions({"fact_purchases": fact.sortWithinPartitions("purchased_at", "purchase_id")}, out_dir, 1)
    files.set_current(spark, out_dir, versions)
    return {n: files.version_path(out_dir, n, v) for n, v in versions.items()}


def _write_versions(outputs: dict[str, DataFrame], root: str, parallel_writes: int) -> dict[str, str]:
    """Write new versions concurrently; nothing is current yet."""
    files.ensure_namespace(next(iter(outputs.values())).sparkSession, root)
    with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
        return dict(pool.map(lambda item: (item[0], files.write_version(item[1], root, item[0])), outputs.items()))


def publish(outputs: dict[str, DataFrame], root: str, parallel_writes: int = 4) -> dict[str, str]:
    """Publish independent outputs together: written concurrently as new versions, then one manifest
    replaced, so a reader sees all old or all new tables. Returns the version paths."""

    spark = next(iter(outputs.values())).sparkSession
    versions = _write_versions(outputs, root, parallel_writes)
    files.set_current(spark, root, versions)
    return {name: files.version_path(root, name, v) for name, v in versions.items()}


SNOWFLAKE_SCHEMAS = {"dim_clients": schemas.CLIENTS, "dim_sellers": schemas.SELLERS,
                     "dim_products": schemas.PRODUCTS, "fact_purchases": schemas.FACT}


def read_snowflake(spark: SparkSession, where: str | dict[str, str]) -> dict[str, DataFrame]:
    """Dims and fact with their declared schemas (no inference): the current versions
    under a root folder, or the given version paths."""
    if isinstance(where, str):
        where = {k: files.current_version(spark, where, k) for k in SNOWFLAKE_SCHEMAS}
    return {k: spark.read.schema(SNOWFLAKE_SCHEMAS[k]).parquet(v) for k, v in where.items()}


def build_all_marts(tables: dict[str, DataFrame], out_dir: str | None = None, checkpoint: bool = False,
                    parallel_writes: int = 4, rollups: tuple[str, ...] = ("day",)) -> dict[str, DataFrame]:
    """All fifteen marts, through the named persisted roll-ups (none: each from the fact).

    With ``out_dir`` the jobs are submitted from a small thread pool, so that small ones
    overlap instead of leaving the cluster idle: the roll-ups and the marts that
    need none at once, each other mart (S11: sorted by its key within partitions) when its
    roll-up is there. The marts are published together; the returned frames read them back.
    """
    fact = tables["fact_purchases"]
    src = M.MartSource.shared(fact, checkpoint=checkpoint, rollups=rollups)
    dims = {"clients": tables["dim_clients"], "sellers": tables["dim_sellers"], "products": tables["dim_products"]}
    marts = M.build_marts(src, dims)
    if out_dir is None:
        return marts
    spark = fact.sparkSession
    files.ensure_namespace(spark, out_dir)
    needs = {m: r for r in rollups for m in M.MART_ROLLUP[r]}
    with ThreadPoolExecutor(max_workers=max(4, parallel_writes)) as pool:
        ready = {r: pool.submit(src.materialise, r) for r in rollups}

        def write(name):
            if name in needs:
                ready[needs[name]].result()
            return name, files.write_version(marts[name].sortWithinPartitions(*M.MARTS[name][2]), out_dir, name)

        versions = dict(pool.map(write, sorted(marts, key=lambda n: n in needs)))
    files.set_current(spark, out_dir, versions)
    written = {n: files.version_path(out_dir, n, v) for n, v in versions.items()}
    src.release()
    # read back with the known schema: no footer-reading inference job per mart
    return {name: spark.read.schema(marts[name].schema).parquet(written[name]) for name in marts}
