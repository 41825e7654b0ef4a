"""V2 constraint audit: the DDL constraints Spark does not enforce, as checks.

Each table is read twice, by two linear pipelines (no intermediate result has
two consumers, so nothing needs caching):

* keys — one grouping-sets aggregate over (pk), each unique column and the empty
  set (rows per value, and the NOT NULL violations), folded by one global
  aggregate into the key checks;
* foreign keys — one grouping-sets aggregate over the foreign-key columns (rows
  per distinct value), left-joined with the parents' keys, folded into the fk
  checks. The joins see distinct values, not rows.

Partial aggregation runs on the map side, so a hot value collapses before it
moves. Every check yields one row ``(table_name, check_name, violations)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_CLIENT = ("client_id", ["email"], ["client_id", "first_name", "last_name", "signup_date"], {},
           {"first_name": 100, "last_name": 100, "email": 255})
_SELLER = ("seller_id", ["email"], ["seller_id", "first_name", "last_name", "company_name", "created_at"], {},
           {"first_name": 100, "last_name": 100, "company_name": 200, "email": 255})
_PRODUCT = ("product_id", [], ["product_id", "seller_id", "name", "price", "quantity", "created_at"],
            {"seller_id": ("sellers", "seller_id")}, {"name": 200})

# table → (primary key, unique columns, NOT NULL columns, {fk column: (parent table, parent key)}, {text column: longest})
CONSTRAINTS = {
    "clients_raw": ("client_id", [], *_CLIENT[2:]),
    "clients": _CLIENT,
    "sellers_raw": _SELLER,
    "sellers": _SELLER,
    "products_raw": _PRODUCT,
    "products": _PRODUCT,
    "purchases": ("purchase_id", [], ["purchase_id", "client_id", "product_id", "quantity", "purchased_at"],
                  {"client_id": ("clients", "client_id"), "product_id": ("products", "product_id")}, {}),
    "fact": ("purchase_id", [], ["purchase_id", "quantity", "price", "full_price", "purchased_at"],
             {"client_id": ("clients", "client_id"), "product_id": ("products", "product_id"),
              "seller_id": ("sellers", "seller_id")}, {}),
    "raw_load_log": ("filename", [], ["filename", "loaded_at"], {}, {}),
}


def _fk_name(parent: str) -> str:
    return "fk_" + (parent[:-1] if parent.endswith("s") else parent)


def _rows(table: str, checks: DataFrame) -> DataFrame:
    """One aggregate row of named checks → one row per check."""
    long = checks.unpivot([], checks.columns, "check_name", "violations")
    return long.select(F.lit(table).alias("table_name"), "check_name",
                       F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations"))


def _per_value(t: DataFrame, cols: list[str], with_total: bool, counts: dict[str, Column] | None = None) -> DataFrame:
    sets = [[c] for c in cols] + ([[]] if with_total else [])
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.grouping(c).alias(f"_g_{c}") for c in cols]
    aggs += [F.count(F.when(bad, 1)).alias(f"_c_{name}") for name, bad in (counts or {}).items()]
    return t.groupingSets(sets, *cols).agg(*aggs)


def key_checks(name: str, t: DataFrame) -> DataFrame:
    pk, unique, not_null, _, limits = CONSTRAINTS[name]
    cols = [pk, *unique]
    any_of = lambda bad: reduce(lambda a, b: a | b, bad)
    counts = {"not_null": any_of([F.col(c).isNull() for c in not_null])} if not_null else {}
    if limits:
        counts["too_long"] = any_of([F.coalesce(F.length(c) > n, F.lit(False)) for c, n in limits.items()])
    g = _per_value(t, cols, with_total=bool(counts), counts=counts)
    checks = [F.count(F.when((F.col(f"_g_{pk}") == 0) & (F.col("_n") > 1), 1)).cast("bigint").alias("pk_unique")]
    for u in unique:
        dup = (F.col(f"_g_{u}") == 0) & F.col(u).isNotNull() & (F.col("_n") > 1)
        checks.append(F.count(F.when(dup, 1)).cast("bigint").alias(f"{u}_unique"))
    total = reduce(lambda a, b: a & b, [F.col(f"_g_{c}") == 1 for c in cols])
    for check in counts:
        checks.append(F.sum(F.when(total, F.col(f"_c_{check}"))).cast("bigint").alias(check))
    return _rows(name, g.agg(*checks))


def fk_checks(name: str, t: DataFrame, tables: dict[str, DataFrame]) -> DataFrame | None:
    fks = {c: v for c, v in CONSTRAINTS[name][3].items() if v[0] in tables}
    if not fks:
        return None
    cols = list(fks)
    g = _per_value(t, cols, with_total=False)
    g = g.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols]))
    checks = []
    for col, (parent, pkey) in fks.items():
        keys = tables[parent].select(F.col(pkey).alias(f"_p_{col}")).distinct()
        g = g.join(keys, g[col] == keys[f"_p_{col}"], "left")
        orphan = (F.col(f"_g_{col}") == 0) & F.col(col).isNotNull() & F.col(f"_p_{col}").isNull()
        checks.append(F.sum(F.when(orphan, F.col("_n"))).cast("bigint").alias(_fk_name(parent)))
    return _rows(name, g.agg(*checks))


def audit_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, t in tables.items():
        if name not in CONSTRAINTS:
            continue
        parts.append(key_checks(name, t))
        fk = fk_checks(name, t, tables)
        if fk is not None:
            parts.append(fk)
    return reduce(DataFrame.unionByName, parts)


# ---- V2 while writing -----------------------------------------------------------------------

def row_checks(name: str) -> dict[str, Column]:
    """The constraints of a table that one row can break: check → condition of a bad row."""
    _, _, not_null, _, limits = CONSTRAINTS[name]
    checks = {}
    if not_null:
        checks["not_null"] = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in not_null])
    if limits:
        checks["too_long"] = reduce(lambda a, b: a | b, [F.coalesce(F.length(c) > n, F.lit(False)) for c, n in limits.items()])
    return checks


def write_observed(tables: dict[str, DataFrame], write: Callable[[str, DataFrame], object]) -> DataFrame:
    """Write each table with ``write(name, frame)`` and count the rows that break its NOT NULL and length rules in
    the same pass (``DataFrame.observe``): no second scan for these checks. Rows as ``audit_constraints`` gives them."""
    found, spark = [], next(iter(tables.values())).sparkSession
    for name, t in tables.items():
        checks = row_checks(name)
        if not checks:
            write(name, t)
            continue
        seen = Observation(f"audit-{name}-{uuid.uuid4().hex}")
        write(name, t.observe(seen, *[F.count_if(bad).alias(check) for check, bad in checks.items()]))
        counts = seen.get
        found += [(name, check, int(counts[check] or 0)) for check in checks]
    return spark.createDataFrame(found, "table_name string, check_name string, violations bigint")
