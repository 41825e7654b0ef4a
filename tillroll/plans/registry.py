
from __future__ import annotations

import importlib

# Plan modules that each export QUERIES (key → callable(spark, data_dir)) and SQL (key → DuckDB SQL).
MODULES = [
    "tillroll.plans.analytics",
    "tillroll.plans.model",
    "tillroll.plans.io",
    "tillroll.plans.changes",
    "tillroll.plans.layouts",
]


def _load():
    queries, sql = {}, {}
    for name in MODULES:
        mod = importlib.import_module(name)
        for k, fn in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query key {k}")
            queries[k] = fn
        sql.update(mod.SQL)
    return queries, sql


def all_queries():
    return _load()[0]


def all_sql():
    return _load()[1]
