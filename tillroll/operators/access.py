"""Read-side access rules: lookups by key (F1), optional filters (F2), pages (L1).

The reference serves these one request at a time; here a lookup takes a set of
keys (semi join, with the anti join listing the not-found keys), filters treat
``None`` as "no filter" and ``0`` as a real key (SURVEY Q11), and pages are
ordered by primary key (SURVEY Q12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """rows whose key is requested."""
    return df.join(keys.select(key), key, "left_semi")


def not_found(keys: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """requested keys with no row."""
    return keys.select(key).join(df.select(key), key, "left_anti")


def filter_optional(df: DataFrame, **equals) -> DataFrame:
    """conjunctive equality filters; a ``None`` value means no filter on that column."""
    out = df
    for col, value in equals.items():
        if value is not None:
            out = out.where(F.col(col) == F.lit(value))
    return out


def page(df: DataFrame, pk: str, skip: int = 0, limit: int = 100) -> DataFrame:
    """L1: ``ORDER BY pk OFFSET skip LIMIT limit``."""
    return df.orderBy(F.col(pk).asc_nulls_last()).offset(skip).limit(limit)


def page_after(df: DataFrame, pk: str, last_key, limit: int = 100) -> DataFrame:
    """L1, deep pages: keyset pagination (``pk > last_key``), a pushed-down filter plus top-k."""
    out = df if last_key is None else df.where(F.col(pk) > F.lit(last_key))
    return out.orderBy(F.col(pk).asc_nulls_last()).limit(limit)
