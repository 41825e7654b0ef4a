"""Type conforming (P2, P3) and event JSON.

ANSI mode stays on (SURVEY Q17); bad input becomes NULL through ``try_*`` forms
instead of failing the job. Timestamps are carried as ``timestamp_ntz`` holding
UTC wall-clock time, independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas


# An ISO text ends with a zone offset (``Z``, ``+03:00``, ``-0500``, ``+03``).
_OFFSET = r"(?i)(z|[+-]\d{2}(:?\d{2})?)$"
_EPOCH_NTZ = "1970-01-01 00:00:00"


def utc_wall(ltz: Column) -> Column:
    """Zone-aware instant → its UTC wall-clock time as ``timestamp_ntz``.

    Built from epoch microseconds, so it does not depend on the session zone
    (and has no daylight-saving ambiguity).
    """
    secs = (F.unix_micros(ltz) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def to_ts(c: Column, dtype: T.DataType | None = None) -> Column:
    """String / timestamp → ``timestamp_ntz`` holding UTC wall-clock time.

    Text without an offset is taken as UTC wall-clock time as written; text with
    an offset and zone-aware timestamps are converted to UTC. Unparsable text →
    NULL. The result does not depend on the session time zone.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return utc_wall(c)
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    text = c.cast("string")
    return F.when(text.rlike(_OFFSET), utc_wall(F.try_to_timestamp(text))).otherwise(text.try_cast("timestamp_ntz"))


def ts_normalise(df: DataFrame, cols: list[str]) -> DataFrame:
    """P2 on named columns."""
    return df.withColumns({c: to_ts(F.col(c), df.schema[c].dataType) for c in cols})


def conform_purchases(df: DataFrame) -> DataFrame:
    """Landed rows → purchase types (timestamp, decimal(10,2)×2, int), fixed order."""
    return df.select(
        F.col("purchase_id").try_cast("bigint").alias("purchase_id"),
        F.col("client_id").try_cast("bigint").alias("client_id"),
        F.col("product_id").try_cast("bigint").alias("product_id"),
        F.col("quantity").try_cast("bigint").alias("quantity"),
        F.col("price").try_cast("decimal(10,2)").alias("price"),
        F.col("full_price").try_cast("decimal(10,2)").alias("full_price"),
        to_ts(F.col("purchased_at"), df.schema["purchased_at"].dataType).alias("purchased_at"),
    )


def event_json(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One flat JSON object per row (``value``); NULL fields are omitted."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}).alias("value"))


def parse_events(df: DataFrame, value: str = "value", keep: str | None = None) -> DataFrame:
    """Topic bytes/text → struct with the fixed event schema → flat columns.

    A line that is not a JSON object keeps its text in ``_corrupt_record``. ``keep`` names a column for the
    text of every line.
    """
    parsed = F.from_json(F.col(value).cast("string"), schemas.EVENT,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    text = [F.col(value).cast("string").alias(keep)] if keep else []
    return df.select(parsed.alias("_e"), *text).select("_e.*", *([keep] if keep else []))
