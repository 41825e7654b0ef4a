"""Events of every kind in one table, as VARIANT values (P15, ST4): a binary form of the JSON itself, with its types and
all of its fields, so a field that no reader knows yet is kept and can be read later. Lines that are not JSON are kept in
the same table as their text: a dead letter is a row of kind ``dead_letter`` whose body is a string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "kind string, body variant"
DEAD = "dead_letter"


def as_variants(events: DataFrame) -> DataFrame:
    """(kind, value: text) → (kind, body). What is not a JSON object becomes a dead letter."""
    body = F.try_parse_json("value")
    is_object = F.coalesce(F.schema_of_variant(body).startswith("OBJECT"), F.lit(False))
    return events.select(F.when(is_object, F.col("kind")).otherwise(DEAD).alias("kind"), F.when(is_object, body).otherwise(F.col("value").cast("variant")).alias("body"))


def write_events(events: DataFrame, path: str) -> str:
    """Append events to the table at ``path``, one folder a kind."""
    as_variants(events).write.mode("append").partitionBy("kind").parquet(path)
    return path


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def field(name: str, kind: str) -> Column:
    """A field of the body as a type; NULL where it is missing or of another type."""
    return F.try_variant_get("body", f"$.{name}", kind)
