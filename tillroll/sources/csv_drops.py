"""S5 CSV product drops with a load ledger.

Files named ``*.csv`` (any case) in the drop folder are listed as a DataFrame
(``binaryFile`` source, content column pruned), files already in the ledger are
skipped with an anti join, the new files are read in ONE pass with the fixed
column order and a header line and kept in the shared folder, and a file with any
malformed row is rejected whole (the reference commits per file). Accepted rows carry
their file name; the ledger gains one row per accepted file. File names are the plain
(decoded) ones on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.session import scratch_path
from tillroll.sources import files

LEDGER_SCHEMA = T.StructType([T.StructField("filename", T.StringType()), T.StructField("loaded_at", T.TimestampNTZType())])
CSV_GLOB = "*.[cC][sS][vV]"
PRODUCT_CSV_COLS = ["seller_id", "name", "price", "quantity", "created_at"]


def _file_name() -> F.Column:
    """Name of the source file; Spark's metadata has it percent-encoded (and ``+`` means itself)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def list_drops(spark: SparkSession, drop_dir: str) -> DataFrame:
    """One row per CSV file: ``path``, ``filename`` (only file metadata is read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(drop_dir)
            .select("path", _file_name().alias("filename")))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if not files.exists(spark, ledger_path):  # no ledger yet
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def read_drops(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of the given CSV files with ``_corrupt_record`` and ``filename``."""
    if not paths:
        return spark.createDataFrame([], schemas.CSV_PRODUCT).withColumn("filename", F.lit(None).cast("string"))
    return (spark.read.schema(schemas.CSV_PRODUCT)
            .option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .csv(paths)
            .withColumn("filename", _file_name()))


def load_csv_drops(spark: SparkSession, drop_dir: str, ledger_path: str, loaded_at: str
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns ``(accepted rows, rejected files, new ledger rows)``; only the parsed rows are kept, in scratch.

    ``created_at`` text is parsed with the timestamp rules of P2 (ISO with ``Z``).
    """
    from tillroll.functions.casts import to_ts

    new = list_drops(spark, drop_dir).join(read_ledger(spark, ledger_path).select("filename"), "filename",
                                              "left_anti")
    # File names are metadata (one per file), listed like Spark's own file index.
    listed = [(r.filename, r.path) for r in new.select("filename", "path").collect()]
    rows = read_drops(spark, [path for _, path in listed])
    rows = rows.withColumn("created_at_ts", to_ts(F.col("created_at")))
    # parsed once: checks, rows and ledger read the parsed table
    staged = files.write_parquet(rows, scratch_path(spark, "csv-rows"))
    rows = spark.read.schema(rows.schema).parquet(staged)
    bad_row = (F.col("_corrupt_record").isNotNull() | F.col("seller_id").isNull() | F.col("name").isNull()
               | F.col("price").isNull() | (F.col("created_at").isNotNull() & F.col("created_at_ts").isNull()))
    counts = rows.groupBy("filename").agg(F.count(F.when(bad_row, 1)).alias("bad_rows"), F.count(F.lit(1)).alias("rows"))
    # a file of a header alone has no rows; it is loaded like any other, so that it is not listed again
    each = spark.createDataFrame([(name,) for name, _ in listed], "filename string")
    per_file = each.join(counts, "filename", "left").na.fill(0, ["bad_rows", "rows"])
    good_files = per_file.where(F.col("bad_rows") == 0).select("filename")
    rejected = per_file.where(F.col("bad_rows") > 0)
    accepted = rows.join(good_files, "filename", "left_semi").select(
        "seller_id", "name", "price", F.coalesce("quantity", F.lit(1)).alias("quantity"),
        F.col("created_at_ts").alias("created_at"), "filename")
    ledger_rows = good_files.select("filename", F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"))
    return accepted, rejected, ledger_rows


def write_loaded(accepted: DataFrame, out: str) -> str:
    """Write accepted rows partitioned by source file with dynamic partition overwrite.

    Loading a file again (a job that died after writing rows but before updating
    the ledger) replaces that file's partition instead of duplicating it, so the
    load is idempotent per file and the ledger only saves work.
    """
    (accepted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("filename").parquet(out))
    return out


def load_and_record(spark: SparkSession, drop_dir: str, ledger_path: str, out: str, loaded_at: str) -> DataFrame:
    """S5 as a job step: load new files, write them idempotently, then append the ledger.

    Returns the rejected files (``filename``, ``bad_rows``, ``rows``)."""
    accepted, rejected, ledger_rows = load_csv_drops(spark, drop_dir, ledger_path, loaded_at)
    write_loaded(accepted, out)
    ledger_rows.write.mode("append").parquet(ledger_path)
    return rejected


def write_drops(df: DataFrame, drop_dir: str, n_files: int = 4) -> str:
    """Test helper side of S5: write product rows as CSV drop files with a header."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in PRODUCT_CSV_COLS])
    out.repartition(n_files).write.mode("overwrite").option("header", True).csv(drop_dir)
    return drop_dir
