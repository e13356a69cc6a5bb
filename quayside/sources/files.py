"""Plain files: exports and the landing area of raw pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the three exports are called, after the stem of the first.
EXPORT_SUFFIXES = {"ship_status": "", "ship_berth_order": "_ship_berth_order", "ship_voyage": "_ship_pass_time"}


def export_folder(stem: str, table: str) -> str:
    return f"{stem.removesuffix('.csv')}{EXPORT_SUFFIXES[table]}.csv"


def export_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Header, no index, earlier export replaced, blanks kept. A folder of files of bounded size:
    read back, a file is one task, as a text may hold a line break."""
    options = {
        "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        "maxRecordsPerFile": rows_per_file}
    df.write.mode("overwrite").options(**options).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An export read back: a quoted empty text is empty, an unquoted one is NULL."""
    options = {"header": True, "escape": '"', "multiLine": True, "nullValue": "\0",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.schema(schema).options(**options).csv(path)


def land_pages(pages: DataFrame, path: str, batch: int | None = None) -> None:
    """Raw pages as they came, by crawl date. A date crawled again is replaced; with ``batch``, only
    what that batch has brought for it, and pages of other batches stay beside it."""
    by = ["crawl_date"]
    if batch is not None:
        pages, by = pages.withColumn("batch", F.lit(batch)), [*by, "batch"]
    (
        pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def landed_pages(spark: SparkSession, path: str, crawl_date: str, schema: T.StructType) -> DataFrame:
    """All pages that have landed for one date."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/crawl_date={crawl_date}")
