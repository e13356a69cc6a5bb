"""What the operators share: their queries, whole words, scratch tables, single evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import configure, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Words are runs of anything but these six ASCII characters.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the package's settings, and with Arrow batches of bounded size: rows may
    hold long texts, and a Python worker has a batch in memory."""
    spark = configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepared(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again.

    What follows reads files that every executor reaches, so a lost executor costs no more
    than its own tasks, and the rows are the same on every read.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Whole words of a text, none for NULL."""
    return F.coalesce(F.array_remove(F.split(text, f"{BLANK}+"), ""), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
