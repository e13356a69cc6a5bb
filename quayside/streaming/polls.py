"""What a poll reports, for all polls at once, and how to report a change only once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

POLL_SECONDS = 60
LOOK_BACK_SECONDS = 181


def reporting_polls(
    changes: DataFrame, time: str, look_back: int = LOOK_BACK_SECONDS, every: int = POLL_SECONDS
) -> DataFrame:
    """One row per change and poll that sees it, batch or stream. Polls look back further
    than they are apart, so most changes are seen several times."""
    window = F.window(time, f"{look_back} seconds", f"{every} seconds")
    return changes.withColumn("_window", window).withColumn("poll_time", F.col("_window.end")).drop("_window")


def zoned(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need a zoned time; the session zone is UTC, so the value stays the same."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def split_late(changes: DataFrame, time: str, seen: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """Changes seen within ``delay`` of their time, and the late ones.

    Stateful operators forget what is older than their watermark, and drop what comes after
    without a trace. So late rows are told apart before, by the row alone, and get an output
    of their own; ``first_reports`` is given the others, with ``seen`` as its time.
    """
    late = F.col(seen) - F.col(time) > F.expr(f"INTERVAL {delay}")
    return changes.filter(~F.coalesce(late, F.lit(True))), changes.filter(F.coalesce(late, F.lit(True)))


def first_reports(changes: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Each change once, however often it is seen within ``delay``. State is kept no longer
    than the watermark needs, whatever the length of the stream."""
    return zoned(changes, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
