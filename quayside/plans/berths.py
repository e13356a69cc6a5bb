"""Berth queues, and alerts that the ship ahead in a berth has moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import rules
from quayside.functions.messages import berth_message
from quayside.functions.text import full_name, ship_id, voyage_serial
from quayside.operators.ordering import with_next, with_position, with_ranges
from quayside.plans.alerts import KEY, revised_times

QUEUE_ORDER = ("berthing_time", "pilotage_time", "ship_name_chinese", "ship_status")


def _hour(time: Column) -> Column:
    return F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time)


def with_queue_segment(berths: DataFrame) -> DataFrame:
    """Cuts a berth's queue by the hour, in queue order: ships with a berthing time, then
    those with only a pilotage time, then those with neither, by first letter."""
    later = 10**9
    segment = F.coalesce(
        _hour(F.col("berthing_time")),
        _hour(F.col("pilotage_time")) + F.lit(later),
        F.ascii("ship_name_chinese") + F.lit(2 * later),
    )
    return berths.withColumn("_queue_segment", segment)


def with_even_segment(berths: DataFrame) -> DataFrame:
    """Cuts a berth's queue into ranges of about equally many entries, also where all have one hour or no time."""
    return with_ranges(berths, ["berth_number"], QUEUE_ORDER, "_queue_segment")


def queue_positions(berths: DataFrame, even: bool = False) -> DataFrame:
    """Each entry's place in its berth's queue, from 1; ``even`` for queues that hours do not cut well."""
    return with_position(
        with_even_segment(berths) if even else with_queue_segment(berths), ["berth_number"], "_queue_segment", QUEUE_ORDER, "queue_position",
    ).drop("_queue_segment")


def moved_ahead(berths: DataFrame, cutoff: Column, even: bool = False) -> DataFrame:
    """Queue entries changed since ``cutoff`` with the name of the ship behind them; ``even`` as above.

    The change test is on the ship ahead, so it must not remove any follower.
    """
    paired = with_next(
        with_even_segment(berths) if even else with_queue_segment(berths), ["berth_number"], "_queue_segment", QUEUE_ORDER,
        ["ship_name_chinese", "ship_name_english"], "_behind", only=F.col("updated_at") >= cutoff,
    )
    return paired.filter(F.col("_behind").isNotNull()).select(
        "berth_number", "berthing_time", "pilotage_time", "updated_at",
        full_name(F.col("_behind.ship_name_chinese"), F.col("_behind.ship_name_english")).alias("ship_name"),
    )


def berth_alerts(
    berths: DataFrame, status: DataFrame, events: DataFrame | None, cutoff: Column, announced: DataFrame | None = None
) -> DataFrame:
    """Alert rows for every voyage of the ship behind one that moved; announced times as in ``latest_status``."""
    berthed = F.col("berthing_time").isNotNull()
    moved = moved_ahead(berths, cutoff).join(status.select("ship_name", KEY), "ship_name")
    times = revised_times(events, moved) if announced is None else announced.select(KEY, "eta", "etd")
    return (
        moved.join(times, KEY, "left")
        .select(
            F.lit(rules.BERTH_FORMAT).alias("message_format"),
            "ship_name",
            KEY,
            ship_id(F.col(KEY)).alias("ship_id"),
            voyage_serial(F.col(KEY)).alias("voyage_serial"),
            "eta",
            "etd",
            "berth_number",
            F.when(berthed, rules.BERTHED).otherwise(rules.PILOTED).alias("event_name"),
            F.coalesce("berthing_time", "pilotage_time").alias("event_time"),
            F.col("updated_at").alias("update_time"),
        )
    )


def berth_outbox(alerts: DataFrame) -> DataFrame:
    """Berth alerts go to the master group only."""
    return alerts.withColumn("message", berth_message()).select(
        F.md5("message").alias("alert_id"), "message_format", KEY, "event_name",
        F.lit(rules.MASTER_GROUP).alias("stakeholder"), "message", F.lit("queued").alias("status"),
    )
