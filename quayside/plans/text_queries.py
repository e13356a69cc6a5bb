"""Registered queries: keys, addresses and time texts.

Texts are built from the times of the provided tables, in all the ways they occur, and
parsed back; the oracle has the times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import times
from quayside.functions.text import page_address, ship_id, voyage_serial
from quayside.operators import quality
from quayside.plans.ingest import typed_events
from quayside.plans.registry import query
from quayside.sources.testdata import oracle_with, project, table

EVENT_PAGE = "http://port.example/events"


def era_text(local: Column, pattern: str = "MM/dd HH:mm") -> Column:
    return F.concat((F.year(local) - times.ERA_YEAR_ZERO).cast("string"), F.lit("/"), F.date_format(local, pattern))


def meridiem_text(local: Column) -> Column:
    hour = F.hour(local)
    return F.concat(
        F.date_format(local, "yyyy/M/d"),
        F.when(hour < 12, " 上午 ").otherwise(" 下午 "),
        F.lpad(F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string"), 2, "0"),
        F.date_format(local, ":mm:ss"),
    )


_ORDER_TIME = "o_orderdate + (INTERVAL '1' SECOND) * cast(o_orderkey % 86400 as int)"


@query("parse_era_time", f"""
    SELECT o_orderkey, CASE
        WHEN o_orderkey % 8 IN (0, 1, 2) THEN NULL
        WHEN o_orderkey % 8 = 3 THEN t
        WHEN o_orderkey % 8 = 4 THEN t - INTERVAL 8 HOUR
        WHEN o_orderkey % 8 = 5 THEN NULL
        ELSE date_trunc('minute', t) - INTERVAL 8 HOUR END AS utc_time,
        o_orderkey % 8 = 5 AS rejected
    FROM (SELECT o_orderkey, {_ORDER_TIME} AS t FROM orders)""")
def parse_era_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, t = F.col("o_orderkey") % 8, F.col("t")
    text = (
        F.when(kind == 0, "待接靠").when(kind == 1, "null").when(kind == 2, "")
        .when(kind == 3, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 4, era_text(t, "M/d HH:mm:ss"))
        .when(kind == 5, era_text(t, "'13'/dd HH:mm"))
        .otherwise(era_text(t))
    )
    return (
        table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_ORDER_TIME).alias("t"))
        .select("o_orderkey", text.alias("text"))
        .select("o_orderkey", times.era_time(F.col("text")).alias("utc_time"),
                times.era_time_rejected(F.col("text")).alias("rejected"))
    )


@query("parse_meridiem_time", """
    SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL
        ELSE date_trunc('second', ts) - INTERVAL 8 HOUR END AS utc_time
    FROM events""")
def parse_meridiem_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = meridiem_text(F.col("ts"))
    # Every ninth text has no half of day.
    text = F.when(F.col("event_id") % 9 == 0, F.regexp_replace(text, " [上下]午 ", " ")).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", text.alias("text")).select(
        "event_id", times.meridiem_time(F.col("text")).alias("utc_time"))


def content_text(key: Column, local: Column) -> Column:
    kind = key % 6
    return (
        F.when(kind == 0, era_text(local))
        .when(kind == 1, era_text(local, "MM/dd HH:mm:ss"))
        .when(kind == 2, F.date_format(local, "yyyyMMddHHmm"))
        .when(kind == 3, "靠泊")
        .when(kind == 4, "abc/def")
    )


@query("parse_content_time", """
    SELECT event_id, CASE event_id % 6
        WHEN 0 THEN date_trunc('minute', ts) - INTERVAL 8 HOUR
        WHEN 1 THEN date_trunc('second', ts) - INTERVAL 8 HOUR
        WHEN 2 THEN date_trunc('minute', ts) - INTERVAL 8 HOUR END AS utc_time
    FROM events""")
def parse_content_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .select("event_id", content_text(F.col("event_id"), F.col("ts")).alias("text"))
        .select("event_id", times.content_time(F.col("text")).alias("utc_time"))
    )


@query("time_rejects", f"""{oracle_with('fx_events')}
    SELECT seq, CASE WHEN seq % 11 IN (0, 1, 2) THEN 'bad_event_time' WHEN seq % 11 = 3 THEN 'null_event_time'
        ELSE 'bad_event_content' END AS reject_reason
    FROM fx_events WHERE seq % 11 IN (0, 1, 2, 3, 4, 5)""")
def time_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = times.to_local(F.col("event_time"))
    kind = F.col("seq") % 11
    good = meridiem_text(local)
    time_text = (
        F.when(kind == 0, F.date_format(local, "yyyy/M/d '下午 13:00:00'"))
        .when(kind == 1, F.date_format(local, "yyyy/M/d '下午 00:10:00'"))
        .when(kind == 2, F.date_format(local, "yyyy/'14'/d '上午 01:00:00'"))
        .when(kind == 3, F.lit(None))
        .otherwise(good)
    )
    content = (
        F.when(kind == 4, "twelve chars").when(kind == 5, "113/13/01 10:30").when(kind == 6, "abc/def")
        .when(kind == 7, "short")
    )
    rows = project(spark, sf_dir, "fx_events").withColumns({"event_content": content, "event_time": time_text})
    return quality.rejected(typed_events(rows)).select("seq", "reject_reason")


@query("split_voyage_key", f"""{oracle_with('fx_ship')}
    SELECT ship_voyage_number, substr(ship_voyage_number, 1, 6) AS ship_id,
        substr(ship_voyage_number, 7, 4) AS voyage_serial,
        '{EVENT_PAGE}?SP_ID=' || substr(ship_voyage_number, 1, 6) || '&SP_SERIAL='
            || substr(ship_voyage_number, 7, 4) AS url
    FROM fx_ship""")
def split_voyage_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("ship_voyage_number")
    return project(spark, sf_dir, "fx_ship").select(
        key, ship_id(key).alias("ship_id"), voyage_serial(key).alias("voyage_serial"),
        page_address(EVENT_PAGE, key).alias("url"))
