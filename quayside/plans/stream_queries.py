"""Registered queries: polls, streams, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.upsert import SPECS
from quayside.plans.alerts import moment
from quayside.plans.registry import query
from quayside.plans.state_queries import _DAY_BATCH, _folded, _oracle_sql, _spark_sql
from quayside.session import scratch_folder
from quayside.sources import files
from quayside.sources.state import StateTable
from quayside.sources.testdata import AS_OF, oracle_with, project, table
from quayside.streaming.ingest import upsert_stream
from quayside.streaming.polls import (
    LOOK_BACK_SECONDS,
    POLL_SECONDS,
    append_stream,
    first_reports,
    reporting_polls,
    split_late,
)

CRAWLS = 3


@query("poll_repeats", f"""
    SELECT event_id, make_timestamp(cast((start * {POLL_SECONDS} + {LOOK_BACK_SECONDS}) * 1000000 as bigint)) AS poll_time
    FROM (
        SELECT event_id, us, unnest(range(us // {POLL_SECONDS * 1000000} - 3, us // {POLL_SECONDS * 1000000} + 1)) AS start
        FROM (SELECT event_id, epoch_us(ts) AS us FROM events))
    WHERE us < (start * {POLL_SECONDS} + {LOOK_BACK_SECONDS}) * 1000000""")
def poll_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "events").select("event_id", "ts")
    return reporting_polls(changes, "ts").select("event_id", "poll_time")


@query("stream_upsert_final_state", f"""{oracle_with('fx_events')},
    state AS (SELECT * FROM fx_events WHERE FALSE),
    batch AS (SELECT {_oracle_sql(_DAY_BATCH)} FROM fx_events), {_folded('ship_events', null_safe=True)}
    SELECT * EXCLUDE (change_type) FROM merged""")
def stream_upsert_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events land in three crawls, one after the other in arrival order, and each is
    taken into the stored table by a run of the stream."""
    root = scratch_folder(spark, "stream-upsert")
    spec = SPECS["ship_events"]
    events = project(spark, sf_dir, "fx_events").selectExpr(*_spark_sql(_DAY_BATCH))
    stored = StateTable(spark, f"{root}/ship_events", spec)
    last = events.agg(F.max("seq")).scalar()
    for crawl in range(CRAWLS):
        landing = events.filter(F.least(F.floor(F.col("seq") * CRAWLS / (last + 1)), F.lit(CRAWLS - 1)) == crawl)
        landing.write.mode("append").parquet(f"{root}/landing")
        arriving = spark.readStream.schema(events.schema).parquet(f"{root}/landing")
        upsert_stream(arriving, stored, f"{root}/checkpoint", lambda _: moment(AS_OF)).awaitTermination()
    return stored.read().select(*spec.keys, *spec.payload)


_CRAWLS = "least(floor(seq * 3 / (last + 1)), 2)"


def _berth_fold() -> str:
    """The state after each of three crawls, one after the other."""
    spec = SPECS["ship_berth_order"]
    keys = ", ".join(spec.keys)
    steps = []
    for i in range(CRAWLS):
        stamp = f"cast('{AS_OF}' as timestamp) + INTERVAL '{i}' MINUTE"
        steps.append(f"""
    crawl{i} AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY seq DESC) AS rn FROM numbered WHERE crawl = {i}) WHERE rn = 1)""")
        if i == 0:
            steps.append(f"""
    state0 AS (SELECT {keys}, {', '.join(spec.payload)}, {stamp} AS created_at, {stamp} AS updated_at FROM crawl0)""")
            continue
        differs = " OR ".join(f"c.{w} <> s.{w}" for w in spec.watched)
        written = f"(s.{spec.keys[0]} IS NULL OR (c.{spec.keys[0]} IS NOT NULL AND coalesce({differs}, FALSE)))"
        steps.append(f"""
    state{i} AS (
        SELECT {', '.join(f'coalesce(s.{k}, c.{k}) AS {k}' for k in spec.keys)},
            {', '.join(f'CASE WHEN {written} THEN c.{w} ELSE s.{w} END AS {w}' for w in spec.payload)},
            CASE WHEN s.{spec.keys[0]} IS NULL THEN {stamp} ELSE s.created_at END AS created_at,
            CASE WHEN {written} THEN {stamp} ELSE s.updated_at END AS updated_at
        FROM state{i - 1} s FULL JOIN crawl{i} c ON {' AND '.join(f's.{k} = c.{k}' for k in spec.keys)})""")
    return ",".join(steps)


@query("stream_upsert_berth", f"""{oracle_with('fx_berth_raw')},
    numbered AS (SELECT *, cast({_CRAWLS} as int) AS crawl FROM fx_berth_raw, (SELECT max(seq) AS last FROM fx_berth_raw)),
    {_berth_fold()}
    SELECT * FROM state2""")
def stream_upsert_berth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three crawls of the berth table have landed before one run of the stream takes them in."""
    root = scratch_folder(spark, "stream-berth")
    stored = StateTable(spark, f"{root}/ship_berth_order", SPECS["ship_berth_order"], parts=8)
    rows = project(spark, sf_dir, "fx_berth_raw")
    last = rows.agg(F.max("seq").alias("last"))
    rows = rows.drop("updated_at").join(last).withColumn("crawl", F.expr(_CRAWLS).cast("int")).drop("last")
    rows.write.parquet(f"{root}/landing")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{root}/landing")
    stamp = lambda crawl: moment(AS_OF) + F.make_dt_interval(mins=F.lit(crawl))
    upsert_stream(arriving, stored, f"{root}/checkpoint", stamp, crawl="crawl").awaitTermination()
    return stored.read()


LATE = "'3' HOUR"


@query("stream_late_rows", f"""{oracle_with('fx_events')},
    seen AS (
        SELECT ship_voyage_number, event_name, event_time, (INTERVAL '1' HOUR) * cast(seq % 5 as int) AS lag FROM fx_events)
    SELECT DISTINCT ship_voyage_number, event_name, event_time, FALSE AS late FROM seen WHERE lag <= INTERVAL {LATE}
    UNION ALL
    SELECT ship_voyage_number, event_name, event_time, TRUE AS late FROM seen WHERE lag > INTERVAL {LATE}""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are seen up to four hours after their time; those over three hours get an output of their own."""
    root = scratch_folder(spark, "stream-late")
    keys = ["ship_voyage_number", "event_name", "event_time"]
    events = project(spark, sf_dir, "fx_events").withColumn(
        "seen", F.col("event_time") + F.make_dt_interval(hours=(F.col("seq") % 5).cast("int"))).select(*keys, "seen")
    events.write.parquet(f"{root}/seen")
    arriving = spark.readStream.schema(events.schema).parquet(f"{root}/seen")
    on_time, late = split_late(arriving, "event_time", "seen", LATE)
    streams = [
        append_stream(first_reports(on_time, keys, "seen", "60 days").select(*keys), f"{root}/reported", f"{root}/checkpoint"),
        append_stream(late.select(*keys), f"{root}/late", f"{root}/late-checkpoint")]
    for stream in streams:
        stream.awaitTermination()
    return spark.read.parquet(f"{root}/reported").withColumn("late", F.lit(False)).union(
        spark.read.parquet(f"{root}/late").withColumn("late", F.lit(True)))


@query("stream_dedup_alerts", f"""{oracle_with('fx_events')}
    SELECT DISTINCT ship_voyage_number, event_time, event_name FROM fx_events""")
def stream_dedup_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is seen by several polls and reported once."""
    root = scratch_folder(spark, "stream-dedup")
    keys = ["ship_voyage_number", "event_name", "event_time"]
    events = project(spark, sf_dir, "fx_events").select(*keys)
    reporting_polls(events, "event_time").select(*keys).write.parquet(f"{root}/polled")
    arriving = spark.readStream.schema(events.schema).parquet(f"{root}/polled")
    append_stream(
        first_reports(arriving, keys, "event_time", "60 days"), f"{root}/reported", f"{root}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/reported").withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("csv_round_trip", f"{oracle_with('fx_berth')} SELECT * FROM fx_berth")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    berths = project(spark, sf_dir, "fx_berth")
    path = f"{scratch_folder(spark, 'csv')}/{files.export_folder('output.csv', 'ship_berth_order')}"
    files.export_csv(berths, path)
    return files.read_csv(spark, path, berths.schema)


@query("raw_landing", """
    SELECT page_id, url, md5(html) AS html_md5, cast(DATE '2024-01-31' - cast(page_id % 7 as int) as varchar) AS crawl_date
    FROM pages""")
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "pages").withColumn(
        "crawl_date", F.date_sub(F.lit("2024-01-31"), (F.col("page_id") % 7).cast("int")).cast("string"))
    path = scratch_folder(spark, "landing")
    files.land_pages(dated, path)
    return spark.read.schema(dated.schema).parquet(path).select(
        "page_id", "url", F.md5("html").alias("html_md5"), "crawl_date")
