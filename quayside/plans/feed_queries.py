"""Registered queries: tables kept from the change feed, and polls that read what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import rules
from quayside.operators.upsert import SPECS
from quayside.plans import alerts as A
from quayside.plans import delivery as D
from quayside.plans.alert_queries import _BERTH_ALERTS, _LATEST, _OUTBOX, _REVISED, _ROUTED, CHANNELS
from quayside.plans.feed import Feed, follow, follow_all
from quayside.plans.registry import query
from quayside.plans.state_queries import _DAY_BATCH, _oracle_sql, _spark_sql
from quayside.session import scratch_folder
from quayside.sources.state import state_table
from quayside.sources.testdata import AS_OF, BERTH_KEYS, CUTOFF, oracle_with, project

PARTS = 8
_EVENT_KEYS = ", ".join(SPECS["ship_events"].keys)


def _last_change(rows: str, order: str) -> str:
    """Oracle: stored events after ``rows`` came in that order. Of equal times in a row the first stays."""
    return f"""
        SELECT * EXCLUDE (newest, changed, turn) FROM (
            SELECT *, row_number() OVER (PARTITION BY {_EVENT_KEYS} ORDER BY {order} DESC) AS newest FROM (
                SELECT *, row_number() OVER w AS turn, lag(event_content_time) OVER w IS DISTINCT FROM event_content_time AS changed
                FROM {rows} WINDOW w AS (PARTITION BY {_EVENT_KEYS} ORDER BY {order}))
            WHERE changed OR turn = 1)
        WHERE newest = 1"""


@query("announced_incremental", f"""{oracle_with('fx_events').replace('fx_events AS', 'fx_raw AS', 1)},
    batch AS (SELECT {_oracle_sql(_DAY_BATCH)}, seq % 4 AS crawl FROM fx_raw),
    fx_events AS ({_last_change('batch', '(crawl, seq)')}), {_REVISED},
    voyages AS (SELECT DISTINCT ship_voyage_number FROM revisions)
    SELECT v.ship_voyage_number, eta.eta, etd.etd FROM voyages v
    LEFT JOIN eta ON eta.ship_voyage_number = v.ship_voyage_number
    LEFT JOIN etd ON etd.ship_voyage_number = v.ship_voyage_number""")
def announced_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announced times kept from what each crawl changed in the stored events, some crawls taken in together."""
    root = scratch_folder(spark, "announced")
    batch = project(spark, sf_dir, "fx_events").selectExpr(*_spark_sql(_DAY_BATCH))
    events = state_table(spark, root, "ship_events")
    for crawl in range(4):
        events.apply(batch.filter(F.col("seq") % 4 == crawl), crawl, A.moment(AS_OF))
        if crawl != 1:
            follow(spark, root, "announced_times", PARTS)
    return state_table(spark, root, "announced_times", PARTS).read().select("ship_voyage_number", "eta", "etd")


def _hours_before(hours: Column) -> Column:
    return A.moment(AS_OF) - F.make_dt_interval(hours=hours.cast("int"))


def _stored(spark: SparkSession, sf_dir: str) -> Feed:
    """The port's tables in two versions, of which the second has what was stamped since the cutoff."""
    root = scratch_folder(spark, "feed")
    before = A.moment(CUTOFF) - F.make_dt_interval(hours=F.lit(1))
    key = F.substring("ship_voyage_number", 2, 5).cast("long") + 100_000 * (
        F.substring("ship_voyage_number", 7, 4).cast("long") - 1)

    status = project(spark, sf_dir, "fx_status").withColumn("seq", F.lit(0).cast("bigint"))
    turn = F.col("c_custkey") % 10
    old = status.filter((turn > 4) | (turn < 4)).withColumn(
        "latest_event", F.when(turn > 4, F.col("latest_event")).otherwise("an event before"))
    stamp = _hours_before(12 * (key % 10))
    table = state_table(spark, root, "ship_status", PARTS)
    table.apply(old, 0, F.when(key % 10 > 4, stamp).otherwise(before))
    table.apply(status.filter(turn <= 4), 1, stamp)

    voyage = project(spark, sf_dir, "fx_voyage").withColumn("seq", F.lit(0).cast("bigint"))
    table = state_table(spark, root, "ship_voyage", PARTS)
    for version, rows in enumerate((voyage.filter(F.col("updated_at") < A.moment(CUTOFF)), voyage.filter(F.col("updated_at") >= A.moment(CUTOFF)))):
        table.apply(rows, version, _hours_before(12 * (key % 7)))

    events, berths = project(spark, sf_dir, "fx_events"), project(spark, sf_dir, "fx_berth_raw").drop("updated_at")
    for version in (0, 1):
        state_table(spark, root, "ship_events", PARTS).apply(events.filter(F.col("seq") % 2 == version), version, before)
        state_table(spark, root, "ship_berth_order", PARTS).apply(
            berths.filter(F.col("seq") % 64 == 0) if version else berths.filter(F.col("seq") % 2 == 1), version,
            A.moment(AS_OF) if version else before)
        follow_all(spark, root, PARTS)
    return Feed(spark, root, {"ship_status": 0, "ship_voyage": 0, "ship_berth_order": 0}, PARTS)


def _kept_last(share: str) -> str:
    keys = ", ".join(BERTH_KEYS)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY seq DESC) AS rn"
            f" FROM fx_berth_raw WHERE {share}) WHERE rn = 1")


_BERTH_SPEC = SPECS["ship_berth_order"]
_WRITTEN = "(s.seq IS NULL OR coalesce(" + " OR ".join(f"b.{c} <> s.{c}" for c in _BERTH_SPEC.watched) + ", FALSE))"
_STORED = f"""{oracle_with('fx_status', 'fx_voyage', 'fx_events', 'fx_berth_raw').replace('fx_events AS', 'fx_raw AS', 1)},
    fx_events AS ({_last_change('fx_raw', '(seq % 2, seq)')}),
    first_berths AS ({_kept_last('seq % 2 = 1')}), second_berths AS ({_kept_last('seq % 64 = 0')}),
    fx_berth AS (
        SELECT {', '.join(f'coalesce(s.{k}, b.{k}) AS {k}' for k in BERTH_KEYS)},
            {', '.join(f'CASE WHEN b.seq IS NOT NULL AND {_WRITTEN} THEN b.{c} ELSE s.{c} END AS {c}' for c in _BERTH_SPEC.payload)},
            CASE WHEN b.seq IS NOT NULL AND {_WRITTEN} THEN cast('{AS_OF}' as timestamp)
                ELSE cast('{CUTOFF}' as timestamp) - INTERVAL 1 HOUR END AS updated_at
        FROM first_berths s FULL JOIN second_berths b ON {' AND '.join(f's.{k} = b.{k}' for k in BERTH_KEYS)})"""


@query("poll_from_feed", f"{_STORED}, {_LATEST} SELECT * FROM latest")
def poll_from_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``latest_status`` out of the parts of stored tables in which something changed."""
    cutoff, feed = A.moment(CUTOFF), _stored(spark, sf_dir)
    status, voyage = feed.status_tables(cutoff)
    return A.latest_status(
        status, voyage, None, cutoff, feed.table("ship_events").read(since_day=CUTOFF[:10]), feed.table("announced_times").read())


@query("feed_outbox", f"""{_STORED}, {_ROUTED}, {_BERTH_ALERTS.replace(_REVISED + ",", "", 1)}, {_OUTBOX} SELECT * FROM outbox""")
def feed_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outbox of a poll as it is stored, from stored tables and what is kept along with them."""
    cutoff, feed = A.moment(CUTOFF), _stored(spark, sf_dir)
    return D.run_poll(
        feed.tables(cutoff, CUTOFF[:10]), rules.rule_table(spark), rules.channel_table(spark, CHANNELS), cutoff,
        scratch_folder(spark, "poll")).outbox
