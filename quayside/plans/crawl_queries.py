"""Registered queries: crawls of all kinds of pages, also such that land late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import times
from quayside.functions.text import page_address
from quayside.plans.alerts import moment
from quayside.plans.page_queries import (
    _CONTENT,
    _NUMBERED,
    CHUNK,
    _event_pages,
    _seen,
    _status_pages,
    grid_row,
    pages_of,
)
from quayside.plans.registry import query
from quayside.plans.state_queries import _folded
from quayside.plans.text_queries import EVENT_PAGE, era_text
from quayside.schemas import BERTH_TITLES, KEYS
from quayside.session import scratch_folder
from quayside.sources import pages as P
from quayside.sources.state import state_table
from quayside.sources.testdata import AS_OF, BERTH_KEYS, oracle_with, project
from quayside.streaming.crawls import BERTH, EVENT, MILE, ORDER, STATUS, crawl_stream

MILE_PAGE = f"{EVENT_PAGE}-miles"
EARLIER_AGENT = "先前"
PARTS = 8

_LISTED = f"""{_NUMBERED},
    gaps AS (SELECT crawl_id, min(row) AS gap FROM numbered WHERE c_custkey % 50 = 7 GROUP BY crawl_id),
    listed AS (SELECT n.* FROM numbered n LEFT JOIN gaps g ON g.crawl_id = n.crawl_id WHERE g.gap IS NULL OR n.row < g.gap)"""


def _mile_pages(spark: SparkSession, sf_dir: str, crawl: int) -> DataFrame:
    """A page per ship; each of two crawls finds one of the two passages."""
    key, text = F.col("c_custkey"), era_text(times.to_local(F.col("updated_at")))
    ten = F.when(key % 4 == 0, "").otherwise(text) if crawl == 0 else F.lit(None).cast("string")
    five = F.when(key % 5 == 0, "").otherwise(text) if crawl == 1 else F.lit(None).cast("string")
    ships = project(spark, sf_dir, "fx_status").withColumn("row", F.lit(0).cast("bigint"))
    return ships.select(
        F.lit("miles").alias("crawl_id"), F.lit(0).alias("page_no"),
        page_address(MILE_PAGE, F.col("ship_voyage_number")).alias("url"),
        grid_row(P.MILE_GRID, F.array(F.lit("x"), F.lit("y"), ten, five)).alias("html"))


def _berth_pages(spark: SparkSession, sf_dir: str, crawl: int) -> DataFrame:
    """The queue, a few rows to a page; the first of two crawls finds another agent on every third row."""
    rows = project(spark, sf_dir, "fx_berth_raw").withColumn("row", F.col("seq")).withColumn(
        "crawl_id", F.lit("berths")).withColumn("page_no", F.floor(F.col("seq") / CHUNK))

    def time_text(name: str) -> Column:
        return F.coalesce(era_text(times.to_local(F.col(name))), F.lit("待接靠"))

    agent = F.coalesce("port_agent", F.lit(""))
    if crawl == 0:
        agent = F.when(F.col("seq") % 3 == 0, EARLIER_AGENT).otherwise(agent)
    cells = F.array(
        F.col("berth_number"), time_text("berthing_time"), F.col("ship_status"), time_text("pilotage_time"),
        F.col("ship_name_chinese"), F.coalesce("ship_name_english", F.lit("")), agent)
    tds = F.transform(cells, lambda c: F.concat(F.lit(f'<td class="{P.CELL_CLASS}">'), c, F.lit("</td>")))
    body = F.concat(F.lit(f'<tr class="{P.ROW_CLASS}">'), F.array_join(tds, ""), F.lit("</tr>"))
    header = "".join(f'<td class="{P.HEADER_CLASS}">{title}</td>' for title in BERTH_TITLES)
    return pages_of(rows, body).withColumn("url", F.lit("berths")).withColumn("html", F.concat(
        F.lit(f'<div class="{P.CONTROL_CLASS}"><tr>{header}</tr>'), "html", F.lit("</div>")))


def _landing(pages: DataFrame, kind: str, crawl: int) -> DataFrame:
    url = F.col("url") if "url" in pages.columns else F.lit("list")
    return pages.select(
        "crawl_id", F.col("page_no").cast("int").alias("page_no"), url.alias("url"), "html", F.lit(kind).alias("kind"),
        F.lit(crawl).alias("crawl"))


def _take(spark: SparkSession, root: str, schema: T.StructType, **options: object) -> None:
    crawl_stream(
        spark.readStream.schema(schema).parquet(f"{root}/arrived"), root, f"{root}/checkpoint", EVENT_PAGE, MILE_PAGE,
        lambda crawl, _: moment(AS_OF) + F.make_dt_interval(hours=F.lit(crawl)), parts=PARTS, **options).awaitTermination()


_FIRST_STAMP = f"cast('{AS_OF}' as timestamp)"
_SECOND_STAMP = f"{_FIRST_STAMP} + INTERVAL '1' HOUR"


def _stamp(changed: str) -> str:
    return f"CASE WHEN {changed} THEN {_SECOND_STAMP} ELSE {_FIRST_STAMP} END"


@query("stream_crawl_all", f"""{oracle_with('fx_status', 'fx_events', 'fx_berth_raw')}, {_LISTED},
    state AS (SELECT * FROM fx_events WHERE FALSE),
    batch AS (
        SELECT * EXCLUDE (navigation_status, event_content_time), coalesce(navigation_status, '') AS navigation_status, {_CONTENT}
        FROM fx_events WHERE ship_voyage_number IN (SELECT ship_voyage_number FROM listed)),
    {_folded('ship_events', null_safe=True)},
    last_berths AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY {', '.join(BERTH_KEYS)} ORDER BY seq DESC) AS rn FROM fx_berth_raw) WHERE rn = 1)
    SELECT 'ship_status' AS table_name, ship_voyage_number AS key, ship_name AS name, cast(NULL as timestamp) AS at,
        {_seen('1')} AS state, cast(NULL as varchar) AS more, cast(NULL as timestamp) AS first_time,
        cast(NULL as timestamp) AS second_time, {_stamp(f"{_seen('0')} <> {_seen('1')}")} AS updated_at
    FROM listed
    UNION ALL SELECT 'ship_events', ship_voyage_number, event_name, event_time, navigation_status, pilot_order_number,
        event_content_time, NULL, NULL FROM merged
    UNION ALL SELECT 'ship_voyage', ship_voyage_number, NULL, NULL, NULL, NULL,
        CASE WHEN c_custkey % 4 <> 0 THEN updated_at END, CASE WHEN c_custkey % 5 <> 0 THEN updated_at END,
        {_stamp('c_custkey % 4 <> 0 OR c_custkey % 5 <> 0')} FROM listed
    UNION ALL SELECT 'ship_berth_order', berth_number, ship_name_chinese, NULL, ship_status,
        coalesce(ship_name_english, '') || '/' || coalesce(port_agent, ''), berthing_time, pilotage_time,
        {_stamp('seq % 3 = 0')} FROM last_berths""")
def stream_crawl_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all four kinds from two crawls have landed before one run of the stream; the rows of all four tables after it."""
    root = scratch_folder(spark, "stream-crawl-all")
    for crawl in range(2):
        ships = project(spark, sf_dir, "fx_status").withColumn("latest_event", F.expr(_seen(str(crawl))))
        found = _landing(_status_pages(spark, sf_dir, ships), STATUS, crawl)
        found = found.union(_landing(_mile_pages(spark, sf_dir, crawl), MILE, crawl))
        found = found.union(_landing(_berth_pages(spark, sf_dir, crawl), BERTH, crawl))
        if crawl == 1:
            found = found.union(_landing(_event_pages(spark, sf_dir), EVENT, crawl))
        found.write.mode("append").parquet(f"{root}/arrived")
    _take(spark, root, found.schema)
    no_text, no_time = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    shown = {
        "ship_status": ("ship_voyage_number", "ship_name", no_time, "latest_event", no_text, no_time, no_time, "updated_at"),
        "ship_events": ("ship_voyage_number", "event_name", "event_time", "navigation_status", "pilot_order_number",
                        "event_content_time", no_time, no_time),
        "ship_voyage": ("ship_voyage_number", no_text, no_time, no_text, no_text, "pass_10_miles_time", "pass_5_miles_time", "updated_at"),
        "ship_berth_order": ("berth_number", "ship_name_chinese", no_time, "ship_status",
                             F.concat_ws("/", "ship_name_english", "port_agent"), "berthing_time", "pilotage_time", "updated_at"),
    }
    names = ("key", "name", "at", "state", "more", "first_time", "second_time", "updated_at")
    result = None
    for table in ORDER:
        columns = (F.col(c) if isinstance(c, str) else c for c in shown[table])
        rows = state_table(spark, root, table, PARTS).read().select(
            F.lit(table).alias("table_name"), *(c.alias(n) for c, n in zip(columns, names, strict=True)))
        result = rows if result is None else result.union(rows)
    return result


LANDING_ORDER = (2, 0, 1)


@query("stream_late_events", f"""{oracle_with('fx_status', 'fx_events')}, {_LISTED},
    reported AS (
        SELECT * EXCLUDE (pilot_order_number), cast(seq as varchar) || '-' || cast(crawl as varchar) AS pilot_order_number
        FROM (SELECT *, unnest([0, 1, 2]) AS crawl FROM fx_events) WHERE (seq + crawl) % 3 <> 0),
    newest AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY {', '.join(KEYS['ship_events'])} ORDER BY crawl DESC, seq DESC) AS rn FROM reported)
        WHERE rn = 1 AND ship_voyage_number IN (SELECT ship_voyage_number FROM listed))
    SELECT ship_voyage_number, event_source, event_time, event_name, coalesce(navigation_status, '') AS navigation_status,
        pilot_order_number, berth_number, {_CONTENT} FROM newest""")
def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three crawls that report two thirds of the events each land one by one, the last one first."""
    root = scratch_folder(spark, "stream-late-events")
    for crawl in LANDING_ORDER:
        events = project(spark, sf_dir, "fx_events").filter((F.col("seq") + crawl) % 3 != 0).withColumn(
            "pilot_order_number", F.concat_ws("-", F.col("seq").cast("string"), F.lit(str(crawl))))
        found = _landing(_status_pages(spark, sf_dir), STATUS, crawl).union(_landing(_event_pages(spark, sf_dir, events), EVENT, crawl))
        found.write.mode("append").parquet(f"{root}/arrived")
        _take(spark, root, found.schema, merge_late=True)
    return state_table(spark, root, "ship_events", PARTS).read().drop("id")
