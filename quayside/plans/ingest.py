"""From scraped rows to typed rows and rejects, and on into the stored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside import schemas
from quayside.functions import times
from quayside.functions.text import voyage_of_address
from quayside.operators import quality
from quayside.operators.latest import keep_last
from quayside.operators.upsert import SPECS
from quayside.schemas import BERTH_TITLES, EVENT_TITLES, MILE_TITLES, STATUS_TITLES
from quayside.sources import pages as P
from quayside.sources.state import StateTable, state_table

# Events as the newest crawl has them, whatever the order in which crawls land: a difference anywhere counts.
NEWEST_EVENTS = SPECS["ship_events"].variant(watched=SPECS["ship_events"].payload)


def _checked(table: str, df: DataFrame, first: dict[str, Column] | None = None, **parse_checks: Column) -> DataFrame:
    checks = {
        **(first or {}),
        **quality.required_checks(schemas.REQUIRED[table]),
        **parse_checks,
        **quality.length_checks(schemas.LENGTHS[table]),
    }
    return quality.with_reasons(df, checks)


def typed_status(rows: DataFrame) -> DataFrame:
    number, name, event = STATUS_TITLES[:3]
    return _checked("ship_status", rows.select(
        F.col(number).alias("ship_voyage_number"), F.col(name).alias("ship_name"),
        F.col(event).alias("latest_event"), "seq"))


def typed_events(rows: DataFrame) -> DataFrame:
    """``event_time`` and ``event_content`` texts become times; a text that is no time rejects the row."""
    raw_time, raw_content = F.col("event_time"), F.col("event_content")
    kept = [c for c in EVENT_TITLES.values() if c not in ("event_time", "event_content")]
    typed = rows.select(
        "ship_voyage_number", *kept, "seq",
        raw_time.alias("event_time_text"), raw_content.alias("event_content_text"),
        times.meridiem_time(raw_time).alias("event_time"),
        times.content_time(raw_content).alias("event_content_time"),
    )
    # A time that cannot be read is another fault than none.
    unread = F.col("event_time_text").isNotNull() & F.col("event_time").isNull()
    return _checked("ship_events", typed, {"bad_event_time": unread}, bad_event_content=times.content_time_rejected(F.col("event_content_text")))


def typed_voyage(rows: DataFrame) -> DataFrame:
    names = tuple(MILE_TITLES.values())
    typed = rows.select(
        "ship_voyage_number", "seq",
        *(F.col(c).alias(f"{c}_text") for c in names), *(times.era_time(F.col(c)).alias(c) for c in names))
    return _checked(
        "ship_voyage", typed, **{f"bad_{c}": times.era_time_rejected(F.col(f"{c}_text")) for c in names})


def typed_berths(rows: DataFrame) -> DataFrame:
    """Only the last row of a (berth, status, Chinese name) counts."""
    names = ("berthing_time", "pilotage_time")
    others = [c for c in BERTH_TITLES.values() if c not in names]
    last = keep_last(rows, schemas.KEYS["ship_berth_order"], "seq")
    typed = last.select(
        *others, "seq",
        *(F.col(c).alias(f"{c}_text") for c in names), *(times.era_time(F.col(c)).alias(c) for c in names))
    return _checked(
        "ship_berth_order", typed, **{f"bad_{c}": times.era_time_rejected(F.col(f"{c}_text")) for c in names})


def own_pages(pages: DataFrame, base: str) -> DataFrame:
    """Pages of single voyages; ``crawl_id`` becomes the voyage number, read from the address.

    So pages are cut where they are read, and only their rows meet the list of ships.
    """
    voyage = voyage_of_address(base, F.col("url"))
    return pages.withColumn("crawl_id", voyage).filter("crawl_id IS NOT NULL").select("crawl_id", "page_no", "url", "html")


def listed_ships(status_pages: DataFrame) -> DataFrame:
    """Typed rows of the ship list, with ``reject_reason``."""
    return typed_status(P.status_rows(status_pages).withColumn("seq", F.col("row")))


def crawl_tables(
    status_pages: DataFrame, event_pages: DataFrame, mile_pages: DataFrame, berth_pages: DataFrame,
    event_base: str, mile_base: str, listed: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Typed rows with ``reject_reason`` of all four tables, from one crawl's pages.

    Event and mile pages are those of the ships in the list. ``listed``, if given, are the typed rows of the
    ship list, stored; otherwise each table that is written cuts the list's pages again.
    """
    listed = listed_ships(status_pages) if listed is None else listed
    listed_only = listed.select(F.col("ship_voyage_number").alias("crawl_id")).distinct()
    events = P.event_rows(own_pages(event_pages, event_base)).join(listed_only, "crawl_id", "left_semi")
    miles = P.mile_rows(own_pages(mile_pages, mile_base)).join(listed_only, "crawl_id", "left_semi")
    berths = P.header_table_rows(berth_pages, BERTH_TITLES)
    voyage = F.col("crawl_id").alias("ship_voyage_number")
    return {
        "ship_status": listed,
        "ship_events": typed_events(events.select("*", voyage, F.col("row").alias("seq"))),
        "ship_voyage": typed_voyage(miles.select("*", voyage, F.lit(0).cast("bigint").alias("seq"))),
        "ship_berth_order": typed_berths(berths.withColumn("seq", F.col("page_no") * F.lit(2**32) + F.col("row"))),
    }


def typed_folder(root: str, table: str, version: int) -> str:
    return f"{root.rstrip('/')}/typed/{table}/crawl={version}"


def write_typed(rows: DataFrame, folder: str) -> tuple[DataFrame, dict[str, int]]:
    """Typed rows, good and bad ones, written and to be read again, and how many ``rows`` and ``rejects``
    there are, counted by the write itself."""
    counts = Observation()
    rows.observe(counts, F.count(F.lit(1)).alias("rows"), F.count("reject_reason").alias("rejects")).write.mode(
        "overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder), counts.get


def store_table(
    spark: SparkSession, rows: DataFrame, root: str, name: str, version: int, as_of: Column, parts: int = 64
) -> None:
    """Typed rows of one table into the stored one. They are written first, good and bad ones, so that
    pages are not read again for the upsert; the rejects stay there with their reason."""
    typed, _ = write_typed(rows, typed_folder(root, name, version))
    state_table(spark, root, name, parts).apply(quality.accepted(typed), version, as_of)


def _typed_crawls(spark: SparkSession, root: str, table: str, numbers: Sequence[int]) -> DataFrame:
    """Accepted rows of some crawls with their number as ``crawl``."""
    folders = [typed_folder(root, table, n) for n in numbers]
    return quality.accepted(spark.read.option("basePath", f"{root.rstrip('/')}/typed/{table}").parquet(*folders))


def merge_events(spark: SparkSession, root: str, numbers: Sequence[int], landed: Sequence[int], version: int) -> None:
    """Typed events of some crawls into the stored ones, with the result that crawls in order would have.

    The stored table has, of each key, the row of the newest crawl that reported it. ``landed`` are the crawls that have
    landed before, maybe newer ones: a row whose key one of these reported as well is left out. Only the
    typed rows of crawls newer than the oldest of ``numbers`` are looked at, and none if crawls land in order.
    """
    keys = list(NEWEST_EVENTS.keys)
    rows = _typed_crawls(spark, root, "ship_events", numbers)
    newer = sorted(n for n in set(landed) - set(numbers) if n > min(numbers))
    if newer:
        reported = _typed_crawls(spark, root, "ship_events", newer).groupBy(*keys).agg(F.max("crawl").alias("_reported"))
        rows = rows.join(reported, keys, "left").filter(F.coalesce(F.col("_reported") < F.col("crawl"), F.lit(True))).drop("_reported")
    StateTable(spark, f"{root.rstrip('/')}/ship_events", NEWEST_EVENTS).apply(
        rows, version, lambda _: F.lit(None).cast("timestamp_ntz"), crawl="crawl")


def store_crawl(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, version: int, as_of: Callable[[str], Column],
    parts: int = 64,
) -> None:
    """Takes one crawl into the stored tables below ``root``.

    ``as_of`` gives
    the time stamped on a table's rows: tables are taken in one after the other, and a
    ship's voyage row is meant to be a little newer than its status row. ``parts`` is how
    many parts the tables without days have; it stays the same for as long as they live.
    """
    for name in ("ship_status", "ship_events", "ship_voyage", "ship_berth_order"):
        store_table(spark, tables[name], root, name, version, as_of(name), parts)


def crawl_rejects(spark: SparkSession, root: str, table: str, version: int) -> DataFrame:
    return quality.rejected(spark.read.parquet(typed_folder(root, table, version)))
