"""Landed pages into the stored tables: the crawling loop as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from quayside.operators import quality
from quayside.plans.ingest import crawl_tables, listed_ships, merge_events, typed_folder, write_typed
from quayside.sources import files
from quayside.sources.pages import page_bytes, spread_crawls, spread_pages
from quayside.sources.state import state_table

# Kinds of pages, and the order in which tables are taken in: a voyage row is to be newer than
# its status row.
STATUS, EVENT, MILE, BERTH = "status", "event", "mile", "berth"
ORDER = {"ship_status": STATUS, "ship_events": EVENT, "ship_voyage": MILE, "ship_berth_order": BERTH}
NOTE = "batch bigint, crawl bigint"
COUNTS = "crawl bigint, table_name string, pages bigint, rows bigint, rejects bigint, late boolean"


def late_folder(root: str, table: str, number: int) -> str:
    return f"{root.rstrip('/')}/late/{table}/crawl={number}"


def _crawls_before(spark: SparkSession, root: str, batch_id: int, numbers: list[int]) -> list[int]:
    """Numbers of the crawls of the batches before this one.

    They are noted, with those of this batch, for the next one, in the other of two places: there is little to read
    however long the stream goes on, and a batch that is run again finds what its first attempt found.
    """
    before: dict[int, list[int]] = {}
    for place in (0, 1):
        try:
            noted = spark.read.schema(NOTE).option("ignoreMissingFiles", True).json(f"{root}/crawls/place={place}")
            for row in noted.filter(F.col("batch") < batch_id).collect():
                before.setdefault(row["batch"], []).append(row["crawl"])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    known = before[max(before)] if before else []
    spark.createDataFrame([(batch_id, n) for n in sorted({*known, *numbers})], NOTE).coalesce(1).write.mode(
        "overwrite").json(f"{root}/crawls/place={batch_id % 2}")
    return known


def crawl_counts(spark: SparkSession, root: str) -> DataFrame:
    """Per crawl and table: pages that came for it, rows cut from them, rejected rows among these, and whether they
    came late. A crawl that goes on has the counts of its newest batch."""
    return spark.read.schema(COUNTS).json(f"{root}/counts/*")


def crawl_stream(
    pages: DataFrame, root: str, checkpoint: str, event_base: str, mile_base: str,
    as_of: Callable[[int, str], Column], parts: int = 64, export_stem: str | None = None, merge_late: bool = False,
) -> StreamingQuery:
    """Takes all pages that have landed into the four tables below ``root``, then stops.

    ``pages`` has the columns of pages, ``kind``, and ``crawl``, the number of the crawl that
    found them. All pages are kept as they came, below ``root/landing``. Crawls of one micro-batch
    are stored one after the other, as the version of their number; ``as_of`` gives the time to stamp
    from number and table. A crawl that goes on in a later micro-batch is taken again with all its
    pages that have landed, in place of its first part. A crawl that is stored is left alone when a batch is run
    again. Of one that lands, or goes on, after a later one has landed in an earlier batch, the typed rows with
    their rejects go to ``late_folder`` instead, as the later one is not to be undone. With ``merge_late``, which
    is chosen for a table's life, its events are taken in all the same: the stored events are those of
    the newest crawl for each key, whatever the order of landing, one version per micro-batch. With
    ``export_stem``, the three exports are made anew after each batch.
    """

    def take_crawl(spark: SparkSession, number: int, late: bool, schema: T.StructType) -> list[tuple]:
        mine = files.landed_pages(spark, f"{root}/landing", str(number), schema)
        sizes = mine.groupBy("kind").agg(F.count("*").alias("pages"), page_bytes(F.col("html")).alias("bytes")).collect()
        arrived, size = ({row["kind"]: row[c] for row in sizes} for c in ("pages", "bytes"))
        kinds = {
            k: spread_pages(mine.filter(F.col("kind") == k).drop("kind", "crawl"), size.get(k, 0)) for k in ORDER.values()}
        crawled = {"ship_status": listed_ships(kinds[STATUS])}
        counts = []
        for name, kind in ORDER.items():
            merged = merge_late and name == "ship_events"
            table = state_table(spark, root, name, parts)
            # A later crawl of the same batch is stored already if the batch is run again.
            stored = not late and not merged and table.newest() > number
            if stored and name != "ship_status":
                continue
            typed, count = write_typed(
                crawled[name], (late_folder if late and not merged else typed_folder)(root, name, number))
            if name == "ship_status":
                crawled = crawl_tables(
                    kinds[STATUS], kinds[EVENT], kinds[MILE], kinds[BERTH], event_base, mile_base, listed=typed)
            counts.append((number, name, arrived.get(kind, 0), count["rows"], count["rejects"], late))
            if not late and not merged and not stored:
                table.apply(quality.accepted(typed), number, as_of(number, name))
        return counts

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read again and not kept: pages are many times larger than the files they come in.
        sizes = {row["crawl"]: row["bytes"] for row in batch.groupBy("crawl").agg(page_bytes(F.col("html")).alias("bytes")).collect()}
        numbers = sorted(sizes)
        dealt = spread_crawls(batch, sizes).withColumn("crawl_date", F.col("crawl").cast("string"))
        files.land_pages(dealt, f"{root}/landing", batch_id)
        before = _crawls_before(spark, root, batch_id, numbers)
        for number in numbers:
            counts = take_crawl(spark, number, bool(before) and number < max(before), batch.schema)
            if counts:
                spark.createDataFrame(counts, COUNTS).coalesce(1).write.mode("overwrite").json(f"{root}/counts/of={number}")
        if merge_late:
            merge_events(spark, root, numbers, before, batch_id)
        if export_stem is not None:
            for name in files.EXPORT_SUFFIXES:
                rows = state_table(spark, root, name, parts).read()
                files.export_csv(rows, f"{root}/{files.export_folder(export_stem, name)}")

    return (
        pages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
