"""Plans: what is shuffled, pushed down, split."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quayside.operators.latest import in_even_parts, keep_last, newest_with_ties
from quayside.operators.substring import last_contained
from quayside.plans import alerts as A
from quayside.plans import berths as B
from tests.conftest import as_tuples


@pytest.fixture
def settings(spark):
    """Sets session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Small stored tables, as parquet. One voyage, berth and name holds a third of all rows."""
    root = str(tmp_path_factory.mktemp("stored"))
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    time = F.lit("2024-01-01").cast("timestamp_ntz")
    base = spark.range(30000).withColumn("k", hot.cast("string")).withColumn(
        "t", time + F.make_dt_interval(mins=(F.col("id") % 5000).cast("int")))
    events = base.select(
        F.concat(F.lit("V"), F.col("k")).alias("ship_voyage_number"), F.col("t").alias("event_time"),
        F.when(F.col("id") % 2 == 0, "修改進港預報").otherwise("申請進港").alias("event_name"),
        F.lit("S").alias("event_source"), F.lit(None).cast("string").alias("navigation_status"),
        F.col("t").alias("event_content_time"), F.lit("unused").alias("pilot_order_number"))
    status = spark.range(30000).select(
        F.concat(F.lit("V"), F.col("id").cast("string")).alias("ship_voyage_number"),
        F.concat(F.lit("明"), (F.col("id") % 2000).cast("string")).alias("ship_name"), time.alias("updated_at"))
    voyage = status.select("ship_voyage_number", "updated_at", *(
        F.lit(None).cast("timestamp_ntz").alias(c) for c in ("pass_10_miles_time", "pass_5_miles_time")))
    berths = base.select(
        F.col("k").alias("berth_number"), F.col("t").alias("berthing_time"), F.col("t").alias("pilotage_time"),
        F.lit("P").alias("ship_status"), F.concat(F.lit("明"), F.col("id").cast("string")).alias("ship_name_chinese"),
        F.lit(None).cast("string").alias("ship_name_english"), F.lit("a").alias("port_agent"), F.col("t").alias("updated_at"))
    frames = {}
    for name, df in {"events": events, "status": status, "voyage": voyage, "berths": berths}.items():
        df.repartition(6).write.parquet(f"{root}/{name}")
        frames[name] = spark.read.parquet(f"{root}/{name}")
    return frames


CUTOFF = "2024-01-03 00:00:00"


def test_scans_read_little(stored):
    text = plan(A.latest_status(stored["status"], stored["voyage"], stored["events"], A.moment(CUTOFF)))
    assert "pilot_order_number" not in text
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(event_time", text)
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_name", text)


def test_no_join_without_keys(stored, settings):
    settings(autoBroadcastJoinThreshold="-1")
    cutoff = A.moment(CUTOFF)
    latest = A.latest_status(stored["status"], stored["voyage"], stored["events"], cutoff)
    for df in (
        A.enriched(A.status_alerts(latest), A.latest_agents(stored["berths"])),
        B.berth_alerts(stored["berths"], stored["status"], stored["events"], cutoff),
        B.queue_positions(stored["berths"]),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
        assert "PythonEval" not in text and "ArrowEval" not in text


def test_newest_rows_combine_before_the_shuffle(stored):
    for df in (keep_last(stored["berths"], ["berth_number"], "updated_at"), A.revised_times(stored["events"])):
        text = plan(df)
        assert text.index("Exchange") < text.index("partial_max")


def test_newest_rows_are_dealt_evenly_before_they_combine(stored):
    """What a task sorts is bounded by adaptive execution, not by how much a part of a file holds."""
    last = keep_last(stored["berths"], ["berth_number"], "updated_at")
    for df in (last, A.latest_agents(stored["berths"]), A.revised_times(stored["events"])):
        text = plan(df)
        assert "REBALANCE_PARTITIONS_BY_COL" in text[text.rindex("partial_max"):]


def test_even_parts_of_one_file_with_a_hot_key(spark, stored, settings, tmp_path):
    settings(shuffle__partitions="16", adaptive__coalescePartitions__enabled="false")
    stored["berths"].coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    dealt = in_even_parts(one, ["berth_number"])
    assert dealt.columns == one.columns
    assert one.rdd.getNumPartitions() == 1
    parts = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 30000 and max(parts) < 7500
    hot = dealt.filter(F.col("berth_number") == "0").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in hot) < 5000
    assert dealt.exceptAll(one).isEmpty() and one.exceptAll(dealt).isEmpty()
    got = keep_last(one, ["berth_number"], "updated_at")
    assert as_tuples(got) == as_tuples(keep_last(stored["berths"], ["berth_number"], "updated_at"))
    assert in_even_parts(one.select("berth_number"), ["berth_number"]).count() == 30000


@pytest.mark.parametrize("asked, dealt", [("4", "4"), ("200", "200"), ("1000", "200")])
def test_rows_are_dealt_without_being_held_first(stored, settings, asked, dealt):
    """Into more than 200 parts Spark writes a shuffle only after a task has all its rows in memory, be its part of a
    file as large as it may."""
    settings(shuffle__partitions=asked)
    berths = keep_last(stored["berths"], ["berth_number"], "updated_at")
    for df in (berths, A.latest_agents(stored["berths"]), A.revised_times(stored["events"])):
        counts = re.findall(r"Exchange hashpartitioning\(_even_part#\d+, (\d+)\), REBALANCE_PARTITIONS_BY_COL", plan(df))
        assert counts == [dealt]


def test_many_parts_give_the_same_rows(stored, settings):
    few = [as_tuples(keep_last(stored["berths"], ["berth_number"], "updated_at")), as_tuples(A.revised_times(stored["events"]))]
    settings(shuffle__partitions="201")
    assert as_tuples(keep_last(stored["berths"], ["berth_number"], "updated_at")) == few[0]
    assert as_tuples(A.revised_times(stored["events"])) == few[1]


def test_hot_keys_are_split(stored, settings):
    """With thresholds to fit the small tables, joins on a hot key run in several tasks."""
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB", adaptive__advisoryPartitionSizeInBytes="8KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5", adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="8")
    # All events of the hot voyage at one time: not even key and time together spread them.
    tied = stored["events"].withColumn(
        "event_time", F.when(F.col("ship_voyage_number") == "V0", A.moment("2024-01-09 00:00:00")).otherwise(
            F.col("event_time")))
    newest = newest_with_ties(tied, "ship_voyage_number", "event_time")
    rows = newest.collect()
    assert "skew=true" in plan(newest)
    assert sum(r.ship_voyage_number == "V0" for r in rows) == 10000
    assert len(rows) == 30000


def test_one_name_inside_every_other(spark):
    ships = spark.range(3000).select(F.concat(F.lit("明"), F.col("id").cast("string")).alias("ship_name"))
    names = spark.createDataFrame([("明", "x"), ("明1", "y")], "name string, v string")
    got = last_contained(ships, "ship_name", names, "name").groupBy("match.v").count()
    assert as_tuples(got) == [("x", 1889), ("y", 1111)]


def test_a_poll_opens_recent_days_only(spark, tmp_path):
    """The ranking reads what is given as recent; revisions are those of reported voyages."""
    events = spark.range(40).select(
        F.concat(F.lit("V"), (F.col("id") % 10).cast("string")).alias("ship_voyage_number"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 4).cast("int"))).alias("event_time"),
        F.lit("申請進港").alias("event_name"), F.lit("S").alias("event_source"), F.lit("進港").alias("navigation_status"),
        F.lit(None).cast("timestamp_ntz").alias("event_content_time"))
    events.withColumn("day", F.date_format("event_time", "yyyy-MM-dd")).write.partitionBy("day").parquet(f"{tmp_path}/events")
    whole = spark.read.parquet(f"{tmp_path}/events").drop("day")
    recent = spark.read.parquet(f"{tmp_path}/events/day=2024-01-04").withColumn("event_name", F.lit("from the recent days"))
    status = spark.range(10).select(
        F.concat(F.lit("V"), F.col("id").cast("string")).alias("ship_voyage_number"), F.lit("n").alias("ship_name"),
        F.lit("2024-01-04").cast("timestamp_ntz").alias("updated_at"))
    voyage = status.select("ship_voyage_number", "updated_at", *(
        F.lit(None).cast("timestamp_ntz").alias(c) for c in ("pass_10_miles_time", "pass_5_miles_time"))).limit(0)
    cutoff = A.moment("2024-01-04 00:00:00")
    latest = A.latest_status(status, voyage, whole, cutoff, recent)
    found = {r.latest_event_name for r in latest.collect()}
    assert found == {"from the recent days"}
    assert latest.count() == A.latest_status(status, voyage, whole, cutoff).count() > 0
    assert re.search(r"LeftSemi", plan(latest))
