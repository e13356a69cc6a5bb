"""Ordered groups cut into segments, and newest rows, against plain windows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators.latest import keep_last, newest_row, newest_with_ties
from quayside.operators.ordering import with_next, with_position, with_ranges
from quayside.plans.berths import QUEUE_ORDER, with_queue_segment
from tests.conftest import as_tuples


@pytest.fixture(scope="module")
def queue(spark):
    """A third of all entries wait at one berth, and many there have no times yet."""
    pick = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        berth = "1042" if pick.random() < 0.34 else str(1000 + pick.randint(0, 20))
        minutes = pick.choice([None, *range(0, 4000, 7)])
        pilot = pick.choice([None, *range(0, 400, 7)])
        rows.append((
            berth, None if minutes is None else start + timedelta(minutes=minutes), pick.choice("PO"),
            None if pilot is None else start + timedelta(minutes=pilot),
            pick.choice("明春海東") + str(i), start + timedelta(hours=pick.randint(0, 200))))
    return spark.createDataFrame(rows, (
        "berth_number string, berthing_time timestamp_ntz, ship_status string, pilotage_time timestamp_ntz,"
        " ship_name_chinese string, updated_at timestamp_ntz")).cache()


def test_missing_keys_and_segments_are_kept(spark):
    rows = [(None, None, 1), (None, None, 2), ("b", None, 3), ("b", 1, 4), ("b", 2, 5)]
    df = spark.createDataFrame(rows, "k string, s int, v int")
    got = with_position(df, ["k"], "s", ["s", "v"])
    assert as_tuples(got, "k", "v", "position") == sorted(
        [(None, 1, 1), (None, 2, 2), ("b", 4, 1), ("b", 5, 2), ("b", 3, 3)], key=repr)
    got = with_next(df, ["k"], "s", ["s", "v"], ["v"]).withColumn("after", F.col("next.v"))
    assert as_tuples(got, "v", "after") == sorted([(1, 2), (2, None), (4, 5), (5, 3), (3, None)], key=repr)


def plain_window():
    return Window.partitionBy("berth_number").orderBy(*(F.asc_nulls_last(c) for c in QUEUE_ORDER))


def test_segments_follow_the_order(queue):
    cut = with_queue_segment(queue).withColumn("before", F.lag("_queue_segment").over(plain_window()))
    assert cut.filter("before > _queue_segment or _queue_segment is null").count() == 0


def test_positions(queue):
    got = with_position(with_queue_segment(queue), ["berth_number"], "_queue_segment", QUEUE_ORDER)
    want = queue.withColumn("position", F.row_number().over(plain_window()))
    names = ("ship_name_chinese", "position")
    assert as_tuples(got, *names) == as_tuples(want, *names)


def test_next_rows(queue):
    got = with_next(with_queue_segment(queue), ["berth_number"], "_queue_segment", QUEUE_ORDER, ["ship_name_chinese"])
    want = queue.withColumn("next", F.lead("ship_name_chinese").over(plain_window()))
    assert as_tuples(got.select("ship_name_chinese", F.col("next.ship_name_chinese").alias("n"))) == as_tuples(
        want.select("ship_name_chinese", F.col("next").alias("n")))


def test_next_rows_of_some(queue):
    """The test on the row itself takes away results, not followers."""
    only = F.col("updated_at") >= F.lit(datetime(2024, 1, 9)).cast("timestamp_ntz")
    got = with_next(
        with_queue_segment(queue), ["berth_number"], "_queue_segment", QUEUE_ORDER, ["ship_name_chinese"], only=only)
    want = queue.withColumn("next", F.lead("ship_name_chinese").over(plain_window())).filter(only)
    assert as_tuples(got.select("ship_name_chinese", F.col("next.ship_name_chinese").alias("n"))) == as_tuples(
        want.select("ship_name_chinese", F.col("next").alias("n")))


def test_next_row_equals_the_self_join(queue):
    """The pairing by row number i and i + 1 over all berths, kept inside a berth."""
    everywhere = Window.orderBy("berth_number", *(F.asc_nulls_last(c) for c in QUEUE_ORDER))
    numbered = queue.withColumn("i", F.row_number().over(everywhere))
    behind = numbered.select((F.col("i") - 1).alias("i"), "berth_number", F.col("ship_name_chinese").alias("n"))
    want = numbered.join(behind, ["i", "berth_number"])
    got = with_next(with_queue_segment(queue), ["berth_number"], "_queue_segment", QUEUE_ORDER, ["ship_name_chinese"])
    assert as_tuples(got.filter("next is not null").select(
        "ship_name_chinese", F.col("next.ship_name_chinese").alias("n"))) == as_tuples(
        want.select("ship_name_chinese", "n"))


def test_newest_rows(spark, queue):
    numbered = queue.withColumn("seq", F.monotonically_increasing_id())
    window = Window.partitionBy("berth_number", "ship_status").orderBy(F.desc("seq"))
    want = numbered.withColumn("rn", F.row_number().over(window)).filter("rn = 1").drop("rn")
    assert as_tuples(keep_last(numbered, ["berth_number", "ship_status"], "seq")) == as_tuples(want)

    ranked = Window.partitionBy("berth_number").orderBy(F.desc("updated_at"))
    want = queue.withColumn("rk", F.rank().over(ranked)).filter("rk = 1").drop("rk")
    assert want.count() > want.select("berth_number").distinct().count()
    assert as_tuples(newest_with_ties(queue, "berth_number", "updated_at"), *queue.columns) == as_tuples(want)


def test_missing_keys_count_as_equal(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("k", 3, None)], "k string, seq int, v string")
    assert as_tuples(keep_last(df, ["k"], "seq"), "k", "v") == [("k", None), (None, "b")]


def test_choice_does_not_depend_on_row_order(spark):
    rows = [("k", 1, v) for v in "dacb"]
    picked = {
        newest_row(spark.createDataFrame(order, "k string, t int, v string").repartition(n), ["k"], ["t"], ["v"])
        .first()["v"] for order, n in ((rows, 1), (rows[::-1], 3))}
    assert picked == {"d"}


def test_ranges_of_a_hot_queue_are_even(queue):
    """A third of all entries at one berth and in one hour: same results, and no segment far above the others."""
    hour = F.lit("2024-01-02 08:00:00").cast("timestamp_ntz")
    hot = F.col("berth_number") == "1042"
    skewed = queue.withColumns({
        "berthing_time": F.when(~hot, F.col("berthing_time")).when(F.col("ship_status") == "P", hour),
        "pilotage_time": F.when(~hot, F.col("pilotage_time"))})
    cut = with_ranges(skewed, ["berth_number"], QUEUE_ORDER, ranges=60, sampled=1500)
    before = cut.withColumn("before", F.lag("segment").over(plain_window()))
    assert before.filter("before > segment or segment is null").count() == 0
    sizes = sorted(r["count"] for r in cut.filter(hot).groupBy("segment").count().collect())
    assert len(sizes) > 15 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    names = ("ship_name_chinese", "position")
    got = with_position(cut, ["berth_number"], "segment", QUEUE_ORDER)
    assert as_tuples(got, *names) == as_tuples(skewed.withColumn("position", F.row_number().over(plain_window())), *names)
    got = with_next(cut, ["berth_number"], "segment", QUEUE_ORDER, ["ship_name_chinese"]).withColumn("after", F.col("next.ship_name_chinese"))
    want = skewed.withColumn("after", F.lead("ship_name_chinese").over(plain_window()))
    assert as_tuples(got, "ship_name_chinese", "after") == as_tuples(want, "ship_name_chinese", "after")


def test_ranges_of_missing_keys_and_empty_tables(spark):
    rows = [(None, i % 7) for i in range(50)] + [("b", None)] * 3
    df = spark.createDataFrame(rows, "k string, v int")
    cut = with_ranges(df, ["k"], ["v"], ranges=10)
    assert cut.count() == 53 and cut.filter("k is null").select("segment").distinct().count() > 3
    got = with_position(cut, ["k"], "segment", ["v"])
    assert sorted(r.position for r in got.filter("k is null").collect()) == list(range(1, 51))
    assert with_ranges(df.limit(0), ["k"], ["v"]).count() == 0
