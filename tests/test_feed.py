"""Tables kept from changes, and polls that open only what changed."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayside import rules
from quayside.operators.substring import GRAM, _pieces, contained_names, rarest_grams
from quayside.operators.upsert import spec_for, upsert
from quayside.plans import alerts as A
from quayside.plans import berths as B
from quayside.plans.feed import Feed, follow, follow_all
from quayside.session import scratch_folder
from quayside.sources.state import state_table
from tests.conftest import as_tuples

DAY = datetime(2024, 1, 1)
EVENT = (
    "ship_voyage_number string, event_time timestamp_ntz, event_name string, event_source string, navigation_status string,"
    " pilot_order_number string, berth_number string, event_content_time timestamp_ntz, seq bigint")


def at(day):
    return F.lit(DAY + timedelta(days=day)).cast("timestamp_ntz")


def events(spark, rng, n, days):
    return spark.createDataFrame([(
        f"v{rng.randrange(6)}", DAY + timedelta(days=rng.choice(days)), rng.choice((rules.ETA_REVISION, rules.ETD_REVISION, "other")),
        "s", None, None, None, rng.choice((None, DAY, DAY + timedelta(hours=rng.randrange(5)))), i) for i in range(n)], EVENT)


def test_announced_times_follow_the_events(spark):
    """Later days, the same days with other times, earlier days; versions one by one, together and again."""
    root, rng = scratch_folder(spark, "follow"), random.Random(2)
    table = state_table(spark, root, "ship_events")
    for version, (days, taken) in enumerate((((2, 3), 1), ((3, 4), 1), ((0, 1), 0), ((1, 3, 4), 2))):
        table.apply(events(spark, rng, 30, days), version, at(0))
        for _ in range(taken):
            follow(spark, root, "announced_times", parts=2)
        if taken:
            got = state_table(spark, root, "announced_times", parts=2)
            assert got.newest() == version
            want = A.revised_times(table.read()).select("ship_voyage_number", "eta", "etd")
            assert as_tuples(got.read(), "ship_voyage_number", "eta", "etd") == as_tuples(want)


def test_newest_reports_come_in_any_order(spark):
    """The state after all batches is the same whichever of them come first."""
    spec, rng = spec_for("name_agents"), random.Random(5)
    rows = [(f"n{rng.randrange(4)}", DAY + timedelta(hours=i), f"b{rng.randrange(3)}", "s", f"a{i}", 0) for i in range(12)]
    schema = "ship_name_chinese string, changed_at timestamp_ntz, berth_number string, ship_status string, port_agent string, seq bigint"
    states = []
    for _ in range(3):
        rng.shuffle(rows)
        state = spark.createDataFrame([], schema).drop("seq")
        for part in (rows[:4], rows[4:], rows[:2]):
            state = upsert(state, spark.createDataFrame(part, schema), spec, F.lit(None)).drop("change_type")
        states.append(as_tuples(state))
    assert states[0] == states[1] == states[2] and len(states[0]) == len({r[0] for r in rows})


@pytest.fixture(scope="module")
def feed(spark):
    """Stored tables of 400 voyages; in the second version a few of them, and one of the berths, change."""
    root = scratch_folder(spark, "feed")
    ids = spark.range(400).withColumn("seq", F.lit(0).cast("bigint"))
    voyage = F.concat(F.lit("V"), F.col("id").cast("string")).alias("ship_voyage_number")
    status = ids.select(voyage, F.concat(F.lit("name"), F.col("id").cast("string")).alias("ship_name"), F.lit("e").alias("latest_event"), "seq", "id")
    miles = ids.select(voyage, F.lit(DAY).cast("timestamp_ntz").alias("pass_10_miles_time"), F.lit(None).cast("timestamp_ntz").alias("pass_5_miles_time"), "seq", "id")
    berths = ids.select(
        (F.col("id") % 40).cast("string").alias("berth_number"), F.lit("P").alias("ship_status"), at(1).alias("pilotage_time"),
        (at(2) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("berthing_time"), F.concat(F.lit("name"), F.col("id").cast("string")).alias("ship_name_chinese"),
        F.lit("").alias("ship_name_english"), F.concat(F.lit("agent"), F.col("id").cast("string")).alias("port_agent"), "seq", "id")
    made = ids.select(
        voyage, (at(0) + F.make_dt_interval(days=(F.col("id") % 9).cast("int"))).alias("event_time"), F.lit(rules.ETA_REVISION).alias("event_name"),
        F.lit("s").alias("event_source"), F.lit("in").alias("navigation_status"), F.lit("p").alias("pilot_order_number"),
        F.lit("1").alias("berth_number"), at(5).alias("event_content_time"), "seq")
    state_table(spark, root, "ship_events", 16).apply(made, 0, at(0))
    changed = {"ship_status": "id IN (8, 17)", "ship_voyage": "id = 26", "ship_berth_order": "id = 7"}
    for version, day in ((0, 0), (1, 8)):
        for name, rows in (("ship_status", status), ("ship_voyage", miles), ("ship_berth_order", berths)):
            if version:
                rows = rows.filter(changed[name]).withColumns({
                    c: F.lit(v).cast(rows.schema[c].dataType) for c, v in (
                        ("latest_event", "new"), ("pass_10_miles_time", DAY + timedelta(1)), ("port_agent", "changed")) if c in rows.columns})
            state_table(spark, root, name, 16).apply(rows.drop("id"), version, at(day))
        follow_all(spark, root, 16)
    return Feed(spark, root, dict.fromkeys(changed, 0), 16)


def parts(df):
    """Parts of stored tables that are opened; written keys lie in none."""
    return {found[1] for name in df.inputFiles() if (found := re.search(r"part=([^/]+)", name))}


def test_a_poll_opens_the_parts_of_changed_keys(feed):
    cutoff = at(8)
    tables = feed.tables(cutoff, "2024-01-09")
    keys = feed.spark.createDataFrame([("V8",), ("V17",), ("V26",)], "ship_voyage_number string")
    places = feed.table("ship_status").places_of(keys)
    assert parts(tables.status) == places == parts(tables.voyage)
    assert len(places) <= 3 and len(feed.table("ship_status").held()) == 16
    assert len(parts(tables.berths)) == 1
    assert parts(tables.recent_events) == {"2024-01-09"}
    assert {r.ship_voyage_number for r in tables.status.collect()} == {"V8", "V17", "V26"}
    # The queue of berth 7: the entry behind the one that changed, and its voyage.
    assert {r.berth_number for r in tables.berths.collect()} == {"7"}
    assert [r.ship_voyage_number for r in tables.named.collect()] == ["V47"]


def test_a_poll_from_changes_equals_one_of_whole_tables(feed):
    cutoff, tables = at(8), feed.tables(at(8), "2024-01-09")
    whole = {name: feed.table(name).read() for name in ("ship_status", "ship_voyage", "ship_events", "ship_berth_order")}
    assert as_tuples(A.latest_status(tables.status, tables.voyage, None, cutoff, tables.recent_events, tables.announced)) == as_tuples(
        A.latest_status(whole["ship_status"], whole["ship_voyage"], whole["ship_events"], cutoff))
    got = B.berth_alerts(tables.berths, tables.named, None, cutoff, tables.announced)
    assert as_tuples(got) == as_tuples(B.berth_alerts(whole["ship_berth_order"], whole["ship_status"], whole["ship_events"], cutoff))
    assert got.count() == 1
    columns = ["ship_name_chinese", "berth_number", "port_agent"]
    assert as_tuples(tables.agents, *columns) == as_tuples(A.latest_agents(whole["ship_berth_order"]), *columns)


def test_names_are_keyed_by_their_rarest_gram(spark):
    """Thousands of names with one stem: keys spread, and a text is cut into no more grams than characters."""
    names = spark.range(3000).select(F.concat(F.lit("stem"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("name"))
    held = rarest_grams(names, "name").groupBy("_gram").count()
    assert held.agg(F.max("count")).first()[0] < 60
    texts = names.limit(500).select(F.concat("name", F.lit(" and "), "name").alias("text"))
    cut = texts.select(F.size(F.array_distinct(_pieces(F.col("text"), F.lit(GRAM)))).alias("n"), F.char_length("text").alias("chars"))
    assert cut.filter("n > chars").count() == 0
    assert contained_names(texts, "text", names, "name").count() == 500


@pytest.mark.parametrize("gram", [1, 2, 3, 5])
def test_grams_of_any_length_find_the_same(spark, gram):
    rng = random.Random(gram)
    names = sorted({"".join(rng.choices("ab船c", k=rng.randint(0, 6))) for _ in range(60)})
    texts = sorted({"".join(rng.choices("ab船c", k=rng.randint(0, 12))) for _ in range(80)})
    got = contained_names(
        spark.createDataFrame([(t,) for t in texts], "text string"), "text",
        spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, v int"), "name", gram)
    assert as_tuples(got.select("text", "name", "v")) == sorted(
        ((t, n, i) for t in texts for i, n in enumerate(names) if n and n in t), key=repr)


def test_names_are_not_sent_to_the_driver(spark):
    """Exploded texts and stored names look small, so that Spark would broadcast them; both are merged instead."""
    names = spark.range(3000).select(F.concat(F.lit("stem"), F.col("id").cast("string")).alias("name"))
    texts = names.select(F.concat("name", F.lit(" aboard")).alias("text"))
    found = contained_names(texts, "text", names, "name")
    assert found.count() == sum(len({str(i)[:n] for n in range(1, len(str(i)) + 1)}) for i in range(3000))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[name#", plan) and re.search(r"SortMergeJoin \[_gram#", plan)
    assert "BroadcastHashJoin" not in plan
