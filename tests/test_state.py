"""Stored tables, streams, files, rejects, whole crawls."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quayside import schemas
from quayside.operators import quality
from quayside.operators.upsert import SPECS
from quayside.plans import ingest
from quayside.plans.ingest import crawl_rejects, crawl_tables, store_crawl
from quayside.session import scratch_folder
from quayside.sources import files
from quayside.sources import pages as P
from quayside.sources.state import state_table
from quayside.streaming.crawls import EVENT, STATUS, crawl_stream, late_folder
from quayside.streaming.ingest import upsert_stream
from quayside.streaming.polls import first_reports, reporting_polls, split_late
from tests.conftest import as_tuples
from tests.test_pages import cell

DAY = datetime(2024, 1, 1)
EVENT_BATCH = (
    "ship_voyage_number string, event_time timestamp_ntz, event_name string, event_source string,"
    " navigation_status string, pilot_order_number string, berth_number string, event_content_time timestamp_ntz,"
    " seq bigint")


def moment(day):
    return F.lit(DAY + timedelta(days=day)).cast("timestamp_ntz")


def status_batch(spark, *rows):
    return spark.createDataFrame(
        [(k, f"{k} name", e, i) for i, (k, e) in enumerate(rows)],
        "ship_voyage_number string, ship_name string, latest_event string, seq bigint")


@pytest.fixture
def root(spark):
    return scratch_folder(spark, "test")


def test_versions(spark, root):
    table = state_table(spark, root, "ship_status", parts=4)
    assert table.read().count() == 0
    table.apply(status_batch(spark, ("a", "0"), ("b", "1")), 0, moment(0))
    table.apply(status_batch(spark, ("a", "1"), ("b", "1")), 0, moment(0))
    table.apply(status_batch(spark, ("b", "2"), ("c", "1")), 1, moment(1))
    want = [("a", "1", DAY), ("b", "2", DAY + timedelta(1)), ("c", "1", DAY + timedelta(1))]
    columns = ("ship_voyage_number", "latest_event", "updated_at")
    assert as_tuples(table.read(), *columns) == want
    assert as_tuples(table.changes(1), "ship_voyage_number", "change_type") == [("b", "update"), ("c", "insert")]
    # The same batch again, as after a failure: it starts from the version before it.
    table.apply(status_batch(spark, ("b", "2"), ("c", "1")), 1, moment(1))
    assert as_tuples(table.read(), *columns) == want
    assert as_tuples(table.changes(1), "ship_voyage_number", "change_type") == [("b", "update"), ("c", "insert")]
    # An empty batch is a version too; one that others were built on stays as it is.
    table.apply(status_batch(spark), 2, moment(2))
    assert as_tuples(table.read(), *columns) == want
    assert table.changes(2).count() == 0
    with pytest.raises(ValueError, match="too old"):
        table.apply(status_batch(spark), 0, moment(0))
    with pytest.raises(ValueError, match="not published"):
        table.changes(3)


def test_only_touched_days_are_rewritten(spark, root):
    table = state_table(spark, root, "ship_events")

    def batch(*rows):
        return spark.createDataFrame(
            [("v", DAY + timedelta(days=d), "e", "s", None, None, None, c, i) for i, (d, c) in enumerate(rows)],
            EVENT_BATCH)

    table.apply(batch((0, None), (1, None), (2, None)), 0, moment(0))
    table.apply(batch((2, DAY), (2, None)), 1, moment(0))
    assert table.held() == {"2024-01-01": 0, "2024-01-02": 0, "2024-01-03": 1}
    assert table.read().count() == 3
    assert as_tuples(table.read("2024-01-02"), "event_time") == [(DAY + timedelta(1),), (DAY + timedelta(2),)]
    assert table.read().dtypes == spark.createDataFrame([], schemas.SHIP_EVENTS).dtypes
    assert as_tuples(table.changes(1), "event_time", "change_type") == [(DAY + timedelta(2), "update")]


def test_stream_equals_one_batch(spark, root):
    crawls = [
        [("a", "1"), ("b", "1"), ("a", "2")], [("b", "1"), ("c", None), ("a", "1")], [("c", "9"), ("b", "3"), ("a", "1")]]
    table = state_table(spark, root, "ship_status", parts=4)
    for crawl in crawls:
        status_batch(spark, *crawl).write.mode("append").parquet(f"{root}/landing")
        arriving = spark.readStream.schema(status_batch(spark).schema).parquet(f"{root}/landing")
        upsert_stream(arriving, table, f"{root}/checkpoint", moment).awaitTermination()
    once = state_table(spark, f"{root}/once", "ship_status")
    once.apply(status_batch(spark, *(row for crawl in crawls for row in crawl)), 0, moment(0))
    columns = ("ship_voyage_number", "latest_event")
    assert as_tuples(table.read(), *columns) == as_tuples(once.read(), *columns) == [
        ("a", "1"), ("b", "3"), ("c", None)]
    assert as_tuples(table.read(), "ship_voyage_number", "updated_at") == [
        ("a", DAY + timedelta(1)), ("b", DAY + timedelta(2)), ("c", DAY + timedelta(1))]


def test_polls_repeat_and_reports_do_not(spark, root):
    changes = spark.createDataFrame([("v", DAY), ("w", DAY + timedelta(seconds=30))], "k string, t timestamp_ntz")
    polls = reporting_polls(changes, "t")
    assert as_tuples(polls.groupBy("k").count()) == [("v", 4), ("w", 3)]
    polls.select("k", "t").write.parquet(f"{root}/polls")
    arriving = spark.readStream.schema(changes.schema).parquet(f"{root}/polls")
    query = (
        first_reports(arriving, ["k", "t"], "t", "1 hour").writeStream.format("memory").queryName("reports")
        .trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("reports").count() == 2


def test_sliding_polls_on_a_stream(spark, root):
    spark.createDataFrame([("v", DAY)], "k string, t timestamp_ntz").write.parquet(f"{root}/changes")
    arriving = spark.readStream.schema("k string, t timestamp_ntz").parquet(f"{root}/changes")
    query = (
        reporting_polls(arriving, "t").writeStream.format("memory").queryName("polls")
        .trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("polls").count() == 4


def test_csv(spark, root):
    df = spark.createDataFrame([('a "b", c\nd', 1), (None, 2), ("", 3)], "t string, n int")
    path = f"{root}/{files.export_folder('output/list.csv', 'ship_voyage')}"
    assert path.endswith("/output/list_ship_pass_time.csv")
    files.export_csv(df, path)
    files.export_csv(df, path)
    assert as_tuples(files.read_csv(spark, path, df.schema), "n", "t") == [(1, 'a "b", c\nd'), (2, None), (3, "")]


def test_landing_replaces_a_date(spark, root):
    pages = spark.createDataFrame([("u", "old", "2024-01-01"), ("u", "x", "2024-01-02")], "url string, html string, crawl_date string")
    files.land_pages(pages, f"{root}/pages")
    files.land_pages(pages.limit(1).withColumn("html", F.lit("new")), f"{root}/pages")
    back = spark.read.schema(pages.schema).parquet(f"{root}/pages")
    assert as_tuples(back, "crawl_date", "html") == [("2024-01-01", "new"), ("2024-01-02", "x")]


def test_rejects(spark):
    df = spark.createDataFrame([("k", "abc"), (None, "a"), ("k", "ab  "), ("k", None)], "k string, v string")
    checked = quality.with_reasons(df, {**quality.required_checks(["k"]), **quality.length_checks({"v": 2})})
    assert as_tuples(quality.rejected(checked), "v", "reject_reason") == [("a", "null_k"), ("abc", "long_v")]
    assert quality.accepted(checked).count() == 2
    with pytest.raises(PySparkException, match="bad row"):
        quality.fail_on_reject(checked).collect()
    assert as_tuples(quality.repeated_keys(df, ["k"])) == [("k", 3)]


def test_unknown_scratch_on_a_cluster_is_refused(spark):
    class Context:
        master = "yarn"

    class Conf:
        @staticmethod
        def get(_, default):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        scratch_folder(Session, "x")


def berth_batch(spark, *rows):
    return spark.createDataFrame(
        [(crawl, seq, "1042", name, "P", agent) for crawl, seq, name, agent in rows],
        "crawl int, seq bigint, berth_number string, ship_name_chinese string, ship_status string, port_agent string",
    ).withColumns({
        "berthing_time": moment(0), "pilotage_time": moment(0), "ship_name_english": F.lit("EN")})


def test_crawls_of_one_batch_apply_in_order(spark, root, monkeypatch):
    """Several crawls that landed before one run, with arrival numbers that start anew in each."""
    monkeypatch.setattr("quayside.sources.state.CRAWLS_PER_PLAN", 2)
    rows = berth_batch(
        spark, (2, 0, "a", "third"), (1, 0, "a", "second"), (0, 0, "a", "x"), (0, 1, "a", "first"), (1, 1, "b", "first"),
        (2, 0, "c", "first"))
    rows.write.parquet(f"{root}/landing")
    table = state_table(spark, root, "ship_berth_order", parts=2)
    for _ in range(2):
        arriving = spark.readStream.schema(rows.schema).parquet(f"{root}/landing")
        upsert_stream(arriving, table, f"{root}/checkpoint", moment, crawl="crawl").awaitTermination()
        assert as_tuples(table.read(), "ship_name_chinese", "port_agent", "created_at", "updated_at") == [
            ("a", "third", DAY, DAY + timedelta(2)), ("b", "first", DAY + timedelta(1), DAY + timedelta(1)),
            ("c", "first", DAY + timedelta(2), DAY + timedelta(2))]
    assert as_tuples(table.changes(0), "ship_name_chinese", "change_type") == [("a", "insert"), ("b", "insert"), ("c", "insert")]
    assert quality.repeated_keys(table.read(), schemas.KEYS["ship_berth_order"]).count() == 0


def test_only_changed_parts_are_written(spark, root):
    table = state_table(spark, root, "ship_status", parts=4)
    keys = [f"k{i}" for i in range(40)]
    table.apply(status_batch(spark, *((k, "0") for k in keys)), 0, moment(0))
    first = table.held()
    table.apply(status_batch(spark, *((k, "0") for k in keys)), 1, moment(1))
    assert table.held() == first and table.changes(1).count() == 0
    table.apply(status_batch(spark, *((k, "1" if k == "k7" else "0") for k in keys)), 2, moment(2))
    assert sorted(table.held().values()) == [0, 0, 0, 2]
    assert as_tuples(table.changes(2), "ship_voyage_number") == [("k7",)]
    assert table.read().count() == 40


def test_days_may_be_split(spark, root):
    table = state_table(spark, root, "ship_events", parts_per_day=3)
    rows = [(f"v{i}", DAY + timedelta(days=i % 2), "e", "s", None, None, None, None, i) for i in range(30)]
    table.apply(spark.createDataFrame(rows, EVENT_BATCH), 0, moment(0))
    assert len(table.held()) == 6 and table.read().count() == 30
    assert table.read(since_day="2024-01-02").count() == 15


def test_exported_blanks_come_back(spark, root):
    rows = list(enumerate([" a ", "b\n", "", None, 'q"r, s', "\t"]))
    df = spark.createDataFrame(rows, "k int, t string")
    files.export_csv(df, f"{root}/x.csv", rows_per_file=2)
    assert as_tuples(files.read_csv(spark, f"{root}/x.csv", df.schema)) == sorted(rows, key=repr)


def test_late_rows_are_told_apart(spark):
    seen = spark.createDataFrame([(1, DAY, DAY), (2, DAY, DAY + timedelta(hours=4)), (3, DAY, None)], "k int, t timestamp_ntz, s timestamp_ntz")
    on_time, late = split_late(seen, "t", "s", "'3' HOUR")
    assert as_tuples(on_time, "k") == [(1,)] and as_tuples(late, "k") == [(2,), (3,)]


def test_a_whole_crawl(spark, root):
    """Pages of all four kinds to stored tables, twice."""
    def pages(*rows):
        return spark.createDataFrame([("c", i, url, html) for i, (url, html) in enumerate(rows)], schemas.PAGES)

    def ship(row, key, name, event):
        values = [key, name, event, *["<img src='ok.png'>"] * 11]
        return "".join(cell(row, i, v, P.STATUS_GRID) for i, v in enumerate(values))

    def own(base, serial):
        return f"http://port.example/{base}?SP_ID=V00001&SP_SERIAL={serial}"

    def event(row, time, content):
        values = ["S", time, "申請進港", "進港", "7", "1042", content]
        return "".join(cell(row, i, v) for i, v in enumerate(values))

    header = "".join(f'<th class="{P.HEADER_CLASS}">{t}</th>' for t in schemas.BERTH_TITLES)

    def berth(*values):
        return f'<tr class="{P.ROW_CLASS}">' + "".join(f'<td class="dxgv">{v}</td>' for v in values) + "</tr>"

    crawled = crawl_tables(
        pages(("list", ship(0, "V000010001", "永明", "申請進港") + ship(1, "V000010002", "好明" * 60, "x"))),
        pages(
            (own("events", "0001"), event(0, "2024/5/1 下午 03:04:05", "113/05/01 10:30") + event(1, "soon", "null")),
            (own("events", "0009"), event(0, "2024/5/1 下午 03:04:05", "null"))),
        pages((own("miles", "0001"), cell(0, 2, "113/05/01 10:30", P.MILE_GRID)), (own("miles", "0002"), "nothing")),
        pages(("berths", f'<div class="{P.CONTROL_CLASS}"><tr>{header}</tr>' + berth("1042", "待接靠", "P", "113/05/01 10:30", "永明", "", "agent")
               + berth("1042", "113/05/01 11:30", "P", "113/05/01 10:30", "永明", "EN", "agent")
               + berth("1043", "tomorrow", "P", "", "好明", "EN", "agent") + "</div>")),
        "http://port.example/events", "http://port.example/miles")
    for version in range(2):
        store_crawl(spark, crawled, root, version, lambda _, v=version: moment(v), parts=2)
    rejects = {name: as_tuples(crawl_rejects(spark, root, name, 0), "reject_reason") for name in SPECS}
    assert rejects == {
        "ship_status": [("long_ship_name",)], "ship_events": [("bad_event_time",)], "ship_voyage": [],
        "ship_berth_order": [("bad_berthing_time",)]}
    tables = {name: state_table(spark, root, name, parts=2) for name in SPECS}
    time = datetime(2024, 5, 1, 2, 30)
    assert as_tuples(tables["ship_status"].read()) == [("V000010001", "永明", "申請進港", DAY, DAY)]
    assert as_tuples(tables["ship_events"].read().drop("id")) == [
        ("V000010001", "S", datetime(2024, 5, 1, 7, 4, 5), "申請進港", "進港", "7", "1042", time)]
    assert as_tuples(tables["ship_voyage"].read()) == [
        ("V000010001", time, None, DAY, DAY), ("V000010002", None, None, DAY, DAY)]
    assert as_tuples(tables["ship_berth_order"].read()) == [
        ("1042", time + timedelta(hours=1), "P", time, "永明", "EN", "agent", DAY, DAY)]
    assert tables["ship_status"].changes(1).count() == 0


def test_crawl_in_several_batches(spark, root):
    """A crawl whose pages land in two batches is stored whole; one that lands late is put out, and undoes nothing."""
    schema = "crawl_id string, page_no int, url string, html string, kind string, crawl int"

    def ships(crawl, page, *rows):
        html = "".join(
            cell(10 * page + i, c, v, P.STATUS_GRID) for i, r in enumerate(rows) for c, v in enumerate([*r, *["NO"] * 11]))
        return ("c", page, "list", html, STATUS, crawl)

    def land(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/arrived")
        crawl_stream(
            spark.readStream.schema(schema).parquet(f"{root}/arrived"), root, f"{root}/checkpoint", "http://port.example/events",
            "http://port.example/miles", lambda crawl, _: moment(crawl), parts=2).awaitTermination()

    def status():
        rows = state_table(spark, root, "ship_status", parts=2).read()
        return as_tuples(rows.select("ship_voyage_number", "latest_event"))

    times = ["S", "2024/5/1 下午 03:04:05", "申請進港", "進港", "7", "1042", "null"]
    own = "http://port.example/events?SP_ID=V00001&SP_SERIAL=0001"
    first = [(f"V00001000{i}", f"n{i}", "a") for i in range(10)]
    land(ships(1, 0, *first))
    # The rows of the list and the events of a ship in its first part come in the second one.
    land(ships(1, 1, ("V000020000", "n", "b")), ("c", 0, own, "".join(cell(0, i, v) for i, v in enumerate(times)), EVENT, 1))
    want = sorted([*((k, e) for k, _, e in first), ("V000020000", "b")], key=repr)
    assert status() == want
    assert state_table(spark, root, "ship_events", parts=2).read().count() == 1
    assert files.landed_pages(spark, f"{root}/landing", "1", spark.createDataFrame([], schema).schema).count() == 3
    land(ships(3, 0, ("V000030000", "n", "c")))
    land(ships(2, 0, ("V000030000", "n", "old"), ("V000040000", "n", "d")))
    assert status() == sorted([*want, ("V000030000", "c")], key=repr)
    late = spark.read.parquet(late_folder(root, "ship_status", 2))
    assert as_tuples(late, "ship_voyage_number", "latest_event") == [("V000030000", "old"), ("V000040000", "d")]


@pytest.mark.parametrize("merge_late", [False, True])
def test_landing_pages_are_not_kept_in_memory(spark, root, monkeypatch, merge_late):
    """All pages of a batch are many times larger than their files: they are read again, and written by tasks of a few MB."""
    schema = "crawl_id string, page_no int, url string, html string, kind string, crawl int"
    kept, persist = [], type(spark.range(0)).persist
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda df, *level: (kept.append(df.columns), persist(df, *level))[1])
    monkeypatch.setattr(P, "TASK_BYTES", 20_000)
    pages = [
        ("c", n, "list", "x" * 1000 + "".join(cell(n, i, v, P.STATUS_GRID) for i, v in enumerate([f"V{crawl}{n:07}", "n", *["NO"] * 12])), STATUS, crawl)
        for crawl in (1, 2) for n in range(40)]
    spark.createDataFrame(pages, schema).coalesce(1).write.parquet(f"{root}/arrived")
    crawl_stream(
        spark.readStream.schema(schema).parquet(f"{root}/arrived"), root, f"{root}/checkpoint", "http://port.example/events",
        "http://port.example/miles", lambda crawl, _: moment(crawl), parts=2, merge_late=merge_late).awaitTermination()
    assert kept and not any("html" in columns for columns in kept)
    landed = [files.landed_pages(spark, f"{root}/landing", str(n), spark.createDataFrame([], schema).schema) for n in (1, 2)]
    assert sorted(map(repr, pages)) == sorted(repr(tuple(r)) for df in landed for r in df.collect())
    assert all(1 < len(df.inputFiles()) <= 5 for df in landed)
    assert state_table(spark, root, "ship_status", parts=2).read().count() == 80


def test_late_events_are_merged(spark, root):
    """Crawls that land in any order, one of them in two parts, leave the events that crawls in order leave."""
    names = [f for f in schemas.SHIP_EVENTS if f.name != "id"]
    random.seed(5)
    crawls = {}
    for number in range(3):
        reported = random.sample(range(12), 8)
        crawls[number] = [
            (f"V{k % 4}", f"S{number}", DAY + timedelta(days=k % 2), f"e{k % 3}", None, str(turn), "1042",
             None if random.random() < 0.4 else DAY + timedelta(hours=random.randrange(2)), turn, "bad" if k == 11 else None)
            for turn, k in enumerate(reported)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names) + ", seq bigint, reject_reason string"
    newest = {}
    for number in range(3):
        for row in crawls[number]:
            if row[-1] is None:
                newest[(row[0], row[2], row[3])] = row[:8]
    want = sorted(newest.values(), key=repr)

    def typed(place, number, rows):
        frame = spark.createDataFrame(rows, fields)
        _, counts = ingest.write_typed(frame, ingest.typed_folder(place, "ship_events", number))
        assert counts == {"rows": len(rows), "rejects": sum(r[-1] is not None for r in rows)}

    for turn, order in enumerate([(0, 1, 2), (2, 0, 1), (2, 1, 0), (1, 2, 0, 1)]):
        place, landed = f"{root}/order={turn}", []
        for version, number in enumerate(order):
            part = crawls[number][:4] if order.count(number) > landed.count(number) + 1 else crawls[number]
            typed(place, number, part)
            ingest.merge_events(spark, place, [number], landed, version)
            landed.append(number)
        got = state_table(spark, place, "ship_events").read().drop("id")
        assert as_tuples(got) == want, order
    place = f"{root}/at-once"
    for number in range(3):
        typed(place, number, crawls[number])
    ingest.merge_events(spark, place, [0, 1, 2], [], 0)
    assert as_tuples(state_table(spark, place, "ship_events").read().drop("id")) == want
