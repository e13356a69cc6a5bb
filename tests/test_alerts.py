from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayside import rules, schemas
from quayside.functions.messages import berth_message, status_message
from quayside.functions.text import full_name, qualified_event
from quayside.operators import routing as R
from quayside.operators.substring import contained_names, last_contained
from quayside.plans import alerts as A
from quayside.plans import berths as B
from quayside.plans import delivery as D
from tests.conftest import as_tuples

NOW = datetime(2024, 5, 1, 12)
CUTOFF = NOW - timedelta(seconds=181)
RECENT, OLD = NOW - timedelta(seconds=60), NOW - timedelta(days=2)


def at(moment):
    return F.lit(moment).cast("timestamp_ntz")


def rows(spark, table, *records):
    schema = schemas.TABLES[table]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in records], schema).coalesce(1)


def status(key, name="永明SHIP", updated=RECENT):
    return {"ship_voyage_number": key, "ship_name": name, "updated_at": updated}


def event(key, name, time=RECENT, **more):
    return {"ship_voyage_number": key, "event_name": name, "event_time": time, "event_source": "S", **more}


@pytest.fixture(scope="module")
def tables(spark):
    key = [f"V0000{i}0001" for i in range(8)]
    return D.PortTables(
        rows(spark, "ship_status", status(key[0]), status(key[1], "海皇", OLD), status(key[2], "東方"),
             status(key[3], "好明"), status(key[4], "吉春"), status(key[5], None), status(key[6], "無名")),
        rows(spark, "ship_voyage",
             {"ship_voyage_number": key[0], "updated_at": OLD, "pass_5_miles_time": OLD},
             {"ship_voyage_number": key[1], "updated_at": RECENT, "pass_5_miles_time": OLD, "pass_10_miles_time": OLD},
             {"ship_voyage_number": key[3], "updated_at": NOW, "pass_10_miles_time": OLD},
             {"ship_voyage_number": key[4], "updated_at": NOW}),
        rows(spark, "ship_events",
             event(key[0], "更新引水時間", navigation_status="進港"), event(key[0], "實際靠妥時間"),
             event(key[0], rules.ETA_REVISION, OLD, event_content_time=OLD),
             event(key[0], rules.ETA_REVISION, OLD - timedelta(days=1), event_content_time=RECENT),
             event(key[1], "引水人出發"), event(key[2], "船席異動", OLD),
             event(key[3], "申請進港"), event(key[4], "出航"), event(key[5], "申請進港"), event(key[6], "申請進港")),
        rows(spark, "ship_berth_order",
             {"berth_number": "1042", "ship_status": "P", "ship_name_chinese": "永明", "port_agent": "陽明海運公司", "updated_at": OLD},
             {"berth_number": "1043", "ship_status": "O", "ship_name_chinese": "永明", "port_agent": "其他", "updated_at": OLD - timedelta(1)},
             {"berth_number": "1120", "ship_status": "P", "ship_name_chinese": "好明", "port_agent": None, "updated_at": OLD},
             {"berth_number": "1121", "ship_status": "P", "ship_name_chinese": "海皇", "port_agent": "萬海航運公司", "updated_at": RECENT,
              "berthing_time": OLD, "pilotage_time": RECENT},
             {"berth_number": "1121", "ship_status": "P", "ship_name_chinese": "吉春", "port_agent": "其他", "updated_at": OLD,
              "pilotage_time": OLD}),
    )


def latest(tables):
    return A.latest_status(tables.status, tables.voyage, tables.events, at(CUTOFF))


def test_latest_status(tables):
    got = as_tuples(latest(tables), "ship_voyage_number", "latest_event_name", "eta", "etd")
    assert got == [
        ("V000000001", "實際靠妥時間", OLD, None), ("V000000001", "更新引水時間", OLD, None),
        ("V000010001", "引水人出發", None, None), ("V000030001", "申請進港", None, None),
        ("V000040001", "出航", None, None), ("V000050001", "申請進港", None, None),
        ("V000060001", "申請進港", None, None)]


def test_look_back(spark, tables):
    seen = A.changed_since(tables.status, A.cutoff_of(at(NOW), 181))
    assert seen.count() == 6
    assert A.changed_since(tables.status, A.cutoff_of(at(RECENT), 0)).count() == 6
    assert A.changed_since(tables.status, A.cutoff_of(at(RECENT + timedelta(seconds=1)), 0)).count() == 0


def test_mile_passages(tables):
    got = {r.ship_voyage_number + r.event_name: (r.event_source, r.event_time, r.update_time)
           for r in A.status_alerts(latest(tables)).collect()}
    assert got["V000010001通過5浬時間"] == ("VTS轉檔", OLD, RECENT)
    assert got["V000030001通過10浬時間"] == ("VTS轉檔", OLD, RECENT)
    # Older voyage row, voyage row without passages, no voyage row: the event stays.
    assert {"V000000001更新引水時間 (進港)", "V000040001出航", "V000060001申請進港"} <= set(got)


def test_enrichment(tables):
    got = as_tuples(D.enriched_alerts(tables, at(CUTOFF)), "ship_voyage_number", "event_name", "berth_number", "port_agent")
    assert got == [
        ("V000000001", "實際靠妥時間", "1042", "陽明海運公司"),
        ("V000000001", "更新引水時間 (進港)", "1042", "陽明海運公司"),
        ("V000010001", "通過5浬時間", "0000", "萬海航運公司"),
        ("V000030001", "通過10浬時間", "0000", None),
        ("V000040001", "出航", "0000", "其他"),
        ("V000050001", "申請進港", "0000", "NO PORT AGENT"),
        ("V000060001", "申請進港", "0000", "NO PORT AGENT")]


def test_routing(spark, tables):
    table = rules.rule_table(spark)
    alerts = D.enriched_alerts(tables, at(CUTOFF)).cache()
    routed = A.routed(alerts, table)
    assert as_tuples(routed, "ship_voyage_number", "event_name", "stakeholders") == [
        ("V000000001", "實際靠妥時間", ["Pilot", "CIQS"]),
        ("V000000001", "更新引水時間 (進港)", ["Pilot", "CIQS", "Unmooring", "Tugboat"]),
        ("V000010001", "通過5浬時間", ["Pilot", "Tugboat", "ShippingAgentWanHai"]),
        ("V000060001", "申請進港", [])]
    assert as_tuples(A.alert_rejects(alerts, table), "ship_voyage_number", "reject_reason") == [
        ("V000030001", "null_agent"), ("V000050001", "null_ship_name")]
    channels = rules.channel_table(spark, ("Pilot", "CIQS"))
    sent = A.stakeholder_outbox(routed, channels).groupBy("status").count()
    assert as_tuples(sent) == [("no_token", 4), ("queued", 5)]
    # A digest lists everyone concerned, reachable or not.
    digests = A.master_digests(routed).filter(F.col("event_name") == "通過5浬時間").first()["message"]
    assert digests.startswith("\n通知對象: \nPilot\nTugboat\nShippingAgentWanHai\n\n船名: 海皇\n")
    everything = D.outbox(tables, table, channels, at(CUTOFF))
    assert everything.count() == 9 + 3 + 1
    assert D.outbox(tables, table, channels, at(CUTOFF), master_configured=False).count() == 9


def test_berth_alert(tables):
    alerts = B.berth_alerts(tables.berths, tables.status, tables.events, at(CUTOFF))
    assert as_tuples(alerts, "ship_voyage_number", "berth_number", "event_name", "event_time", "update_time") == [
        ("V000040001", "1121", "靠泊", OLD, RECENT)]
    (text,) = (r[0] for r in alerts.select(berth_message()).collect())
    assert text == (
        "\n\n船名: 吉春\n船編: V00004\n航次: 0001\nETA: None\nETD: None\n\n碼頭代號: 1121\n"
        "前一艘船舶靠泊時間: 2024/04/29 20:00:00\n\n更新時間: \n2024/05/01 19:59:00")


def test_status_text(tables):
    alerts = A.status_alerts(latest(tables)).filter(F.col("event_name") == "實際靠妥時間")
    (text,) = (r[0] for r in alerts.select(status_message()).collect())
    assert text == (
        "\n\n船名: 永明SHIP\n船編: V00000\n航次: 0001\nETA: 2024/04/29 20:00:00\nETD: None\n\n"
        "最新事件: 實際靠妥時間\n事件時間: None\n事件來源: S\n\n更新時間: \n2024/05/01 19:59:00")
    (text,) = (r[0] for r in alerts.withColumn("update_time", F.lit(None).cast("timestamp_ntz")).select(
        status_message()).collect())
    assert text.endswith("\n更新時間: \nN/A")


def test_names(spark):
    df = spark.createDataFrame([("更新引水時間", None), ("更新引水時間", "出港"), ("申請進港", "進港")], "e string, s string")
    assert [r[0] for r in df.select(qualified_event(F.col("e"), F.col("s"))).collect()] == [
        "更新引水時間 (None)", "更新引水時間 (出港)", "申請進港"]
    names = spark.createDataFrame([("明", None), (None, "A"), ("明", "A")], "zh string, en string")
    assert [r[0] for r in names.select(full_name(F.col("zh"), F.col("en"))).collect()] == ["明", "A", "明A"]


@pytest.mark.parametrize("with_empty", [False, True])
def test_contained_names_against_every_pair(spark, with_empty):
    pick = random.Random(11)
    texts = sorted({"".join(pick.choice("ab明") for _ in range(pick.randint(0, 9))) for _ in range(120)})
    names = {"".join(pick.choice("ab明") for _ in range(pick.randint(1, 4))) for _ in range(25)}
    if with_empty:
        names.add("")
    text_df = spark.createDataFrame([(t, i) for i, t in enumerate([*texts, *texts, None])], "text string, i int")
    name_df = spark.createDataFrame([(n, f"v{n}") for n in names], "name string, v string")
    pairs = contained_names(text_df.select("text").filter("text is not null").distinct(), "text", name_df, "name")
    assert as_tuples(pairs, "text", "name") == sorted(
        ((t, n) for t in texts for n in names if n and n in t), key=repr)
    best = last_contained(text_df, "text", name_df, "name").select("i", F.col("match.v").alias("v"))
    want = []
    for i, text in enumerate([*texts, *texts, None]):
        inside = [n for n in names if text is not None and n in text]
        want.append((i, f"v{max(inside)}" if inside else None))
    assert as_tuples(best) == sorted(want, key=repr)


def test_rules_are_whole(spark):
    assert len(rules.RECIPIENTS) == 27
    known = set(rules.KNOWN_STAKEHOLDERS)
    unknown = {s for names in rules.RECIPIENTS.values() for s in names} - known
    assert unknown == {"UNMOORING", "ShippingAgent", "ShippingCompany"}
    assert rules.rule_table(spark).count() == 27


def test_rules_by_version(spark, tables, tmp_path):
    """A poll of then that is done again with today's versions gives what it gave then; alerts take the rule of their time."""
    first, second = "2024-04-01 00:00:00", "2024-05-01 11:59:30"
    versions = rules.rule_versions(spark, [
        (first, rules.RECIPIENTS), (second, {"更新引水時間 (進港)": None, "出航": ("Pilot",), "實際靠妥時間": ("Tugboat",)})])
    channels = rules.channel_table(spark, ("Pilot",))

    def outbox(table, name):
        return as_tuples(D.run_poll(tables, table, channels, at(CUTOFF), str(tmp_path / name)).outbox)

    then = outbox(rules.rule_table(spark), "then")
    assert outbox(R.rules_at(versions, at(CUTOFF)), "again") == then
    assert outbox(R.rules_at(versions, at(NOW)), "now") != then
    names = ["更新引水時間 (進港)", "出航", "實際靠妥時間"]
    times = [None, datetime(2024, 3, 1), datetime(2024, 5, 1, 11, 59), datetime(2024, 5, 1, 11, 59, 30), NOW]
    alerts = spark.createDataFrame([(n, t) for n in names for t in times], "event_name string, t timestamp_ntz")

    def rule(name, t):
        if t is not None and t < datetime(2024, 4, 1):
            return None
        if t is not None and t < datetime(2024, 5, 1, 11, 59, 30):
            return rules.RECIPIENTS.get(name)
        return {"出航": ("Pilot",), "實際靠妥時間": ("Tugboat",)}.get(name)

    got = {(r.event_name, r.t): tuple(r.stakeholders) for r in R.with_rule_as_of(alerts, versions, F.col("t")).collect()}
    assert got == {(n, t): rule(n, t) for n in names for t in times if rule(n, t) is not None}
    none = {(r.event_name, r.t) for r in R.without_rule_as_of(alerts, versions, F.col("t")).collect()}
    assert none == {(n, t) for n in names for t in times if rule(n, t) is None}
