"""Registered queries: latest state, alerts, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import rules
from quayside.functions.messages import berth_message, status_message
from quayside.functions.text import in_fleet, qualified_event
from quayside.operators.latest import newest_with_ties
from quayside.operators.routing import without_rule
from quayside.operators.substring import contained_names
from quayside.plans import alerts as A
from quayside.plans import berths as B
from quayside.plans import delivery as D
from quayside.plans.registry import query
from quayside.session import scratch_folder
from quayside.sources.testdata import AS_OF, CUTOFF, LOOK_BACK_HOURS, oracle_with, project

# Everyone but the tug crews has a channel in these queries.
CHANNELS = tuple(name for name in rules.KNOWN_STAKEHOLDERS if name != "Tugboat")

_CUT = f"cast('{CUTOFF}' as timestamp)"
_REVISED = f"""
    revisions AS (
        SELECT ship_voyage_number, event_name, event_time, event_content_time,
            row_number() OVER (PARTITION BY ship_voyage_number, event_name
                ORDER BY event_time DESC, event_content_time DESC NULLS LAST) AS rn
        FROM fx_events WHERE event_name IN ('{rules.ETA_REVISION}', '{rules.ETD_REVISION}')),
    eta AS (SELECT ship_voyage_number, event_content_time AS eta FROM revisions
        WHERE rn = 1 AND event_name = '{rules.ETA_REVISION}'),
    etd AS (SELECT ship_voyage_number, event_content_time AS etd FROM revisions
        WHERE rn = 1 AND event_name = '{rules.ETD_REVISION}')"""
_LATEST = f"""{_REVISED},
    candidates AS (
        SELECT status.ship_name, ship_voyage_number, status.updated_at, voyage.updated_at AS ship_voyage_updated_at,
            voyage.pass_10_miles_time, voyage.pass_5_miles_time
        FROM fx_status status LEFT JOIN fx_voyage voyage USING (ship_voyage_number)
        WHERE greatest(status.updated_at, coalesce(voyage.updated_at, status.updated_at)) >= {_CUT}),
    newest AS (
        SELECT ship_voyage_number, max(event_time) AS event_time FROM fx_events GROUP BY ship_voyage_number
        HAVING max(event_time) >= {_CUT}),
    latest AS (
        SELECT candidates.*, eta, etd, event_name AS latest_event_name, event_time AS latest_event_time,
            navigation_status, event_content_time AS latest_event_content_time, event_source AS latest_event_source
        FROM candidates JOIN newest USING (ship_voyage_number)
        JOIN fx_events USING (ship_voyage_number, event_time)
        LEFT JOIN eta USING (ship_voyage_number) LEFT JOIN etd USING (ship_voyage_number))"""
_SUFFIXED = ", ".join(map(rules.sql_text, rules.SUFFIXED_EVENTS))
_ALERTS = f"""{_LATEST},
    chosen AS (
        SELECT *, CASE
            WHEN ship_voyage_updated_at > updated_at AND pass_5_miles_time IS NOT NULL THEN 5
            WHEN ship_voyage_updated_at > updated_at AND pass_10_miles_time IS NOT NULL THEN 10
            ELSE 0 END AS mile
        FROM latest),
    named AS (
        SELECT *, CASE mile WHEN 5 THEN '{rules.FIVE_MILE_EVENT}' WHEN 10 THEN '{rules.TEN_MILE_EVENT}'
            ELSE latest_event_name END AS raw_event
        FROM chosen),
    alerts AS (
        SELECT '{rules.STATUS_FORMAT}' AS message_format, ship_name, ship_voyage_number,
            substr(ship_voyage_number, 1, 6) AS ship_id, substr(ship_voyage_number, 7, 4) AS voyage_serial,
            eta, etd,
            CASE WHEN raw_event IN ({_SUFFIXED})
                THEN raw_event || ' (' || coalesce(navigation_status, 'None') || ')' ELSE raw_event END AS event_name,
            CASE mile WHEN 5 THEN pass_5_miles_time WHEN 10 THEN pass_10_miles_time
                ELSE latest_event_content_time END AS event_time,
            CASE WHEN mile > 0 THEN '{rules.MILE_SOURCE}' ELSE latest_event_source END AS event_source,
            CASE WHEN raw_event = '' THEN ship_voyage_updated_at ELSE latest_event_time END AS update_time
        FROM named)"""
_AGENTS = """
    agents AS (
        SELECT ship_name_chinese, berth_number, port_agent FROM (
            SELECT *, row_number() OVER (PARTITION BY ship_name_chinese
                ORDER BY updated_at DESC, berth_number DESC, ship_status DESC) AS rn FROM fx_berth)
        WHERE rn = 1)"""
_BERTH_EVENTS = ", ".join(map(rules.sql_text, rules.BERTH_EVENTS))
_ENRICHED = f"""{_ALERTS},{_AGENTS},
    matched AS (
        SELECT a.*, g.ship_name_chinese, g.berth_number AS match_berth, g.port_agent AS match_agent,
            row_number() OVER (PARTITION BY a.ship_voyage_number, a.event_name, a.event_time, a.event_source,
                    a.update_time, a.eta, a.etd, a.copy
                ORDER BY g.ship_name_chinese DESC NULLS LAST) AS pick
        FROM (SELECT *, row_number() OVER (PARTITION BY ship_voyage_number, event_name, event_time, event_source,
                update_time, eta, etd) AS copy FROM alerts) a
        LEFT JOIN agents g ON contains(a.ship_name, g.ship_name_chinese)),
    enriched AS (
        SELECT message_format, ship_name, ship_voyage_number, ship_id, voyage_serial, eta, etd, event_name,
            event_time, event_source, update_time,
            CASE WHEN ship_name_chinese IS NOT NULL AND event_name IN ({_BERTH_EVENTS})
                THEN match_berth ELSE '{rules.NO_BERTH}' END AS berth_number,
            CASE WHEN ship_name_chinese IS NOT NULL THEN match_agent ELSE '{rules.NO_AGENT}' END AS port_agent
        FROM matched WHERE pick = 1)"""


def _shown(column: str) -> str:
    return f"coalesce(strftime({column} + INTERVAL 8 HOUR, '%Y/%m/%d %H:%M:%S'), 'None')"


_SHIP_TEXT = (
    "chr(10) || chr(10) || '船名: ' || ship_name || chr(10) || '船編: ' || ship_id || chr(10) || '航次: ' || voyage_serial"
    f" || chr(10) || 'ETA: ' || {_shown('eta')} || chr(10) || 'ETD: ' || {_shown('etd')} || chr(10) || chr(10)"
)
_UPDATE_TEXT = (
    "chr(10) || chr(10) || '更新時間: ' || chr(10)"
    f" || CASE WHEN update_time IS NULL THEN 'N/A' ELSE {_shown('update_time')} END"
)
_STATUS_TEXT = (
    f"{_SHIP_TEXT} || '最新事件: ' || event_name || chr(10) || '事件時間: ' || {_shown('event_time')}"
    f" || chr(10) || '事件來源: ' || coalesce(event_source, 'None') || {_UPDATE_TEXT}"
)
_BERTH_TEXT = (
    f"{_SHIP_TEXT} || '碼頭代號: ' || berth_number || chr(10) || '前一艘船舶' || event_name || '時間: '"
    f" || {_shown('event_time')} || {_UPDATE_TEXT}"
)
_FLEET = " OR ".join(f"contains(ship_name, '{name}')" for name in rules.FLEET)
_ROUTED = f"""{_ENRICHED},
    rules AS (SELECT * FROM (VALUES {rules.rule_values()}) AS r(event_name, position, stakeholder)),
    texts AS (SELECT *, {_STATUS_TEXT} AS message, row_number() OVER () AS alert FROM enriched),
    conditions AS (
        SELECT *, contains(port_agent, '{rules.YANG_MING}') AS ym, contains(port_agent, '{rules.WAN_HAI}') AS wh,
            berth_number IN ('1042', '1043') AS lh, berth_number IN ('1120', '1121') AS so, ({_FLEET}) AS fleet
        FROM texts WHERE port_agent IS NOT NULL),
    passed AS (
        SELECT c.*, r.position, r.stakeholder FROM conditions c JOIN rules r ON r.event_name = c.event_name
        WHERE CASE r.stakeholder
            WHEN 'Pilot' THEN ym OR wh OR lh OR so WHEN 'CIQS' THEN ym OR wh OR lh OR so
            WHEN 'PierLienHai' THEN lh WHEN 'PierSelfOperated' THEN so
            WHEN 'ShippingCompanyYangMing' THEN ym WHEN 'ShippingAgentWanHai' THEN wh
            WHEN 'Unmooring' THEN fleet WHEN 'LoadingUnloading' THEN lh OR so
            WHEN 'Tugboat' THEN ym OR wh ELSE false END)"""
_BERTH_ALERTS = f"""{_REVISED},
    queue AS (
        SELECT *, lead(ship_name_chinese) OVER q AS behind_zh, lead(ship_name_english) OVER q AS behind_en
        FROM fx_berth WINDOW q AS (PARTITION BY berth_number ORDER BY berthing_time NULLS LAST,
            pilotage_time NULLS LAST, ship_name_chinese NULLS LAST, ship_status NULLS LAST)),
    moved AS (
        SELECT berth_number, berthing_time, pilotage_time, updated_at, concat(behind_zh, behind_en) AS ship_name
        FROM queue WHERE updated_at >= {_CUT} AND behind_zh IS NOT NULL),
    berth_alerts AS (
        SELECT '{rules.BERTH_FORMAT}' AS message_format, m.ship_name, ss.ship_voyage_number,
            substr(ss.ship_voyage_number, 1, 6) AS ship_id, substr(ss.ship_voyage_number, 7, 4) AS voyage_serial,
            eta.eta, etd.etd, m.berth_number,
            CASE WHEN m.berthing_time IS NOT NULL THEN '{rules.BERTHED}' ELSE '{rules.PILOTED}' END AS event_name,
            coalesce(m.berthing_time, m.pilotage_time) AS event_time, m.updated_at AS update_time
        FROM moved m JOIN fx_status ss ON ss.ship_name = m.ship_name
        LEFT JOIN eta ON eta.ship_voyage_number = ss.ship_voyage_number
        LEFT JOIN etd ON etd.ship_voyage_number = ss.ship_voyage_number)"""

_OUTBOX = f"""
    outbox AS (
        SELECT md5(message) AS alert_id, message_format, ship_voyage_number, event_name, stakeholder, message,
            CASE WHEN stakeholder = 'Tugboat' THEN 'no_token' ELSE 'queued' END AS status FROM passed
        UNION ALL
        SELECT md5(any_value(message)), any_value(message_format), ship_voyage_number, any_value(event_name),
            '{rules.MASTER_GROUP}', chr(10) || '通知對象: ' || chr(10)
                || string_agg(stakeholder, chr(10) ORDER BY position) || any_value(message), 'queued'
        FROM passed GROUP BY alert, ship_voyage_number
        UNION ALL
        SELECT md5(message), message_format, ship_voyage_number, event_name, '{rules.MASTER_GROUP}', message, 'queued'
        FROM (SELECT *, {_BERTH_TEXT} AS message FROM berth_alerts))"""

_STATE = oracle_with("fx_status", "fx_voyage", "fx_events")
_ALL = oracle_with("fx_status", "fx_voyage", "fx_events", "fx_berth")
_BERTHS = oracle_with("fx_status", "fx_events", "fx_berth")


def _tables(spark: SparkSession, sf_dir: str) -> D.PortTables:
    return D.PortTables(*(project(spark, sf_dir, f"fx_{n}") for n in ("status", "voyage", "events", "berth")))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return A.latest_status(t.status, t.voyage, t.events, A.moment(CUTOFF))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.enriched_alerts(_tables(spark, sf_dir), A.moment(CUTOFF))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.routed(_enriched(spark, sf_dir), rules.rule_table(spark))


@query("changed_since", f"""{oracle_with('fx_status')}
    SELECT ship_voyage_number, ship_name, updated_at FROM fx_status WHERE updated_at >= {_CUT}""")
def changed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = A.cutoff_of(A.moment(AS_OF), LOOK_BACK_HOURS * 3600)
    return A.changed_since(project(spark, sf_dir, "fx_status"), cutoff).select(
        "ship_voyage_number", "ship_name", "updated_at")


@query("latest_per_event_kind", f"""{oracle_with('fx_events')}, {_REVISED}
    SELECT ship_voyage_number, event_name, event_time, event_content_time FROM revisions WHERE rn = 1""")
def latest_per_event_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.latest_per_kind(project(spark, sf_dir, "fx_events"))


@query("latest_event_ranked", f"""{oracle_with('fx_events')}
    SELECT * EXCLUDE (rk) FROM (SELECT *, rank() OVER (PARTITION BY ship_voyage_number ORDER BY event_time DESC) AS rk
    FROM fx_events) WHERE rk = 1""")
def latest_event_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_with_ties(project(spark, sf_dir, "fx_events"), "ship_voyage_number", "event_time")


@query("eta_etd", f"""{oracle_with('fx_status', 'fx_events')}, {_REVISED}
    SELECT s.ship_voyage_number, eta.eta, etd.etd FROM fx_status s
    LEFT JOIN eta ON eta.ship_voyage_number = s.ship_voyage_number
    LEFT JOIN etd ON etd.ship_voyage_number = s.ship_voyage_number""")
def eta_etd(spark: SparkSession, sf_dir: str) -> DataFrame:
    ships = project(spark, sf_dir, "fx_status").select("ship_voyage_number")
    return ships.join(A.revised_times(project(spark, sf_dir, "fx_events")), "ship_voyage_number", "left")


@query("latest_status", f"{_STATE}, {_LATEST} SELECT * FROM latest")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.in_report_order(_latest(spark, sf_dir))


@query("mile_override", f"{_STATE}, {_ALERTS} SELECT * FROM alerts")
def mile_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.status_alerts(_latest(spark, sf_dir))


@query("qualified_event", f"""{oracle_with('fx_events')}
    SELECT seq, CASE WHEN event_name IN ({_SUFFIXED})
        THEN event_name || ' (' || coalesce(navigation_status, 'None') || ')' ELSE event_name END AS event_name
    FROM fx_events""")
def qualified_event_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, "fx_events").select(
        "seq", qualified_event(F.col("event_name"), F.col("navigation_status")).alias("event_name"))


@query("fleet_ships", f"""{oracle_with('fx_status')}
    SELECT ship_voyage_number, ship_name FROM fx_status WHERE {_FLEET}""")
def fleet_ships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, "fx_status").filter(in_fleet(F.col("ship_name"))).select(
        "ship_voyage_number", "ship_name")


@query("pier_entries", f"""{oracle_with('fx_berth')}
    SELECT berth_number, ship_name_chinese, ship_status FROM fx_berth
    WHERE berth_number IN ('1042', '1043', '1120', '1121')""")
def pier_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    piers = (*rules.PIERS_LIEN_HAI, *rules.PIERS_SELF_OPERATED)
    return project(spark, sf_dir, "fx_berth").filter(F.col("berth_number").isin(*piers)).select(
        "berth_number", "ship_name_chinese", "ship_status")


@query("berth_keep_last", f"{oracle_with('fx_berth')} SELECT * FROM fx_berth")
def berth_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, "fx_berth")


@query("berth_queue_position", f"""{oracle_with('fx_berth')}
    SELECT berth_number, berthing_time, pilotage_time, ship_name_chinese, ship_status,
        row_number() OVER (PARTITION BY berth_number ORDER BY berthing_time NULLS LAST, pilotage_time NULLS LAST,
            ship_name_chinese NULLS LAST, ship_status NULLS LAST) AS queue_position
    FROM fx_berth""")
def berth_queue_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.queue_positions(project(spark, sf_dir, "fx_berth")).select(
        "berth_number", *B.QUEUE_ORDER, "queue_position")


# A third of all entries wait at one berth, in one hour or without any time.
_HOT = """hot AS (
        SELECT CASE WHEN ascii(ship_name_chinese) % 3 = 0 THEN '1042' ELSE berth_number END AS berth_number,
            CASE WHEN ascii(ship_name_chinese) % 3 <> 0 THEN berthing_time
                WHEN ship_status = 'P' THEN NULL ELSE TIMESTAMP '2024-01-20 08:00:00' END AS berthing_time,
            CASE WHEN ascii(ship_name_chinese) % 3 <> 0 THEN pilotage_time END AS pilotage_time,
            ship_name_chinese, ship_name_english, ship_status, updated_at
        FROM fx_berth)"""


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = F.ascii("ship_name_chinese") % 3 == 0
    hour = F.when(F.col("ship_status") != "P", F.lit("2024-01-20 08:00:00").cast("timestamp_ntz"))
    return project(spark, sf_dir, "fx_berth").withColumns({
        "berth_number": F.when(hot, "1042").otherwise(F.col("berth_number")),
        "berthing_time": F.when(hot, hour).otherwise(F.col("berthing_time")),
        "pilotage_time": F.when(~hot, F.col("pilotage_time")),
    })


@query("hot_queue_position", f"""{oracle_with('fx_berth')}, {_HOT}
    SELECT berth_number, berthing_time, pilotage_time, ship_name_chinese, ship_status,
        row_number() OVER (PARTITION BY berth_number ORDER BY berthing_time NULLS LAST, pilotage_time NULLS LAST,
            ship_name_chinese NULLS LAST, ship_status NULLS LAST) AS queue_position
    FROM hot""")
def hot_queue_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.queue_positions(_hot(spark, sf_dir), even=True).select("berth_number", *B.QUEUE_ORDER, "queue_position")


@query("berth_neighbours", f"{_BERTHS}, {_BERTH_ALERTS} SELECT * FROM moved")
def berth_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.moved_ahead(project(spark, sf_dir, "fx_berth"), A.moment(CUTOFF))


@query("berth_alerts", f"{_BERTHS}, {_BERTH_ALERTS} SELECT *, {_BERTH_TEXT} AS message FROM berth_alerts")
def berth_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return B.berth_alerts(t.berths, t.status, t.events, A.moment(CUTOFF)).withColumn("message", berth_message())


@query("latest_agent", f"{oracle_with('fx_berth')}, {_AGENTS} SELECT * FROM agents")
def latest_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.latest_agents(project(spark, sf_dir, "fx_berth"))


@query("substring_join", f"""{oracle_with('fx_status', 'fx_berth')}, {_AGENTS}
    SELECT s.ship_name, g.ship_name_chinese, g.berth_number, g.port_agent
    FROM fx_status s JOIN agents g ON contains(s.ship_name, g.ship_name_chinese)""")
def substring_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ships = project(spark, sf_dir, "fx_status").select("ship_name")
    agents = D.stored_agents(project(spark, sf_dir, "fx_berth"))
    return contained_names(ships, "ship_name", agents, "ship_name_chinese").select(
        "ship_name", "ship_name_chinese", "berth_number", "port_agent")


@query("enriched_status", f"{_ALL}, {_ENRICHED} SELECT * FROM enriched")
def enriched_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


@query("status_messages", f"{_STATE}, {_ALERTS} SELECT ship_voyage_number, {_STATUS_TEXT} AS message FROM alerts")
def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.status_alerts(_latest(spark, sf_dir)).select("ship_voyage_number", status_message().alias("message"))


@query("alert_rejects", f"""{_ALL}, {_ENRICHED}
    SELECT ship_voyage_number, event_name, 'null_agent' AS reject_reason FROM enriched
    WHERE port_agent IS NULL AND event_name IN ({', '.join(map(rules.sql_text, rules.RECIPIENTS))})""")
def alert_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alert_rejects(_enriched(spark, sf_dir), rules.rule_table(spark)).select(
        "ship_voyage_number", "event_name", "reject_reason")


@query("route_stakeholders", f"""{_ALL}, {_ROUTED}
    SELECT ship_voyage_number, event_name, cast(position + 1 as bigint) AS position, stakeholder FROM passed""")
def route_stakeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = _routed(spark, sf_dir)
    rule = rules.rule_table(spark).withColumnRenamed("stakeholders", "listed")
    return (
        routed.join(rule, "event_name")
        .select("ship_voyage_number", "event_name", "listed", F.explode("stakeholders").alias("stakeholder"))
        .withColumn("position", F.array_position("listed", F.col("stakeholder")))
        .drop("listed")
    )


# Rules that change at two moments: one for whom, one that ends, and that one once more.
RULE_CHANGES = (
    ("1970-01-01 00:00:00", rules.RECIPIENTS),
    ("2024-01-30 00:00:00", {"實際靠妥時間": ("Tugboat", "Pilot", "PierLienHai"), rules.ETD_REVISION: None}),
    ("2024-01-30 12:00:00", {rules.ETD_REVISION: ("Tugboat",), rules.ETA_REVISION: None}),
)


def _rule_intervals() -> str:
    """Rows ``(event_name, position, stakeholder, valid_from, valid_to)``, for the oracle."""
    rows = []
    for i, (start, changed) in enumerate(RULE_CHANGES):
        for event, names in changed.items():
            end = next((t for t, later in RULE_CHANGES[i + 1:] if event in later), "9999-01-01 00:00:00")
            rows += [
                f"({rules.sql_text(event)}, {n}, {rules.sql_text(name)}, TIMESTAMP '{start}', TIMESTAMP '{end}')"
                for n, name in enumerate(names or ())]
    return ", ".join(rows)


_ROUTED_AS_OF = _ROUTED.replace(
    f"(VALUES {rules.rule_values()}) AS r(event_name, position, stakeholder)",
    f"(VALUES {_rule_intervals()}) AS r(event_name, position, stakeholder, valid_from, valid_to)",
).replace("ON r.event_name = c.event_name", """ON r.event_name = c.event_name
            AND coalesce(c.update_time, TIMESTAMP '9998-01-01') >= r.valid_from
            AND coalesce(c.update_time, TIMESTAMP '9998-01-01') < r.valid_to""")


@query("routed_as_of", f"""{_ALL}, {_ROUTED_AS_OF}
    SELECT ship_voyage_number, event_name, update_time, stakeholder FROM passed""")
def routed_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts routed by the rules in force at their own time."""
    versions = rules.rule_versions(spark, RULE_CHANGES)
    routed = A.routed(_enriched(spark, sf_dir), versions, F.col("update_time"))
    return routed.select("ship_voyage_number", "event_name", "update_time", F.explode("stakeholders").alias("stakeholder"))


@query("delivery_outbox", f"""{_ALL}, {_ROUTED}
    SELECT md5(message) AS alert_id, message_format, ship_voyage_number, event_name, stakeholder, message,
        CASE WHEN stakeholder = 'Tugboat' THEN 'no_token' ELSE 'queued' END AS status FROM passed""")
def delivery_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.stakeholder_outbox(_routed(spark, sf_dir), rules.channel_table(spark, CHANNELS))


@query("master_digest", f"""{_ALL}, {_ROUTED}
    SELECT ship_voyage_number, any_value(event_name) AS event_name,
        chr(10) || '通知對象: ' || chr(10) || string_agg(stakeholder, chr(10) ORDER BY position)
            || any_value(message) AS message
    FROM passed GROUP BY alert, ship_voyage_number""")
def master_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.master_digests(_routed(spark, sf_dir)).select("ship_voyage_number", "event_name", "message")


@query("poll_outbox", f"""{_ALL}, {_ROUTED}, {_BERTH_ALERTS.replace(_REVISED + ",", "", 1)}, {_OUTBOX} SELECT * FROM outbox""")
def poll_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.outbox(
        _tables(spark, sf_dir), rules.rule_table(spark), rules.channel_table(spark, CHANNELS), A.moment(CUTOFF))


@query("poll_rejects", f"""{_ALL}, {_ENRICHED}
    SELECT ship_voyage_number, event_name, CASE
        WHEN event_name NOT IN ({', '.join(map(rules.sql_text, rules.RECIPIENTS))}) THEN 'no_rule'
        WHEN ship_name IS NULL THEN 'null_ship_name' ELSE 'null_agent' END AS reason
    FROM enriched
    WHERE event_name NOT IN ({', '.join(map(rules.sql_text, rules.RECIPIENTS))}) OR ship_name IS NULL OR port_agent IS NULL""")
def poll_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stored poll did not deliver, with the reason."""
    poll = D.run_poll(
        _tables(spark, sf_dir), rules.rule_table(spark), rules.channel_table(spark, CHANNELS), A.moment(CUTOFF),
        scratch_folder(spark, "poll"))
    columns = ["ship_voyage_number", "event_name", "reason"]
    return poll.rejects.withColumnRenamed("reject_reason", "reason").select(*columns).union(
        poll.non_target.withColumn("reason", F.lit("no_rule")).select(*columns))


@query("non_target_events", f"""{_ALL}, {_ENRICHED}
    SELECT ship_voyage_number, ship_name, event_name FROM enriched
    WHERE event_name NOT IN ({', '.join(map(rules.sql_text, rules.RECIPIENTS))})""")
def non_target_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_rule(_enriched(spark, sf_dir), rules.rule_table(spark)).select(
        "ship_voyage_number", "ship_name", "event_name")


@query("rule_usage", f"""{oracle_with('fx_events')},
    rules AS (SELECT * FROM (VALUES {rules.rule_values()}) AS r(event_name, position, stakeholder)),
    seen AS (
        SELECT CASE WHEN event_name IN ({_SUFFIXED}) THEN event_name || ' (' || coalesce(navigation_status, 'None')
            || ')' ELSE event_name END AS event_name, count(*) AS n FROM fx_events GROUP BY 1)
    SELECT r.event_name, r.stakeholder, coalesce(s.n, 0) AS n_events,
        r.stakeholder IN ({', '.join(map(rules.sql_text, rules.KNOWN_STAKEHOLDERS))}) AS known_stakeholder,
        regexp_matches(r.event_name, '\\(.*\\)$')
            AND regexp_replace(r.event_name, ' \\(.*\\)$', '') NOT IN ({_SUFFIXED}) AS raw_suffix_only
    FROM rules r LEFT JOIN seen s ON s.event_name = r.event_name""")
def rule_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the rules against the events seen: how often each fires, stakeholders no
    condition knows, and events that match only if their raw name has the suffix."""
    events = project(spark, sf_dir, "fx_events")
    seen = events.groupBy(
        qualified_event(F.col("event_name"), F.col("navigation_status")).alias("event_name")
    ).agg(F.count("*").alias("n"))
    listed = rules.rule_table(spark).select("event_name", F.explode("stakeholders").alias("stakeholder"))
    stem = F.regexp_replace("event_name", r" \(.*\)$", "")
    return listed.join(seen, "event_name", "left").select(
        "event_name", "stakeholder", F.coalesce("n", F.lit(0)).alias("n_events"),
        F.col("stakeholder").isin(*rules.KNOWN_STAKEHOLDERS).alias("known_stakeholder"),
        (F.col("event_name").rlike(r"\(.*\)$") & ~stem.isin(*rules.SUFFIXED_EVENTS)).alias("raw_suffix_only"),
    )
