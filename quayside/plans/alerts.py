"""Status alerts: from the stored tables to rendered, routed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import rules
from quayside.functions.messages import digest_message, status_message
from quayside.functions.text import qualified_event, ship_id, voyage_serial
from quayside.operators import quality
from quayside.operators.latest import in_even_parts, newest_row, newest_with_ties
from quayside.operators.routing import with_channel, with_recipients, with_rule, with_rule_as_of
from quayside.operators.substring import last_contained

KEY = "ship_voyage_number"
EPOCH = "1970-01-01 00:00:00"


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def changed_since(df: DataFrame, cutoff: Column, column: str = "updated_at") -> DataFrame:
    return df.filter(F.col(column) >= cutoff)


def cutoff_of(as_of: Column, seconds: int) -> Column:
    """Start of a look-back of ``seconds``. The clock is always an argument."""
    return as_of - F.make_dt_interval(secs=F.lit(seconds))


def revised_times(events: DataFrame, voyages: DataFrame | None = None) -> DataFrame:
    """Latest announced arrival (``eta``) and departure (``etd``) per voyage, of all or of ``voyages``.

    Both come from one aggregation, which reads only the two kinds of revision. Voyages that are
    asked for are few as a rule; Spark picks how to keep only their revisions, by their size.
    """
    if voyages is not None:
        events = events.join(voyages.select(KEY), KEY, "left_semi")
    report = F.struct("event_time", "event_content_time")

    def latest(kind: str) -> Column:
        return F.max(F.when(F.col("event_name") == kind, report))["event_content_time"]

    revisions = events.filter(F.col("event_name").isin(rules.ETA_REVISION, rules.ETD_REVISION)).select(
        KEY, "event_name", "event_time", "event_content_time")
    return (
        in_even_parts(revisions, [KEY])
        .groupBy(KEY)
        .agg(latest(rules.ETA_REVISION).alias("eta"), latest(rules.ETD_REVISION).alias("etd"))
    )


def latest_per_kind(events: DataFrame) -> DataFrame:
    """The newest revision of each kind per voyage."""
    revisions = events.filter(F.col("event_name").isin(rules.ETA_REVISION, rules.ETD_REVISION))
    return newest_row(revisions, [KEY, "event_name"], ["event_time"], ["event_time", "event_content_time"])


def recent_candidates(status: DataFrame, voyage: DataFrame, cutoff: Column) -> DataFrame:
    """Ships whose status or voyage row changed since ``cutoff``."""
    voyages = voyage.select(
        KEY, "pass_10_miles_time", "pass_5_miles_time", F.col("updated_at").alias("ship_voyage_updated_at"))
    return (
        status.select(KEY, "ship_name", "updated_at")
        .join(voyages, KEY, "left")
        .filter((F.col("updated_at") >= cutoff) | (F.col("ship_voyage_updated_at") >= cutoff))
    )


def latest_status(
    status: DataFrame, voyage: DataFrame, events: DataFrame | None, cutoff: Column, recent_events: DataFrame | None = None,
    announced: DataFrame | None = None,
) -> DataFrame:
    """Recently changed ships with their latest event(s), ETA, ETD and mile passages.

    Only events since ``cutoff`` are ranked: the newest event of a voyage is reported only
    if it is that recent, and then it is also the newest of the recent ones. They are taken from
    ``recent_events`` if given. The announced times are taken from ``announced`` if given; else the revisions
    of the reported voyages are aggregated.
    """
    recent = events if recent_events is None else recent_events
    latest = newest_with_ties(
        recent.filter(F.col("event_time") >= cutoff).select(
            KEY, "event_time", "event_name", "navigation_status", "event_content_time", "event_source"),
        KEY, "event_time",
    ).select(
        KEY,
        F.col("event_name").alias("latest_event_name"),
        F.col("event_time").alias("latest_event_time"),
        "navigation_status",
        F.col("event_content_time").alias("latest_event_content_time"),
        F.col("event_source").alias("latest_event_source"),
    )
    reported = recent_candidates(status, voyage, cutoff).join(latest, KEY)
    times = revised_times(events, reported) if announced is None else announced.select(KEY, "eta", "etd")
    return (
        reported.join(times, KEY, "left")
        .select(
            "ship_name", KEY, "eta", "etd", "latest_event_name", "latest_event_time", "navigation_status",
            "latest_event_content_time", "latest_event_source", "updated_at", "pass_10_miles_time",
            "pass_5_miles_time", "ship_voyage_updated_at",
        )
    )


def in_report_order(latest: DataFrame) -> DataFrame:
    epoch = moment(EPOCH)
    when = F.greatest(
        F.coalesce("latest_event_time", epoch), F.coalesce("ship_voyage_updated_at", epoch))
    return latest.orderBy(when, KEY, "latest_event_name")


def status_alerts(latest: DataFrame) -> DataFrame:
    """Alert rows. A voyage row newer than the status row turns the alert into the mile
    passage it reports; a ship without a voyage row keeps its event."""
    newer = F.coalesce(F.col("ship_voyage_updated_at") > F.col("updated_at"), F.lit(False))
    five = newer & F.col("pass_5_miles_time").isNotNull()
    ten = newer & F.col("pass_10_miles_time").isNotNull()
    event = (
        F.when(five, rules.FIVE_MILE_EVENT).when(ten, rules.TEN_MILE_EVENT).otherwise(F.col("latest_event_name"))
    )
    return latest.select(
        F.lit(rules.STATUS_FORMAT).alias("message_format"),
        "ship_name",
        KEY,
        ship_id(F.col(KEY)).alias("ship_id"),
        voyage_serial(F.col(KEY)).alias("voyage_serial"),
        "eta",
        "etd",
        qualified_event(event, F.col("navigation_status")).alias("event_name"),
        F.when(five, F.col("pass_5_miles_time")).when(ten, F.col("pass_10_miles_time"))
        .otherwise(F.col("latest_event_content_time")).alias("event_time"),
        F.when(five | ten, rules.MILE_SOURCE).otherwise(F.col("latest_event_source")).alias("event_source"),
        F.when(event.isin(*rules.VOYAGE_TIMED_EVENTS), F.col("ship_voyage_updated_at"))
        .otherwise(F.col("latest_event_time")).alias("update_time"),
    )


def latest_agents(berths: DataFrame) -> DataFrame:
    """Berth and agent per Chinese ship name, from its last changed queue entry."""
    return newest_row(
        berths, ["ship_name_chinese"], ["updated_at", "berth_number", "ship_status"], ["berth_number", "port_agent"])


def enriched(alerts: DataFrame, agents: DataFrame) -> DataFrame:
    """Adds berth and agent of the queue entry whose Chinese name occurs in the ship's name.

    The berth is copied only for events that concern a berth. An agent that is known to be
    missing stays NULL; a ship without any entry gets the defaults.
    """
    found = F.col("_match").isNotNull()
    return (
        last_contained(alerts, "ship_name", agents, "ship_name_chinese", "_match")
        .withColumn("berth_number", F.when(
            found & F.col("event_name").isin(*rules.BERTH_EVENTS), F.col("_match.berth_number"),
        ).otherwise(rules.NO_BERTH))
        .withColumn("port_agent", F.when(found, F.col("_match.port_agent")).otherwise(rules.NO_AGENT))
        .drop("_match")
    )


def alert_rejects(alerts: DataFrame, rule_table: DataFrame) -> DataFrame:
    """Alerts that cannot be routed, with the reason: no ship name, or a rule that has to
    read an agent that is missing."""
    has_rule = rule_table.select("event_name", F.lit(True).alias("_ruled"))
    checked = quality.with_reasons(
        alerts.join(has_rule, "event_name", "left"),
        {
            "null_ship_name": F.col("ship_name").isNull(),
            "null_agent": F.col("port_agent").isNull() & F.col("_ruled"),
        },
    )
    return quality.rejected(checked.drop("_ruled"))


def routed(alerts: DataFrame, rule_table: DataFrame, time: Column | None = None) -> DataFrame:
    """Alerts with a rule, each with the list of stakeholders to tell (maybe empty) and its text. With ``time``,
    the table holds versions of rules, and those in force at the time of an alert count for it."""
    usable = alerts.filter(F.col("ship_name").isNotNull() & F.col("port_agent").isNotNull())
    ruled = with_rule(usable, rule_table) if time is None else with_rule_as_of(usable, rule_table, time)
    return (
        with_recipients(ruled)
        .withColumn("message", status_message())
        .withColumn("alert_id", F.md5("message"))
    )


def stakeholder_outbox(routed_alerts: DataFrame, channels: DataFrame, with_master: bool = False) -> DataFrame:
    """One row per alert and stakeholder, marked by whether the stakeholder can be reached.

    With a master group, it gets each alert that concerned anyone, reachable or not, with
    the list of them. All rows of an alert come out of one pass over it.
    """
    letters = F.transform("stakeholders", lambda name: F.struct(name.alias("stakeholder"), F.col("message")))
    if with_master:
        digest = F.array(F.struct(
            F.lit(rules.MASTER_GROUP).alias("stakeholder"),
            digest_message(F.col("message"), F.col("stakeholders")).alias("message")))
        letters = F.when(F.size("stakeholders") > 0, F.concat(letters, digest))
    each = routed_alerts.select(
        "alert_id", "message_format", KEY, "event_name", F.explode(letters).alias("letter")
    ).select("alert_id", "message_format", KEY, "event_name", "letter.*")
    return with_channel(each, channels)


def master_digests(routed_alerts: DataFrame) -> DataFrame:
    """The master group's copies alone."""
    return routed_alerts.filter(F.size("stakeholders") > 0).select(
        "alert_id", "message_format", KEY, "event_name",
        digest_message(F.col("message"), F.col("stakeholders")).alias("message"))
