"""Who is told about an alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import rules
from quayside.functions.text import in_fleet


def stakeholder_conditions(ship_name: Column, port_agent: Column, berth: Column) -> dict[str, Column]:
    """Condition per stakeholder; a missing agent makes those that read it unknown."""
    yang_ming, wan_hai = port_agent.contains(rules.YANG_MING), port_agent.contains(rules.WAN_HAI)
    lien_hai, self_operated = berth.isin(*rules.PIERS_LIEN_HAI), berth.isin(*rules.PIERS_SELF_OPERATED)
    line, pier = yang_ming | wan_hai, lien_hai | self_operated
    return {
        "Pilot": line | pier,
        "CIQS": line | pier,
        "PierLienHai": lien_hai,
        "PierSelfOperated": self_operated,
        "ShippingCompanyYangMing": yang_ming,
        "ShippingAgentWanHai": wan_hai,
        "Unmooring": in_fleet(ship_name),
        "LoadingUnloading": pier,
        "Tugboat": line,
    }


def with_rule(alerts: DataFrame, rule_table: DataFrame) -> DataFrame:
    """Alerts whose event has a rule, with its ``stakeholders``."""
    return alerts.join(rule_table, "event_name")


def without_rule(alerts: DataFrame, rule_table: DataFrame) -> DataFrame:
    return alerts.join(rule_table, "event_name", "left_anti")


def _in_force(alerts: DataFrame, versions: DataFrame, time: Column, how: str) -> DataFrame:
    """Alerts with the ``stakeholders`` of the rule in force at ``time``, NULL if there is none.

    The versions of an event, no more than its rule has ever had, travel as one ordered list, so the join is on the event
    alone and gives one row per alert. Of versions from the same moment the greatest list counts; an alert
    without a time takes the newest version.
    """
    history = versions.groupBy("event_name").agg(
        F.array_sort(F.collect_list(F.struct("valid_from", "stakeholders"))).alias("_history"))
    known = F.filter("_history", lambda version: F.coalesce(version["valid_from"] <= time, F.lit(True)))
    return alerts.join(history, "event_name", how).withColumn(
        "stakeholders", F.try_element_at(known, F.lit(-1))["stakeholders"]).drop("_history")


def with_rule_as_of(alerts: DataFrame, versions: DataFrame, time: Column) -> DataFrame:
    """``with_rule`` by the rules in force at the time of each alert; ``versions`` as ``rules.rule_versions``."""
    return _in_force(alerts, versions, time, "inner").filter(F.col("stakeholders").isNotNull())


def without_rule_as_of(alerts: DataFrame, versions: DataFrame, time: Column) -> DataFrame:
    return _in_force(alerts, versions, time, "left").filter(F.col("stakeholders").isNull()).drop("stakeholders")


def rules_at(versions: DataFrame, time: Column) -> DataFrame:
    """The plain rule table that was in force at one moment, for a poll of then that is done again."""
    newest = versions.filter(F.col("valid_from") <= time).groupBy("event_name").agg(
        F.max(F.struct("valid_from", "stakeholders"))["stakeholders"].alias("stakeholders"))
    return newest.filter(F.col("stakeholders").isNotNull())


def with_recipients(ruled: DataFrame) -> DataFrame:
    """Replaces ``stakeholders`` by those whose condition holds, in rule order.

    The list of one alert is at most as long as its rule, so it is filtered in place and
    the rows need no shuffle to be regrouped.
    """
    conditions = stakeholder_conditions(F.col("ship_name"), F.col("port_agent"), F.col("berth_number"))
    passing = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in conditions.items())))
    return (
        ruled.withColumn("_passing", passing)
        .withColumn("stakeholders", F.filter("stakeholders", lambda name: F.array_contains(F.col("_passing"), name)))
        .drop("_passing")
    )


def with_channel(routed: DataFrame, channels: DataFrame) -> DataFrame:
    """Adds delivery ``status`` per (alert, stakeholder) row; ``channels`` has one row per
    stakeholder name. Rows for the master group only exist if it can be reached."""
    reachable = F.coalesce("configured", F.lit(False)) | (F.col("stakeholder") == rules.MASTER_GROUP)
    status = F.when(reachable, "queued").otherwise("no_token")
    return routed.join(channels, "stakeholder", "left").withColumn("status", status).drop("configured")
