"""One poll: every alert due now, as rows of the outbox."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame

from quayside.operators.routing import without_rule
from quayside.plans import alerts as A
from quayside.plans import berths as B
from quayside.session import scratch_folder


@dataclass(frozen=True)
class PortTables:
    status: DataFrame
    voyage: DataFrame
    # Not looked at if the next two are given.
    events: DataFrame | None
    berths: DataFrame
    # The part of ``events`` that may be recent, if it can be read on its own.
    recent_events: DataFrame | None = None
    # ``revised_times`` and ``latest_agents`` of all rows, if they are kept.
    announced: DataFrame | None = None
    agents: DataFrame | None = None
    # Status rows of the names in ``berths``, if those in ``status`` are not all.
    named: DataFrame | None = None


def _with_announced(tables: PortTables) -> PortTables:
    """Both branches of a poll with the same aggregate, so that revisions are read once."""
    return replace(tables, announced=A.revised_times(tables.events)) if tables.announced is None else tables


def enriched_alerts(tables: PortTables, cutoff: Column) -> DataFrame:
    latest = A.latest_status(tables.status, tables.voyage, tables.events, cutoff, tables.recent_events, tables.announced)
    agents = stored_agents(tables.berths) if tables.agents is None else tables.agents
    return A.enriched(A.status_alerts(latest), agents.select("ship_name_chinese", "berth_number", "port_agent"))


def stored_agents(berths: DataFrame) -> DataFrame:
    """``latest_agents``, written once below the scratch folder: an index of names asks for them several times."""
    agents = A.latest_agents(berths)
    path = scratch_folder(berths.sparkSession, "agents")
    agents.write.parquet(path)
    return berths.sparkSession.read.schema(agents.schema).parquet(path)


def _berth_rows(tables: PortTables, cutoff: Column) -> DataFrame:
    status = tables.status if tables.named is None else tables.named
    return B.berth_outbox(B.berth_alerts(tables.berths, status, tables.events, cutoff, tables.announced))


@dataclass(frozen=True)
class Poll:
    """What one poll found, as stored."""

    outbox: DataFrame
    rejects: DataFrame
    non_target: DataFrame


def run_poll(
    tables: PortTables, rule_table: DataFrame, channels: DataFrame, cutoff: Column, folder: str,
    master_configured: bool = True,
) -> Poll:
    """Runs a poll and stores it below ``folder``: the alerts once, and from them the outbox, the
    alerts that cannot be routed with their reason, and the events nobody is told about. A poll
    that is run again replaces what its first attempt left."""
    spark = tables.status.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    if master_configured:
        tables = _with_announced(tables)
    alerts = kept(enriched_alerts(tables, cutoff), "alerts")
    rows = A.stakeholder_outbox(A.routed(alerts, rule_table), channels, master_configured)
    if master_configured:
        rows = rows.unionByName(_berth_rows(tables, cutoff), allowMissingColumns=True)
    return Poll(
        kept(rows, "outbox"), kept(A.alert_rejects(alerts, rule_table), "rejects"),
        kept(without_rule(alerts, rule_table), "non-target"))


def outbox(
    tables: PortTables, rule_table: DataFrame, channels: DataFrame, cutoff: Column, master_configured: bool = True
) -> DataFrame:
    """Status alerts per stakeholder; with a master group also its digests and berth alerts."""
    if master_configured:
        tables = _with_announced(tables)
    routed = A.routed(enriched_alerts(tables, cutoff), rule_table)
    rows = A.stakeholder_outbox(routed, channels, master_configured)
    if master_configured:
        rows = rows.unionByName(_berth_rows(tables, cutoff), allowMissingColumns=True)
    return rows
