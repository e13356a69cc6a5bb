"""A poll that reads what changed: tables kept from the change feed, and stored tables by place.

Three small tables follow the stored ones. Each takes in the rows that changed since the version it last
saw, keeps the newest of what they report, and is published under the same version number:

- ``announced_times``: per voyage the newest announced arrival and departure, from revisions of events;
- ``name_agents``: per Chinese name the queue entry that changed last, from berth entries;
- ``ship_names``: which voyages a ship name has had, from status rows. A voyage may have been given another
  name since, so who asks looks at the status row as well.

All three keep what is newest by the rows' own times, so taking rows in twice, or together with rows that did
not change, or several versions at once, gives the same. A poll then opens the parts of the stored tables
in which a key changed, the berths in which a ship moved, and the days since its cutoff.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import rules
from quayside.plans.alerts import KEY
from quayside.plans.berths import moved_ahead
from quayside.plans.delivery import PortTables
from quayside.session import scratch_folder
from quayside.sources.state import StateTable, state_table


def announced_reports(events: DataFrame) -> DataFrame:
    """Revisions of arrival and departure, each as a row of ``announced_times``."""
    def of(kind: str, column: str) -> Column:
        return F.when(F.col("event_name") == kind, F.col(column))

    return events.filter(F.col("event_name").isin(rules.ETA_REVISION, rules.ETD_REVISION)).select(
        KEY, of(rules.ETA_REVISION, "event_time").alias("eta_reported"), of(rules.ETA_REVISION, "event_content_time").alias("eta"),
        of(rules.ETD_REVISION, "event_time").alias("etd_reported"), of(rules.ETD_REVISION, "event_content_time").alias("etd"))


def agent_reports(berths: DataFrame) -> DataFrame:
    return berths.select(
        "ship_name_chinese", F.col("updated_at").alias("changed_at"), "berth_number", "ship_status", "port_agent")


def name_reports(status: DataFrame) -> DataFrame:
    return status.select("ship_name", KEY, F.col("updated_at").alias("seen_at"))


FOLLOWERS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "announced_times": ("ship_events", announced_reports),
    "name_agents": ("ship_berth_order", agent_reports),
    "ship_names": ("ship_status", name_reports),
}


def follow(spark: SparkSession, root: str, name: str, parts: int = 64, parts_per_day: int = 1) -> None:
    """Brings one of ``FOLLOWERS`` up to the newest version of the table it follows."""
    source, reports = FOLLOWERS[name]
    followed, follower = state_table(spark, root, source, parts, parts_per_day), state_table(spark, root, name, parts)
    newest, done = followed.newest(), follower.newest()
    if newest > done:
        # No report needs to win by arrival: rows of one key with equal times are equal.
        batch = reports(followed.since(done)).withColumn("seq", F.lit(0).cast("bigint"))
        follower.apply(batch, newest, F.lit(None).cast("timestamp_ntz"))


def follow_all(spark: SparkSession, root: str, parts: int = 64, parts_per_day: int = 1) -> None:
    for name in FOLLOWERS:
        follow(spark, root, name, parts, parts_per_day)


@dataclass(frozen=True)
class Feed:
    """The stored tables of a port, as a poll reads them.

    ``after`` has the version of each stamped table that was the newest before the cutoff (-1: none);
    all rows stamped since the cutoff are from later versions.
    """

    spark: SparkSession
    root: str
    after: Mapping[str, int]
    parts: int = 64
    parts_per_day: int = 1

    def table(self, name: str) -> StateTable:
        return state_table(self.spark, self.root, name, self.parts, self.parts_per_day)

    def changed(self, name: str, cutoff: Column) -> DataFrame:
        """Rows stamped since the cutoff; only parts rewritten since are opened."""
        return self.table(name).since(self.after.get(name, -1)).filter(F.col("updated_at") >= cutoff)

    def of_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows that have these values in the columns of ``keys``, out of the parts they lie in."""
        table = self.table(name)
        return table.read(places=table.places_of(keys)).join(keys, keys.columns, "left_semi")

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        """The few rows that several steps ask for, written once."""
        path = scratch_folder(self.spark, name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def status_tables(self, cutoff: Column) -> tuple[DataFrame, DataFrame]:
        """Status and voyage rows of the voyages of which either changed."""
        keys = self._kept(self.changed("ship_status", cutoff).select(KEY).union(
            self.changed("ship_voyage", cutoff).select(KEY)).distinct(), "changed-voyages")
        return self.of_keys("ship_status", keys), self.of_keys("ship_voyage", keys)

    def berth_tables(self, cutoff: Column) -> tuple[DataFrame, DataFrame]:
        """Queues of the berths in which an entry changed, and the status rows of the ships behind one that moved."""
        berths = self._kept(self.changed("ship_berth_order", cutoff).select("berth_number").distinct(), "changed-berths")
        queues = self.of_keys("ship_berth_order", berths)
        names = self._kept(moved_ahead(queues, cutoff).select("ship_name").distinct(), "names-behind")
        voyages = self._kept(self.of_keys("ship_names", names).select(KEY).distinct(), "voyages-behind")
        return queues, self.of_keys("ship_status", voyages).join(names, "ship_name", "left_semi")

    def tables(self, cutoff: Column, since_day: str) -> PortTables:
        """What ``delivery`` needs for one poll; ``since_day`` is the day of the cutoff."""
        status, voyage = self.status_tables(cutoff)
        queues, named = self.berth_tables(cutoff)
        polled = self._kept(status.select(KEY).union(named.select(KEY)).distinct(), "polled-voyages")
        return PortTables(
            status, voyage, None, queues, recent_events=self.table("ship_events").read(since_day=since_day),
            announced=self.of_keys("announced_times", polled), agents=self.table("name_agents").read(), named=named)
