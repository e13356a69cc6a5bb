"""Stored tables as versioned parquet, updated by upserts.

A table is split into parts, by event day or by a hash of the key. An upsert reads only the
parts its batch touches, rewrites only those in which a row changes, and then publishes a list of
which version holds each part. The two newest lists are kept, each in its own place, and the older one is written
over: a reader always finds a whole list, and however long the table is kept, there is little
to read. Applying the newest version again starts from the version before it and replaces
what the first attempt left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.upsert import UNCHANGED, UpsertSpec, changes_of, spec_for, upsert
from quayside.schemas import DERIVED, TABLES
from quayside.session import scratch_folder

# Crawls of one batch that are folded in one plan; of more, the rows in between are written.
CRAWLS_PER_PLAN = 8
LIST = "version bigint, part string, held_by bigint"


class StateTable:
    def __init__(
        self, spark: SparkSession, root: str, spec: UpsertSpec, parts: int = 64, parts_per_day: int = 1
    ) -> None:
        self.parts_per_day = parts_per_day
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.parts = parts
        self.names = {**TABLES, **DERIVED}[spec.table].names
        columns = [f for f in {**TABLES, **DERIVED}[spec.table].fields if f.name != "id"]
        self.schema = T.StructType([*columns, T.StructField("change_type", T.StringType())])

    def _place(self) -> Column:
        """What the name of a part begins with: the day, or a hash."""
        if self.spec.table == "ship_events":
            return F.date_format("event_time", "yyyy-MM-dd")
        return F.pmod(F.xxhash64(*(self.spec.layout or self.spec.keys)), F.lit(self.parts)).cast("string")

    def _part(self) -> Column:
        if self.parts_per_day == 1 or not (self.spec.table == "ship_events" or self.spec.layout):
            return self._place()
        share = F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.parts_per_day))
        return F.concat_ws("_", self._place(), share.cast("string"))

    def places_of(self, rows: DataFrame) -> set[str]:
        """Places that rows with these keys, or columns of the layout, lie in; no more than there are parts."""
        return {row["place"] for row in rows.select(self._place().alias("place")).distinct().collect()}

    def _lists(self) -> dict[int, dict[str, tuple[int, int]]]:
        """Version -> part -> (version holding it, place of the list). As small as the number of parts."""
        lists: dict[int, dict[str, tuple[int, int]]] = {}
        for place in (0, 1):
            try:
                rows = (
                    self.spark.read.schema(LIST).option("ignoreMissingFiles", True)
                    .json(f"{self.root}/published/{place}").collect())
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            for row in rows:
                lists.setdefault(row["version"], {})[row["part"]] = (row["held_by"], place)
        return lists

    def newest(self) -> int:
        """Number of the newest published version, -1 if there is none."""
        return max(self._lists(), default=-1)

    def held(self) -> dict[str, int]:
        """Which version holds each part, in the newest version."""
        lists = self._lists()
        return {part: version for part, (version, _) in lists[max(lists)].items()} if lists else {}

    def _base(self, version: int) -> tuple[dict[str, int], int]:
        """What ``version`` starts from, and the place its list goes to."""
        lists = self._lists()
        earlier = [v for v in lists if v < version]
        if earlier:
            newest = lists[max(earlier)]
            return {part: held for part, (held, _) in newest.items()}, 1 - next(iter(newest.values()))[1]
        if set(lists) <= {version}:
            return {}, 0
        raise ValueError(f"version {version} of {self.root} is too old to be applied again")

    def _rows(self, held: dict[str, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.root}/data/version={v}/part={p}" for p, v in sorted(held.items())]
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, since_day: str | None = None, places: set[str] | None = None, after: int | None = None) -> DataFrame:
        """The newest published version. If wanted, only: of events the days from ``since_day`` on; the parts at
        some ``places``; the parts rewritten by a version ``after`` a given one."""
        held = self.held()
        if since_day is not None:
            if self.spec.table != "ship_events":
                raise ValueError("only events are stored by day")
            held = {part: version for part, version in held.items() if part >= since_day}
        if places is not None:
            held = {part: version for part, version in held.items() if part.split("_")[0] in places}
        if after is not None:
            held = {part: version for part, version in held.items() if version > after}
        rows = self._rows(held).drop("change_type")
        if self.spec.table == "ship_events":
            # Stands for a serial number: the same key always has the same one.
            rows = rows.withColumn("id", F.xxhash64(*self.spec.keys))
        return rows.select(*self.names)

    def changes(self, version: int) -> DataFrame:
        """Change feed of one version, as long as its data is kept."""
        if version > max(self._lists(), default=-1):
            raise ValueError(f"version {version} of {self.root} is not published")
        folder = f"{self.root}/data/version={version}"
        return changes_of(self.spark.read.schema(self.schema).parquet(folder))

    def since(self, version: int) -> DataFrame:
        """All rows changed after ``version``, as they are now: just these if one version came since, else
        with them the other rows of the parts rewritten."""
        known = sorted(self._lists())
        if known and known[0] <= version < known[-1]:
            return self.changes(known[-1]).drop("change_type")
        return self.read(after=version)

    def apply(
        self, batch: DataFrame, version: int, as_of: Column | Callable[[int], Column], arrival: str = "seq",
        crawl: str | None = None,
    ) -> None:
        """Upserts ``batch`` and publishes the result as ``version``.

        With ``crawl``, the batch holds several crawls, numbered in that column. They are
        taken in one after the other, and ``as_of`` gives the time to stamp from the number.
        """
        held, place = self._base(version)
        batch = batch.withColumn("_part", self._part()).persist()
        merged = None
        try:
            touched = {row["_part"] for row in batch.select("_part").distinct().collect()}
            merged = self._rows({p: v for p, v in held.items() if p in touched}).drop("change_type")
            if crawl is None:
                merged = upsert(merged, batch, self.spec, as_of, arrival)
            else:
                numbers = sorted(row[crawl] for row in batch.select(crawl).distinct().collect())
                for done, number in enumerate(numbers):
                    merged = upsert(merged, batch.filter(F.col(crawl) == number), self.spec, as_of(number), arrival)
                    if done % CRAWLS_PER_PLAN == CRAWLS_PER_PLAN - 1:
                        merged = self._written(merged, "between-crawls")
            if "change_type" not in merged.columns:
                merged = merged.withColumn("change_type", F.lit(UNCHANGED))
            merged = merged.withColumn("part", self._part()).persist()
            changed = {row["part"] for row in changes_of(merged).select("part").distinct().collect()}
            # Rebalancing gathers each part in few files, and splits a part too big for one.
            (
                merged.filter(F.col("part").isin(changed)).select("part", *self.schema.names)
                .hint("rebalance", F.col("part"))
                .write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/data/version={version}")
            )
        finally:
            batch.unpersist()
            if merged is not None:
                merged.unpersist()
        rows = [(version, p, v) for p, v in {**held, **dict.fromkeys(changed, version)}.items()]
        self.spark.createDataFrame(rows, LIST).coalesce(1).write.mode("overwrite").json(
            f"{self.root}/published/{place}")

    def _written(self, rows: DataFrame, name: str) -> DataFrame:
        """The same rows read from a folder, so that the plan does not grow with every crawl."""
        path = scratch_folder(self.spark, name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def state_table(spark: SparkSession, root: str, table: str, parts: int = 64, parts_per_day: int = 1) -> StateTable:
    """The stored table of that name; an unknown name is refused. Days of events, and parts that are laid out
    by some of the keys, are split into ``parts_per_day``, the other tables into ``parts``; both stay the
    same for a table's life."""
    return StateTable(spark, f"{root.rstrip('/')}/{table}", spec_for(table), parts, parts_per_day)
