"""Upsert of a batch into a keyed table, with change detection.

A batch may hold a key many times. Its rows apply one after the other in arrival order, and
each is compared with the row the previous ones left behind. The folds below give that
result without walking the rows: the batch is reduced to one summary row per key, without
looking at the stored table, and the summaries are then joined with the stored rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside import schemas
from quayside.operators.changes import any_of, differs_null_safe, differs_plain
from quayside.operators.latest import keep_last

REPLACE, COALESCE, NEWEST = "replace", "coalesce", "newest"
INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


@dataclass(frozen=True)
class UpsertSpec:
    """How one table takes a batch.

    ``watched``: a difference in these makes a stored row change.
    ``payload``: the columns then written (``watched`` included).
    ``null_safe``: whether NULL against a value is a difference.
    ``merge``: write the new values; or keep stored ones where the new are NULL; or keep of each of the
    ``reports``, groups of columns led by those that say how new it is, the newest, wherever it is.
    ``layout``: columns that say where a row is stored, if not all keys.
    ``stamped``: whether the table has ``created_at`` and ``updated_at``.
    ``last_only``: of a batch, which is one crawl, only the last row of a key counts.
    """

    table: str
    keys: tuple[str, ...]
    watched: tuple[str, ...]
    payload: tuple[str, ...]
    null_safe: bool = True
    merge: str = REPLACE
    stamped: bool = True
    last_only: bool = False
    reports: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...] = ()
    layout: tuple[str, ...] = ()

    def variant(self, **changes: object) -> UpsertSpec:
        return replace(self, **changes)

    def differs(self, new: Column, old: Column) -> Column:
        return differs_null_safe(new, old) if self.null_safe else differs_plain(new, old)


SPECS = {
    spec.table: spec
    for spec in (
        UpsertSpec("ship_status", schemas.KEYS["ship_status"],
                   ("latest_event",), ("ship_name", "latest_event"), null_safe=False),
        UpsertSpec("ship_berth_order", schemas.KEYS["ship_berth_order"],
                   ("berthing_time", "pilotage_time", "ship_name_english", "port_agent"),
                   ("berthing_time", "pilotage_time", "ship_name_english", "port_agent"),
                   null_safe=False, last_only=True, layout=("berth_number",)),
        UpsertSpec("ship_voyage", schemas.KEYS["ship_voyage"],
                   ("pass_10_miles_time", "pass_5_miles_time"), ("pass_10_miles_time", "pass_5_miles_time"),
                   merge=COALESCE),
        UpsertSpec("ship_events", schemas.KEYS["ship_events"],
                   ("event_content_time",),
                   ("event_source", "navigation_status", "pilot_order_number", "berth_number", "event_content_time"),
                   stamped=False),
    )
}



def _kept_newest(table: str, *reports: tuple[tuple[str, ...], tuple[str, ...]], layout: tuple[str, ...] = ()) -> UpsertSpec:
    columns = tuple(name for order, values in reports for name in (*order, *values))
    return UpsertSpec(
        table, schemas.KEYS[table], columns, columns, merge=NEWEST, stamped=False, reports=reports, layout=layout)


# Tables kept up to date from the changes of the others.
DERIVED_SPECS = {
    spec.table: spec
    for spec in (
        _kept_newest("announced_times", (("eta_reported",), ("eta",)), (("etd_reported",), ("etd",))),
        _kept_newest("name_agents", (("changed_at", "berth_number", "ship_status"), ("port_agent",))),
        _kept_newest("ship_names", (("seen_at",), ()), layout=("ship_name",)),
    )
}


def spec_for(table: str) -> UpsertSpec:
    spec = SPECS.get(table) or DERIVED_SPECS.get(table)
    if spec is None:
        raise ValueError(f"no such table: {table}")
    return spec


def _row(spec: UpsertSpec, arrival: str) -> Column:
    return F.struct(F.col(arrival).alias("arrival"), *spec.payload)


def _watched(spec: UpsertSpec, row: str) -> Column:
    return F.struct(*(F.col(f"{row}.{name}").alias(name) for name in spec.watched))


def fold_runs(batch: DataFrame, spec: UpsertSpec, arrival: str, segment_rows: int = 1_000_000) -> DataFrame:
    """One row per key with ``raw_first``, ``first`` and ``change``.

    ``first``: first row that can cause a change (all rows when null-safe, else those
    without a NULL in the watched columns). ``change``: last row whose watched values
    differ from those before it, NULL if there is none. ``raw_first``: first row of all.

    Long keys are cut by arrival number into segments of ``segment_rows``; a segment is
    folded in one task, the few segment summaries of a key in another. ``arrival`` must be
    an integer, unique within a key.
    """
    segment = F.floor(F.col(arrival) / F.lit(segment_rows))
    counts = F.lit(True) if spec.null_safe else any_of([F.col(c).isNull() for c in spec.watched]) == F.lit(False)
    value = F.struct(*spec.watched)
    earlier = (
        Window.partitionBy(*spec.keys, "_segment").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = (
        batch.select(*spec.keys, arrival, *spec.payload)
        .withColumn("_segment", segment)
        .withColumn("_value", F.when(counts, value))
        .withColumn("_before", F.last("_value", ignorenulls=True).over(earlier))
    )
    row = _row(spec, arrival)
    changed = F.col("_value").isNotNull() & F.col("_before").isNotNull() & ~F.col("_value").eqNullSafe(F.col("_before"))
    segments = rows.groupBy(*spec.keys, "_segment").agg(
        F.min(row).alias("raw_first"),
        F.min(F.when(F.col("_value").isNotNull(), row)).alias("first"),
        F.max(F.when(F.col("_value").isNotNull(), row)).alias("last"),
        F.max(F.when(changed, row)).alias("change"),
    )
    along = Window.partitionBy(*spec.keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.withColumn("_previous", F.last("last", ignorenulls=True).over(along))
    at_border = (
        F.col("first").isNotNull() & F.col("_previous").isNotNull()
        & ~_watched(spec, "first").eqNullSafe(_watched(spec, "_previous"))
    )
    return segments.groupBy(*spec.keys).agg(
        F.min("raw_first").alias("raw_first"),
        F.min("first").alias("first"),
        F.max(F.coalesce("change", F.when(at_border, F.col("first")))).alias("change"),
    )


def _fold_coalesce(batch: DataFrame, spec: UpsertSpec, arrival: str) -> DataFrame:
    """Per key the last non-NULL value of each column, and what shows that none differed."""
    aggregates = [F.count("*").alias("_rows")]
    for name in spec.watched:
        column = F.col(name)
        aggregates += [
            F.max_by(column, F.when(column.isNotNull(), F.col(arrival))).alias(f"_last_{name}"),
            F.min(column).alias(f"_min_{name}"),
            F.max(column).alias(f"_max_{name}"),
            F.count(column).alias(f"_filled_{name}"),
        ]
    return batch.groupBy(*spec.keys).agg(*aggregates)


def _coalesce_result(spec: UpsertSpec, old: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    """Fires unless every row of the batch equals what is stored."""
    fired, values = [], {}
    for name in spec.watched:
        filled, rows = F.col(f"_filled_{name}"), F.col("_rows")
        same = F.when(old[name].isNull(), filled == 0).otherwise(
            (filled == rows) & (F.col(f"_min_{name}") == old[name]) & (F.col(f"_max_{name}") == old[name]))
        fired.append(~same)
        values[name] = F.coalesce(F.col(f"_last_{name}"), old[name])
    return any_of(fired), values


def _fold_newest(batch: DataFrame, spec: UpsertSpec, arrival: str) -> DataFrame:
    """Per key the newest of each report; of equally new ones the last to arrive. One row per key and task travels."""
    newest = [
        F.max(F.when(F.col(order[0]).isNotNull(), F.struct(F.struct(*order).alias("order"), arrival, *values))).alias(f"_report_{i}")
        for i, (order, values) in enumerate(spec.reports)]
    return batch.groupBy(*spec.keys).agg(*newest)


def _newest_result(spec: UpsertSpec, old: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    """A report counts unless a newer one is stored, so batches may come in any order."""
    fired, result = [], {}
    for i, (order, values) in enumerate(spec.reports):
        report = F.col(f"_report_{i}")
        stored = F.struct(*(old[name].alias(name) for name in order))
        taken = report.isNotNull() & (old[order[0]].isNull() | (report["order"] >= stored))
        for name in (*order, *values):
            new = report["order"][name] if name in order else report[name]
            result[name] = F.when(taken, new).otherwise(old[name])
            fired.append(~result[name].eqNullSafe(old[name]))
    return any_of(fired), result


def _run_result(spec: UpsertSpec, old: dict[str, Column], stored: Column) -> tuple[Column, dict[str, Column]]:
    final = F.coalesce("change", "first")
    first_differs = any_of([spec.differs(F.col(f"first.{name}"), old[name]) for name in spec.watched])
    fired = F.col("first").isNotNull() & (F.col("change").isNotNull() | first_differs)
    inserted = final
    if not spec.null_safe:
        # A stored NULL compares as unknown for ever, and so does a NULL that is inserted.
        fired &= any_of([old[name].isNull() for name in spec.watched]) == F.lit(False)
        inserted = F.when(F.col("raw_first").eqNullSafe(F.col("first")), final).otherwise(F.col("raw_first"))
    row = F.when(stored, final).otherwise(inserted)
    return fired, {name: row[name] for name in spec.payload}


def _single_result(spec: UpsertSpec, old: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    new = {name: F.col(f"_new_{name}") for name in spec.payload}
    fired = any_of([spec.differs(new[name], old[name]) for name in spec.watched])
    if spec.merge == COALESCE:
        return fired, {name: F.coalesce(new[name], old[name]) for name in spec.payload}
    return fired, new


def upsert(
    state: DataFrame,
    batch: DataFrame,
    spec: UpsertSpec,
    as_of: Column,
    arrival: str = "seq",
    segment_rows: int = 1_000_000,
) -> DataFrame:
    """The table after ``batch``, with ``change_type`` ∈ insert / update / unchanged per row.

    Filter on ``change_type`` for the change feed; drop it for the new state. A key is in the
    result once, however often it is in the batch. If ``state`` is itself the result of an upsert,
    with its ``change_type``, the types of both add up.
    """
    single = spec.last_only
    if single:
        last = keep_last(batch.select(*spec.keys, arrival, *spec.payload), spec.keys, arrival)
        summary = last.select(*spec.keys, *(F.col(c).alias(f"_new_{c}") for c in spec.payload))
    elif spec.merge == COALESCE:
        if not spec.null_safe:
            raise ValueError("repeated keys under coalesce need the null-safe comparison")
        summary = _fold_coalesce(batch, spec, arrival)
    elif spec.merge == NEWEST:
        summary = _fold_newest(batch, spec, arrival)
    elif len(spec.watched) > 1 and not spec.null_safe:
        raise ValueError("several plainly compared columns need a batch of which the last row counts")
    else:
        summary = fold_runs(batch, spec, arrival, segment_rows)

    stamps = ("created_at", "updated_at") if spec.stamped else ()
    stored_rows = state.select(
        *spec.keys, *(F.col(c).alias(f"_old_{c}") for c in (*spec.payload, *stamps)), F.lit(True).alias("_stored"),
        (F.col("change_type") if "change_type" in state.columns else F.lit(UNCHANGED)).alias("_before"))
    joined = stored_rows.join(summary.withColumn("_arrived", F.lit(True)), list(spec.keys), "full_outer")

    old = {name: F.col(f"_old_{name}") for name in spec.payload}
    stored, arrived = F.col("_stored").isNotNull(), F.col("_arrived").isNotNull()
    if single:
        fired, values = _single_result(spec, old)
    elif spec.merge == COALESCE:
        fired, values = _coalesce_result(spec, old)
    elif spec.merge == NEWEST:
        fired, values = _newest_result(spec, old)
    else:
        fired, values = _run_result(spec, old, stored)

    written = ~stored | (arrived & F.coalesce(fired, F.lit(False)))
    kind = F.when(~stored | (F.col("_before") == INSERT), INSERT).when(written, UPDATE).otherwise(F.col("_before"))
    columns = [F.when(F.col("_written"), values[name]).otherwise(old[name]).alias(name) for name in spec.payload]
    if spec.stamped:
        columns += [
            F.when(stored, F.col("_old_created_at")).otherwise(as_of).alias("created_at"),
            F.when(F.col("_written"), as_of).otherwise(F.col("_old_updated_at")).alias("updated_at"),
        ]
    return joined.withColumn("_written", written).withColumn("change_type", kind).select(*spec.keys, *columns, "change_type")


def state_of(merged: DataFrame) -> DataFrame:
    return merged.drop("change_type")


def changes_of(merged: DataFrame) -> DataFrame:
    """The change feed: rows this batch inserted or updated."""
    return merged.filter(F.col("change_type") != UNCHANGED)
