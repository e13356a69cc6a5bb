"""Upserts against a plain loop over the rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators.upsert import COALESCE, SPECS, changes_of, spec_for, state_of, upsert
from tests.conftest import as_tuples

NOW, THEN = datetime(2024, 2, 1), datetime(2024, 1, 1)
TYPES = {
    "pass_10_miles_time": "timestamp_ntz", "pass_5_miles_time": "timestamp_ntz", "event_time": "timestamp_ntz",
    "event_content_time": "timestamp_ntz", "berthing_time": "timestamp_ntz", "pilotage_time": "timestamp_ntz",
}


def differs(new, old, null_safe):
    if null_safe:
        return new != old
    return new is not None and old is not None and new != old


def by_loop(stored, batch, spec):
    """Applies the batch row by row, the way the rows would be sent to a database."""
    state = {key: (dict(row), "unchanged") for key, row in stored.items()}
    for key, row in batch:
        if key not in state:
            state[key] = ({**row, "created_at": NOW, "updated_at": NOW}, "insert")
            continue
        old, kind = state[key]
        if any(differs(row[c], old[c], spec.null_safe) for c in spec.watched):
            new = {c: old[c] if spec.merge == COALESCE and row[c] is None else row[c] for c in spec.payload}
            state[key] = ({**old, **new, "updated_at": NOW}, "insert" if kind == "insert" else "update")
    return state


def frame(spark, rows, spec, extra):
    columns = [*spec.keys, *spec.payload, *extra]
    types = {**TYPES, "seq": "bigint", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], schema)


def check(spark, spec, stored, batch, segment_rows):
    stamps = ("created_at", "updated_at") if spec.stamped else ()
    with_keys = lambda key, row: {**row, **dict(zip(spec.keys, key, strict=True))}
    state_df = frame(spark, [with_keys(k, r) for k, r in stored.items()], spec, stamps)
    batch_df = frame(
        spark, [{**with_keys(k, r), "seq": i} for i, (k, r) in enumerate(batch)], spec, ("seq",))
    merged = upsert(state_df, batch_df, spec, F.lit(NOW).cast("timestamp_ntz"), segment_rows=segment_rows)
    want = sorted(
        (tuple([*key, *(row[c] for c in (*spec.payload, *stamps)), kind])
         for key, (row, kind) in by_loop(stored, batch, spec).items()), key=repr)
    assert as_tuples(merged, *spec.keys, *spec.payload, *stamps, "change_type") == want


def key_of(spec, number):
    return tuple(datetime(2000, 1, 1) + timedelta(number) if TYPES.get(k) else f"k{number}" for k in spec.keys)


def random_row(pick, spec, n_values):
    """NULL or one of a few values per column, so that repeats and returns to an old value are common."""
    row = {}
    for column in spec.payload:
        value = pick.choice([None, *range(n_values)])
        text = None if value is None else f"v{value}"
        row[column] = (value if value is None else datetime(2024, 1, 1, value)) if TYPES.get(column) else text
    return row


def random_case(spec, seed, n_keys, n_rows, unique):
    """Some keys are stored only, some new, some hit by hundreds of rows, most by a few."""
    pick = random.Random(seed)
    stored = {
        key_of(spec, k): {**random_row(pick, spec, 3), "created_at": THEN, "updated_at": THEN}
        for k in range(n_keys) if pick.random() < 0.6}
    numbers = range(n_keys // 10, n_keys) if unique else (
        pick.choice((pick.randint(0, n_keys), pick.randint(0, 3))) for _ in range(n_rows))
    return stored, [(key_of(spec, k), random_row(pick, spec, 2)) for k in numbers]


@pytest.mark.parametrize("table", ["ship_status", "ship_voyage", "ship_events"])
@pytest.mark.parametrize("segment_rows", [7, 1_000_000])
def test_matches_row_by_row(spark, table, segment_rows):
    check(spark, SPECS[table], *random_case(SPECS[table], segment_rows, 1500, 4000, unique=False), segment_rows)


@pytest.mark.parametrize("null_safe", [False, True])
def test_berths_with_unique_keys(spark, null_safe):
    spec = SPECS["ship_berth_order"].variant(null_safe=null_safe)
    check(spark, spec, *random_case(spec, 5, 1500, 0, unique=True), 10)


def test_missing_report_keeps_the_time_but_counts_as_change(spark):
    spec = SPECS["ship_voyage"]
    old = {"pass_10_miles_time": THEN, "pass_5_miles_time": THEN, "created_at": THEN, "updated_at": THEN}
    state = frame(spark, [{"ship_voyage_number": "a", **old}], spec, ("created_at", "updated_at"))
    batch = frame(
        spark, [{"ship_voyage_number": "a", "pass_10_miles_time": None, "pass_5_miles_time": None, "seq": 0}],
        spec, ("seq",))
    merged = upsert(state, batch, spec, F.lit(NOW).cast("timestamp_ntz"))
    assert as_tuples(changes_of(merged)) == [("a", THEN, THEN, THEN, NOW, "update")]
    assert state_of(merged).columns == ["ship_voyage_number", *spec.payload, "created_at", "updated_at"]


def test_unknown_table_is_refused():
    with pytest.raises(ValueError, match="no such table"):
        spec_for("ship_crew")


def test_unfoldable_combinations_are_refused(spark):
    state = frame(spark, [], SPECS["ship_berth_order"], ("created_at", "updated_at"))
    batch = frame(spark, [], SPECS["ship_berth_order"], ("seq",))
    with pytest.raises(ValueError, match="last row counts"):
        upsert(state, batch, SPECS["ship_berth_order"].variant(last_only=False), F.current_timestamp())
    with pytest.raises(ValueError, match="null-safe"):
        upsert(state, batch, SPECS["ship_berth_order"].variant(
            last_only=False, merge=COALESCE), F.current_timestamp())
