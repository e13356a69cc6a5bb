"""Position and next row in an ordered group that may be too big for one task.

A group is cut into segments that follow its sort order (for times: hours). Windows run
inside a segment; only one summary row per segment is ordered over the whole group. The
caller names the segment column: its values must rise along the order (NULL is the last segment),
and a row's segment must depend on the row alone, so that a rerun task cuts the group at the same
places. NULL keys make a group like others.

Where no column cuts a group evenly (all of a queue in one hour, or without any time), ``with_ranges``
makes the segments from a sample: ranges of the order that hold about as many rows each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import scratch_folder

#: Ranges that all groups together are cut into, and rows sampled to find them.
RANGES, SAMPLED = 512, 1 << 16


def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_last(name) for name in order]


def _sort_struct(order: Sequence[str]) -> list[Column]:
    """Struct fields that compare like ``order`` with NULLs last."""
    fields = []
    for i, name in enumerate(order):
        fields += [F.isnull(name).alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return fields


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join in which NULL keys meet; the keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({name: f"_key_{name}" for name in keys})
    condition = F.lit(True)
    for name in keys:
        condition &= left[name].eqNullSafe(renamed[f"_key_{name}"])
    return left.join(renamed, condition).drop(*(f"_key_{name}" for name in keys))


def range_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int = RANGES, sampled: int = SAMPLED) -> DataFrame:
    """``(*keys, cuts)``: places along ``order`` at which a group is cut, about ``ranges`` over all groups.

    Every so many sampled rows of a group are a cut, so a group has cuts in proportion to its rows, and
    most have none. The cuts are stored, since another sample would cut elsewhere.
    """
    rows = df.count()
    along = Window.partitionBy(*keys).orderBy("at")
    found = (
        df.select(*keys, F.struct(*_sort_struct(order)).alias("at"))
        .sample(min(1.0, sampled / max(1, rows)), seed=17)
        .withColumn("n", F.row_number().over(along))
        .filter(F.col("n") % max(1, -(-min(rows, sampled) // ranges)) == 0)
        .groupBy(*keys).agg(F.collect_set("at").alias("cuts"))
    )
    path = scratch_folder(df.sparkSession, "range-cuts")
    found.coalesce(1).write.parquet(path)
    return df.sparkSession.read.schema(found.schema).parquet(path)


def with_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "segment", ranges: int = RANGES, sampled: int = SAMPLED
) -> DataFrame:
    """Adds segments that rise along ``order`` and hold about equally many rows, however the values lie.

    A row's segment is the number of its group's cuts up to it. Rows alike in all of ``order`` stay
    together, so the order should end in what tells rows apart. ``df`` is read twice before the result is, for its
    size and for the sample.
    """
    # Some ``ranges`` cuts go to every task, whatever the size of the table.
    cuts = range_cuts(df, keys, order, ranges, sampled).withColumnsRenamed({k: f"_key_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition &= df[key].eqNullSafe(F.col(f"_key_{key}"))
    at = F.struct(*_sort_struct(order))
    return (
        df.withColumn("_at", at).join(F.broadcast(cuts), condition, "left")
        .withColumn(name, F.coalesce(F.size(F.filter("cuts", lambda cut: cut <= F.col("_at"))), F.lit(0)))
        .drop("_at", "cuts", *(f"_key_{key}" for key in keys))
    )


def with_position(
    df: DataFrame, keys: Sequence[str], segment: str, order: Sequence[str], name: str = "position"
) -> DataFrame:
    """Row number within ``keys`` along ``order`` (NULLs last)."""
    inside = Window.partitionBy(*keys, segment).orderBy(*_nulls_last(order))
    before = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(segment)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys, segment).agg(F.count("*").alias("_rows"))
        .select(*keys, segment, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        _join_null_safe(df.withColumn("_local", F.row_number().over(inside)), offsets, [*keys, segment])
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_local", "_offset")
    )


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    segment: str,
    order: Sequence[str],
    values: Sequence[str],
    name: str = "next",
    only: Column | None = None,
) -> DataFrame:
    """Adds struct ``name`` holding ``values`` of the following row, NULL at the end.

    With ``only``, rows that fail it are followers but not results; segments without any
    such row are dropped before they are sorted.
    """
    group = [*keys, segment]
    wanted = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    heads = df.groupBy(*group).agg(
        F.min(F.struct(*_sort_struct(order), F.struct(*values).alias("row"))).alias("_head"),
        F.max(wanted).alias("_wanted"),
    )
    along = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(segment))
    # Every segment has a say in who follows, so the wanted ones are picked after the window.
    following = heads.select(*group, "_wanted", F.lead("_head.row").over(along).alias("_far")).filter("_wanted")
    inside = Window.partitionBy(*group).orderBy(*_nulls_last(order))
    return (
        _join_null_safe(df, following, group)
        .withColumn("_near", F.lead(F.struct(*values)).over(inside))
        .filter(wanted)
        .withColumn(name, F.coalesce("_near", "_far"))
        .drop("_near", "_far", "_wanted")
    )
