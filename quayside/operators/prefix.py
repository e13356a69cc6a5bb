"""Leading rows of a numbered grid, up to the first gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contiguous_prefix(rows: DataFrame, group: str, row: str, complete: str) -> DataFrame:
    """Rows 0..k-1 of each group, where k is the first number missing or not complete.

    A run ends at a complete row without a complete successor. Those are found by a join on
    (group, row), so one big group is spread over all tasks and never sorted as a whole.

    ``rows`` occurs three times in the plan. No occurrence has a filter of its own that could
    sink below the shuffle ``rows`` starts from, so that shuffle is computed once and reused.
    """
    whole = rows.filter(complete).select(group, row)
    successors = whole.select(group, F.col(row).alias("_after"), F.lit(True).alias("_followed"))
    ahead = whole.select(group, row, (F.col(row) + 1).alias("_after"))
    limits = (
        ahead.join(successors, [group, "_after"], "left")
        .groupBy(group)
        .agg(
            F.min(F.when(F.col("_followed").isNull(), F.col("_after"))).alias("_gap"),
            F.min(row).alias("_start"),
        )
        .select(group, F.when(F.col("_start") == 0, F.col("_gap")).otherwise(0).alias("_gap"))
    )
    return rows.join(limits, group).filter(F.col(row) < F.col("_gap")).drop("_gap")
