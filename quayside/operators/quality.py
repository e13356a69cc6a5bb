"""Checks that split a table into rows to keep and rows to reject, with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_reasons(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Adds ``reject_reason``: the first check that holds, NULL for a good row."""
    reason = F.lit(None).cast("string")
    for name, failed in reversed(checks.items()):
        reason = F.when(F.coalesce(failed, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNotNull())


def fail_on_reject(df: DataFrame) -> DataFrame:
    """The strict variant: the job stops at the first bad row."""
    bad = F.col("reject_reason")
    stop = F.raise_error(F.concat(F.lit("bad row: "), bad)).cast("boolean")
    # A filter, because a column nobody selects would never be computed.
    return df.filter(F.when(bad.isNotNull(), stop).otherwise(True)).drop("reject_reason")


def required_checks(columns: Sequence[str]) -> dict[str, Column]:
    return {f"null_{name}": F.col(name).isNull() for name in columns}


def length_checks(limits: Mapping[str, int]) -> dict[str, Column]:
    """Longer than the limit; blanks beyond it do not count."""
    return {f"long_{name}": F.char_length(F.rtrim(name)) > limit for name, limit in limits.items()}


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
