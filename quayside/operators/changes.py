"""Change tests between a new and a stored row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs_plain(new: Column, old: Column) -> Column:
    """SQL ``<>``; unknown (a NULL on either side) counts as no change."""
    return F.coalesce(new != old, F.lit(False))


def differs_null_safe(new: Column, old: Column) -> Column:
    """SQL ``IS DISTINCT FROM``."""
    return ~new.eqNullSafe(old)


def any_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
