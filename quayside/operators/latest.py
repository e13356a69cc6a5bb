"""Newest row per key.

All forms combine on the map side before they shuffle by key, so a key with a third of all rows
sends one row per task and not its whole history.

To combine rows that hold texts Spark sorts them, and the more rows a task has, the more memory that takes. Stored
rows are packed many times smaller than they are, so a part of a file may be far too much: see ``in_even_parts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts over which the rows of one key may lie.
KEY_PARTS = 8
# Spark writes a shuffle into up to 200 parts straight to files; for more it holds all rows of a task in memory first.
EVEN_PARTS = 200


def in_even_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, dealt to tasks by their bytes and not by the files they lie in.

    Rows of a key stay together but for ``KEY_PARTS`` parts, so that they still combine before the shuffle by key,
    and a hot one is shared out. Adaptive execution gathers and cuts what the tasks get; without it, this does nothing.
    They are at most ``EVEN_PARTS`` parts to begin with, so that a task that reads a large part of a file does not hold it.
    """
    rest = [name for name in df.columns if name not in keys]
    part = F.pmod(F.xxhash64(*rest), F.lit(KEY_PARTS)) if rest else F.lit(0)
    parts = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), EVEN_PARTS)
    # By a hash, as a shuffle by the keys themselves would be taken for the one that follows.
    return df.withColumn("_even_part", F.hash(*keys, part)).hint("rebalance", parts, F.col("_even_part")).drop("_even_part")


def newest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key: the one greatest by ``order`` (NULL is least).

    ``values`` break what ties remain, so the choice never depends on the row order.
    """
    ordering = [F.col(name).alias(f"o{i}") for i, name in enumerate(order)]
    newest = F.max(F.struct(*ordering, *values))
    wanted = dict.fromkeys([*keys, *order, *values])
    return in_even_parts(df.select(*wanted), keys).groupBy(*keys).agg(newest.alias("_newest")).select(
        *keys, *(F.col(f"_newest.{name}").alias(name) for name in values)
    )


def newest_with_ties(df: DataFrame, key: str, time: str) -> DataFrame:
    """All rows at the newest ``time`` of their key (rank 1, ties kept).

    The semi-join is on key *and* time, so the rows of one hot key spread by time.
    """
    newest = df.groupBy(key).agg(F.max(time).alias(time))
    return df.join(newest, [key, time], "left_semi")


def keep_last(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The last row to arrive per key; NULL keys count as equal."""
    rest = [name for name in df.columns if name not in keys]
    return newest_row(df, keys, [arrival], rest).select(*df.columns)
