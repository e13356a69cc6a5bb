"""Crawl files into the stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from quayside.sources.state import StateTable


def upsert_stream(
    rows: DataFrame, table: StateTable, checkpoint: str, as_of: Callable[[int], Column], crawl: str | None = None
) -> StreamingQuery:
    """Upserts everything that has landed, then stops; run it again after the next crawl.

    A micro-batch takes all that has landed, maybe several crawls. ``crawl`` names the column
    with their numbers; they are then applied in that order, each stamped with ``as_of`` of its
    number. Without it, each micro-batch must be one crawl and is stamped by its batch number.
    Either way it is published as the version of its batch number, so one that is run again
    after a failure replaces its first attempt.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id, as_of if crawl else as_of(batch_id), crawl=crawl)

    return (
        rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
