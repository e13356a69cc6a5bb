"""Alert texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.times import display_time


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), F.coalesce(value, F.lit("None")))


def _ship_lines() -> list[Column]:
    return [
        F.lit("\n"),
        _line("船名", F.col("ship_name")),
        _line("船編", F.col("ship_id")),
        _line("航次", F.col("voyage_serial")),
        _line("ETA", display_time(F.col("eta"))),
        _line("ETD", display_time(F.col("etd"))),
        F.lit(""),
    ]


def _update_lines() -> list[Column]:
    shown = F.when(F.col("update_time").isNull(), F.lit("N/A")).otherwise(display_time(F.col("update_time")))
    return [F.lit(""), F.lit("更新時間: "), shown]


def status_message() -> Column:
    """Text of a status alert, from the columns of a status alert row."""
    return F.concat_ws(
        "\n",
        *_ship_lines(),
        _line("最新事件", F.col("event_name")),
        _line("事件時間", display_time(F.col("event_time"))),
        _line("事件來源", F.col("event_source")),
        *_update_lines(),
    )


def berth_message() -> Column:
    """Text of a berth alert: the ship ahead in this berth has moved."""
    moved = F.concat(
        F.lit("前一艘船舶"), F.col("event_name"), F.lit("時間: "), display_time(F.col("event_time"))
    )
    return F.concat_ws("\n", *_ship_lines(), _line("碼頭代號", F.col("berth_number")), moved, *_update_lines())


def digest_message(message: Column, stakeholders: Column) -> Column:
    """The text for the master group: who was told, then the message itself."""
    return F.concat(F.lit("\n通知對象: \n"), F.array_join(stakeholders, "\n"), message)
