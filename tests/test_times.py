from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import times

ERA = {
    "113/05/01 10:30": datetime(2024, 5, 1, 2, 30),
    "113/5/1 07:00:30": datetime(2024, 4, 30, 23, 0, 30),
    "113/5/1 7:5": datetime(2024, 4, 30, 23, 5),
    "待接靠": None, "null": None, "": None, None: None,
    "2024-05-01 10:30:00": datetime(2024, 5, 1, 10, 30),
    "113/13/01 10:30": "reject", "113/05/01": "reject", "113/05/01 24:00": "reject",
    "113/05/01 10:60": "reject", "113/05/01 10:30:60": "reject", "113/02/30 10:30": "reject",
    "113/05/01  10:30": "reject", "not a time": "reject",
    "9000/01/01 00:00": "reject", "8088/12/31 10:00": datetime(9999, 12, 31, 2, 0), "0/1/1 08:00": datetime(1911, 1, 1),
}
MERIDIEM = {
    "2024/5/1 下午 03:04:05": datetime(2024, 5, 1, 7, 4, 5),
    "2024/5/1 下午 12:30:00": datetime(2024, 5, 1, 4, 30),
    "2024/5/1 上午 12:30:00": datetime(2024, 4, 30, 16, 30),
    "2024/5/1 AM 03:04:05": datetime(2024, 4, 30, 19, 4, 5),
    "2024/5/1 下午 13:00:00": "reject", "2024/5/1 下午 00:10:00": "reject",
    "2024/5/1 03:04:05": "reject", "24/5/1 下午 03:04:05": "reject", "0000/5/1 下午 03:04:05": "reject",
    "2024/5/1 下午 x 03:04:05": datetime(2024, 4, 30, 19, 4, 5), "": "reject", None: "reject",
}
CONTENT = {
    "113/05/01 10:30": datetime(2024, 5, 1, 2, 30),
    "  113/05/01   10:30:15 ": datetime(2024, 5, 1, 2, 30, 15),
    "202405011030": datetime(2024, 5, 1, 2, 30),
    "": None, "null": None, None: None, "靠泊": None, "abc/def": None, "113/05 10:30": None,
    "twelve chars": "reject", "000001010000": "reject", "9999/1/1 00:00": "reject", "202413011030": "reject", "113/13/01 10:30": "reject", "113/05/01 soon": "reject",
}


@pytest.mark.parametrize(
    ("cases", "value", "rejected"),
    [
        (ERA, times.era_time, times.era_time_rejected),
        (MERIDIEM, times.meridiem_time, times.meridiem_time_rejected),
        (CONTENT, times.content_time, times.content_time_rejected),
    ],
)
def test_parsers(spark, cases, value, rejected):
    df = spark.createDataFrame([(text,) for text in cases], "text string")
    got = {r.text: "reject" if r.bad else r.value for r in df.select(
        "text", value(F.col("text")).alias("value"), rejected(F.col("text")).alias("bad")).collect()}
    assert got == cases


def test_results_carry_no_zone(spark):
    df = spark.createDataFrame([("113/05/01 10:30",)], "text string")
    assert df.select(times.era_time(F.col("text")).alias("t")).schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_display(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 1, 20, 5, 7),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(times.display_time(F.col("t"))).collect()] == ["2024/05/02 04:05:07", "None"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(datetime(1950, 1, 1), datetime(2100, 1, 1)), min_size=50, max_size=50))
def test_round_trip(spark, moments):
    moments = [m.replace(microsecond=0) for m in moments]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    local = times.to_local(F.col("t"))
    from quayside.plans.text_queries import era_text, meridiem_text

    back = df.select(
        "t", times.era_time(era_text(local, "M/d H:m:s")).alias("a"), times.meridiem_time(meridiem_text(local)).alias("b"),
        times.content_time(era_text(local, "MM/dd HH:mm:ss")).alias("c"))
    assert all(r.t == r.a == r.b == r.c for r in back.collect())
