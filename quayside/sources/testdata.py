"""Port tables projected from the provided tables.

Each projection is written once, in SQL both Spark and an ANSI oracle read; ``TS`` stands
for the zone-less timestamp type, which the two spell differently. A key of more than
99,999 customers runs over into the voyage serial; the fixture ends where the serial has more than
four digits, at 999,900,000 customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.latest import keep_last
from quayside.rules import ETA_REVISION, ETD_REVISION, WAN_HAI, YANG_MING

AS_OF = "2024-01-31 00:00:00"
LOOK_BACK_HOURS = 48
CUTOFF = "2024-01-29 00:00:00"

# Name stems, picked by customer key.
STEMS = ("永明", "文明", "好明", "續明", "吉春", "長春輪", "星春輪", "石春", "遠明", "昇春", "海皇", "東方")
BERTHS = 130


def _case(value: str, choices: dict[int, str], last: str) -> str:
    arms = " ".join(f"WHEN {value} = {key} THEN {result}" for key, result in choices.items())
    return f"CASE {arms} ELSE {last} END"


def voyage_key(key: str) -> str:
    turn = f"cast(cast(floor({key} / 100000) as bigint) + 1 as string)"
    return f"'V' || lpad(cast({key} % 100000 as string), 5, '0') || lpad({turn}, 4, '0')"


def chinese_name(key: str) -> str:
    stem = _case(f"{key} % 12", {i: f"'{s}'" for i, s in enumerate(STEMS[:-1])}, f"'{STEMS[-1]}'")
    return f"{stem} || cast({key} as string)"


def hours(count: str) -> str:
    return f"(INTERVAL '1' HOUR) * cast({count} as int)"


_AS_OF = f"cast('{AS_OF}' as TS)"
_STATUS_TIME = f"{_AS_OF} - {hours('12 * (c_custkey % 10)')}"
_VOYAGE_TIME = f"{_AS_OF} - {hours('12 * (c_custkey % 7)')}"

# name -> (source table, row filter or None, {column: expression})
PROJECTIONS: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "fx_ship": ("customer", None, {
        "c_custkey": "c_custkey",
        "ship_voyage_number": voyage_key("c_custkey"),
        "zh": chinese_name("c_custkey"),
        "en": "'SHIP' || cast(c_custkey as string)",
    }),
    "fx_status": ("customer", None, {
        "c_custkey": "c_custkey",
        "ship_voyage_number": voyage_key("c_custkey"),
        "ship_name": f"{chinese_name('c_custkey')} || 'SHIP' || cast(c_custkey as string)",
        "latest_event": _case("c_custkey % 5", {
            0: f"'{ETA_REVISION}'", 1: f"'{ETD_REVISION}'", 2: "'更新引水時間'", 3: "'實際靠妥時間'",
        }, "NULL"),
        "created_at": f"{_STATUS_TIME} - {hours('24')}",
        "updated_at": _STATUS_TIME,
    }),
    "fx_voyage": ("customer", "c_mktsegment <> 'HOUSEHOLD'", {
        "ship_voyage_number": voyage_key("c_custkey"),
        "pass_10_miles_time": f"CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {_VOYAGE_TIME} - {hours('2')} END",
        "pass_5_miles_time": f"CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE {_VOYAGE_TIME} - {hours('1')} END",
        "created_at": f"{_VOYAGE_TIME} - {hours('24')}",
        "updated_at": _VOYAGE_TIME,
    }),
    "fx_events": ("events", None, {
        "ship_voyage_number": voyage_key("user_id"),
        "event_source": "'SRC' || cast(event_id % 3 as string)",
        "event_time": "cast(date_trunc('hour', ts) as TS)",
        "event_name": (
            f"CASE event_type WHEN 'signup' THEN '{ETA_REVISION}' WHEN 'error' THEN '{ETD_REVISION}'"
            " WHEN 'click' THEN '更新引水時間' WHEN 'view' THEN '實際靠妥時間' ELSE '引水人出發' END"
        ),
        "navigation_status": (
            "CASE WHEN event_id % 2 = 0 THEN '進港' WHEN event_id % 11 = 0 THEN NULL ELSE '出港' END"
        ),
        "pilot_order_number": "cast(event_id as string)",
        "berth_number": f"cast(1000 + user_id % {BERTHS} as string)",
        "event_content_time": (
            "CASE WHEN event_id % 7 = 0 THEN NULL"
            f" ELSE cast(date_trunc('minute', ts) as TS) + {hours('6')} END"
        ),
        "seq": "event_id",
    }),
    "fx_berth_raw": ("orders", None, {
        "berth_number": f"cast(1000 + (o_custkey * 7 + o_orderkey) % {BERTHS} as string)",
        "berthing_time": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END",
        "ship_status": "o_orderstatus",
        "pilotage_time": f"o_orderdate - {hours('o_orderkey % 12')}",
        "ship_name_chinese": chinese_name("o_custkey"),
        "ship_name_english": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'SHIP' || cast(o_custkey as string) END",
        "port_agent": _case(
            "o_custkey % 4", {0: f"'{YANG_MING}'", 1: f"'{WAN_HAI}'", 2: "'其他代理'"}, "NULL"),
        "updated_at": f"{_AS_OF} - {hours('o_orderkey % 200')}",
        "seq": "o_orderkey",
    }),
}
BERTH_KEYS = ("berth_number", "ship_name_chinese", "ship_status")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``PROJECTIONS`` as a DataFrame, or ``fx_berth`` (its raw rows, last kept)."""
    if name == "fx_berth":
        return keep_last(project(spark, sf_dir, "fx_berth_raw"), BERTH_KEYS, "seq")
    source, condition, columns = PROJECTIONS[name]
    df = table(spark, sf_dir, source)
    if condition:
        df = df.filter(condition)
    spelled = (f"{e.replace(' TS)', ' timestamp_ntz)')} AS {c}" for c, e in columns.items())
    return df.selectExpr(*spelled)


def _oracle_select(name: str) -> str:
    if name == "fx_berth":
        keys = ", ".join(BERTH_KEYS)
        return (
            "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER"
            f" (PARTITION BY {keys} ORDER BY seq DESC) AS rn FROM fx_berth_raw) WHERE rn = 1"
        )
    source, condition, columns = PROJECTIONS[name]
    spelled = ", ".join(f"{e.replace(' TS)', ' timestamp)')} AS {c}" for c, e in columns.items())
    return f"SELECT {spelled} FROM {source}" + (f" WHERE {condition}" if condition else "")


def oracle_with(*names: str) -> str:
    """``WITH`` clause that defines the named projections for the oracle."""
    if "fx_berth" in names:
        names = (*(n for n in names if n not in ("fx_berth", "fx_berth_raw")), "fx_berth_raw", "fx_berth")
    return "WITH " + ",\n".join(f"{n} AS ({_oracle_select(n)})" for n in names)
