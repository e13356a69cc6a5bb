"""Table schemas, keys and length limits. Times are UTC without a zone."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS = T.StringType(), T.TimestampNTZType()


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


PAGES = _schema(
    ("crawl_id", _S), ("page_no", T.LongType()), ("url", _S), ("html", _S),
)

SHIP_STATUS = _schema(
    ("ship_voyage_number", _S), ("ship_name", _S), ("latest_event", _S),
    ("created_at", _TS), ("updated_at", _TS),
)

SHIP_BERTH_ORDER = _schema(
    ("berth_number", _S), ("berthing_time", _TS), ("ship_status", _S), ("pilotage_time", _TS),
    ("ship_name_chinese", _S), ("ship_name_english", _S), ("port_agent", _S),
    ("created_at", _TS), ("updated_at", _TS),
)

SHIP_VOYAGE = _schema(
    ("ship_voyage_number", _S), ("pass_10_miles_time", _TS), ("pass_5_miles_time", _TS),
    ("created_at", _TS), ("updated_at", _TS),
)

SHIP_EVENTS = _schema(
    ("id", T.LongType()), ("ship_voyage_number", _S), ("event_source", _S), ("event_time", _TS),
    ("event_name", _S), ("navigation_status", _S), ("pilot_order_number", _S),
    ("berth_number", _S), ("event_content_time", _TS),
)

# Kept up to date from the changes of the others: newest announced arrival and departure of a voyage, newest
# queue entry of a Chinese name, and the voyages that a ship name has had.
ANNOUNCED_TIMES = _schema(
    ("ship_voyage_number", _S), ("eta_reported", _TS), ("eta", _TS), ("etd_reported", _TS), ("etd", _TS),
)

NAME_AGENTS = _schema(
    ("ship_name_chinese", _S), ("changed_at", _TS), ("berth_number", _S), ("ship_status", _S), ("port_agent", _S),
)

SHIP_NAMES = _schema(
    ("ship_name", _S), ("ship_voyage_number", _S), ("seen_at", _TS),
)

TABLES = {
    "ship_status": SHIP_STATUS,
    "ship_berth_order": SHIP_BERTH_ORDER,
    "ship_voyage": SHIP_VOYAGE,
    "ship_events": SHIP_EVENTS,
}

DERIVED = {
    "announced_times": ANNOUNCED_TIMES,
    "name_agents": NAME_AGENTS,
    "ship_names": SHIP_NAMES,
}

KEYS = {
    "ship_status": ("ship_voyage_number",),
    "ship_berth_order": ("berth_number", "ship_name_chinese", "ship_status"),
    "ship_voyage": ("ship_voyage_number",),
    "ship_events": ("ship_voyage_number", "event_time", "event_name"),
    "announced_times": ("ship_voyage_number",),
    "name_agents": ("ship_name_chinese",),
    "ship_names": ("ship_name", "ship_voyage_number"),
}

# Columns that may not be NULL: the primary keys, plus the event time on which the
# latest-event operators order.
REQUIRED = {
    "ship_status": ("ship_voyage_number", "ship_name"),
    "ship_berth_order": KEYS["ship_berth_order"],
    "ship_voyage": KEYS["ship_voyage"],
    "ship_events": KEYS["ship_events"],
}

# Longest text each column takes.
LENGTHS = {
    "ship_status": {"ship_voyage_number": 10, "ship_name": 100, "latest_event": 100},
    "ship_berth_order": {
        "berth_number": 10, "ship_status": 10, "ship_name_chinese": 50,
        "ship_name_english": 50, "port_agent": 50,
    },
    "ship_voyage": {"ship_voyage_number": 10},
    "ship_events": {
        "ship_voyage_number": 10, "event_source": 50, "event_name": 100,
        "navigation_status": 50, "pilot_order_number": 20, "berth_number": 10,
    },
}

# Scraped column titles and the names used here.
STATUS_TITLES = (
    "船編航次", "船名", "最新事件", "進港申請", "移泊申請", "出港申請", "港外船舶進港", "錨泊中",
    "進港作業中", "裝卸須知", "移泊作業中", "移泊裝卸作業", "出港作業中", "船舶已出港",
)
EVENT_TITLES = {
    "事件來源": "event_source", "發生時間": "event_time", "事件名稱": "event_name",
    "航行狀態": "navigation_status", "引水單序號": "pilot_order_number",
    "碼頭代碼": "berth_number", "事件內容": "event_content",
}
MILE_TITLES = {"10浬": "pass_10_miles_time", "5浬": "pass_5_miles_time"}
BERTH_TITLES = {
    "船席": "berth_number", "靠泊時間": "berthing_time", "動態": "ship_status",
    "引水時間": "pilotage_time", "中文船名": "ship_name_chinese",
    "英文船名": "ship_name_english", "港代理": "port_agent",
}
