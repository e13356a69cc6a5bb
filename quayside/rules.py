"""Alert rules: which event concerns whom, and how events are named."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# ---- Fixed values -------------------------------------------------------------------
ETA_REVISION = "修改進港預報"
ETD_REVISION = "修改出港預報"
FIVE_MILE_EVENT = "通過5浬時間"
TEN_MILE_EVENT = "通過10浬時間"
MILE_SOURCE = "VTS轉檔"
BERTHED, PILOTED = "靠泊", "引水"
STATUS_FORMAT, BERTH_FORMAT = "一般訊息", "接靠順序"
NO_BERTH, NO_AGENT = "0000", "NO PORT AGENT"
MASTER_GROUP = "__master__"

YANG_MING, WAN_HAI = "陽明海運", "萬海航運公司"
PIERS_LIEN_HAI = ("1042", "1043")
PIERS_SELF_OPERATED = ("1120", "1121")
FLEET = ("永明", "文明", "好明", "續明", "吉春", "長春輪", "星春輪", "石春", "遠明", "昇春")

# Events whose name gets the navigation status appended.
SUFFIXED_EVENTS = (
    "新增引水申請", "更新引水時間", "引水人上船時間", "引水人出發", "引水人排班", "海巡署審核", "移民署審核",
)
# Events for which the ship's berth is copied into the alert.
BERTH_EVENTS = (
    "新增引水申請 (進港)", "更新引水時間 (進港)", "船長報告ETA", "引水人出發 (進港)", "實際靠妥時間",
    "新增引水申請 (出港)", "更新引水時間 (出港)", "引水人出發 (出港)", "引水人上船時間 (進港)",
)
# Events reported with the voyage's update time instead of the event time.
VOYAGE_TIMED_EVENTS = ("",)

_BASE = ("Pilot", "CIQS", "ShippingAgentWanHai")
_DISTANT = ("ShippingAgent", "ShippingCompany", "Pilot", "Tugboat")
_NEAR = ("Pilot", "Unmooring", "Tugboat", "ShippingAgentWanHai", "ShippingCompanyYangMing", "LoadingUnloading")

# Event name -> stakeholders, in the order in which a digest lists them.
RECIPIENTS: dict[str, tuple[str, ...]] = {
    "進港預報申請": _BASE,
    "修改進港預報": (*_BASE, "Unmooring"),
    "新增引水申請 (進港)": (*_BASE, "Tugboat"),
    "更新引水時間 (進港)": (*_BASE, "Unmooring", "Tugboat"),
    "船席異動": (*_BASE, "Unmooring"),
    "船長報告ETA": (*_BASE, "Tugboat"),
    "引水人排班 (進港)": _BASE,
    "引水人出發 (進港)": (*_BASE, "UNMOORING", "LoadingUnloading", "Tugboat"),
    "引水人上船時間 (進港)": (
        "Pilot", "CIQS", "PierLienHai", "PierSelfOperated", "ShippingCompanyYangMing", "ShippingAgentWanHai",
    ),
    "申請進港": _BASE,
    "經過信號台 (進港)": (*_BASE, "Unmooring"),
    "實際靠妥時間": _BASE,
    "海巡署審核 (進港)": _BASE,
    "移民署審核 (進港)": _BASE,
    "出港預報申請": _BASE,
    "修改出港預報": (*_BASE, "Unmooring"),
    "海巡署審核 (出港)": _BASE,
    "移民署審核 (出港)": _BASE,
    "新增引水申請 (出港)": (*_BASE, "Tugboat"),
    "更新引水時間 (出港)": (*_BASE, "Unmooring", "Tugboat"),
    "引水人排班 (出港)": _BASE,
    "引水人出發 (出港)": (
        "Pilot", "CIQS", "ShippingCompanyYangMing", "ShippingAgentWanHai", "Unmooring", "Tugboat",
    ),
    "引水人上船時間 (出港)": _BASE,
    "離開泊地時間": _DISTANT,
    "通過15浬時間": _DISTANT,
    TEN_MILE_EVENT: _NEAR,
    FIVE_MILE_EVENT: _NEAR,
}

# Stakeholders that have a condition; any other name never passes.
KNOWN_STAKEHOLDERS = (
    "Pilot", "CIQS", "PierLienHai", "PierSelfOperated", "ShippingCompanyYangMing",
    "ShippingAgentWanHai", "Unmooring", "LoadingUnloading", "Tugboat",
)
# ---- End of fixed values ------------------------------------------------------------


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rule_values() -> str:
    """The rules as VALUES rows ``(event_name, position, stakeholder)``."""
    return ", ".join(
        f"({sql_text(event)}, {position}, {sql_text(stakeholder)})"
        for event, names in RECIPIENTS.items()
        for position, stakeholder in enumerate(names)
    )


def rule_table(spark: SparkSession) -> DataFrame:
    """``(event_name, stakeholders ARRAY<STRING>)``, one row per event with a rule."""
    rows = ", ".join(
        f"({sql_text(event)}, array({', '.join(map(sql_text, names))}))" for event, names in RECIPIENTS.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r(event_name, stakeholders)")


def rule_versions(spark: SparkSession, versions: Sequence[tuple[str, Mapping[str, tuple[str, ...] | None]]]) -> DataFrame:
    """``(event_name, valid_from, stakeholders)`` of versions, each with the time from which it holds and the rules
    that change with it; None ends a rule."""
    rows = ", ".join(
        f"({sql_text(event)}, TIMESTAMP_NTZ {sql_text(valid_from)}, "
        + ("CAST(NULL AS array<string>)" if names is None else f"CAST(array({', '.join(map(sql_text, names))}) AS array<string>)") + ")"
        for valid_from, changed in versions for event, names in changed.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r(event_name, valid_from, stakeholders)")


def channel_table(spark: SparkSession, configured: tuple[str, ...]) -> DataFrame:
    """``(stakeholder, configured)``: who can be reached. Holds no secrets."""
    rows = ", ".join(
        f"({sql_text(name)}, {'true' if name in configured else 'false'})" for name in KNOWN_STAKEHOLDERS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS c(stakeholder, configured)")
