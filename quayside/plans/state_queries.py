"""Registered queries: upserts, change feed, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import schemas
from quayside.operators import quality
from quayside.operators.latest import keep_last, newest_row
from quayside.operators.upsert import SPECS, changes_of, upsert
from quayside.plans.alerts import moment
from quayside.plans.registry import query
from quayside.sources.testdata import AS_OF, BERTH_KEYS, oracle_with, project, table

_AS_OF = f"cast('{AS_OF}' as timestamp)"

# A batch of status reports: one per event, every tenth about a voyage not stored yet,
# every thirteenth without an event.
_STATUS_BATCH = {
    "ship_voyage_number": (
        "CASE WHEN seq % 10 = 0 THEN substr(ship_voyage_number, 1, 6) || '0002' ELSE ship_voyage_number END"
    ),
    "ship_name": "ship_voyage_number || '/' || cast(seq % 3 as string)",
    "latest_event": "CASE WHEN seq % 13 = 0 THEN NULL ELSE event_name END",
    "seq": "seq",
}
_EVENT_BATCH = {
    "ship_voyage_number": _STATUS_BATCH["ship_voyage_number"],
    "event_time": "event_time",
    "event_name": "event_name",
    "event_source": "event_source || 'b'",
    "navigation_status": "navigation_status",
    "pilot_order_number": "pilot_order_number",
    "berth_number": "berth_number",
    "event_content_time": (
        "CASE WHEN seq % 4 = 0 THEN event_content_time + (INTERVAL '1' HOUR) WHEN seq % 9 = 0 THEN NULL"
        " ELSE event_content_time END"
    ),
    "seq": "seq",
}
_DAY_BATCH = {
    **{name: name for name in _EVENT_BATCH},
    "event_time": "cast(date_trunc('day', event_time) as TS)",
    "event_content_time": (
        "CASE WHEN seq % 7 = 0 THEN NULL ELSE cast(date_trunc('day', event_time) as TS)"
        " + (INTERVAL '1' HOUR) * cast(floor(seq / 8) % 3 as int) END"
    ),
}
_BERTH_BATCH = {
    "berth_number": "berth_number",
    "ship_name_chinese": "ship_name_chinese",
    "ship_status": "CASE WHEN seq % 10 = 0 THEN 'new' ELSE ship_status END",
    "berthing_time": "CASE WHEN seq % 6 = 0 THEN berthing_time + (INTERVAL '1' HOUR) ELSE berthing_time END",
    "pilotage_time": "CASE WHEN seq % 8 = 0 THEN NULL ELSE pilotage_time END",
    "ship_name_english": "ship_name_english",
    "port_agent": "CASE WHEN seq % 7 = 0 THEN '新代理' ELSE port_agent END",
    "seq": "seq",
}
# Two reports per ship; by key: as stored, missing, new, new then missing, missing then as stored.
_MILES = {
    "ship_voyage_number": "ship_voyage_number",
    "pass_10_miles_time": (
        "CASE WHEN k % 5 = 0 OR (k % 5 = 4 AND turn = 1) THEN old_10"
        " WHEN k % 5 = 2 OR (k % 5 = 3 AND turn = 0) THEN report ELSE NULL END"
    ),
    "pass_5_miles_time": (
        "CASE WHEN k % 5 = 0 OR (k % 5 = 4 AND turn = 1) THEN old_5"
        " WHEN k % 5 = 2 OR (k % 5 = 3 AND turn = 0) THEN report ELSE NULL END"
    ),
    "seq": "turn",
}


def _spark_sql(columns: dict[str, str]) -> list[str]:
    return [f"{e.replace(' TS)', ' timestamp_ntz)')} AS {c}" for c, e in columns.items()]


def _oracle_sql(columns: dict[str, str]) -> str:
    return ", ".join(f"{e.replace(' TS)', ' timestamp)')} AS {c}" for c, e in columns.items())


def _folded(spec_name: str, null_safe: bool, old: str = "state") -> str:
    """Oracle CTEs for ``batch`` folded onto a stored table: the result is ``merged``."""
    spec = SPECS[spec_name]
    keys, (watched,) = ", ".join(spec.keys), spec.watched
    same = " AND ".join(f"s.{k} = f.{k}" for k in spec.keys)
    counted = "TRUE" if null_safe else f"{watched} IS NOT NULL"
    payload = ", ".join(
        f"CASE WHEN kind <> 'unchanged' THEN new_{c} ELSE old_{c} END AS {c}" for c in spec.payload)
    old_blocked = "FALSE" if null_safe else f"s.{watched} IS NULL"
    picked = ", ".join(
        "CASE WHEN s.present IS NULL AND f.raw_seq IS DISTINCT FROM f.first_seq THEN r." + c
        + " ELSE p." + c + f" END AS new_{c}, s.{c} AS old_{c}" for c in spec.payload)
    stamps = (
        f", CASE WHEN kind = 'insert' THEN {_AS_OF} ELSE old_created END AS created_at,"
        f" CASE WHEN kind <> 'unchanged' THEN {_AS_OF} ELSE old_updated END AS updated_at"
    ) if spec.stamped else ""
    old_stamps = ", s.created_at AS old_created, s.updated_at AS old_updated" if spec.stamped else ""
    return f"""
        runs AS (
            SELECT *, lag({watched}) OVER w AS before, row_number() OVER w AS place FROM batch WHERE {counted}
            WINDOW w AS (PARTITION BY {keys} ORDER BY seq)),
        firsts AS (SELECT {keys}, min(seq) AS raw_seq FROM batch GROUP BY {keys}),
        changes AS (
            SELECT {keys}, min(seq) AS first_seq,
                max(CASE WHEN place > 1 AND before IS DISTINCT FROM {watched} THEN seq END) AS change_seq
            FROM runs GROUP BY {keys}),
        folded AS (
            SELECT f.*, c.first_seq, c.change_seq, coalesce(c.change_seq, c.first_seq) AS pick_seq
            FROM firsts f LEFT JOIN changes c USING ({keys})),
        joined AS (
            SELECT {', '.join(f'coalesce(s.{k}, f.{k}) AS {k}' for k in spec.keys)}, {picked}{old_stamps},
                CASE WHEN s.present IS NULL THEN 'insert'
                    WHEN f.raw_seq IS NULL OR f.first_seq IS NULL OR {old_blocked} THEN 'unchanged'
                    WHEN f.change_seq IS NOT NULL OR o.{watched} IS DISTINCT FROM s.{watched} THEN 'update'
                    ELSE 'unchanged' END AS kind
            FROM (SELECT *, TRUE AS present FROM {old}) s FULL JOIN folded f ON {same}
            LEFT JOIN batch p ON p.seq = f.pick_seq {''.join(f' AND p.{k} = f.{k}' for k in spec.keys)}
            LEFT JOIN batch r ON r.seq = f.raw_seq {''.join(f' AND r.{k} = f.{k}' for k in spec.keys)}
            LEFT JOIN batch o ON o.seq = f.first_seq {''.join(f' AND o.{k} = f.{k}' for k in spec.keys)}),
        merged AS (SELECT {keys}, {payload}{stamps}, kind AS change_type FROM joined)"""


_STATUS_ORACLE = f"""{oracle_with('fx_status', 'fx_events')},
    state AS (SELECT * FROM fx_status), batch AS (SELECT {_oracle_sql(_STATUS_BATCH)} FROM fx_events),
    {_folded('ship_status', null_safe=False)}"""


def _merged_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = project(spark, sf_dir, "fx_events").selectExpr(*_spark_sql(_STATUS_BATCH))
    return upsert(project(spark, sf_dir, "fx_status"), batch, SPECS["ship_status"], moment(AS_OF))


@query("upsert_status", f"{_STATUS_ORACLE} SELECT * FROM merged")
def upsert_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_status(spark, sf_dir)


@query("change_feed_status", f"""{_STATUS_ORACLE}
    SELECT ship_voyage_number, latest_event, change_type FROM merged WHERE change_type <> 'unchanged'""")
def change_feed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_of(_merged_status(spark, sf_dir)).select("ship_voyage_number", "latest_event", "change_type")


_FIRST_EVENTS = """
    state AS (SELECT * FROM (SELECT *, row_number() OVER
        (PARTITION BY ship_voyage_number, event_time, event_name ORDER BY seq) AS rn FROM fx_events) WHERE rn = 1)"""


@query("upsert_events", f"""{oracle_with('fx_events')}, {_FIRST_EVENTS},
    batch AS (SELECT {_oracle_sql(_EVENT_BATCH)} FROM fx_events), {_folded('ship_events', null_safe=True)}
    SELECT * FROM merged""")
def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SPECS["ship_events"]
    events = project(spark, sf_dir, "fx_events")
    stored = newest_row(events.withColumn("_first", -F.col("seq")), spec.keys, ["_first"], spec.payload)
    return upsert(stored, events.selectExpr(*_spark_sql(_EVENT_BATCH)), spec, moment(AS_OF))


@query("upsert_fold_in_batch", f"""{oracle_with('fx_events')},
    state AS (SELECT * FROM fx_events WHERE FALSE),
    batch AS (SELECT {_oracle_sql(_DAY_BATCH)} FROM fx_events), {_folded('ship_events', null_safe=True)}
    SELECT * FROM merged""")
def upsert_fold_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into an empty table, with many rows per key. Segments are short, so keys span several."""
    events = project(spark, sf_dir, "fx_events")
    batch = events.selectExpr(*_spark_sql(_DAY_BATCH))
    return upsert(events.limit(0), batch, SPECS["ship_events"], moment(AS_OF), segment_rows=500)


@query("upsert_berth", f"""{oracle_with('fx_berth')},
    state AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
        (PARTITION BY {', '.join(BERTH_KEYS)} ORDER BY seq) AS rn FROM fx_berth_raw) WHERE rn = 1),
    reported AS (SELECT {_oracle_sql(_BERTH_BATCH)} FROM fx_berth_raw),
    batch AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
        (PARTITION BY {', '.join(BERTH_KEYS)} ORDER BY seq DESC) AS rn FROM reported) WHERE rn = 1),
    joined AS (
        SELECT {', '.join(f'coalesce(s.{k}, b.{k}) AS {k}' for k in BERTH_KEYS)},
            CASE WHEN s.seq IS NULL THEN 'insert'
                WHEN {' OR '.join(f'b.{c} <> s.{c}' for c in SPECS['ship_berth_order'].watched)} THEN 'update'
                ELSE 'unchanged' END AS change_type,
            {', '.join(f's.{c} AS old_{c}, b.{c} AS new_{c}' for c in SPECS['ship_berth_order'].payload)},
            s.updated_at AS old_updated
        FROM state s FULL JOIN batch b ON {' AND '.join(f's.{k} = b.{k}' for k in BERTH_KEYS)})
    SELECT {', '.join(BERTH_KEYS)}, change_type,
        {', '.join(f"CASE WHEN change_type = 'unchanged' THEN old_{c} ELSE new_{c} END AS {c}"
                   for c in SPECS['ship_berth_order'].payload)},
        CASE WHEN change_type = 'insert' THEN {_AS_OF} ELSE old_updated END AS created_at,
        CASE WHEN change_type = 'unchanged' THEN old_updated ELSE {_AS_OF} END AS updated_at
    FROM joined""")
def upsert_berth(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = project(spark, sf_dir, "fx_berth_raw")
    stored = newest_row(
        raw.withColumn("_first", -F.col("seq")), BERTH_KEYS, ["_first"],
        [*SPECS["ship_berth_order"].payload, "updated_at"],
    ).withColumn("created_at", F.col("updated_at"))
    batch = keep_last(raw.selectExpr(*_spark_sql(_BERTH_BATCH)), BERTH_KEYS, "seq")
    return upsert(stored, batch, SPECS["ship_berth_order"], moment(AS_OF))


_MILE_SOURCE = """
    SELECT s.c_custkey AS k, s.ship_voyage_number, s.updated_at AS report, turn,
        v.pass_10_miles_time AS old_10, v.pass_5_miles_time AS old_5"""


@query("upsert_voyage", f"""{oracle_with('fx_status', 'fx_voyage')},
    reports AS (SELECT {_oracle_sql(_MILES)} FROM ({_MILE_SOURCE}
        FROM fx_status s CROSS JOIN (VALUES (0), (1)) AS t(turn)
        LEFT JOIN fx_voyage v ON v.ship_voyage_number = s.ship_voyage_number)),
    step0 AS (
        SELECT coalesce(v.ship_voyage_number, r.ship_voyage_number) AS ship_voyage_number,
            coalesce(r.pass_10_miles_time, v.pass_10_miles_time) AS p10,
            coalesce(r.pass_5_miles_time, v.pass_5_miles_time) AS p5, v.created_at, v.updated_at,
            v.ship_voyage_number IS NULL AS inserted,
            r.pass_10_miles_time IS DISTINCT FROM v.pass_10_miles_time
                OR r.pass_5_miles_time IS DISTINCT FROM v.pass_5_miles_time AS fired
        FROM (SELECT * FROM reports WHERE seq = 0) r
        LEFT JOIN fx_voyage v ON v.ship_voyage_number = r.ship_voyage_number),
    step1 AS (
        SELECT s.ship_voyage_number, coalesce(r.pass_10_miles_time, p10) AS pass_10_miles_time,
            coalesce(r.pass_5_miles_time, p5) AS pass_5_miles_time, created_at, updated_at, inserted,
            fired OR r.pass_10_miles_time IS DISTINCT FROM p10 OR r.pass_5_miles_time IS DISTINCT FROM p5 AS fired
        FROM step0 s JOIN reports r ON r.ship_voyage_number = s.ship_voyage_number AND r.seq = 1)
    SELECT ship_voyage_number, pass_10_miles_time, pass_5_miles_time,
        CASE WHEN inserted THEN {_AS_OF} ELSE created_at END AS created_at,
        CASE WHEN inserted OR fired THEN {_AS_OF} ELSE updated_at END AS updated_at,
        CASE WHEN inserted THEN 'insert' WHEN fired THEN 'update' ELSE 'unchanged' END AS change_type
    FROM step1""")
def upsert_voyage(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = project(spark, sf_dir, "fx_voyage")
    old = stored.select(
        "ship_voyage_number", F.col("pass_10_miles_time").alias("old_10"), F.col("pass_5_miles_time").alias("old_5"))
    reports = (
        project(spark, sf_dir, "fx_status")
        .select(F.col("c_custkey").alias("k"), "ship_voyage_number", F.col("updated_at").alias("report"))
        .join(old, "ship_voyage_number", "left")
        .withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
    )
    return upsert(stored, reports.selectExpr(*_spark_sql(_MILES)), SPECS["ship_voyage"], moment(AS_OF))


@query("key_audit", f"""{oracle_with('fx_events')}
    SELECT ship_voyage_number, event_time, event_name, count(*) AS n_rows FROM fx_events
    GROUP BY ALL HAVING count(*) > 1""")
def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(project(spark, sf_dir, "fx_events"), schemas.KEYS["ship_events"])


@query("length_audit", """
    SELECT page_id, CASE WHEN length(rtrim(url, ' ')) > 50 THEN 'long_url' ELSE 'long_html' END AS reject_reason
    FROM pages WHERE length(rtrim(url, ' ')) > 50 OR length(rtrim(html, ' ')) > 4000""")
def length_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = quality.length_checks({"url": 50, "html": 4000})
    return quality.rejected(quality.with_reasons(table(spark, sf_dir, "pages"), checks)).select(
        "page_id", "reject_reason")


@query("null_key_audit", f"""{oracle_with('fx_berth_raw')}
    SELECT seq, CASE WHEN berthing_time IS NULL THEN 'null_berthing_time'
        WHEN ship_name_english IS NULL THEN 'null_ship_name_english' ELSE 'null_port_agent' END AS reject_reason
    FROM fx_berth_raw WHERE berthing_time IS NULL OR ship_name_english IS NULL OR port_agent IS NULL""")
def null_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = quality.required_checks(["berthing_time", "ship_name_english", "port_agent"])
    return quality.rejected(quality.with_reasons(project(spark, sf_dir, "fx_berth_raw"), checks)).select(
        "seq", "reject_reason")


# Per port table: its fixture, a row number, and faults planted by it in the limited and required columns.
_AUDITED = {
    "ship_status": ("fx_status", "c_custkey"), "ship_berth_order": ("fx_berth_raw", "seq"),
    "ship_voyage": ("fx_voyage", "cast(substr(ship_voyage_number, 2, 5) as int)"), "ship_events": ("fx_events", "seq"),
}


def _planted(name: str) -> dict[str, str]:
    number, columns = _AUDITED[name][1], {c: c for c in (*schemas.KEYS[name], *schemas.REQUIRED[name], *schemas.LENGTHS[name])}
    for i, column in enumerate(schemas.LENGTHS[name]):
        columns[column] = f"CASE WHEN {number} % 43 = {i} THEN {column} || repeat('x', 101) ELSE {column} END"
    for i, column in enumerate(schemas.REQUIRED[name]):
        columns[column] = f"CASE WHEN {number} % 41 = {i} THEN NULL ELSE {columns[column]} END"
    return columns


def _audit_oracle() -> str:
    planted, parts = [], []
    for name, (fixture, _) in _AUDITED.items():
        planted.append(f"{name}_rows AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _planted(name).items())} FROM {fixture})")
        arms = [f"WHEN {c} IS NULL THEN 'null_{c}'" for c in schemas.REQUIRED[name]]
        arms += [f"WHEN length(rtrim({c}, ' ')) > {limit} THEN 'long_{c}'" for c, limit in schemas.LENGTHS[name].items()]
        parts.append(f"""
    SELECT '{name}' AS table_name, reason, count(*) AS n
    FROM (SELECT CASE {' '.join(arms)} END AS reason FROM {name}_rows) WHERE reason IS NOT NULL GROUP BY ALL""")
        parts.append(f"""
    SELECT '{name}', 'repeated_key', count(*) FROM (
        SELECT 1 FROM {name}_rows GROUP BY {', '.join(schemas.KEYS[name])} HAVING count(*) > 1) HAVING count(*) > 0""")
    fixtures = [fixture for fixture, _ in _AUDITED.values()]
    return f"{oracle_with(*fixtures)}, {', '.join(planted)} {' UNION ALL '.join(parts)}"


@query("port_audit", _audit_oracle())
def port_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing keys, over-long texts and repeated keys of the four port tables, by their own limits."""
    found = None
    for name, (fixture, _) in _AUDITED.items():
        rows = project(spark, sf_dir, fixture).selectExpr(*(f"{e} AS {c}" for c, e in _planted(name).items()))
        checks = {**quality.required_checks(schemas.REQUIRED[name]), **quality.length_checks(schemas.LENGTHS[name])}
        bad = quality.rejected(quality.with_reasons(rows, checks)).groupBy(
            F.lit(name).alias("table_name"), F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))
        repeated = quality.repeated_keys(rows, schemas.KEYS[name]).agg(F.count("*").alias("n")).filter("n > 0").select(
            F.lit(name).alias("table_name"), F.lit("repeated_key").alias("reason"), "n")
        part = bad.union(repeated)
        found = part if found is None else found.union(part)
    return found
