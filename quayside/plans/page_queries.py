"""Registered queries: extraction from pages.

The provided pages have no grids, so grid pages are built from the other tables, a few
rows to a page, and read back; the oracle has the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions import times
from quayside.functions.text import page_address
from quayside.operators import quality
from quayside.operators.ordering import with_position
from quayside.plans.alerts import moment
from quayside.plans.ingest import own_pages, typed_events
from quayside.plans.registry import query
from quayside.plans.text_queries import EVENT_PAGE, content_text, era_text, meridiem_text
from quayside.schemas import BERTH_TITLES, STATUS_TITLES
from quayside.session import scratch_folder
from quayside.sources import pages as P
from quayside.sources.state import state_table
from quayside.sources.testdata import AS_OF, oracle_with, project, table
from quayside.streaming.crawls import STATUS, crawl_stream

CHUNK = 64
PAGE_ROWS = 16


def grid_row(grid: str, cells: Column) -> Column:
    """A table row; a NULL cell is left out."""
    shown = F.transform(cells, lambda body, i: F.when(body.isNull(), "").otherwise(F.concat(
        F.lit(f'<td class="dxgv" id="{grid}'), F.col("row").cast("string"), F.lit("_"), i.cast("string"),
        F.lit('">'), body, F.lit("</td>"))))
    return F.concat(F.lit("<tr>"), F.array_join(shown, ""), F.lit("</tr>\n"))


def pages_of(rows: DataFrame, html: Column, *keys: str) -> DataFrame:
    """Pages of the rows that share ``crawl_id`` and ``page_no``; callers see to it that these are few."""
    lines = F.array_sort(F.collect_list(F.struct("row", html.alias("html"))))
    body = F.array_join(F.transform(lines, lambda line: line["html"]), "")
    return rows.groupBy("crawl_id", "page_no", *keys).agg(
        F.concat(F.lit("<html><body><table>\n"), body, F.lit("</table></body></html>")).alias("html"))


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Adds ``crawl_id`` (a chunk of ``CHUNK`` keys) and ``row`` (from 0 within the chunk)."""
    chunk = F.floor(F.col(key) / CHUNK)
    inside = Window.partitionBy("_chunk").orderBy(key)
    return (
        df.withColumn("_chunk", chunk)
        .withColumn("row", F.row_number().over(inside).cast("bigint") - 1)
        .withColumn("crawl_id", F.col("_chunk").cast("string"))
        .drop("_chunk")
    )


_NUMBERED = f"""numbered AS (
    SELECT *, cast(cast(floor(c_custkey / {CHUNK}) as bigint) AS varchar) AS crawl_id,
        row_number() OVER (PARTITION BY floor(c_custkey / {CHUNK}) ORDER BY c_custkey) - 1 AS row
    FROM fx_status)"""


def _status_pages(spark: SparkSession, sf_dir: str, ships: DataFrame | None = None) -> DataFrame:
    """Ship list pages. Every fiftieth ship lacks a cell, which ends the grid of its chunk."""
    key = F.col("c_custkey")
    flags = [
        F.when((key + i) % 3 == 0, F.lit('<img alt="" src="img/ok.png">'))
        .when((key + i) % 3 == 1, F.lit("<span> <img src='img/red.gif'/> </span>")).otherwise("&nbsp;")
        for i in range(3, len(STATUS_TITLES))
    ]
    flags[2] = F.when(key % 50 == 7, F.lit(None)).otherwise(flags[2])
    cells = F.array(
        F.concat(F.lit("<a href='#'> "), "ship_voyage_number", F.lit("\n</a>")), F.col("ship_name"),
        F.coalesce("latest_event", F.lit("")), *flags)
    ships = project(spark, sf_dir, "fx_status") if ships is None else ships
    rows = numbered(ships, "c_custkey").withColumn("page_no", F.floor(F.col("row") / PAGE_ROWS))
    return pages_of(rows, grid_row(P.STATUS_GRID, cells))


@query("grid_extract_status", f"""{oracle_with('fx_status')}, {_NUMBERED},
    gaps AS (SELECT crawl_id, min(row) AS gap FROM numbered WHERE c_custkey % 50 = 7 GROUP BY crawl_id)
    SELECT n.crawl_id, n.row, ship_voyage_number, ship_name, coalesce(latest_event, 'NO') AS latest_event,
        {', '.join(f"CASE (c_custkey + {i}) % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'RED' ELSE 'NO' END AS flag_{i}"
                   for i in range(3, len(STATUS_TITLES)))}
    FROM numbered n LEFT JOIN gaps g ON g.crawl_id = n.crawl_id WHERE g.gap IS NULL OR n.row < g.gap""")
def grid_extract_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["ship_voyage_number", "ship_name", "latest_event", *(f"flag_{i}" for i in range(3, len(STATUS_TITLES)))]
    rows = P.status_rows(_status_pages(spark, sf_dir))
    return rows.select("crawl_id", "row", *(F.col(t).alias(n) for t, n in zip(STATUS_TITLES, names, strict=True)))


def _seen(crawl: str) -> str:
    """Event of a ship at a crawl: the second one finds every seventh changed."""
    return f"CASE WHEN {crawl} = 1 AND c_custkey % 7 = 0 THEN 'changed' ELSE coalesce(latest_event, 'NO') END"


@query("stream_crawl", f"""{oracle_with('fx_status')}, {_NUMBERED},
    gaps AS (SELECT crawl_id, min(row) AS gap FROM numbered WHERE c_custkey % 50 = 7 GROUP BY crawl_id)
    SELECT ship_voyage_number, ship_name, {_seen('1')} AS latest_event, cast('{AS_OF}' as timestamp) AS created_at,
        CASE WHEN {_seen('0')} <> {_seen('1')} THEN cast('{AS_OF}' as timestamp) + INTERVAL '1' HOUR
            ELSE cast('{AS_OF}' as timestamp) END AS updated_at
    FROM numbered n LEFT JOIN gaps g ON g.crawl_id = n.crawl_id WHERE g.gap IS NULL OR n.row < g.gap""")
def stream_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of two crawls have landed before one run of the stream; both are taken in, in order."""
    root = scratch_folder(spark, "stream-crawl")
    found = None
    for crawl in range(2):
        ships = project(spark, sf_dir, "fx_status").withColumn("latest_event", F.expr(_seen(str(crawl))))
        part = _status_pages(spark, sf_dir, ships).withColumns({
            "url": F.lit("list"), "kind": F.lit(STATUS), "crawl": F.lit(crawl)})
        found = part if found is None else found.union(part)
    found = found.select("crawl_id", F.col("page_no").cast("int").alias("page_no"), "url", "html", "kind", "crawl")
    found.write.parquet(f"{root}/arrived")
    arriving = spark.readStream.schema(found.schema).parquet(f"{root}/arrived")
    crawl_stream(
        arriving, root, f"{root}/checkpoint", EVENT_PAGE, f"{EVENT_PAGE}-miles",
        lambda crawl, _: moment(AS_OF) + F.make_dt_interval(hours=F.lit(crawl)), parts=8, export_stem="output",
    ).awaitTermination()
    return state_table(spark, root, "ship_status", 8).read()


@query("arity_audit", f"""{oracle_with('fx_status')}, {_NUMBERED}
    SELECT crawl_id, row, cast({len(STATUS_TITLES) - 1} as bigint) AS n_cells FROM numbered WHERE c_custkey % 50 = 7""")
def arity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid rows that do not have the expected number of cells."""
    cells = P.grid_cells(_status_pages(spark, sf_dir), P.STATUS_GRID)
    counted = cells.groupBy("crawl_id", "row").agg(F.count_distinct("col").alias("n_cells"))
    return quality.rejected(quality.with_reasons(
        counted, {"cell_count": F.col("n_cells") != len(STATUS_TITLES)})).drop("reject_reason")


@query("multi_page_first_match", f"""{oracle_with('fx_status')}, {_NUMBERED}
    SELECT crawl_id, row, ship_voyage_number, ship_name || '@' || cast(CASE
            WHEN row >= {PAGE_ROWS} AND row % {PAGE_ROWS} < 4 THEN row // {PAGE_ROWS} - 1
            ELSE row // {PAGE_ROWS} END AS varchar) AS ship_name
    FROM numbered""")
def multi_page_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page repeats the first rows of the next one; the earlier page counts."""
    own = F.floor(F.col("row") / PAGE_ROWS)
    repeated = (F.col("row") >= PAGE_ROWS) & (F.col("row") % PAGE_ROWS < 4)
    rows = numbered(project(spark, sf_dir, "fx_status"), "c_custkey").withColumn(
        "page_no", F.explode(F.when(repeated, F.array(own - 1, own)).otherwise(F.array(own))))
    cells = F.array("ship_voyage_number", F.concat("ship_name", F.lit("@"), F.col("page_no").cast("string")))
    pages = pages_of(rows, grid_row(P.EVENT_GRID, cells))
    return P.grid_rows(
        P.grid_cells(pages, P.EVENT_GRID), ("ship_voyage_number", "ship_name"), F.col("text"))


def _event_pages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Event pages addressed by voyage; a voyage's rows go on over its pages."""
    local = times.to_local(F.col("event_time"))
    cells = F.array(
        F.col("event_source"), meridiem_text(local), F.col("event_name"),
        F.coalesce("navigation_status", F.lit("")), F.col("pilot_order_number"), F.col("berth_number"),
        F.coalesce(content_text(F.col("seq"), times.to_local(F.col("event_content_time"))), F.lit("null")),
    )
    events = project(spark, sf_dir, "fx_events") if events is None else events
    events = events.withColumn("part", F.floor(F.col("seq") / 2**20))
    rows = (
        with_position(events, ["ship_voyage_number"], "part", ["seq"], "row")
        .withColumn("row", F.col("row") - 1)
        .withColumn("page_no", F.floor(F.col("row") / CHUNK))
        .withColumn("crawl_id", F.col("ship_voyage_number"))
        .withColumn("url", page_address(EVENT_PAGE, F.col("ship_voyage_number")))
    )
    return pages_of(rows, grid_row(P.EVENT_GRID, cells), "url")


_CONTENT = (
    "CASE WHEN seq % 6 IN (0, 1, 2) THEN event_content_time END AS event_content_time"
)


@query("grid_extract_events", f"""{oracle_with('fx_events')}
    SELECT ship_voyage_number, event_source, event_time, event_name, coalesce(navigation_status, '')
        AS navigation_status, pilot_order_number, berth_number, {_CONTENT}
    FROM fx_events""")
def grid_extract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.event_rows(_event_pages(spark, sf_dir))
    typed = typed_events(rows.withColumn("ship_voyage_number", F.col("crawl_id")).withColumn("seq", F.col("row")))
    return quality.accepted(typed).drop("seq", "event_time_text", "event_content_text")


@query("keyed_page_enrich", f"""{oracle_with('fx_status', 'fx_events')}
    SELECT e.ship_voyage_number, s.ship_name, e.pilot_order_number, e.event_name
    FROM fx_events e JOIN fx_status s ON s.ship_voyage_number = e.ship_voyage_number""")
def keyed_page_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ship's own page found by address, its rows tagged with the ship's key."""
    ships = project(spark, sf_dir, "fx_status").select("ship_voyage_number", "ship_name")
    pages = own_pages(_event_pages(spark, sf_dir).drop("crawl_id"), EVENT_PAGE)
    rows = P.event_rows(pages).withColumnRenamed("crawl_id", "ship_voyage_number")
    return rows.join(ships, "ship_voyage_number").select(
        "ship_voyage_number", "ship_name", "pilot_order_number", "event_name")


@query("grid_lookup_miles", f"""{oracle_with('fx_status')}
    SELECT ship_voyage_number,
        CASE WHEN c_custkey % 3 = 0 OR c_custkey % 4 = 0 THEN NULL ELSE updated_at END AS pass_10_miles_time,
        CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN NULL ELSE updated_at END AS pass_5_miles_time
    FROM fx_status""")
def grid_lookup_miles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per ship with two fixed cells, empty or missing on some, no grid at all on others."""
    key, text = F.col("c_custkey"), era_text(times.to_local(F.col("updated_at")))
    cells = F.array(
        F.lit("x"), F.lit("y"), F.when(key % 4 == 0, "").otherwise(text), F.when(key % 5 != 0, text))
    rows = project(spark, sf_dir, "fx_status").select(
        "c_custkey", "updated_at", F.col("ship_voyage_number").alias("crawl_id"),
        F.lit(0).alias("page_no"), F.lit(0).cast("bigint").alias("row"))
    html = F.when(key % 3 == 0, "<p>no passage</p>").otherwise(grid_row(P.MILE_GRID, cells))
    miles = P.mile_rows(rows.select("crawl_id", "page_no", html.alias("html")))
    return miles.select(
        F.col("crawl_id").alias("ship_voyage_number"),
        times.era_time(F.col("pass_10_miles_time")).alias("pass_10_miles_time"),
        times.era_time(F.col("pass_5_miles_time")).alias("pass_5_miles_time"))


def _code(text: Column) -> Column:
    """Number of the first character, as pages spell it."""
    return F.conv(F.hex(F.encode(F.substring(text, 1, 1), "UTF-16BE")), 16, 10)


@query("header_zip_rows", f"""{oracle_with('fx_berth_raw')}
    SELECT seq AS order_key, berth_number, berthing_time, ship_status, pilotage_time, ship_name_chinese,
        CASE WHEN seq % 23 = 0 THEN NULL ELSE coalesce(ship_name_english, '') END AS ship_name_english,
        CASE WHEN seq % 23 = 0 THEN NULL WHEN seq % 17 = 0 THEN 'earlier' ELSE coalesce(port_agent, '') END
            AS port_agent
    FROM fx_berth_raw""")
def header_zip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables read by header: the agent's header comes twice, some rows are short, some long."""
    rows = project(spark, sf_dir, "fx_berth_raw").withColumn("row", F.col("seq")).withColumn(
        "crawl_id", F.floor(F.col("seq") / CHUNK).cast("string")).withColumn("page_no", F.lit(0))

    def time_text(name: str) -> Column:
        return F.coalesce(era_text(times.to_local(F.col(name))), F.lit("待接靠"))

    # On every seventh page the first character stands as a number, on some of its rows a table in the cell.
    odd = F.col("crawl_id").cast("bigint") % 7 == 0
    nested = odd & (F.col("seq") % 5 == 0)
    first = F.when(odd, F.concat(F.lit("&#"), _code(F.col("ship_name_chinese")), F.lit(";"))).otherwise(
        F.substring("ship_name_chinese", 1, 1))
    cells = F.array(
        F.col("seq").cast("string"), F.col("berth_number"), time_text("berthing_time"), F.col("ship_status"),
        time_text("pilotage_time"), F.concat(
            F.when(nested, "<table><tr><td>").otherwise("<b>"), first, F.expr("substring(ship_name_chinese, 2)"),
            F.when(nested, "</td></tr></table>").otherwise("</b> ")),
        F.coalesce("ship_name_english", F.lit("")), F.lit("earlier"), F.coalesce("port_agent", F.lit("")), F.lit("extra"))
    width = F.when(F.col("seq") % 23 == 0, 6).when(F.col("seq") % 17 == 0, 8).when(F.col("seq") % 19 == 0, 10).otherwise(9)
    tds = F.transform(F.slice(cells, F.lit(1), width), lambda c: F.concat(F.lit('<td class="dxgv">'), c, F.lit("</td>")))
    body = F.concat(
        F.when(F.col("seq") % 2 == 0, f'<tr class="{P.ROW_CLASS}">')
        .otherwise(f'<tr class="{P.ROW_CLASS} dxgvDataRowAlt_PlasticBlue">'),
        F.array_join(tds, ""), F.lit("</tr>"))
    titles = {"編號": "order_key", **BERTH_TITLES}
    header = "".join(f'<td class="{P.HEADER_CLASS}"> {t} </td>' for t in (*titles, "港代理"))
    wrong = f'<table class="{P.CONTROL_CLASS}"><tr><td class="{P.HEADER_CLASS}">x</td></tr></table>'
    pages = pages_of(rows, body).withColumn("html", F.concat(
        F.lit(f'<p>before</p><div class="{P.CONTROL_CLASS} wide"><table><tr>{header}</tr></table>'), "html",
        F.lit("</div>"), F.when(odd, wrong).otherwise("")))
    zipped = P.header_table_rows(pages, titles)
    return zipped.drop("crawl_id", "page_no", "row").withColumns({
        "order_key": F.col("order_key").cast("bigint"),
        "berthing_time": times.era_time(F.col("berthing_time")),
        "pilotage_time": times.era_time(F.col("pilotage_time")),
    })


@query("nav_links_from_pages", """
    SELECT page_id, i - 1 AS position, hrefs[i] AS href, texts[i] AS text FROM (
        SELECT page_id, hrefs, texts, unnest(range(1, len(hrefs) + 1)) AS i FROM (
            SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
                regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2) AS texts
            FROM pages))""")
def nav_links_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.list_links(table(spark, sf_dir, "pages").select("page_id", "html"))
