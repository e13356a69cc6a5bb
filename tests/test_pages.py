from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators.prefix import contiguous_prefix
from quayside.schemas import BERTH_TITLES, PAGES, STATUS_TITLES
from quayside.sources import cell_reader
from quayside.sources import pages as P
from quayside.sources.cell_reader import plain_cells, read_cells, read_table
from tests.conftest import as_tuples

GRID = P.EVENT_GRID


def pages_df(spark, *bodies):
    return spark.createDataFrame([(f"c{i}", 0, "u", body) for i, body in enumerate(bodies)], PAGES)


def cell(row, col, body, grid=GRID, tag="td"):
    return f'<{tag} class="dxgv" id="{grid}{row}_{col}">{body}</{tag}>'


def event_row(row, *values):
    return "<tr>" + "".join(cell(row, i, v) for i, v in enumerate(values)) + "</tr>"


def test_text_pieces_are_stripped_and_joined(spark):
    bodies = {
        " a ": "a", "<b> x </b> y &amp; z": "xy & z", "": "", "&nbsp;q　": "q", "1 < 2": "1 < 2",
        "<span>m</span> n": "mn", "in  side": "in  side", "a<!-- note --> b": "ab", '<a title="x > y">t</a>': "t",
        "&amp;lt;": "&lt;", "&copy; 1": "© 1", "<script>var x = '<b>';</script>t": "t",
    }
    page = "".join(cell(0, i, body) for i, body in enumerate(bodies))
    got = {r.col: r.text for r in P.grid_cells(pages_df(spark, page), GRID).collect()}
    assert [got[i] for i in range(len(bodies))] == list(bodies.values())


def test_odd_pages_read_the_same_as_plain_ones(spark):
    """Random pages, cut by expressions or by the parser: the same cells."""
    pick = random.Random(7)
    scraps = ["x", " y ", "<b>b</b>", "<i> c", "</i>", "<br>", "&amp;", "&copy;", "<img src='a/ok.png'>",
              "<img>", "<!-- n -->", "<td>n</td>", "<table><td>m</td></table>", "<", "　", "&nbsp;", "q<"]
    pages = []
    for _ in range(150):
        parts = []
        for c in range(pick.randint(1, 5)):
            body = "".join(pick.choice(scraps) for _ in range(pick.randint(0, 4)))
            text = cell(c // 3, c % 3, body)
            if pick.random() < 0.1:
                text = pick.choice([
                    text.replace("id=", "title='a>b' id="), text.replace('">', '" title="a>b">', 1),
                    text.replace("td", "TD", 1), text.replace('"', "'")])
            parts.append(text if pick.random() < 0.9 else text.removesuffix("</td>"))
        pages.append("<table>" + "".join(parts) + "</table>")
    want = sorted(
        (f"c{i}", at, c["row"], c["col"], c["text"], c["icon"])
        for i, page in enumerate(pages) for at, c in enumerate(read_cells(page, GRID)))
    rows = P.grid_cells(pages_df(spark, *pages), GRID).filter("row is not null").collect()
    got = sorted((r.crawl_id, r.position, r.row, r.col, r.text, r.icon) for r in rows)
    wrong = [(g, w, pages[int(w[0][1:])]) for g, w in zip(got, want, strict=True) if g != w]
    assert wrong == []


def test_parser_rewrites_to_plain_cells():
    page = cell(0, 0, "<table><td>in</td></table>&copy; a < b<img src='x\"y'>")
    again = "".join(plain_cells(page, GRID))
    assert read_cells(page, GRID) == read_cells(again, GRID)


def test_grid_ends_at_the_first_incomplete_row(spark):
    full = list("abcdefg")
    page = event_row(0, *full) + event_row(1, *full) + event_row(2, *full[:6]) + event_row(3, *full)
    late = event_row(1, *full)
    rows = P.event_rows(pages_df(spark, page, late, "nothing", event_row(0, *[""] * 7)))
    assert as_tuples(rows, "crawl_id", "row") == [("c0", 0), ("c0", 1), ("c3", 0)]


def test_first_of_repeated_cells_counts(spark):
    rows = [("c", 1, "u", event_row(0, *"hijklmn") + event_row(1, *"opqrstu")),
            ("c", 0, "u", event_row(0, *"abcdefg") + cell(0, 0, "z"))]
    got = P.event_rows(spark.createDataFrame(rows, PAGES))
    assert as_tuples(got) == [("c", 0, *"abcdefg"), ("c", 1, *"opqrstu")]


def test_status_flags(spark):
    bodies = ["V000010001", " 永明 ", "", "<img src='i/ok.png'>", "<img src='red.gif'>", "t<img src='ok.png'>",
              "<img alt='ok.png'>", "<img src='other.png'>", *["&nbsp;"] * 6]
    page = "".join(cell(0, i, b, P.STATUS_GRID) for i, b in enumerate(bodies))
    (row,) = P.status_rows(pages_df(spark, page)).collect()
    assert [row[t] for t in STATUS_TITLES] == [
        "V000010001", "永明", "NO", "YES", "RED", "tYES", "NO", "NO", *["NO"] * 6]


def test_miles(spark):
    both = cell(0, 2, "113/05/01 10:30", P.MILE_GRID) + cell(0, 3, " ", P.MILE_GRID)
    other_row = cell(1, 2, "x", P.MILE_GRID)
    assert as_tuples(P.mile_rows(pages_df(spark, both, other_row, "none"))) == [
        ("c0", "113/05/01 10:30", "null"), ("c1", "null", "null"), ("c2", "null", "null")]


def test_header_table(spark):
    def tds(css, texts):
        return "".join(f'<td class="{css}">{t}</td>' for t in texts)

    titles = [*BERTH_TITLES][:3] + ["動態"]
    def grid(first):
        return (
            f'<table class="{P.CONTROL_CLASS} x"><tr>{tds(P.HEADER_CLASS, titles)}</tr>'
            f'<tr class="{P.ROW_CLASS}">{tds("dxgv", [first, " a <b>b</b>  c ", "old", "new", "extra"])}</tr>'
            f'<tr class="{P.ROW_CLASS} alt">{tds("dxgv", ["1043"])}</tr>'
            f'<tr class="other">{tds("dxgv", ["no"])}</tr></table>')

    inner = "&#49;<table><tr><td>0</td><td>42</td></tr></table>"
    stray = f'<table><tr class="{P.ROW_CLASS}">{tds("dxgv", ["out"])}</tr></table>'
    unclosed = grid("1042").replace("</td>", "").replace("</tr>", "")
    # Plain; several grids; an entity and a table in a cell; rows outside; cells left open; no grid at all.
    pages = [grid("1042"), grid("1042") + grid("other"), grid(inner), stray + grid("1042") + stray, unclosed, stray]
    got = P.header_table_rows(pages_df(spark, *pages), BERTH_TITLES)
    assert as_tuples(got, "crawl_id", "row", "berth_number", "berthing_time", "ship_status", "port_agent") == sorted(
        row for i in range(5) for row in [
            (f"c{i}", 0, "1042", "a b c", "new", None), (f"c{i}", 1, "1043", None, None, None)])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["1", "a b", " <b>x</b> y", "&amp;", "&nbsp;z", "<br>q", "", "m<span> n</span>"]), max_size=4), max_size=4))
def test_header_table_equals_reader(rows):
    """What the patterns read on plain pages is what the parser reads."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    titles = [*BERTH_TITLES][:3]
    head = "".join(f'<td class="{P.HEADER_CLASS}">{t}</td>' for t in titles)
    body = "".join(
        f'<tr class="{P.ROW_CLASS}">' + "".join(f'<td class="dxgv">{c}</td>' for c in row) + "</tr>" for row in rows)
    page = f'<table class="{P.CONTROL_CLASS}"><tr>{head}</tr>{body}</table>'
    got = P.header_table_rows(pages_df(spark, page), BERTH_TITLES).orderBy("row").collect()
    header, cells = read_table(page, P.CONTROL_CLASS, P.HEADER_CLASS, P.ROW_CLASS, P.CELL_CLASS)
    want = [dict(zip(header, row, strict=False)) for row in cells]
    assert [tuple(r[BERTH_TITLES[t]] for t in titles) for r in got] == [tuple(w.get(t) for t in titles) for w in want]


def test_ids_are_exact_and_may_be_long(spark):
    page = cell(0, 0, "right") + cell("00", 0, "padded") + cell(10**20, 0, "far") + cell(0, 10**12, "wide") + cell(1, 0, "next")
    got = P.grid_rows(P.grid_cells(pages_df(spark, page), P.EVENT_GRID), ("t",), F.col("text"))
    assert as_tuples(got, "row", "t") == [(0, "right"), (1, "next")]


def test_links(spark):
    page = '<!-- <li><a href="/x">x</a></li> --><ul><li><a href="/a">A <b>b</b></a></li><li><a href="/c">c</a></li></ul>'
    got = P.list_links(spark.createDataFrame([(1, page)], "page_id int, html string"))
    assert as_tuples(got, "position", "href", "text") == [(0, "/a", "Ab"), (1, "/c", "c")]


def test_pages_are_parsed_once(spark):
    """The grid is used three times over; all uses share one shuffle, and so one parse."""
    rows = P.event_rows(pages_df(spark, event_row(0, *"abcdefg")))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("ArrowEvalPython") == 1
    assert "ReusedExchange" in final


def test_prefix_on_one_big_group(spark):
    rows = spark.range(5000).select(
        F.lit("g").alias("g"), F.col("id").alias("row"), (F.col("id") != 4321).alias("ok"))
    kept = contiguous_prefix(rows, "g", "row", "ok")
    assert (kept.count(), kept.agg(F.max("row")).first()[0]) == (4321, 4320)


def test_tables_side_by_side_are_cut_once_and_without_the_parser(spark):
    pages = pages_df(spark, "<p></p>")
    got = P.header_table_rows(pages, BERTH_TITLES)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("!--.*?--|") == 1
    row, nested = "<tr><td>a</td><TD>b</td ></tr>", "<tr><td><table><tr><td>a</td></tr></table></td></tr>"
    html = [f"<table>{row}</table><div><table>{row}{row}</table></div>{row}", f"<table>{nested}</table>", f"<table>{row}", nested]
    flat = spark.createDataFrame(list(enumerate(html)), "i int, html string").select("i", P._flat_tables(F.col("html")).alias("flat"))
    assert as_tuples(flat) == [(0, True), (1, False), (2, False), (3, False)]


def test_pages_are_cut_once_for_few_columns_too(spark):
    """The ship list is wanted in three of its columns, but a row counts if it is whole."""
    page = "".join(cell(0, i, f"v{i}", P.STATUS_GRID) for i in range(len(STATUS_TITLES)))
    rows = P.status_rows(pages_df(spark, page, page.replace("0_13", "0_99"))).select("crawl_id", *STATUS_TITLES[:3])
    assert as_tuples(rows) == [("c0", "v0", "v1", "v2")]
    final = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("ArrowEvalPython") == 1


def test_pages_are_dealt_by_their_size(spark):
    """Stored pages are small and in one file; what they hold is not."""
    pages = spark.range(40, numPartitions=1).select(
        F.lit(None).cast("string").alias("crawl_id"), F.col("id").cast("int").alias("page_no"), F.lit("u").alias("url"),
        F.repeat(F.lit("x"), P.TASK_BYTES // 10).alias("html"))
    size = pages.agg(P.page_bytes(F.col("html"))).first()[0]
    dealt = P.spread_pages(pages, size)
    held = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert size == 40 * (P.TASK_BYTES // 10) and dealt.count() == 40
    assert len(held) > 1 and max(r["count"] for r in held) < 40
    assert P.spread_pages(pages.limit(0), 0).count() == 0


def test_crawls_are_dealt_by_their_size(spark):
    """To tasks of their own, as many as each one's bytes need."""
    html = F.repeat(F.lit("x"), P.TASK_BYTES // 10)
    pages = spark.range(64, numPartitions=1).select(
        F.col("id").cast("string").alias("crawl_id"), F.when(F.col("id") < 40, html).when(F.col("id") < 62, "y").alias("html"),
        F.when(F.col("id") < 40, 3).when(F.col("id") < 50, 1).when(F.col("id") < 63, 2).alias("crawl"))
    sizes = {r["crawl"]: r["size"] for r in pages.groupBy("crawl").agg(P.page_bytes(F.col("html")).alias("size")).collect()}
    dealt = P.spread_crawls(pages, sizes)
    held = dealt.groupBy("crawl", F.spark_partition_id().alias("task")).count().collect()
    assert as_tuples(dealt.select("crawl_id", "crawl")) == as_tuples(pages.select("crawl_id", "crawl"))
    tasks = {c: {r["task"] for r in held if r["crawl"] == c} for c in (1, 2, 3)}
    assert len(tasks[1]) == len(tasks[2]) == 1 and 1 < len(tasks[3]) <= 4
    assert not (tasks[1] & tasks[2] or tasks[1] & tasks[3] or tasks[2] & tasks[3])
    assert P.spread_crawls(pages.limit(0), {}).count() == 0


def test_a_batch_of_pages_is_cut_some_at_a_time():
    """What is cut from it stays in Arrow: as Python objects pages and cells take several times that."""
    page = "<table>" + "".join(event_row(i, *"abcdefg") for i in range(16)) + "</table>"
    pages = [None, "", *([page] * 1000), cell(0, 0, "end")]
    batch = pa.array(pages, pa.string())
    tracemalloc.start()
    got = cell_reader.cells_of(batch, GRID)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < batch.nbytes / 3
    assert [len(x) for x in got.to_pylist()] == [0, 0, *([112] * 1000), 1]
    assert got.to_pylist()[-1] == [{"row": 0, "col": 0, "text": "end", "icon": None}]
    assert cell_reader.cells_of(pa.array([], pa.string()), GRID).type == got.type


def test_plain_pages_are_cut_by_a_pattern():
    """And no others: what the pattern cannot read goes to the parser."""
    plain = event_row(0, "a &amp; b", "<b> x </b>y", "<img src='a/ok.png'>", "", "1 &#48;") + event_row(1, *"cdefg")
    odd = [cell(0, 0, "<td>n</td>"), cell(0, 0, "a") + "<td id=x", cell(0, 0, "<!-- n -->a"), cell(0, 0, "a", tag="TD"),
           f'<p>{GRID}</p>' + cell(0, 0, "a"), f'<div id="{GRID}1_1">' + cell(0, 0, "a") + "</div>", "<textarea>" + cell(0, 0, "a"),
           cell(0, 0, "a").removesuffix("</td>"), cell(0, 0, "1 < 2"), f'<td title="<" id="{GRID}0_0">a</td>']
    pattern = cell_reader._plain_cell(GRID)
    for page in [plain, *odd]:
        want = [(c["row"], c["col"], c["text"], c["icon"]) for c in read_cells(page, GRID)]
        assert list(cell_reader._found_cells(page, GRID, pattern)) == want, page
    assert len(pattern.findall(plain)) == 10
