"""Fill-in-the-middle against plain Python."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from quayside.llm import fill_middle

MORE = [
    (100, "has <P> inside"), (101, "has <S>"), (102, "<M>"), (103, "<<<P"), (104, "a" * 50_000), (105, "!" * 50_000),
    (106, "a$1 \\2 <P> no" .replace("<P>", "<p>")), (107, "$1\\$3" * 20), (108, "\r\n\n" * 30), (109, chr(0x1F600) * 9 + "ab" + chr(0xE9)),
    (110, "x"), (-5, "negative id"), (111, "P><S" * 5)]


def brute(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k: 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def test_documents(odd, empty):
    more = odd.sparkSession.createDataFrame(
        [(k + 1000 * i, t) for k, t in MORE for i in range(6)], "doc_id long, text string").withColumn("fim", F.lit("old"))
    for docs in (odd.withColumn("fim", F.lit(1)).withColumn("_n", F.lit(1)), more):
        rows = fill_middle.filled_in(docs)
        assert rows.columns == [*(c for c in docs.columns if c != "fim"), "fim"]
        got = rows.withColumn("back", fill_middle.restored(F.col("fim.output"), F.col("fim.form"))).collect()
        assert len(got) == docs.count()
        for r in got:
            f = r.fim
            assert (f.n, f.form, f.output, f.prefix_chars, f.middle_chars) == brute(r.doc_id, r.text), r.doc_id
            assert r.back == (r.text or "")
    assert {r.fim.form for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.filled_in(empty).count() == 0


def test_shares(session):
    docs = session.range(4000).select(F.col("id").alias("doc_id"), F.lit("some words of text").alias("text"))
    forms = {r[0]: r[1] for r in fill_middle.filled_in(docs, changed=50, suffix_first=50, seed=7).groupBy("fim.form").count().collect()}
    assert abs(forms["plain"] - 2000) < 200 and abs(forms["spm"] - 1000) < 150
    assert {r[0] for r in fill_middle.filled_in(docs, changed=0).select("fim.form").distinct().collect()} == {"plain"}


def test_long_texts_take_one_match(session):
    """Hundreds of thousands of units in a counted group: no stack grows with them."""
    text = "ab 1" * 150_000
    docs = session.createDataFrame([(k, text) for k in range(4)], "doc_id long, text string")
    for r in fill_middle.filled_in(docs).collect():
        assert (r.fim.n, r.fim.form, r.fim.output, r.fim.prefix_chars, r.fim.middle_chars) == brute(r.doc_id, r.text)
