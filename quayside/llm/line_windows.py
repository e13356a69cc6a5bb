"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines that hold a word are hashed. Of equal windows anywhere in the
corpus, the first one stays (by doc_id, then place); of all later ones the lines are marked, and
marks of overlapping windows merge. So a passage copied from elsewhere goes whole, and single
lines that many texts share stay.

Per hash the first and last place are found by partial aggregation, so a window found in a third
of all texts sends one row per task. The later places come from a join that adaptive execution
splits where one hash is hot; per document there are no more marks than lines.

Results by case: texts with fewer than three such lines, blank and NULL ones stay as they are;
lines without a word neither count nor go; rows that repeat doc_id and text are taken as one
document and come out alike; NULL doc_id orders first; extra columns are passed through, and one
with the name of the added struct is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import WORD, query, table

WINDOW = 3


def _windows(text: Column) -> Column:
    """Per window: 128 bits of hash and the places of its lines."""
    def of(held: Column) -> Column:
        def window(i: Column) -> Column:
            parts = [F.get(held, i + k) for k in range(WINDOW)]
            lines = [p["line"] for p in parts]
            return F.struct(
                F.xxhash64(*lines).alias("h1"), F.xxhash64(F.lit(WINDOW), *reversed(lines)).alias("h2"),
                F.array(*(p["at"] for p in parts)).alias("at"))

        return F.when(F.size(held) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(held) - WINDOW), window))

    placed = F.transform(F.split(text, "\n"), lambda line, at: F.struct(line.alias("line"), at.alias("at")))
    held = F.filter(placed, lambda p: p["line"].rlike(WORD))
    return F.element_at(F.transform(F.array(held), of), 1)


def without_repeated_windows(docs: DataFrame, text: str = "text", key: str = "doc_id", name: str = "lines") -> DataFrame:
    """``docs`` with what is left of the texts, and struct ``name``: n_lines, n_removed."""
    docs = docs.drop(name)
    tie = F.xxhash64(text)
    windows = docs.select(
        F.col(key).alias("_key"), tie.alias("_tie"), F.explode(_windows(F.col(text))).alias("w"),
    ).select("_key", "_tie", "w.*")
    place = F.struct("_key", "_tie", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    later = windows.join(repeated, ["h1", "h2"]).filter(place > F.col("first"))
    marks = (
        later.select("_key", "_tie", F.explode("at").alias("line")).distinct()
        .groupBy("_key", "_tie").agg(F.collect_list("line").alias("_marks")))
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_own"), tie.alias("_hash"))
    joined = rows.join(marks, F.expr("_own <=> _key AND _hash = _tie"), "left")
    whole = F.col("_row")[text]
    lines = F.split(whole, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_marks")
    left = F.when(F.col("_marks").isNull(), whole).otherwise(F.array_join(
        F.element_at(F.transform(F.array(lines), lambda x: F.transform(kept, lambda i: F.get(x, i))), 1), "\n"))
    n_lines = F.coalesce(F.size(F.filter(lines, lambda line: line.rlike(WORD))), F.lit(0))
    n_lines = F.when(whole.isNull(), F.lit(0)).otherwise(n_lines)
    counts = F.struct(
        n_lines.cast("long").alias("n_lines"), F.coalesce(F.array_size("_marks"), F.lit(0)).cast("long").alias("n_removed"))
    return joined.select(*(left.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns), counts.alias(name))


def deduplicated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages go, and with them documents of which nothing is left."""
    rows = without_repeated_windows(docs.select("doc_id", "text", F.struct("*").alias("row")))
    emptied = (F.col("lines.n_removed") > 0) & (F.col("lines.n_removed") == F.col("lines.n_lines"))
    return rows.filter(~emptied).select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


_ORACLE = f"""
    WITH lines AS (
        SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
    held AS (
        SELECT doc_id, line AS a, pos AS at_a, lead(line, 1) OVER p AS b, lead(pos, 1) OVER p AS at_b,
            lead(line, 2) OVER p AS c, lead(pos, 2) OVER p AS at_c
        FROM lines WHERE regexp_matches(line, '{WORD}') WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
    later AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, at_a) AS n FROM held WHERE c IS NOT NULL)
        WHERE n > 1),
    marks AS (
        SELECT DISTINCT doc_id, unnest([at_a, at_b, at_c]) AS pos FROM later),
    kept AS (
        SELECT doc_id, count(*) FILTER (regexp_matches(line, '{WORD}')) AS n_lines, count(marks.pos) AS n_removed,
            coalesce(string_agg(line, chr(10) ORDER BY lines.pos) FILTER (marks.pos IS NULL), '') AS kept
        FROM lines LEFT JOIN marks USING (doc_id, pos) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(kept) AS kept_sha256
    FROM documents LEFT JOIN kept USING (doc_id)"""


@query("op6_line_windows", _ORACLE)
def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeated_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "lines.n_lines", "lines.n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
