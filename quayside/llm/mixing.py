"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected in the mix ``target / source size`` times. Along a fixed
order of the source these expectations are summed up, one random offset is added, and a document
is emitted once for each whole number that its own step crosses. So a source's documents differ
by one copy at most, and since the order goes by size, the words taken stay near the target.

The order is cut into segments (source, band of sizes, salt of the document), whose places
depend on the row alone. Row numbers run inside a segment; only the segments' row counts are
summed over a whole source, so no source, however large, is sorted in one task. The table of
sources is sorted in one task: it has one row per source.

Results by case: a NULL text has no words; NULL is a source of its own, the last; a source
without words gets target 0 and no copies; rows that repeat one another count as documents of
their own; a table without rows gives none. Columns of the input are passed through; one that
has the name of the added struct is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.base import WORD, query, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 11
SALTS = 256


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Sources take part by weight until they reach ``most`` times their size; what is over goes
    to the others by weight. That is a level ``v`` with target = least(most * size, weight * v).
    With the sources in the order in which they fill up, v is the greatest of the levels that
    result if exactly those before a source are full.
    """
    weight = F.element_at(F.lit(list(weights)), (F.col("_turn") % len(weights) + 1).cast("int"))
    along = Window.orderBy("_full_at", "_turn")
    everything = Window.partitionBy()
    level = (
        (share * F.sum("source_size").over(everything)
         - F.coalesce(F.sum("_cap").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("_weight").over(along.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    return (
        sizes.withColumn("_turn", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
        .withColumn("_weight", weight)
        .withColumn("_cap", most * F.col("source_size"))
        .withColumn("_full_at", F.col("_cap") / F.col("_weight"))
        .withColumn("_level", level)
        .withColumn("target", F.least("_cap", F.col("_weight") * F.max("_level").over(everything)))
        .select("source", "source_size", "target"))


def _number(text: Column, digits: int) -> Column:
    """A number from the first hexadecimal digits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def with_copies(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
                name: str = "mix", seed: int = SEED) -> DataFrame:
    """Adds struct ``name``: size, source_size, target, copies, taken."""
    docs = docs.drop(name)
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(source).alias("_named"), F.col(key).alias("_key"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("_source"),
        word_count(F.col(text)).alias("_size"),
        (_number(F.coalesce(F.col(key).cast("string"), F.lit("")), 4) % SALTS).alias("_salt"),
        F.xxhash64(text).alias("_tie"),
    ).withColumn("_band", F.floor(F.sqrt(F.col("_size").cast("double"))))
    segment = ["_source", "_band", "_salt"]

    counted = rows.groupBy(*segment).agg(F.count("*").alias("_rows"), F.sum("_size").alias("_words"), F.first("_named").alias("source"))
    before = Window.partitionBy("_source").orderBy("_band", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(*segment, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    sizes = counted.groupBy("_source").agg(F.first("source").alias("source"), F.sum("_words").alias("source_size"))
    start = _number(F.concat(F.lit(f"{seed} "), "_source"), 8) / F.lit(float(2**32))
    targets = source_targets(sizes.select("source", "source_size")).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_source"), "source_size", "target",
    ).withColumn("_rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))).withColumn("_start", start)
    places = offsets.join(targets, "_source")

    inside = Window.partitionBy(*segment).orderBy("_size", "_key", "_tie")
    placed = rows.withColumn("_number", F.row_number().over(inside)).join(places, segment)
    last = F.col("_offset") + F.col("_number")
    copies = F.least(
        F.floor(F.col("_rate") * last + F.col("_start")) - F.floor(F.col("_rate") * (last - 1) + F.col("_start")),
        F.ceil("_rate"))
    return placed.withColumn("_copies", copies).select("_row.*", F.struct(
        F.col("_size").alias("size"), "source_size", "target", F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken")).alias(name))


def mixed(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: every document as often as it is taken."""
    taken = with_copies(docs.select(F.struct("*").alias("row"), "text", "source", "doc_id"), **options).filter("mix.copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix.copies")))).select("row.*")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents as often as the mix takes them."""
    return mixed(docs)


_ORACLE = f"""
    WITH sized AS (
        SELECT doc_id, coalesce('s' || source, 'n') AS s, source,
            CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
            CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 4) AS BIGINT) % {SALTS} AS salt
        FROM documents),
    sources AS (
        SELECT s, source, CAST(sum(size) AS BIGINT) AS source_size,
            CAST('0x' || substr(md5('{SEED} ' || s), 1, 8) AS BIGINT) / CAST({2**32} AS DOUBLE) AS start
        FROM sized GROUP BY ALL),
    weighed AS (
        SELECT *, CAST({MOST} AS DOUBLE) * source_size AS cap,
            list_extract([{', '.join(map(str, WEIGHTS))}], CAST(turn % {len(WEIGHTS)} + 1 AS INT)) AS weight
        FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM sources)),
    levels AS (
        SELECT *, (CAST({SHARE} AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(cap) OVER (
                ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighed),
    targets AS (SELECT s, source_size, start, least(cap, weight * max(level) OVER ()) AS target FROM levels),
    placed AS (
        SELECT doc_id, size, source_size, target, start,
            CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
            row_number() OVER (PARTITION BY s ORDER BY floor(sqrt(CAST(size AS DOUBLE))), salt, size, doc_id) AS place
        FROM sized JOIN targets USING (s))
    SELECT doc_id, size, source_size, target,
        CAST(size * least(floor(rate * place + start) - floor(rate * (place - 1) + start), ceil(rate)) AS BIGINT) AS taken
    FROM placed"""


@query("op4_mixing", _ORACLE)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return with_copies(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
