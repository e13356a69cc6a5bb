"""Fill-in-the-middle texts, cut by one match of a pattern with counted quantifiers.

A text is a row of units: a run of ASCII letters, or any other single character. ``regexp_count`` gives
their number n. Two places among the n + 1 are drawn from a digest of the document's id, and a pattern
made for the row takes ``a`` units, then ``b - a`` units, then the rest, in a single match whose
replacement puts the three parts in their order between sentinels. All quantifiers are possessive: the
units are taken one after the other without a way back, so a match costs no more stack or time for
100,000 units than its length says.

Nothing is shuffled or sampled, and a document's form depends on its id and text alone, so a task that is
run again gives the same rows. A text in which a sentinel stands is left as it is, since its parts
could not be told apart again; ``restored`` gives the exact text back from output and form.

Results by case: a NULL or empty text has no units and stays empty in plain form; a text in which one unit is
everything is cut before or behind it; NULL ids draw as an empty one; equal ids draw alike, so repeated
rows come out alike; a table without rows gives none; extra columns are passed through, and one with
the name of the added struct is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import query, table

UNIT = r"[A-Za-z]+|[^A-Za-z]"
_ONE = r"(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINEL = "<[PSM]>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _draws(key: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def filled_in(docs: DataFrame, text: str = "text", key: str = "doc_id", name: str = "fim", seed: int = 1,
              changed: int = 90, suffix_first: int = 20) -> DataFrame:
    """``docs`` with the struct ``name``: n, form, output, prefix_chars, middle_chars.

    ``changed`` percent of the documents are cut, and of these ``suffix_first`` percent begin with the suffix.
    """
    whole = F.coalesce(F.col("_row")[text].cast("string"), F.lit(""))
    h1, h2, h3, h4 = _draws(F.col("_row")[key], seed)
    places = F.col("_n") + 1
    first, second = F.pmod(h1, places), F.pmod(h2, places)
    untouched = (whole == "") | (h3 % 100 >= changed)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        untouched = untouched | F.contains(whole, F.lit(sentinel))
    pattern = F.format_string(rf"\A((?:{_ONE}){{%d}}+)((?:{_ONE}){{%d}}+)((?s:.*+))\z", "_a", F.col("_b") - F.col("_a"))
    order = F.when(F.col("_form") == SPM, F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")).otherwise(F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"))
    plain = F.col("_form") == PLAIN
    rows = (
        docs.drop(name).select(F.struct("*").alias("_row"))
        .withColumn("_n", F.regexp_count(whole, F.lit(UNIT)).cast("long"))
        .withColumns({
            "_a": F.least(first, second), "_b": F.greatest(first, second),
            "_form": F.when(untouched, PLAIN).when(h4 % 100 < suffix_first, SPM).otherwise(PSM)})
        .withColumn("_output", F.when(plain, whole).otherwise(F.regexp_replace(whole, pattern, order)))
        .withColumn("_parts", _parts(F.col("_output"), F.col("_form"))))
    made = F.struct(
        F.col("_n").alias("n"), F.col("_form").alias("form"), F.col("_output").alias("output"),
        F.char_length("_parts.prefix").cast("long").alias("prefix_chars"),
        F.char_length("_parts.middle").cast("long").alias("middle_chars"))
    return rows.select(*(F.col("_row")[c].alias(c) for c in docs.columns if c != name), made.alias(name))


def _parts(output: Column, form: Column) -> Column:
    """Prefix, middle and suffix of an output; NULL in plain form. Each sentinel stands in it once."""
    cut = F.split(output, _SENTINEL)
    spm = form == SPM
    return F.when(form != PLAIN, F.struct(
        F.when(spm, F.get(cut, F.lit(2))).otherwise(F.get(cut, F.lit(1))).alias("prefix"),
        F.get(cut, F.lit(3)).alias("middle"),
        F.when(spm, F.get(cut, F.lit(1))).otherwise(F.get(cut, F.lit(2))).alias("suffix")))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = _parts(output, form)
    return F.when(form == PLAIN, output).otherwise(F.concat(parts["prefix"], parts["middle"], parts["suffix"]))


def _digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


_ORACLE = f"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u,
            sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
    drawn AS (
        SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
            ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM units),
    placed AS (
        SELECT doc_id, text, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (
        SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
            array_to_string(u[b + 1:n], '') AS s FROM placed)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
            ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts"""


@query("op11_fill_middle", _ORACLE)
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filled_in(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", _digest(F.col("output")).alias("output_sha256"),
        _digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
