"""Weak supervision: rules vote or abstain, expectation-maximisation says how far to trust them.

Every rule looks at a few counts of a text and calls it clean, junk, or abstains. Nobody says
which rule is right. A model of two classes, in which a rule calls a clean text clean or junk
with rates of its own and a junk text with others, is fitted to the observed combinations of
votes by expectation-maximisation; the posterior probability of the clean class decides.

The votes of six rules make at most 3**6 combinations. The fit works on the counts of these,
in DataFrame aggregations; only the rates themselves (four per rule) come to the driver.
Everything else is one pass over the texts in built-in functions.

Results by case: a NULL or blank text has no words, fails the base rule and is not kept; a
table without rows gives no rows; repeated rows are judged alike, one by one, and each counts
in the fit; NULL in other columns plays no part. Columns of the input are passed through, but
for one that has the name of the added struct, which is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import BLANK, WORD, let, query, stored, table, words_of

CLEAN, JUNK, ABSTAIN = 1, -1, 0
ROUNDS = 20
# Start of the fit: share of clean texts, and votes of a rule on either class.
PRIOR_CLEAN = 0.8
JUNK_CALLED_JUNK, JUNK_CALLED_CLEAN = 0.5, 0.25
CLEAN_CALLED_JUNK, CLEAN_CALLED_CLEAN = 0.02, 0.7
# Votes that each rate is thought to rest on before any text is seen.
WEIGHT = 10.0
# Words of letters, perhaps quoted, ended by ordinary punctuation.
PLAIN_WORD = r"(?<![^\x20\x09-\x0D])[\"'(]?\p{L}+(?:['’-]\p{L}+)*[.,;:?!]?[\"')]?(?![^\x20\x09-\x0D])"
UPPER = r"[A-ZÀ-ÖØ-Þ]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_plain", "n_upper")


def repeated_window_words(words: Column) -> Column:
    """How many words stand in a window of three that occurs twice or more in the text."""
    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda p: F.size(F.array_distinct(F.flatten(F.transform(
            F.filter(p, lambda x, j: (
                F.coalesce(x["h"] == F.get(p, j - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(p, j + 1)["h"], F.lit(False)))),
            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))

    def count(w: Column) -> Column:
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(
            windows(w),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))

    return let(words, count)


def counts_of(text: Column) -> Column:
    """Struct of ``COUNTS``, all long and none NULL."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            (F.char_length(text) - F.regexp_count(text, F.lit(BLANK))).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_window_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(text, F.lit(PLAIN_WORD)).cast("long").alias("n_plain"),
            F.regexp_count(text, F.lit(UPPER)).cast("long").alias("n_upper"),
        )

    return let(words_of(text), of)


def _vote(clean: str | None, junk: str | None) -> str:
    arms = [f"WHEN {c} THEN {v}" for c, v in ((junk, JUNK), (clean, CLEAN)) if c]
    return f"CASE {' '.join(arms)} ELSE {ABSTAIN} END"


# name -> vote, in SQL that both Spark and the oracle read; integer arithmetic, so both agree.
RULES = {
    "plain_words": _vote("10 * n_plain >= 9 * n_words", "10 * n_plain < 7 * n_words"),
    "symbols": _vote("n_symbols = 0", "10 * n_symbols > n_words"),
    "repetition": _vote("20 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    "shouting": _vote("10 * n_upper <= word_chars", "10 * n_upper > 3 * word_chars"),
    "repeated_lines": _vote(None, "10 * n_dup_lines > 3 * n_lines"),
    "word_length": _vote("word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


@dataclass(frozen=True)
class Model:
    """Share of clean texts and, per rule, how often it calls (clean texts clean, clean texts
    junk, junk texts clean, junk texts junk)."""

    prior: float
    rates: dict[str, tuple[float, float, float, float]]

    def log_odds(self) -> Column:
        """Of clean against junk, of a row with the votes as columns."""
        odds = F.log(F.lit(self.prior)) - F.log(F.lit(1.0 - self.prior))
        for name, (cc, cj, jc, jj) in self.rates.items():
            odds = odds + (
                F.when(F.col(name) == CLEAN, F.log(F.lit(cc)) - F.log(F.lit(jc)))
                .when(F.col(name) == JUNK, F.log(F.lit(cj)) - F.log(F.lit(jj)))
                .otherwise(F.log(F.lit(1.0 - cc - cj)) - F.log(F.lit(1.0 - jc - jj))))
        return odds

    def posterior(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.log_odds()))


START = Model(PRIOR_CLEAN, dict.fromkeys(
    RULES, (CLEAN_CALLED_CLEAN, CLEAN_CALLED_JUNK, JUNK_CALLED_CLEAN, JUNK_CALLED_JUNK)))


def fit(votes: DataFrame, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the combinations of votes in ``votes``."""
    patterns = stored(votes.groupBy(*RULES).agg(F.count("*").alias("n")).coalesce(1), "quality-patterns")
    model = START
    for _ in range(rounds):
        rows = patterns.withColumn("c", F.col("n") * model.posterior()).withColumn("j", F.col("n") - F.col("c"))
        sums = rows.agg(
            F.sum("n").alias("n"), F.sum("c").alias("c"), F.sum("j").alias("j"),
            *(F.sum(F.when(F.col(name) == vote, F.col(side)).otherwise(0.0)).alias(f"{name}_{side}_{vote}")
              for name in RULES for side in ("c", "j") for vote in (CLEAN, JUNK)),
        ).first()
        if not sums["n"]:
            break

        def rate(name: str, side: str, vote: int, start: float) -> float:
            return (sums[f"{name}_{side}_{vote}"] + WEIGHT * start) / (sums[side] + WEIGHT)

        model = Model(
            (sums["c"] + WEIGHT * PRIOR_CLEAN) / (sums["n"] + WEIGHT),
            {name: (
                rate(name, "c", CLEAN, CLEAN_CALLED_CLEAN), rate(name, "c", JUNK, CLEAN_CALLED_JUNK),
                rate(name, "j", CLEAN, JUNK_CALLED_CLEAN), rate(name, "j", JUNK, JUNK_CALLED_JUNK)) for name in RULES})
    return model


def with_quality(
    docs: DataFrame, text: str = "text", threshold: float = 0.5, name: str = "quality", keep: Sequence[str] | None = None
) -> DataFrame:
    """Adds struct ``name``: the counts, the votes, ``base_failed``, ``posterior`` and ``kept``.

    The counted rows are stored once, since the fit must see all votes before the first
    verdict; ``keep`` names the columns still needed then (all, if not given).
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c != name]
    row = F.struct(*columns).alias("_row") if columns else F.struct(F.lit(1)).alias("_row")
    counted = stored(docs.select(row, counts_of(F.col(text)).alias("_counts")), "quality-counts")
    flat = counted.select("_row", *(F.col(f"_counts.{c}").alias(f"_q_{c}") for c in COUNTS))

    def over_counts(sql: str) -> Column:
        return F.expr(_prefixed(sql))

    voted = flat.select("*", *(over_counts(sql).alias(f"_v_{rule}") for rule, sql in RULES.items()))
    judged = voted.filter(~over_counts(BASE_FAILED))
    model = fit(judged.select(*(F.col(f"_v_{rule}").alias(rule) for rule in RULES)))
    votes = F.struct(*(F.col(f"_v_{rule}").alias(rule) for rule in RULES))
    posterior = _renamed_posterior(model)
    failed = over_counts(BASE_FAILED)
    quality = F.struct(
        *(F.col(f"_q_{c}").alias(c) for c in COUNTS), votes.alias("votes"), failed.alias("base_failed"),
        posterior.alias("posterior"), (~failed & (posterior >= threshold)).alias("kept"))
    return voted.select(*(F.col("_row")[c].alias(c) for c in columns), quality.alias(name))


def _prefixed(sql: str) -> str:
    for column in COUNTS:
        sql = sql.replace(column, f"_q_{column}")
    return sql


def _renamed_posterior(model: Model) -> Column:
    return Model(model.prior, {f"_v_{name}": rates for name, rates in model.rates.items()}).posterior()


def kept_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    rows = with_quality(docs.select("text", F.struct("*").alias("row")), keep=("row",))
    return rows.filter("quality.kept").select("row.*")


def _oracle() -> str:
    votes = ", ".join(f"{sql} AS {name}" for name, sql in RULES.items())

    def log_odds(p: str) -> str:
        terms = [f"ln({p}prior) - ln(1.0 - {p}prior)"]
        for r in RULES:
            cc, cj, jc, jj = (f"{p}{r}_{s}" for s in ("cc", "cj", "jc", "jj"))
            terms.append(
                f"CASE {r} WHEN {CLEAN} THEN ln({cc}) - ln({jc}) WHEN {JUNK} THEN ln({cj}) - ln({jj})"
                f" ELSE ln(1.0 - {cc} - {cj}) - ln(1.0 - {jc} - {jj}) END")
        return " + ".join(terms)

    start = {"cc": CLEAN_CALLED_CLEAN, "cj": CLEAN_CALLED_JUNK, "jc": JUNK_CALLED_CLEAN, "jj": JUNK_CALLED_JUNK}
    first = ", ".join(f"CAST({v} AS DOUBLE) AS {r}_{s}" for r in RULES for s, v in start.items())
    sides = {"cc": ("c", CLEAN), "cj": ("c", JUNK), "jc": ("j", CLEAN), "jj": ("j", JUNK)}
    sums = {
        f"{r}_{s}": f"(sum(CASE WHEN {r} = {vote} THEN {side} ELSE 0.0 END) + {WEIGHT * start[s]}) / (sum({side}) + {WEIGHT})"
        for r in RULES for s, (side, vote) in sides.items()}
    names = ", ".join(sums)
    return f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents)),
    windows AS (
        SELECT doc_id, i, word, lead(word, 1) OVER p AS second, lead(word, 2) OVER p AS third
        FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
    twice AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, second, third) AS n
            FROM windows WHERE third IS NOT NULL) WHERE n > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + d) AS n
        FROM twice, (VALUES (0), (1), (2)) AS t(d) GROUP BY doc_id),
    texts AS (
        SELECT doc_id, coalesce(text, '') AS t,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines,
            regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
        FROM documents),
    counts AS (
        SELECT doc_id, len(w) AS n_words,
            length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
            len(lines) AS n_lines,
            len(list_filter(w, lambda x: regexp_full_match(x, '["''(]?\\p{{L}}+([''’-]\\p{{L}}+)*[.,;:?!]?["'')]?'))) AS n_plain,
            len(regexp_extract_all(t, '{UPPER}')) AS n_upper
        FROM texts LEFT JOIN covered USING (doc_id)),
    voted AS (SELECT *, {votes}, {BASE_FAILED} AS base_failed FROM counts),
    patterns AS (SELECT {', '.join(RULES)}, CAST(count(*) AS DOUBLE) AS n FROM voted WHERE NOT base_failed GROUP BY ALL),
    em AS (
        SELECT 0 AS turn, CAST({PRIOR_CLEAN} AS DOUBLE) AS prior, {first}
        UNION ALL
        SELECT turn + 1, (sum(c) + {WEIGHT * PRIOR_CLEAN}) / (sum(n) + {WEIGHT}), {', '.join(sums.values())}
        FROM (
            SELECT turn, patterns.*, n / (1.0 + exp(-({log_odds('')}))) AS c, n - n / (1.0 + exp(-({log_odds('')}))) AS j
            FROM em, patterns WHERE turn < {ROUNDS})
        GROUP BY turn)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
        CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
        CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
        NOT base_failed AND 1.0 / (1.0 + exp(-({log_odds('')}))) >= 0.5 AS kept
    FROM voted, (SELECT prior, {names} FROM em WHERE turn = {ROUNDS})"""


@query("op5_quality_rules", _oracle())
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The text is not needed once it is counted.
    judged = with_quality(docs, name="q", keep=("doc_id",))
    return judged.select(
        "doc_id", *(f"q.{c}" for c in COUNTS[:5]), "q.base_failed", "q.kept")
