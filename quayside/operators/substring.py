"""Join on "this text contains that name", without comparing every pair.

Names are known by their beginnings, pieces of ``GRAM`` neighbouring characters, each with the lengths of the
names that begin so: a list that does not grow with the number of names. Each text is cut into its grams, no more
than it has characters, and where one is a beginning, into the pieces of those lengths; an equality join of the pieces
with the names gives the pairs themselves, none to be thrown away. Names shorter than a gram are joined on the
pieces of the text of their lengths.

Names are read several times, so they are best stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def _pieces(text: Column, length: Column) -> Column:
    """The parts of ``text`` that have this length."""
    last = F.char_length(text) - length + 1
    return F.when(last > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda start: F.substring(text, start, length)))


def _starting(text: Column, gram: Column, lengths: Column) -> Column:
    """The distinct parts of ``text`` that start with ``gram`` and have one of these lengths."""
    last = F.char_length(text) - F.char_length(gram) + 1
    starts = F.filter(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.char_length(gram)) == gram)
    parts = F.transform(starts, lambda i: F.transform(
        F.filter(lengths, lambda n: i + n - 1 <= F.char_length(text)), lambda n: F.substring(text, i, n)))
    return F.array_distinct(F.flatten(parts))


def rarest_grams(names: DataFrame, name: str, gram: int = GRAM) -> DataFrame:
    """Distinct names that have grams with ``_gram``, of theirs the one that the fewest names hold."""
    grams = names.select(name, F.explode(F.array_distinct(_pieces(F.col(name), F.lit(gram)))).alias("_gram"))
    held = grams.groupBy("_gram").agg(F.count("*").alias("_held"))
    return grams.join(held, "_gram").groupBy(name).agg(F.min(F.struct("_held", "_gram"))["_gram"].alias("_gram"))


def contained_names(texts: DataFrame, text: str, names: DataFrame, name: str, gram: int = GRAM) -> DataFrame:
    """``texts`` joined with each row of ``names`` whose ``name`` is a part of ``text``.

    Texts must be distinct. An empty name is part of every text, but is left out here: see
    ``last_contained``.
    """
    whole = F.array_distinct(_pieces(F.col(text), F.lit(gram)))
    begun = names.filter(F.char_length(name) >= gram).groupBy(F.substring(name, 1, gram).alias("_gram")).agg(
        F.collect_set(F.char_length(name)).alias("_lengths"))
    # Spark takes exploded texts to be as small as the texts, and those and the names to be as small as they are stored,
    # packed: left alone it may send all grams, or all names, through the driver. Hence the merges.
    long = texts.select(*texts.columns, F.explode(whole).alias("_gram")).hint("merge").join(begun, "_gram").select(
        *texts.columns, F.explode(_starting(F.col(text), F.col("_gram"), F.col("_lengths"))).alias(name))
    few = names.filter(F.char_length(name).between(1, gram - 1))
    lengths = few.agg(F.collect_set(F.char_length(name))).scalar()
    pieces = F.array_distinct(F.flatten(F.filter(
        F.transform("_lengths", lambda n: _pieces(F.col(text), n)), lambda found: found.isNotNull())))
    short = texts.withColumn("_lengths", lengths).select(*texts.columns, F.explode(pieces).alias(name))
    return long.union(short).join(names.hint("merge"), name)


def last_contained(rows: DataFrame, text: str, names: DataFrame, name: str, match: str = "match") -> DataFrame:
    """Adds struct ``match``: of the ``names`` rows contained in ``text``, the greatest by ``name``.

    ``names`` has one row per name. Repeated texts are matched once.
    """
    best = F.max(F.struct(name, *(c for c in names.columns if c != name)))
    found = contained_names(rows.select(text).filter(F.col(text).isNotNull()).distinct(), text, names, name)
    # The empty name sorts before all others, so it only counts where nothing else matched.
    empty = names.filter(F.col(name) == "").agg(best).scalar()
    return (
        rows.join(found.groupBy(text).agg(best.alias("_best")), text, "left")
        .withColumn(match, F.coalesce(F.col("_best"), F.when(F.col(text).isNotNull(), empty)))
        .drop("_best")
    )
