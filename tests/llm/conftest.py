from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quayside.llm.base import prepared


@pytest.fixture
def session(spark):
    return prepared(spark)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Documents with NULLs, blanks, ties, repeats, near copies and a very long text."""
    rng = random.Random(3)
    base, passage, long = words(rng, 120), words(rng, 50), words(rng, 6000)
    near = base.split()
    near[60] = "changed"
    shouted = words(rng, 70)
    lines = "\n".join(words(rng, 12) for _ in range(6))
    texts = [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (None, base), (None, None),
        (7, long), (8, long + " end"), (9, "four words of text"), (10, "four  words\nof text"), (11, "x"),
        (12, words(rng, 30) + " " + passage + " " + words(rng, 30)), (13, words(rng, 40) + "\n" + passage),
        (14, lines), (15, words(rng, 8) + "\n" + lines), (16, "ünï 日本 #$% | " + words(rng, 60)), (16, "other text of the same id"),
        (17, "same same same same " * 30), (18, lines + "\n\n" + lines), (2**40, words(rng, 55)),
        (19, shouted.upper()), (20, shouted.title()), (21, shouted + " \xc9T\xc9"), (22, shouted + " \xe9t\xe9"), (23, "Four Words OF Text"),
    ]
    return [(k, t, ("a", "b", None)[i % 3]) for i, (k, t) in enumerate(texts)]


@pytest.fixture
def odd(session, odd_rows):
    """The same with columns whose names the operators use themselves."""
    docs = session.createDataFrame(odd_rows, "doc_id long, text string, source string").repartition(3)
    return docs.withColumns({name: F.lit(i) for i, name in enumerate((
        "key", "tie", "size", "mix", "lines", "quality", "n_words", "node", "component_id", "bucket", "low", "_tie", "ids"))})


@pytest.fixture
def empty(session):
    return session.createDataFrame([], "doc_id long, text string, source string")
