"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents that a label calls good. Everything else is unlabelled web text:
labels that call a document bad are not used. A linear model is fitted to the non-negative unbiased risk
(the risk on positives, weighted by the class prior, plus what the unlabelled texts add beyond
the positives among them, which may not go below zero). The class prior is estimated before:
it is the least ratio of unlabelled to positive texts above any threshold of a classifier of the
two that was fitted to other texts.

Features are counts over the whole text: shares of kinds of bytes, of word lengths, of the kinds of first and last
byte of words, and of repeated words and word triples. They are made in array passes over
slices of texts, and scored in the same task.

The fit takes at most ``MOST_POSITIVES`` and ``MOST_UNLABELLED`` texts, chosen by a hash of the
id; neither it nor the prior sees a held-out text. Every document is scored.

Results by case: NULL and empty texts have no features and get the score of the offset alone; rows
without id are never held out; repeated rows get the same score; without positives or unlabelled texts all
scores are 0.5; an empty table gives no rows; a document with several labels is a positive if
one of them is; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import query, table
from quayside.llm.words import Words, shingles, text_slices

MOST_POSITIVES, MOST_UNLABELLED = 8000, 16000
STEPS, RATE, DECAY = 400, 0.05, 1e-3
#: Least share of positives above a threshold at which the prior is read off.
LEAST_ABOVE = 0.2
SEED = 5


def _byte_kinds() -> np.ndarray:
    """Letters by case, digits, blanks, each ASCII sign, and lead and later bytes of other characters."""
    kinds = np.zeros(256, np.int64)
    kinds[:0x21] = 1
    kinds[0x0A] = 2
    signs = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
    for i, b in enumerate(signs):
        kinds[b] = 7 + i
    kinds[ord("0"): ord("9") + 1] = 3
    kinds[ord("a"): ord("z") + 1] = 4
    kinds[ord("A"): ord("Z") + 1] = 5
    kinds[0x80:] = 6
    return kinds


_KINDS = _byte_kinds()
_N_KINDS = int(_KINDS.max()) + 1
# For the ends of words: signs as they are, but letters of either alphabet as one.
_LENGTHS = 16
N_FEATURES = _N_KINDS + _LENGTHS + 2 * _N_KINDS + 5


def _repeats(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Share of values of each text that occur in it before."""
    order = np.lexsort((values, text))
    v, t = values[order], text[order]
    again = (v[1:] == v[:-1]) & (t[1:] == t[:-1])
    return np.bincount(t[1:][again], minlength=n) / np.maximum(1, np.bincount(text, minlength=n))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(n), lengths)
    kinds = np.bincount(text * _N_KINDS + _KINDS[data], minlength=n * _N_KINDS).reshape(n, -1)
    words = Words(data, offsets)
    counts, owner = np.diff(words.first), words.text_of()
    packed, start, end = words.packed()
    size = np.minimum(end - start, _LENGTHS) - 1
    by_length = np.bincount(owner * _LENGTHS + size, minlength=n * _LENGTHS).reshape(n, -1)
    ends = [np.bincount(owner * _N_KINDS + _KINDS[packed[at]], minlength=n * _N_KINDS).reshape(n, -1) for at in (start, end - 1)]
    triples, at = shingles(words, 3)
    twin = np.zeros(len(words.hash), bool)
    twin[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    held = np.maximum(1, counts)[:, None]
    return np.concatenate([
        np.sqrt(kinds / np.maximum(1, lengths)[:, None]), by_length / held, *(np.sqrt(x / held) for x in ends),
        np.stack([
            np.log1p(counts) / 10, (lengths == 0).astype(float), _repeats(words.hash, owner, n),
            _repeats(triples, owner[at], n), np.bincount(owner, twin, n) / held[:, 0]], 1),
    ], 1).astype(np.float32)


@dataclass(frozen=True)
class Classifier:
    """Score = logistic of ``weights . (x - mean) / spread + offset``."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    offset: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights + self.offset

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _descend(gradient, n: int) -> np.ndarray:
    """Adam on a vector of ``n`` numbers."""
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)
    for step in range(1, STEPS + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def _slope(z: np.ndarray) -> np.ndarray:
    """Of the loss log(1 + exp(-z))."""
    return -1 / (1 + np.exp(np.clip(z, -40, 40)))


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], 1)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, rng: np.random.Generator) -> float:
    """Share of positives among the unlabelled, from above."""
    p, u = rng.permutation(positive), rng.permutation(unlabelled)
    half_p, half_u = len(p) // 2, len(u) // 2

    def gradient(w: np.ndarray) -> np.ndarray:
        a, b = p[:half_p], u[:half_u]
        return (a * _slope(a @ w)[:, None]).mean(0) - (b * _slope(-(b @ w))[:, None]).mean(0) + DECAY * w

    w = _descend(gradient, p.shape[1])
    above_p, above_u = np.sort(p[half_p:] @ w), np.sort(u[half_u:] @ w)
    cuts = above_p[: max(1, int(len(above_p) * (1 - LEAST_ABOVE)))]
    share_p = 1 - np.searchsorted(above_p, cuts) / len(above_p)
    share_u = 1 - np.searchsorted(above_u, cuts) / len(above_u)
    slack = np.sqrt(share_u * (1 - share_u) / len(above_u)) + np.sqrt(share_p * (1 - share_p) / len(above_p))
    return float(np.clip(((share_u + slack) / share_p).min(), 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Classifier:
    n = N_FEATURES
    if len(positive) < 2 or len(unlabelled) < 2:
        return Classifier(np.zeros(n), np.ones(n), np.zeros(n), 0.0, 0.5)
    mean = unlabelled.mean(0, dtype=np.float64)
    spread = unlabelled.std(0, dtype=np.float64)
    spread = np.where(spread > 1e-4, spread, 1.0)
    p, u = (_with_one(np.clip((x - mean) / spread, -20, 20)) for x in (positive, unlabelled))
    prior = estimated_prior(p, u, np.random.default_rng(SEED))

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        good = prior * (p * _slope(zp)[:, None]).mean(0)
        # Risk of calling positives bad, taken off the risk of calling unlabelled texts bad.
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope = -(u * _slope(-zu)[:, None]).mean(0) + prior * (p * _slope(-zp)[:, None]).mean(0)
        decay = DECAY * np.append(w[:-1], 0)
        return (good + slope if negative >= 0 else -slope) + decay

    w = _descend(gradient, n + 1)
    return Classifier(mean, spread, w[:-1], float(w[-1]), prior)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in text_slices(batch):
            x = features(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "positive", "x"])


def _scores(model: Classifier, names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, text):
                x = np.clip((features(data, offsets) - model.mean) / model.spread, -20, 20)
                score = 1 / (1 + np.exp(-np.clip(x @ model.weights + model.offset, -40, 40)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(score)], [*names, "score"])
    return run


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
            most_positives: int = MOST_POSITIVES, most_unlabelled: int = MOST_UNLABELLED) -> Classifier:
    """Fits to documents that are not held out; ``labels(doc_id, quality)`` name the positives."""
    def sample(rows: DataFrame, most: int) -> DataFrame:
        ids = rows.select(F.col(key).cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").filter(~held_out("doc_id")).distinct()
        return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    positives = sample(labels.filter("quality = 1"), most_positives).withColumn("positive", F.lit(True))
    unlabelled = sample(docs, most_unlabelled).withColumn("positive", F.lit(False))
    chosen = positives.union(unlabelled)  # no more rows than the two bounds
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "positive").agg(F.max("text").alias("text"))
    found = rows.mapInArrow(_features, "doc_id long, positive boolean, x binary").collect()
    found.sort(key=lambda r: (r["positive"], r["doc_id"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in found], np.float64).reshape(-1, N_FEATURES)
    positive = np.array([r["positive"] for r in found], bool)
    return fit(x[positive], x[~positive])


def scored(docs: DataFrame, model: Classifier, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` of every document."""
    rows = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = rows.select(*keep).schema
    return rows.mapInArrow(_scores(model, list(keep), "_text"), schema.add("score", "double"))


@query("op9_pu_classifier")
def op9_pu_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
