"""Packing documents into sequences by lexical retrieval.

Related documents are brought together first. Each document goes to the pivot, of some sampled
documents, that BM25 puts nearest to it; those of one pivot are ordered by their most telling terms, so
copies and most near copies come next to each other wherever they were stored. This order is cut into
shards of about equal numbers of documents, a big group into several.

Each shard has an inverted index from
token to the documents that hold it, with BM25 weights; the document frequencies and the mean
length in these weights are those of the whole corpus. A window starts with a seed document. The
index returns the unused documents of the shard that are nearest to the seed, and they fill the
window one after the other; one that does not fit is cut, and its rest seeds the next window. So
all windows of a partition but its last are full. A seed does not ask other shards than its own.

Tokens are the terms, so the table of frequencies has one entry per id of the vocabulary, whatever
the corpus. Token ids are stored once, below the shared folder; shards are made from that table in an
order that depends on the rows alone, so that a task that is run again makes the same sequences.

Results by case: a NULL or empty text is the closing id alone; repeated rows and rows without
doc_id are documents like others; a table without rows gives none; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import query, stored, table
from quayside.llm.bpe import VOCABULARY, Encoder, default_ranks
from quayside.llm.words import spans, text_slices

LENGTH = 2048
END = 1
SHARD_DOCS, SHARD_TOKENS = 2048, 4_000_000
#: A term that this share of a shard's documents hold has a row of weights.
COMMON = 1 / 8
#: Nearest documents that are sorted at first.
BLOCK = 16
#: Documents that the order of routes is shaped by, and the most bytes of ids of one.
PIVOTS, PIVOT_BYTES = 64, 1 << 17
#: Partitions the order is cut into at most, each of one or more shards; documents sampled for the cuts, for each and at most.
PARTITIONS, PER_PART, SAMPLED = 20_000, 32, 1 << 17
K1, B = 1.2, 0.75
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def distinct(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, id and count of the distinct ids of consecutive documents, all in one sort."""
    n = len(lengths)
    keys = np.repeat(np.arange(n, dtype=np.uint32 if n <= 1 << 16 else np.uint64) << 16, lengths)
    keys |= ids
    keys.sort()
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    counts = np.diff(new, append=len(keys))
    keys = keys[new]
    return (keys >> 16).astype(np.int64), (keys & 0xFFFF).astype(np.int64), counts


def _encoded(ranks_path: str, end: int):
    """A row of ids per document, and a last row per task with its document frequencies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, frequency = Encoder(ranks_path), np.zeros(VOCABULARY, np.int64)
        names = ["doc_id", "ids", "frequency", "task"]
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                ids, first = encoder.slice(data, offsets)
                n = len(first) - 1
                # Room for the closing id of each document.
                out = np.full(len(ids) + n, end, np.uint16)
                starts = first + np.arange(n + 1)
                out[spans(starts[:-1], np.diff(first))] = ids
                raw = out.tobytes()
                frequency += np.bincount(distinct(ids, np.diff(first))[1], minlength=VOCABULARY)
                rows = pa.array([raw[2 * a: 2 * b] for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), rows, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([frequency.tobytes()], pa.binary()),
            pa.array([TaskContext.get().partitionId()], pa.int64())], names)
    return run


def _added(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in group.column("frequency"))
    return pa.table({"frequency": pa.array([np.asarray(total).tobytes()], pa.binary())})


def document_frequency(encoded: DataFrame) -> np.ndarray:
    """Documents that hold each id: arrays of the tasks, added up in two steps."""
    rows = encoded.filter("frequency IS NOT NULL").select("task", "frequency")
    groups = int(max(1, rows.count() ** 0.5))
    half = rows.groupBy(F.pmod("task", F.lit(groups)).alias("g")).applyInArrow(_added, "frequency binary")
    row = half.groupBy(F.lit(0).alias("g")).applyInArrow(_added, "frequency binary").first()
    return np.frombuffer(row["frequency"], np.int64) if row else np.zeros(VOCABULARY, np.int64)


class Shard:
    """An inverted index with BM25 weights over some documents, each an array of ids."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        lengths = np.array([len(d) for d in docs], np.int64)
        # Without the closing ids.
        owner, self._terms, counts = distinct(np.concatenate([d[:-1] for d in docs]), lengths - 1)
        self._first = np.searchsorted(owner, np.arange(len(docs) + 1))
        weight = idf[self._terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[owner] / mean_length))
        order = np.argsort(self._terms, kind="stable")
        self._owner, self._weight = owner[order], weight[order]
        held = np.bincount(self._terms, minlength=VOCABULARY)
        self._at, self.held = np.concatenate(([0], np.cumsum(held))), held
        self._n = len(docs)
        # Adding up rows is much quicker than going through the documents of common terms.
        common = np.flatnonzero(held >= max(2, COMMON * self._n))
        self._row = np.full(VOCABULARY, -1, np.int32)
        self._row[common] = np.arange(len(common))
        self._rows = np.zeros((len(common), self._n), np.float32)
        row = self._row[self._terms[order]]
        self._rows[row[row >= 0], self._owner[row >= 0]] = self._weight[row >= 0]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all documents for all terms of a seed."""
        return self.scores_of(self._terms[self._first[seed]: self._first[seed + 1]])

    def scores_of(self, terms: np.ndarray) -> np.ndarray:
        """BM25 of all documents for these terms, each once."""
        row = self._row[terms]
        terms = terms[row < 0]
        places = spans(self._at[terms], self.held[terms])
        return np.bincount(self._owner[places], self._weight[places], self._n) + self._rows[row[row >= 0]].sum(axis=0)


class Routes:
    """A number for each document; like ones have equal numbers, or numbers next to each other."""

    def __init__(self, pivots: list[np.ndarray], frequency: np.ndarray, idf: np.ndarray, mean_length: float) -> None:
        self._weights = np.zeros((VOCABULARY, max(1, len(pivots))), np.float32)
        if pivots:
            index = Shard(pivots, idf, mean_length)
            for term in range(VOCABULARY):
                if index.held[term]:
                    self._weights[term] = index.scores_of(np.array([term]))
        # Terms by rarity, and how many of them no two documents hold.
        self._term = np.argsort(frequency, kind="stable").astype(np.uint16)
        self._rank = np.zeros(VOCABULARY, np.uint16)
        self._rank[self._term] = np.arange(VOCABULARY)
        self._alone = int((frequency <= 1).sum())

    def of(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per document the nearest pivot, then the three rarest terms that another document holds."""
        n = len(lengths)
        owner, rank, _ = distinct(self._rank[ids], lengths)
        first = np.searchsorted(owner, np.arange(n + 1))
        scores, nearest = self._weights[self._term[rank]], np.zeros(n, np.int64)
        held = np.flatnonzero(np.diff(first))
        if len(held):
            nearest[held] = np.argmax(np.add.reduceat(scores, first[held], axis=0), axis=1)
        # Ranks of a document rise, so its rarest terms are the first ones that are not alone.
        shared = rank >= self._alone
        rank, first = rank[shared], np.concatenate(([0], np.cumsum(shared)))[first]
        number = nearest
        for k in range(3):
            at = first[:-1] + k
            there = at < first[1:]
            term = np.full(n, 0xFFFF, np.int64)
            term[there] = self._term[rank[at[there]]]
            number = number << 16 | term
        return number


def _blocks(lengths: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Consecutive documents of some ``most`` ids together, one at least."""
    ends, low = np.cumsum(lengths), 0
    while low < len(lengths):
        high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, "right"))
        high = max(high, low + 1)
        yield low, high
        low = high


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of documents without the closing ones, and their number per document."""
    rows = [np.frombuffer(x.as_py(), np.uint16)[:-1] for x in column]
    return np.concatenate(rows) if rows else np.zeros(0, np.uint16), np.array([len(r) for r in rows], np.int64)


def _routed(routes: Routes, bounds: list[tuple[int, int]]):
    """Adds route and part: the place of (route, salt) among the bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths = _ids_of(batch.column(1))
            first = np.concatenate(([0], np.cumsum(lengths)))
            number = np.concatenate([np.zeros(0, np.int64)] + [
                routes.of(ids[first[a]: first[b]], lengths[a:b]) for a, b in _blocks(lengths)])
            part = [bisect_right(bounds, x) for x in zip(number.tolist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number, pa.int64()), pa.array(part, pa.int32())],
                ["doc_id", "ids", "salt", "route", "part"])
    return run


ROUTED = "doc_id long, ids binary, salt long, route long, part int"


def _by_route(rows: DataFrame, docs: int, tokens: int, frequency: np.ndarray, idf: np.ndarray, mean_length: float) -> DataFrame:
    """``(doc_id, ids)`` in the order of routes, consecutive ones in one partition."""
    rows = rows.withColumn("tie", F.xxhash64("doc_id", "ids"))
    # A big group of copies is not to take all places, so rows are sampled, and equal texts once.
    some = rows.filter(F.octet_length("ids").between(4, PIVOT_BYTES)).filter(
        F.pmod("tie", F.lit(max(1, docs // (4 * PIVOTS)))) == 0).groupBy("tie").agg(F.first("ids").alias("ids"))
    pivots = [np.frombuffer(x, np.uint16) for x in dict.fromkeys(bytes(r["ids"]) for r in some.orderBy("tie").limit(PIVOTS).collect())]
    routes = Routes(pivots, frequency, idf, mean_length)
    # Somewhat more partitions than full shards, so that most are one shard.
    parts = int(min(PARTITIONS, max(1, -(-5 * max(docs / SHARD_DOCS, tokens / SHARD_TOKENS) // 4))))
    # Rows alike in doc_id and text differ by their place in the stored table, so that no partition gets all of them.
    rows = rows.select("doc_id", "ids", F.xxhash64("tie", F.monotonically_increasing_id()).alias("salt"))
    bounds = []
    if parts > 1:
        found = rows.sample(min(1.0, min(SAMPLED, PER_PART * parts) / docs), seed=1).mapInArrow(_routed(routes, []), ROUTED)
        found = sorted((r["route"], r["salt"]) for r in found.select("route", "salt").collect())
        bounds = [found[len(found) * k // parts] for k in range(1, parts)] if found else []
    routed = rows.mapInArrow(_routed(routes, bounds), ROUTED)
    return routed.repartitionById(parts, F.col("part")).sortWithinPartitions("route", "salt", "doc_id").select("doc_id", "ids")


def _nearest(scores: np.ndarray, some: int) -> np.ndarray:
    """The documents that score best, best first: ``some``, and those that score as much as the last of them."""
    some = min(some, len(scores))
    near = np.flatnonzero((scores > 0) & (scores >= np.partition(scores, -some)[-some]))
    return near[np.lexsort((near, -scores[near]))]


def _order(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, length: int, filled: int) -> Iterator[int]:
    """The documents of a shard in packing order; ``filled`` is how full the window is before."""
    shard = Shard(docs, idf, mean_length)
    unused = np.ones(len(docs), bool)
    lowest, seed, near, at, some = 0, -1, np.zeros(0, np.int64), 0, BLOCK
    scores = np.zeros(len(docs))
    for _ in range(len(docs)):
        if at == len(near) and len(near):
            # All of these are in the window: the next best, more of them each time.
            scores[near], some = 0.0, 2 * some
            near, at = _nearest(scores, some), 0
        if at < len(near):
            pick, at = int(near[at]), at + 1
        else:
            while not unused[lowest]:
                lowest += 1
            pick = lowest
        unused[pick] = False
        yield pick
        left = filled + len(docs[pick])
        filled = left % length
        if seed < 0 or left >= length:
            # A new window: what is cut, or else this document, is its seed.
            seed = pick
            scores = np.where(unused, shard.scores(pick), 0.0)
            some = BLOCK
            near, at = _nearest(scores, some), 0


def _packed(idf: np.ndarray, mean_length: float, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, filled = TaskContext.get().partitionId() << 32, 0

        def shard(keys: list, docs: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal sequence, filled
            rows: list[tuple] = []
            for i in _order(docs, idf, mean_length, length, filled):
                ids, start = docs[i].astype("<u4"), 0
                while start < len(ids):
                    n = min(length - filled, len(ids) - start)
                    rows.append((keys[i], start, n, zlib.crc32(ids[start: start + n].tobytes()), len(ids), sequence, filled))
                    start, filled = start + n, filled + n
                    if filled == length:
                        sequence, filled = sequence + 1, 0
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

        keys, docs, tokens = [], [], 0
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if docs and (len(docs) >= SHARD_DOCS or tokens >= SHARD_TOKENS):
                    yield shard(keys, docs)
                    keys, docs, tokens = [], [], 0
                keys.append(key)
                docs.append(np.frombuffer(ids.as_py(), np.uint16))
                tokens += len(docs[-1])
        if docs:
            yield shard(keys, docs)
    return run


def packed(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, end: int = END,
           ranks_path: str | None = None) -> DataFrame:
    """One row per piece of a document (see ``PIECES``)."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    encoded = stored(texts.mapInArrow(
        _encoded(ranks_path or default_ranks(), end), "doc_id long, ids binary, frequency binary, task long"), "token-ids")
    rows = encoded.filter("ids IS NOT NULL").select("doc_id", "ids")
    sums = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("ids")).alias("bytes")).first()
    n = max(1, sums["n"])
    frequency = document_frequency(encoded)
    idf = np.log(1 + (n - frequency + 0.5) / (frequency + 0.5))
    tokens = (sums["bytes"] or 0) / 2
    routed = _by_route(rows, n, tokens, frequency, idf, tokens / n)
    return routed.mapInArrow(_packed(idf, tokens / n, length), PIECES)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all sequences."""
    return packed(docs)


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))
