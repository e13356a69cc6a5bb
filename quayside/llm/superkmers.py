"""Removal of long passages that occur twice, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. Its minimiser is the least hash of the
``SEED_WORDS``-word runs in it. Consecutive windows with the same minimiser travel as one packed
string (a super-k-mer) to the bucket of the minimiser, so equal windows meet in one bucket,
wherever they are, and a word travels some three times instead of thirty-five. A bucket sorts its
windows and so counts them exactly (a window counts as its 128-bit digest); places of windows
that occur twice go back to their texts as ranges of words, and the texts are cut.

A minimiser can be hot: a passage in a third of all texts. A first pass finds all minimisers with
more than one in ``HOT_SHARE`` of all super-k-mers (at most that many, whatever the input); their
windows travel one by one, to buckets chosen by the whole window. And each task first
counts its own: of strings equal within a batch one is sent, marked as repeated, and the places
of all of them are known at once. So a bucket gets each string once per batch at most. The number
of buckets follows the size of the corpus, not a setting.

Results by case: a NULL text has no words and keeps none; texts shorter than a window stay whole,
with single spaces between their words; rows that repeat one another are different places, so
their windows count as repeated; NULL doc_id is an id like others; columns of the input are
passed through, and those of the names that are added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.base import WORD, query, stored, table
from quayside.llm.packed import pack, unpack
from quayside.llm.words import SLICE_BYTES, Words, mix, run_hashes, run_starts, shingles, spans, text_slices

WINDOW = 35
SEED_WORDS = 3
HOT_SHARE = 1000
BUCKET_BYTES = 16_000_000
LEAST_BUCKETS = 64
COMBINE_BYTES = 4_000_000
ADDED = ("n_words", "n_removed", "kept_text")


def _minimisers(words: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser of every window, first word of every window, and where runs of one minimiser begin."""
    hashes, _ = shingles(words, seed)
    starts = run_starts(words.first, window)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(0, np.int64)
    # Seed runs are numbered without the ends of texts; a text before has left out seed - 1.
    text = np.searchsorted(words.first, starts, "right") - 1
    counts = np.maximum(np.diff(words.first) - seed + 1, 0)
    at = np.concatenate(([0], np.cumsum(counts)))[text] + (starts - words.first[text])
    width, have, least = window - seed + 1, 1, hashes
    while 2 * have <= width:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    least = np.minimum(least[at], least[at + width - have])
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
    return least, starts, np.flatnonzero(new)


def _profile(window: int, seed: int, hot_share: int):
    """Per batch: number of super-k-mers, their bytes, and the minimisers frequent in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                words = Words(data, offsets)
                least, starts, runs = _minimisers(words, window, seed)
                if not len(runs):
                    continue
                values, counts = np.unique(least[runs], return_counts=True)
                often = counts * 2 * hot_share >= len(runs)
                often &= counts > 1
                values, counts = values[often], counts[often]
                n_words = len(starts) + len(runs) * (window - 1)
                size = int(n_words * len(data) / max(1, len(words.hash)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([None, *values.view(np.int64).tolist()], pa.int64()),
                    pa.array([len(runs), *counts.tolist()], pa.int64()),
                    pa.array([size, *[0] * len(values)], pa.int64())], ["minimiser", "n", "size"])
    return run


def _digests(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits for each run of words, as two rows of numbers."""
    return np.stack([
        run_hashes(hashes, starts, ends), run_hashes(mix(hashes ^ np.uint64(0xA0761D6478BD642F)), starts, ends)])


def _groups(digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts equal digests together, and where each group of them begins in it."""
    order = np.lexsort(digest)
    new = np.ones(len(order), bool)
    new[1:] = (digest[:, order[1:]] != digest[:, order[:-1]]).any(axis=0)
    return order, np.flatnonzero(new)


_PLACE = np.dtype([("key", np.int64), ("tie", np.int64), ("at", np.int32), ("words", np.int32)])


def _units(window: int, seed: int, hot: np.ndarray, buckets: int):
    """Super-k-mers of each batch, combined and packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, most=COMBINE_BYTES):
                words = Words(data, offsets)
                least, starts, runs = _minimisers(words, window, seed)
                if not len(runs):
                    continue
                lengths = np.diff(np.append(runs, len(starts)))
                single = np.isin(least[runs], hot)
                # Windows of a hot minimiser are units of their own.
                alone = spans(runs[single], lengths[single])
                begin = np.concatenate((starts[runs[~single]], starts[alone]))
                n_words = np.concatenate((lengths[~single] + window - 1, np.full(len(alone), window)))
                digest = _digests(words.hash, begin, begin + n_words)
                minimiser = np.concatenate((least[runs[~single]], digest[0, len(begin) - len(alone):]))
                order, heads = _groups(digest)
                counts = np.diff(np.append(heads, len(order)))
                repeated = np.zeros(len(begin), bool)
                repeated[order] = np.repeat(counts > 1, counts)
                text = np.searchsorted(words.first, begin, "right") - 1
                place = np.empty(len(begin), _PLACE)
                place["key"] = part.column(0).to_numpy(zero_copy_only=False)[text]
                place["tie"] = part.column(1).to_numpy(zero_copy_only=False)[text]
                place["at"] = begin - words.first[text]
                place["words"] = n_words
                known = place[repeated]
                known_bucket = mix(known["key"].view(np.uint64) ^ known["tie"].view(np.uint64)) % np.uint64(buckets)
                sent, often = order[heads], counts > 1
                bucket = mix(minimiser[sent]) % np.uint64(buckets)
                order, known_order = np.argsort(bucket, kind="stable"), np.argsort(known_bucket, kind="stable")
                sent, often, bucket = sent[order], often[order], bucket[order]
                known, known_bucket = known[known_order], known_bucket[known_order]
                packed, start, end = words.packed()
                out_bucket, out_blob = [], []
                for b in np.union1d(bucket, known_bucket):
                    low, high = np.searchsorted(bucket, [b, b + np.uint64(1)])
                    mine = sent[low:high]
                    first, last = begin[mine], begin[mine] + n_words[mine] - 1
                    text_bytes = packed[spans(start[first], end[last] - start[first] + 1)]
                    k_low, k_high = np.searchsorted(known_bucket, [b, b + np.uint64(1)])
                    out_bucket.append(int(b))
                    out_blob.append(pack([place[mine], often[low:high], text_bytes, known[k_low:k_high]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_bucket, pa.int64()), pa.array(out_blob, pa.binary())], ["bucket", "blob"])
    return run


RANGES = "key long, tie long, low int, high int"


def _count(window: int):
    """Ranges of words that are covered by windows that occur twice, of one bucket."""
    def digests(place: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows of some strings: digest, number of the string, place in it."""
        words = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        first = np.concatenate(([0], np.cumsum(place["words"])))[:-1]
        per = place["words"] - window + 1
        starts, unit = spans(first, per), np.repeat(np.arange(len(place)), per)
        return _digests(words.hash, starts, starts + window), unit, starts - first[unit]

    def run(group: pa.Table) -> pa.Table:
        places, oftens, parts, found = [], [], [], []
        units, waiting, texts = 0, [], []

        def flush() -> None:
            nonlocal units
            place = np.concatenate(waiting)
            digest, unit, at = digests(place, b"".join(texts))
            parts.append((digest, unit + units, at))
            units += len(place)
            waiting.clear()
            texts.clear()

        for blob in group.column("blob"):
            a, b, text, known = unpack(blob.as_py())
            known = np.frombuffer(known, _PLACE)
            found.append(np.stack([known["key"], known["tie"], known["at"], known["at"] + known["words"]], 1))
            place = np.frombuffer(a, _PLACE)
            if not len(place):
                continue
            places.append(place)
            oftens.append(np.frombuffer(b, bool))
            waiting.append(place)
            texts.append(text)
            if sum(map(len, texts)) > SLICE_BYTES:
                flush()
        if waiting:
            flush()
        if places:
            place, often = np.concatenate(places), np.concatenate(oftens)
            digest = np.concatenate([p[0] for p in parts], axis=1)
            unit, at = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
            parts.clear()
            order, heads = _groups(digest)
            # A string that was repeated within its batch counts twice, and so do its windows;
            # its own places are known already.
            times = np.add.reduceat(1 + often[unit[order]].astype(np.int64), heads)
            twice = np.zeros(len(order), bool)
            twice[order] = np.repeat(times > 1, np.diff(np.append(heads, len(order))))
            hit = np.flatnonzero(twice & ~often[unit])
            if len(hit):
                cut = np.ones(len(hit), bool)
                cut[1:] = (hit[1:] != hit[:-1] + 1) | (unit[hit[1:]] != unit[hit[:-1]])
                begin = np.flatnonzero(cut)
                finish = np.append(begin[1:], len(hit)) - 1
                of = place[unit[hit[begin]]]
                found.append(np.stack([
                    of["key"], of["tie"], of["at"] + at[hit[begin]], of["at"] + at[hit[finish]] + window], 1))
        rows = _merged(np.concatenate(found).astype(np.int64))
        return pa.table({
            "key": rows[:, 0], "tie": rows[:, 1],
            "low": rows[:, 2].astype(np.int32), "high": rows[:, 3].astype(np.int32)})
    return run


def _merged(rows: np.ndarray) -> np.ndarray:
    """Ranges of one text that touch become one; rows are key, tie, low, high."""
    if len(rows) < 2:
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    _, text = np.unique(rows[:, :2], axis=0, return_inverse=True)
    text = text.reshape(-1)
    far = 1 << 40
    reach = np.maximum.accumulate(rows[:, 3] + text * far) - text * far
    new = np.ones(len(rows), bool)
    new[1:] = (text[1:] != text[:-1]) | (rows[1:, 2] > reach[:-1])
    begin = np.flatnonzero(new)
    out = rows[begin].copy()
    out[:, 3] = reach[np.append(begin[1:], len(rows)) - 1]
    return out


def _cut(names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            lows, highs = batch.column("_low"), batch.column("_high")
            n_words, n_removed, kept = [], [], []
            for value, low, high in zip(column, lows, highs, strict=True):
                words = (value.as_py() or b"").split()
                n_words.append(len(words))
                if low.is_valid:
                    gone = np.zeros(len(words) + 1, np.int32)
                    np.add.at(gone, np.asarray(low.as_py()), 1)
                    np.add.at(gone, np.asarray(high.as_py()), -1)
                    stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    n_removed.append(len(words) - len(stay))
                    words = [words[i] for i in stay]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words))
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary())], [*names, *ADDED])
    return run


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, seed: int = SEED_WORDS,
                    hot_share: int = HOT_SHARE) -> DataFrame:
    """``docs`` (the text as bytes under ``text``) with ``n_words``, ``n_removed`` and ``kept_text``,
    the UTF-8 form of the words that stay, joined by single spaces."""
    docs = docs.drop(*ADDED).withColumn(text, F.col(text).cast("binary"))
    texts = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("key"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))

    found = docs.select(F.col(text).alias("text")).mapInArrow(_profile(window, seed, hot_share), "minimiser long, n long, size long")
    found = stored(found.groupBy("minimiser").agg(F.sum("n").alias("n"), F.sum("size").alias("size")), "minimisers")
    # Counts are from below, so there are no more than 2 * hot_share of them.
    sums = found.agg(F.sum(F.when(F.col("minimiser").isNull(), F.col("n"))).alias("n"), F.sum("size").alias("size")).first()
    n, size = sums["n"] or 0, sums["size"] or 0
    hot = np.array([r["minimiser"] for r in found.filter(
        F.col("minimiser").isNotNull() & (F.col("n") * 2 * hot_share >= n) & (F.col("n") > hot_share)).collect()], np.int64).view(np.uint64)
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)

    blobs = texts.mapInArrow(_units(window, seed, hot, buckets), "bucket long, blob binary")
    ranges = blobs.groupBy("bucket").applyInArrow(_count(window), RANGES)
    per_text = ranges.groupBy("key", "tie").agg(F.collect_list(F.struct("low", "high")).alias("_ranges"))
    joined = docs.join(
        per_text, (F.coalesce(F.col(key).cast("long"), F.lit(0)) == per_text["key"]) & (F.xxhash64(docs[text]) == per_text["tie"]), "left")
    names = docs.columns
    rows = joined.select(
        *(docs[c] for c in names), F.col("_ranges.low").alias("_low"), F.col("_ranges.high").alias("_high"))
    added = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept_text", "binary")
    return rows.mapInArrow(_cut(names, text), T.StructType([*docs.schema.fields, *added.fields]))


_ORACLE = f"""
    WITH words AS (
        SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word
        FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w FROM documents)),
    windows AS (
        SELECT doc_id, pos, md5(string_agg(word, ' ') OVER p) AS digest, count(*) OVER p AS n
        FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
    twice AS (
        SELECT doc_id, pos FROM (
            SELECT doc_id, pos, count(*) OVER (PARTITION BY digest) AS times FROM windows WHERE n = {WINDOW})
        WHERE times > 1),
    reach AS (
        SELECT words.doc_id, words.pos, word,
            coalesce(max(twice.pos) OVER (PARTITION BY words.doc_id ORDER BY words.pos) > words.pos - {WINDOW}, FALSE) AS gone
        FROM words LEFT JOIN twice ON words.doc_id = twice.doc_id AND words.pos = twice.pos),
    texts AS (
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
            coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept
        FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents LEFT JOIN texts USING (doc_id)"""


@query("op7_superkmers", _ORACLE)
def op7_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
