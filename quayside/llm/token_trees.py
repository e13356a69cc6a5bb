"""Token counts that follow edits without encoding whole texts again.

A text is cut where the tokenizer's own splitting must begin anew: before a space that is followed by
something that is no blank. Some cuts together are a leaf; above the leaves stands a tree of sums of
tokens and characters. An edit (at a character, delete so many, insert a text) finds its leaves by
descending the sums, and only these are encoded again, with the leaf before them if the
edit touches the head of the first, since the cut before it may be gone then. The head of the leaf after
them is untouched, so it still begins a cut. The sums above are brought up to date.

Trees are kept as columns of the table (bytes, characters and tokens of the leaves); the sums are made
from them when a document is first edited. Edits of one document follow one another, each in the
coordinates that the earlier ones left, so they run in one task; they stream through it in order, and
the task holds one document, however many edits there are.

Results by case: a NULL text is empty; places beyond the text are moved to its end, negative ones
to its beginning; NULL numbers are zero and NULL insertions empty; edits without doc_id, or of a
document that is not there, do nothing; edits with the same number apply in order of place, deletion and
insertion; of rows that share a doc_id, the edits go to the one with the greatest text, the others stay;
rows without doc_id are counted and never edited; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import query, table
from quayside.llm.bpe import SPECIAL, Encoder, cut_starts, default_ranks
from quayside.llm.words import text_slices

LEAF_CUTS = 32
LEAF_BYTES_MOST = 2048
KEPT = ("leaf_bytes", "leaf_chars", "leaf_tokens")
TREES = "doc_id long, text binary, leaf_bytes binary, leaf_chars binary, leaf_tokens binary"
COUNTED = TREES + ", n_edits long, tokens_before long, n_tokens long, bytes_encoded long"
_LATER_BYTES = np.zeros(256, np.int64)
_LATER_BYTES[0x80:0xC0] = 1


def _chars(text: bytes) -> int:
    return len(text) - int(_LATER_BYTES[np.frombuffer(text, np.uint8)].sum())


class SegmentTree:
    """Sums over leaves; ``rows`` holds (tokens, characters) of each."""

    def __init__(self, rows: np.ndarray) -> None:
        self.levels = [rows]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(np.add.reduceat(below, np.arange(0, len(below), 2)))

    def total(self) -> np.ndarray:
        return self.levels[-1][0] if len(self.levels[0]) else np.zeros(2, np.int64)

    def find(self, char: int) -> tuple[int, int]:
        """Leaf that holds this character (the last one, if it is beyond), and its place in it."""
        i = 0
        for level in self.levels[-2::-1]:
            i *= 2
            if char >= level[i, 1] and i + 1 < len(level):
                char -= int(level[i, 1])
                i += 1
        return i, char

    def update(self, i: int, row: tuple[int, int]) -> None:
        self.levels[0][i] = row
        for below, level in zip(self.levels, self.levels[1:], strict=False):
            i //= 2
            level[i] = below[2 * i: 2 * i + 2].sum(axis=0)


class Counted:
    """One document: its leaves and the tree over them."""

    def __init__(self, encoder: Encoder, leaves: list[bytes], rows: np.ndarray) -> None:
        self._encoder, self.leaves, self.tree = encoder, leaves, SegmentTree(rows)
        self.encoded = 0

    def _leaf(self, text: bytes) -> tuple[int, int]:
        self.encoded += len(text)
        return len(self._encoder.whole(text)), _chars(text)

    def edit(self, at: int, delete: int, insert: bytes) -> None:
        total = int(self.tree.total()[1])
        at = min(max(at, 0), total)
        end = min(at + max(delete, 0), total)
        if end == at and not insert:
            return
        if not self.leaves:
            self.leaves = [b""]
            self.tree = SegmentTree(np.zeros((1, 2), np.int64))
        first, offset = self.tree.find(at)
        # The last leaf of which something goes.
        last = self.tree.find(end - 1)[0] if end > at else first
        while offset < 2 and first > 0:
            first -= 1
            offset += int(self.tree.levels[0][first, 1])
        text = b"".join(self.leaves[first: last + 1]).decode("utf-8", "replace")
        # Two characters at the head of what follows decide whether it is still a cut.
        new = (text[:offset] + insert.decode("utf-8", "replace") + text[offset + end - at:]).encode()
        if len(new) > LEAF_BYTES_MOST and SPECIAL not in new:
            starts = cut_starts(np.frombuffer(new, np.uint8), np.array([0, len(new)]))[::LEAF_CUTS]
            pieces = [new[a:b] for a, b in zip(starts, [*starts[1:], len(new)], strict=True)]
        else:
            pieces = [new] if new else []
        rows = [self._leaf(p) for p in pieces]
        self.leaves[first: last + 1] = pieces
        if len(rows) == last + 1 - first == 1:
            self.tree.update(first, rows[0])
        else:
            kept = self.tree.levels[0]
            self.tree = SegmentTree(np.concatenate((
                kept[:first], np.array(rows, np.int64).reshape(-1, 2), kept[last + 1:])))


def _trees(ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path)
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                n = len(offsets) - 1
                lists: dict[str, list[bytes]] = {name: [] for name in KEPT}
                # A text that holds the special string is one leaf.
                starts, counts, _ = encoder.parts(data, offsets)
                first = np.searchsorted(starts, offsets)
                later = np.concatenate(([0], np.cumsum(_LATER_BYTES[data])))
                ends = np.append(starts, len(data))[1:]
                for a, b in zip(first[:-1], first[1:], strict=True):
                    cuts = np.arange(a, b, LEAF_CUTS)
                    if not len(cuts):
                        for name in KEPT:
                            lists[name].append(b"")
                        continue
                    low, high = starts[cuts], ends[np.append(cuts[1:], b) - 1]
                    size = high - low
                    lists["leaf_bytes"].append(size.astype(np.int32).tobytes())
                    lists["leaf_chars"].append((size - (later[high] - later[low])).astype(np.int32).tobytes())
                    lists["leaf_tokens"].append(np.add.reduceat(counts[a:b], cuts - a).astype(np.int32).tobytes())
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.binary()), *(pa.array(lists[name], pa.binary()) for name in KEPT)],
                    ["doc_id", "text", *KEPT])
                assert n == len(texts)
    return run


def token_trees(docs: DataFrame, text: str = "text", key: str = "doc_id", ranks_path: str | None = None) -> DataFrame:
    """The documents with the leaves of their trees, as int32 arrays (see ``TREES``)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_trees(ranks_path or default_ranks()), TREES)


def _ints(values: list[int]) -> bytes:
    return np.array(values, np.int32).tobytes()


def _edited(ranks_path: str, with_trees: bool):
    names = [x.split()[0] for x in COUNTED.split(", ")]
    types = [pa.int64() if x.split()[1] == "long" else pa.binary() for x in COUNTED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path)
        held: dict | None = None
        rows: list[tuple] = []
        size = 0

        def opened() -> Counted:
            """The held document's tree, made when the first edit needs it."""
            if "tree" not in held:
                sizes, chars, tokens = (np.frombuffer(held[name], np.int32).astype(np.int64) for name in KEPT)
                ends = np.cumsum(sizes)
                leaves = [held["text"][b - a: b] for a, b in zip(sizes, ends, strict=True)]
                held["tree"] = Counted(encoder, leaves, np.stack([tokens, chars], 1))
            return held["tree"]

        def close() -> None:
            nonlocal held, size
            if held is None:
                return
            before = int(np.frombuffer(held["leaf_tokens"], np.int32).sum())
            text, kept, after, encoded = held["text"], [held[name] for name in KEPT], before, 0
            if "tree" in held:
                counted = held["tree"]
                leaves = counted.tree.levels[0] if counted.leaves else np.zeros((0, 2), np.int64)
                text, after, encoded = b"".join(counted.leaves), int(counted.tree.total()[0]), counted.encoded
                kept = [_ints([len(x) for x in counted.leaves]), _ints(leaves[:, 1]), _ints(leaves[:, 0])]
            rows.append((held["doc_id"], *((text, *kept) if with_trees else [None] * 4), held["n"], before, after, encoded))
            size += (len(text) if with_trees else 0) + 100
            held = None

        def out() -> pa.RecordBatch:
            nonlocal rows, size
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
            rows, size = [], 0
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                if row["text"] is not None:
                    close()
                    held = row | {"n": 0}
                elif held is not None and held["doc_id"] is not None and held["doc_id"] == row["doc_id"]:
                    opened().edit(row["at"] or 0, row["delete"] or 0, row["insert"] or b"")
                    held["n"] += 1
                if size > 4_000_000:
                    yield out()
        close()
        if rows:
            yield out()
    return run


def edited(trees: DataFrame, edits: DataFrame, ranks_path: str | None = None, with_trees: bool = True) -> DataFrame:
    """``trees`` after ``edits(doc_id, seq, at, delete, insert)``, with ``n_edits``, ``tokens_before``,
    ``n_tokens`` and ``bytes_encoded``, the bytes that were encoded again."""
    nothing = {"at": "long", "delete": "long", "insert": "binary", "seq": "long"}
    left = trees.withColumns({name: F.lit(None).cast(kind) for name, kind in nothing.items()}).withColumn(
        "text", F.coalesce("text", F.lit(b"")))
    right = edits.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), *(F.lit(None).cast("binary").alias(c) for c in ("text", *KEPT)),
        *(F.col(c).cast("string").cast("binary").alias(c) if c == "insert" else F.col(c).cast("long").alias(c) for c in ("at", "delete", "insert")),
        F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"))
    rows = left.select(right.columns).union(right)
    parts = int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows without doc_id are never edited, so they need not meet.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    ordered = rows.repartition(parts, spread).sortWithinPartitions(
        "doc_id", F.col("text").isNull(), "text", "seq", "at", "delete", "insert")
    return ordered.mapInArrow(_edited(ranks_path or default_ranks(), with_trees), COUNTED)


def derived_edits(docs: DataFrame) -> DataFrame:
    """Three edits of each document, from its own text: its beginning again a third in, a cut at
    two thirds, and an exchange near the end."""
    n = F.char_length("text")
    def one(seq: int, at, delete, insert):
        return F.struct(
            F.lit(seq).alias("seq"), F.floor(at).alias("at"), F.floor(delete).alias("delete"), insert.alias("insert"))

    each = F.array(
        one(0, n / 3, F.lit(0), F.substring("text", 1, 40)), one(1, 2 * n / 3, n / 50, F.lit("")),
        one(2, n - 12, F.lit(5), F.concat(F.lit(" "), F.upper(F.substring("text", 3, 6)))))
    return docs.filter("text IS NOT NULL").select("doc_id", F.explode(each).alias("e")).select("doc_id", "e.*")


@query("op10_token_trees")
def op10_token_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens before and after its edits, and how much was encoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = edited(token_trees(docs), derived_edits(docs), with_trees=False)
    return counted.select("doc_id", "n_edits", "tokens_before", "n_tokens", "bytes_encoded")
