"""Alignment of the tokens of two tokenizers, and how many documents hold each pair linked.

Both tokenizers read a space and the text. Places where a token of A and one of B end together cut the
bytes into groups; within a group every A token is linked with the B tokens whose bytes it overlaps.

*Identity map.* For each A id the B id that stands for the same bytes is looked up once. A link of such a pair is nearly always
a group of one token each; how many documents hold it is counted in one array as long as A's vocabulary, a
row per task. Only the other pairs are counted by a shuffle, and for each slice of texts a pair is one row
there, however many of its documents hold it. Counts go back to the slices the same way, so a pair that stands
everywhere is a row per slice, never one per place. A slice is a few megabytes of texts or one text.

Neither tokenizer has a token across the place before a space that follows no space and precedes none of
the characters that could be blank, so such cuts are aligned each on its own, once while it is remembered, and a text is the
sum of its cuts. (A test holds ids and groups against whole texts.) Cuts are recognised by 64 bits of hash.

Collected: two numbers per A id, so 50,257 of each with the default files.

Results by case: a NULL or empty text, and one whose tokens do not give its bytes back (B cannot
tell U+2581 from a space), has no tokens and is zero throughout, with empty groups; repeated rows count
as a document each; rows without doc_id are documents like others; a table without rows gives none; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm.base import query, stored, table
from quayside.llm.bpe import cut_starts
from quayside.llm.packed import pack, unpack
from quayside.llm.transducer import byte_symbols
from quayside.llm.words import SLICE_BYTES, byte_values, run_hashes, spans, text_slices

SLICE = SLICE_BYTES
#: Cuts and links that are remembered.
KNOWN_MOST, LINKS_MOST = 200_000, 4_000_000
LEARNT_TOGETHER = 1 << 15
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
STORED = "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, pairs binary, same binary"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def default_paths() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def token_bytes_a(tokenizer: Tokenizer) -> list[bytes]:
    number = {symbol: b for b, symbol in enumerate(byte_symbols())}
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes(number[c] for c in name) if all(c in number for c in name) else name.encode() for name in names]


def token_bytes_b(pieces: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    blank = chr(0x2581)
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    return [bytes([int(name[3:-1], 16)]) if pieces.is_byte(i) else name.replace(blank, " ").encode() for i, name in enumerate(names)]


class Links:
    """The links of some texts: ``first`` into codes a * |B| + b."""

    def __init__(self, first: np.ndarray, codes: np.ndarray) -> None:
        self.first, self.codes = first, codes


class Aligner:
    """Both tokenizers, the identity map, and the cuts seen lately."""

    def __init__(self, a_path: str, b_path: str) -> None:
        library = Tokenizer.from_file(a_path)
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self._bytes_a, self._bytes_b = token_bytes_a(library), token_bytes_b(self._b)
        # Ids are ranks in this file; for short texts this is the quicker way to them.
        special = set(library.get_added_tokens_decoder())
        self._bpe = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, special_tokens={},
            mergeable_ranks={x: i for i, x in enumerate(self._bytes_a) if i not in special})
        self._joined_b = np.frombuffer(b"".join(self._bytes_b), np.uint8)
        self._size_a = np.array([len(x) for x in self._bytes_a], np.int64)
        self._size_b = np.array([len(x) for x in self._bytes_b], np.int64)
        self.n_a, self.n_b = len(self._bytes_a), len(self._bytes_b)
        # Of several B ids with the same bytes, the one that is no byte by itself.
        first: dict[bytes, int] = {}
        for i in sorted(range(self.n_b), key=lambda i: (self._b.is_byte(i), i)):
            first.setdefault(self._bytes_b[i], i)
        #: Code of the pair of an A id and the B id of the same bytes; -1 without one.
        b = np.array([first.get(x, -1) for x in self._bytes_a], np.int64)
        self.identity = np.where(b >= 0, np.arange(self.n_a) * self.n_b + b, -1)
        self._name = np.array([b"%d" % i for i in range(max(self.n_a, self.n_b))], object)
        self._identity_name = np.array([b"%d|%d" % pair for pair in enumerate(b.tolist())], object)
        self._hash = np.zeros(0, np.uint64)
        self._used = np.zeros(0, np.int64)
        self._numbers = np.zeros((0, len(NUMBERS)), np.int64)
        self._valid = np.zeros(0, bool)
        self._at = np.zeros(0, np.int64)
        self._codes = np.zeros(0, np.uint32)
        self._groups = np.zeros(0, object)
        self._round = 0

    def is_identity(self, codes: np.ndarray) -> np.ndarray:
        return self.identity[codes // self.n_b] == codes

    def aligned(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[bytes], Links]:
        """Numbers, groups and links of each text of a slice."""
        n = len(offsets) - 1
        filled = np.diff(offsets) > 0
        before = np.concatenate(([0], np.cumsum(filled)))
        spaced = np.full(len(data) + int(before[-1]), 0x20, np.uint8)
        spaced[spans(offsets[:-1] + before[1:], np.diff(offsets))] = data
        offsets = offsets + before
        starts = self._cuts(spaced, offsets)
        ends = np.append(starts[1:], len(spaced))
        hashes = run_hashes(byte_values()[spaced], starts, ends)
        found, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = self._places(found, first, starts, ends, spaced.tobytes())[which]
        cut = np.searchsorted(starts, offsets)
        text = np.repeat(np.arange(n), np.diff(cut))
        valid = np.bincount(text[~self._valid[place]], minlength=n) == 0
        sums = np.concatenate((np.zeros((1, len(NUMBERS)), np.int64), np.cumsum(self._numbers[place], axis=0)))
        numbers = np.where(valid[:, None], sums[cut[1:]] - sums[cut[:-1]], 0)
        groups = [
            b";".join(self._groups[place[a:b]].tolist()) if ok else b""
            for a, b, ok in zip(cut[:-1], cut[1:], valid, strict=True)]
        kept = valid[text]
        return numbers, groups, self._links(n, text[kept], place[kept])

    def _links(self, n: int, text: np.ndarray, place: np.ndarray) -> Links:
        """All links of the texts, a code as often as it occurs."""
        counts = self._numbers[place, 3]
        codes = self._codes[spans(self._at[place], counts)]
        first = np.concatenate(([0], np.cumsum(np.bincount(text, counts, n).astype(np.int64))))
        return Links(first, codes)

    @staticmethod
    def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts = cut_starts(data, offsets)
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        return starts[begins[starts] | (data[starts - 1] != 0x20)]

    def _places(self, found: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray, raw: bytes) -> np.ndarray:
        """Where the cuts with these hashes are remembered, after learning those that are not."""
        self._round += 1
        if len(self._hash) > KNOWN_MOST or len(self._codes) > LINKS_MOST:
            self._keep(self._used > np.median(self._used))
        at = np.searchsorted(self._hash, found)
        known = np.zeros(len(found), bool)
        inside = at < len(self._hash)
        known[inside] = self._hash[at[inside]] == found[inside]
        new = np.flatnonzero(~known)
        for low in range(0, len(new), LEARNT_TOGETHER):
            some = new[low: low + LEARNT_TOGETHER]
            self._learn(found[some], [raw[starts[i]: ends[i]] for i in first[some]])
        at = np.searchsorted(self._hash, found)
        self._used[at] = self._round
        return at

    def _keep(self, kept: np.ndarray) -> None:
        counts = self._numbers[kept, 3]
        self._codes = self._codes[spans(self._at[kept], counts)]
        self._at = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)
        for name in ("_hash", "_used", "_numbers", "_valid", "_groups"):
            setattr(self, name, getattr(self, name)[kept])

    def _learn(self, hashes: np.ndarray, cuts: list[bytes]) -> None:
        texts = [cut.decode("utf-8", "replace") for cut in cuts]
        encode = self._bpe.encode_ordinary
        a_ids = [encode(text) for text in texts]
        # B puts a space before what it is given.
        b_ids = self._b.encode([text[1:] for text in texts], num_threads=1)
        valid = self._whole(cuts, texts, b_ids)
        numbers, codes, groups = self._grouped(
            [x for x, ok in zip(a_ids, valid, strict=True) if ok], [x for x, ok in zip(b_ids, valid, strict=True) if ok])
        all_numbers = np.zeros((len(cuts), len(NUMBERS)), np.int64)
        all_numbers[valid] = numbers
        all_groups = np.full(len(cuts), b"", object)
        all_groups[valid] = groups
        places = len(self._codes) + np.concatenate(([0], np.cumsum(all_numbers[:, 3])[:-1]))
        self._codes = np.concatenate((self._codes, codes))
        merged = np.concatenate((self._hash, hashes))
        order = np.argsort(merged)
        self._hash = merged[order]
        self._used = np.concatenate((self._used, np.zeros(len(cuts), np.int64)))[order]
        self._numbers = np.concatenate((self._numbers, all_numbers))[order]
        self._valid = np.concatenate((self._valid, valid))[order]
        self._at = np.concatenate((self._at, places))[order]
        self._groups = np.concatenate((self._groups, all_groups))[order]

    def _grouped(self, a_ids: list[list[int]], b_ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, codes of links and groups of cuts whose two lists of tokens have equal bytes."""
        a, a_first = _flat(a_ids)
        b, b_first = _flat(b_ids)
        a_ends, b_ends = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        # The B tokens from the one that holds an A token's first byte to the one that holds its last.
        low = np.searchsorted(b_ends, a_ends - self._size_a[a], "right")
        n_links = np.searchsorted(b_ends, a_ends, "left") + 1 - low
        codes = (np.repeat(a, n_links) * self.n_b + b[spans(low, n_links)]).astype(np.uint32)
        last = np.append(a_ends, 0)[a_first[1:] - 1]
        groups_to = np.concatenate(([0], np.searchsorted(common, last, "right")))
        links_to = np.concatenate(([0], np.cumsum(n_links)))[a_first]
        numbers = np.stack([np.diff(a_first), np.diff(b_first), np.diff(groups_to), np.diff(links_to)], 1)
        each = self._group_names(a, np.searchsorted(a_ends, common, "right"), b, np.searchsorted(b_ends, common, "right"))
        groups = np.empty(len(a_ids), object)
        groups[:] = [b";".join(each[i:j]) for i, j in zip(groups_to[:-1].tolist(), groups_to[1:].tolist(), strict=True)]
        return numbers, codes, groups


    def _group_names(self, a: np.ndarray, a_to: np.ndarray, b: np.ndarray, b_to: np.ndarray) -> list[bytes]:
        """Each group as text, from where its tokens end in both lists."""
        a_from, b_from = np.append(0, a_to)[:-1], np.append(0, b_to)[:-1]
        one = (a_to - a_from == 1) & (b_to - b_from == 1)
        one[one] = self.identity[a[a_from[one]]] == a[a_from[one]] * self.n_b + b[b_from[one]]
        out = np.empty(len(a_to), object)
        out[one] = self._identity_name[a[a_from[one]]]
        left, right = self._name[a].tolist(), self._name[b].tolist()
        rest = np.flatnonzero(~one)
        bounds = zip(*(x[rest].tolist() for x in (a_from, a_to, b_from, b_to)), strict=True)
        out[rest] = [b",".join(left[i:j]) + b"|" + b",".join(right[k:m]) for i, j, k, m in bounds]
        return out.tolist()

    def _whole(self, cuts: list[bytes], texts: list[str], b_ids: list[list[int]]) -> np.ndarray:
        """Whether both give back a cut's bytes: A does for all text, B where it has them all and no other."""
        ids, first = _flat(b_ids)
        lengths = np.array([len(cut) for cut in cuts], np.int64)
        ends = np.concatenate(([0], np.cumsum(self._size_b[ids])))
        valid = np.diff(ends[first]) == lengths
        kept = ids[np.repeat(valid, np.diff(first))]
        begins = np.cumsum(self._size_b) - self._size_b
        made = self._joined_b[spans(begins[kept], self._size_b[kept])]
        given = np.frombuffer(b"".join([cut for cut, ok in zip(cuts, valid.tolist(), strict=True) if ok]), np.uint8)
        wrong = np.searchsorted(np.cumsum(lengths[valid]), np.flatnonzero(made != given), "right")
        valid[np.flatnonzero(valid)[wrong]] = False
        if "\ufffd" in "".join(texts):
            valid &= np.array([text.encode() == cut for cut, text in zip(cuts, texts, strict=True)], bool)
        return valid


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(first[-1])), first


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process, as the cuts it has seen serve later tasks too."""
    return Aligner(a_path, b_path)


def _distinct(links: Links) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, code and number of places of every code that a text holds, in this order."""
    text = np.repeat(np.arange(len(links.first) - 1), np.diff(links.first))
    keys, times = np.unique(text.astype(np.int64) << 32 | links.codes, return_counts=True)
    return keys >> 32, (keys & 0xFFFFFFFF).astype(np.uint32), times.astype(np.uint32)


def _align(a_path: str, b_path: str, digest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per document, a row per slice with its pairs, and a row per task with the counts of identity."""
    names = [field.split()[0] for field in STORED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[field.split()[1]] for field in STORED.split(", ")]

    def rows(n: int, **columns: object) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in zip(names, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = aligner(a_path, b_path)
        same, number = np.zeros(shared.n_a, np.int64), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, data, offsets in text_slices(batch, most=SLICE):
                numbers, groups, links = shared.aligned(data, offsets)
                text, code, times = _distinct(links)
                plain = shared.is_identity(code.astype(np.int64))
                same += np.bincount(code[plain].astype(np.int64) // shared.n_b, minlength=shared.n_a)
                at = np.searchsorted(text, np.arange(len(part) + 1))
                blobs = [pack([code[i:j], times[i:j]]) for i, j in zip(at[:-1], at[1:], strict=True)]
                pairs, docs = np.unique(code[~plain], return_counts=True)
                if digest:
                    groups = [hashlib.sha256(x).hexdigest() if x else "" for x in groups]
                yield rows(
                    len(part), slice=np.full(len(part), number), doc_id=part.column(0), links=blobs,
                    groups=groups if digest else [x.decode() for x in groups],
                    **{name: numbers[:, k] for k, name in enumerate(NUMBERS)})
                yield rows(1, slice=[number], pairs=[pack([pairs, docs.astype(np.uint32)])])
                number += 1
        yield rows(1, same=[pack([same])])
    return run


def _pairs(n_b: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                code, docs = (np.frombuffer(x, np.uint32).astype(np.int64) for x in unpack(blob.as_py()))
                columns = np.full(len(code), number), code // n_b, code % n_b, docs
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slice", "a", "b", "docs"])
    return run


def _same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of a task's rows added up: a row per A id that occurs."""
    total = None
    for batch in batches:
        for blob in batch.column(0):
            counts = np.frombuffer(unpack(blob.as_py())[0], np.int64)
            total = counts if total is None else total + counts
    if total is not None:
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["a", "n"])


def _by_id(rows: DataFrame, n_a: int) -> np.ndarray:
    """``(a, n)`` of at most one row per A id, as an array."""
    out = np.zeros(n_a, np.int64)
    for row in rows.collect():
        out[row["a"]] = row["n"]
    return out


def _scored(identity: np.ndarray, same: np.ndarray, most: np.ndarray, n_b: int):
    names = [field.split()[0] for field in ALIGNED.split(", ")]

    def run(docs: pa.Table, counted: pa.Table) -> pa.Table:
        code = counted.column("a").to_numpy() * n_b + counted.column("b").to_numpy()
        order = np.argsort(code)
        code, n = code[order], counted.column("n").to_numpy()[order]
        sums, best = [], []
        for blob in docs.column("links").to_pylist():
            held, times = (np.frombuffer(x, np.uint32).astype(np.int64) for x in unpack(blob))
            a = held // n_b
            count = same[a]
            other = np.flatnonzero(identity[a] != held)
            count[other] = n[np.searchsorted(code, held[other])]
            sums.append(int((times * count).sum()))
            best.append(int(times[count == most[a]].sum()))
        made = docs.append_column("n_best", pa.array(best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
        return made.select(names)
    return run


class Alignment:
    """The alignment of a table: ``documents`` (see ``ALIGNED``), and ``pairs()``."""

    def __init__(self, docs: DataFrame, text: str = "text", key: str = "doc_id", digest: bool = False,
                 paths: tuple[str, str] | None = None) -> None:
        a_path, b_path = paths or default_paths()
        shared = aligner(a_path, b_path)
        n_b, identity = shared.n_b, shared.identity
        texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
        rows = stored(texts.mapInArrow(_align(a_path, b_path, digest), STORED), "aligned")
        irregular = rows.filter("pairs IS NOT NULL").select("slice", "pairs").mapInArrow(_pairs(n_b), "slice long, a long, b long, docs long")
        counts = stored(irregular.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pair-counts")
        arrays = rows.filter("same IS NOT NULL").select("same").mapInArrow(_same, "a long, n long")
        same = _by_id(arrays.groupBy("a").agg(F.sum("n").alias("n")), shared.n_a)
        most = np.maximum(same, _by_id(counts.groupBy("a").agg(F.max("n").alias("n")), shared.n_a))
        answers = irregular.select("slice", "a", "b").join(counts, ["a", "b"])
        self.documents = rows.filter("n_a IS NOT NULL").drop("pairs", "same").groupBy("slice").cogroup(
            answers.groupBy("slice")).applyInArrow(_scored(identity, same, most, n_b), ALIGNED)
        self._counts, self._same, self._partners = counts, same, identity % n_b

    def pairs(self) -> DataFrame:
        """``(a, b, n)``: in how many documents a pair of ids is linked."""
        plain = [(int(a), int(self._partners[a]), int(self._same[a])) for a in np.flatnonzero(self._same)]
        return self._counts.unionByName(self._counts.sparkSession.createDataFrame(plain, "a long, b long, n long"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Alignment(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True).documents
    return rows.withColumnRenamed("groups", "groups_sha256")
