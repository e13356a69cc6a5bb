"""Token ids, packing, edit-aware counts, against the tokenizer itself."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quayside.llm import packing, token_trees
from quayside.llm.bpe import Encoder, default_ranks
from quayside.llm.words import text_slices

TEXT = st.text(st.one_of(st.sampled_from(" \n\t.,'abcAB12éü日  　|#"), st.characters(codec="utf-8")), max_size=60)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_ranks())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXT, st.just("a <|endoftext|> b")), min_size=1, max_size=6))
@example(["a  b", "a \n b", "  ", "x ", " x", "  y", "  y", "don't 's", ""])
def test_ids(tokenizer, encoder, texts):
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    for _, data, offsets in text_slices(batch):
        ids, first = encoder.slice(data, offsets)
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.lists(st.tuples(st.integers(-3, 400), st.integers(0, 60), TEXT), max_size=8), st.integers(1, 4))
def test_edits(tokenizer, encoder, parts, edits, cuts):
    text = " ".join(parts)
    before, token_trees.LEAF_CUTS = token_trees.LEAF_CUTS, cuts
    try:
        batch = pa.record_batch([pa.array([1]), pa.array([text.encode()])], ["doc_id", "text"])
        row = next(_trees_with(encoder, batch))
        sizes, chars, tokens = (np.frombuffer(row[name], np.int32).astype(np.int64) for name in token_trees.KEPT)
        ends = np.cumsum(sizes)
        doc = token_trees.Counted(encoder, [row["text"][b - a: b] for a, b in zip(sizes, ends, strict=True)], np.stack([tokens, chars], 1))
        for at, delete, insert in edits:
            at = min(max(at, 0), len(text))
            text = text[:at] + insert + text[at + delete:]
            doc.edit(at, delete, insert.encode())
            assert b"".join(doc.leaves).decode() == text
            assert doc.tree.total().tolist() == [len(tokenizer.encode(text, add_special_tokens=False).ids), len(text)]
    finally:
        token_trees.LEAF_CUTS = before


def _trees_with(encoder, batch):
    """The task function with an encoder that is there already."""
    original, token_trees.Encoder = token_trees.Encoder, lambda _: encoder
    try:
        yield from (r for out in token_trees._trees("")(iter([batch])) for r in out.to_pylist())
    finally:
        token_trees.Encoder = original


def test_special_neighbours_change_nothing(session):
    """What is encoded again does not depend on the texts that share a batch."""
    rng = random.Random(5)
    long = " ".join("".join(rng.choices("abcdefghij", k=4)) for _ in range(4000))
    rows = [(1, long), (2, "a <|endoftext|> b"), (3, ""), (4, "<|endof"), (5, "text|> c"), (6, None)]
    edits = session.createDataFrame([(1, 0, 9000, 3, "zz"), (2, 0, 1, 1, "q")], "doc_id long, seq int, at long, delete long, insert string")
    found = []
    for shown in (rows, rows[:1], rows[::-1]):
        docs = session.createDataFrame(shown, "doc_id long, text string").coalesce(1)
        got = {r.doc_id: r for r in token_trees.edited(token_trees.token_trees(docs), edits).collect()}
        found.append((got[1].bytes_encoded, got[1].n_tokens, bytes(got[1].leaf_tokens)))
    assert found[0] == found[1] == found[2] and found[0][0] < 2000


def test_known_cuts_are_dropped_and_learnt_again(tokenizer):
    from quayside.llm import bpe

    before, bpe.KNOWN_MOST = bpe.KNOWN_MOST, 40
    try:
        rng, encoder = random.Random(6), Encoder(default_ranks())
        for _ in range(30):
            texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 9) + rng.choice(["", "\n", " ", "é"]) for _ in range(20)) for _ in range(3)]
            data = np.frombuffer("".join(texts).encode(), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
            ids, first = encoder.slice(data, offsets)
            assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [
                tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    finally:
        bpe.KNOWN_MOST = before


def test_edits_of_odd_documents(odd, tokenizer, empty):
    edits = odd.sparkSession.createDataFrame([
        (7, 0, 5, 3, "zz zz"), (7, 1, 10**9, 1, " tail"), (7, 2, 20000, 9000, None), (4, 0, 0, 0, "new"), (None, 0, 0, 0, "no"),
        (99, 0, 0, 0, "no"), (5, None, None, None, None), (11, 0, 0, 1, ""), (2, 0, 3, 0, "q"),
    ], "doc_id long, seq int, at long, delete long, insert string")
    rows = token_trees.edited(token_trees.token_trees(odd), edits).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
        assert r.n_tokens == len(tokenizer.encode(bytes(r.text).decode(), add_special_tokens=False).ids)
        assert np.frombuffer(r.leaf_tokens, np.int32).sum() == r.n_tokens
    assert bytes(by_id[4][0].text) == b"new" and bytes(by_id[11][0].text) == b""
    assert sorted(r.n_edits for r in by_id[2]) == [0, 1] and by_id[7][0].n_edits == 3
    assert 0 < by_id[7][0].bytes_encoded < len(by_id[8][0].text) + 1
    assert all(r.n_edits == 0 for r in by_id[None])
    assert token_trees.edited(token_trees.token_trees(empty), edits).count() == 0


def test_packing_round_trip(odd, tokenizer, empty):
    rows = packing.packed(odd, length=256).collect()
    want = sorted((len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes())) for ids in (
        tokenizer.encode(r.text or "", add_special_tokens=False).ids for r in odd.collect()))
    # Pieces of documents with one id cannot be told apart, so ids that occur once are put together.
    count = defaultdict(list)
    for r in odd.collect():
        count[r.doc_id].append(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1])
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert sum(r.length for r in rows) == sum(n for n, _ in want)
    for key, texts in count.items():
        if len(texts) == 1:
            ids = np.array(texts[0], "<u4")
            at = 0
            for r in sorted(pieces[key], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[at: at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    assert packing.packed(empty).count() == 0


def test_neighbours_share_windows(session):
    """Texts about one thing are put together, wherever they are in the table."""
    subjects = ["apple pear plum cherry", "engine wheel brake clutch", "violin flute drum harp", "rain snow hail wind"]
    rows = [(i, " ".join([subjects[i % 4]] * 12)) for i in range(48)]
    got = packing.packed(session.createDataFrame(rows, "doc_id long, text string").coalesce(1), length=256).collect()
    windows = defaultdict(set)
    for r in got:
        windows[r.sequence_id].add(r.doc_id % 4)
    # In the order of the table every window would hold four subjects.
    assert np.mean([len(w) for w in windows.values()]) < 2


def test_packing_brings_copies_together(session):
    """Copies far apart in the table, more documents than a shard holds."""
    from tests.llm.conftest import words

    rng = random.Random(5)
    n = packing.SHARD_DOCS + 200
    texts = [words(rng, 12) for _ in range(n)]
    docs = session.createDataFrame([(i, texts[i % n]) for i in range(2 * n)], "doc_id long, text string").coalesce(1)
    rows = packing.packed(docs, length=256).collect()
    first = {r.doc_id: (r.sequence_id, r.offset) for r in rows if r.start == 0}
    assert len(first) == 2 * n
    near = sum(abs(first[i][0] - first[i + n][0]) <= 1 for i in range(n))
    assert near > 0.95 * n


def test_window_goes_on_with_related_documents():
    """More short related documents than the first block holds, with others between them in the table."""
    related = np.array([*range(100, 120), packing.END], np.uint16)
    docs = [related if i % 3 == 0 else np.array([*range(1000 + 20 * i, 1020 + 20 * i), packing.END], np.uint16) for i in range(210)]
    order = list(packing._order(docs, np.ones(packing.VOCABULARY), 21.0, 2048, 0))
    assert sorted(order) == list(range(210))
    assert order[:70] == list(range(0, 210, 3))


def test_scores_count_all_terms():
    """BM25 by plain Python, of seeds with many terms: common ones, rare ones, and terms of one document."""
    rng = random.Random(7)
    docs = [np.array([*(rng.choices(range(10, 400), k=rng.randint(0, 300)) + [500 + i] * 2), packing.END], np.uint16) for i in range(30)]
    idf = np.array([0.5 + t % 13 for t in range(packing.VOCABULARY)])
    mean = float(np.mean([len(d) for d in docs]))
    shard = packing.Shard(docs, idf, mean)
    for seed, ids in enumerate(docs):
        want = []
        for d in docs:
            held = d[:-1].tolist()
            norm = packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
            want.append(sum(
                idf[t] * held.count(t) * (packing.K1 + 1) / (held.count(t) + norm) for t in set(ids[:-1].tolist()) if t in held))
        assert np.allclose(shard.scores(seed), want, rtol=1e-5)
