"""Alignment of two tokenizers against a walk through both lists of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quayside.llm import alignment
from quayside.llm.catalogue import QUERIES
from quayside.llm.words import text_slices

TEXT = st.lists(st.one_of(
    st.text(" \n\t.,'abAB12|#<>!" + "".join(map(chr, (0, 0xE9, 0xFC, 0x65E5, 0x300, 0xAC00, 0x3000, 0xA0, 0x85))), max_size=10),
    st.text(st.characters(codec="utf-8"), max_size=4),
    st.sampled_from([chr(0x2581), "<|endoftext|>", "<s>", "<0x41>", "the ", "tokenization ", "  ", " of"])), max_size=6).map("".join)


class Brute:
    def __init__(self):
        a, b = alignment.default_paths()
        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        self.bytes_a, self.bytes_b = alignment.token_bytes_a(self.a), alignment.token_bytes_b(self.b)

    def of(self, text):
        """Ids of both, groups and links; None where the bytes differ."""
        a, b = self.a.encode(" " + (text or ""), add_special_tokens=False).ids, self.b.encode(text or "")
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(table[i] for i in ids) != whole for table, ids in ((self.bytes_a, a), (self.bytes_b, b))):
            return None
        i = j = end_a = end_b = 0
        left, right, groups, links = [a[0]], [b[0]], [], []
        end_a, end_b = len(self.bytes_a[a[0]]), len(self.bytes_b[b[0]])
        while True:
            links.append((a[i], b[j]))
            if end_a == end_b:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
                if end_a == len(whole):
                    return a, b, groups, links
            low_a, low_b = end_a <= end_b, end_b <= end_a
            if low_a:
                i += 1
                left.append(a[i])
                end_a += len(self.bytes_a[a[i]])
            if low_b:
                j += 1
                right.append(b[j])
                end_b += len(self.bytes_b[b[j]])

    def corpus(self, texts):
        found = [self.of(t) for t in texts]
        counts = Counter(pair for f in found if f for pair in set(f[3]))
        most = Counter()
        for (a, _), n in counts.items():
            most[a] = max(most[a], n)
        rows = [(0, 0, 0, 0, 0, 0, "") if f is None else (
            len(f[0]), len(f[1]), len(f[2]), len(f[3]), sum(counts[x] == most[x[0]] for x in f[3]), sum(counts[x] for x in f[3]),
            ";".join(f[2])) for f in found]
        return rows, counts


@pytest.fixture(scope="module")
def brute():
    return Brute()


@pytest.fixture(scope="module")
def shared():
    return alignment.Aligner(*alignment.default_paths())


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5), st.sampled_from([10, 300_000]))
@example(["a  b", " x", "x ", "  ", "", "a" + chr(0x2581) + " b"], 10)
def test_texts(brute, shared, texts, known):
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    before, alignment.KNOWN_MOST = alignment.KNOWN_MOST, known
    try:
        for _, data, offsets in text_slices(batch):
            numbers, groups, links = shared.aligned(data, offsets)
            for k, text in enumerate(texts):
                want = brute.of(text)
                codes = links.codes[links.first[k]: links.first[k + 1]].tolist()
                assert sorted(divmod(c, shared.n_b) for c in codes) == (sorted(want[3]) if want else [])
                assert groups[k].decode() == (";".join(want[2]) if want else "")
                assert numbers[k].tolist() == ([len(x) for x in want] if want else [0] * 4)
    finally:
        alignment.KNOWN_MOST = before


def test_identity_map(shared):
    """A pair of the map has the same bytes; a byte by itself is not preferred to a piece."""
    held = [(c // shared.n_b, c % shared.n_b) for c in shared.identity.tolist() if c >= 0]
    assert len(held) > 10_000
    assert all(shared._bytes_a[a] == shared._bytes_b[b] for a, b in held)
    letter = next(b for a, b in held if shared._bytes_a[a] == b"q")
    assert not shared._b.is_byte(letter)


@pytest.mark.parametrize("size", [8_000_000, 300])
def test_documents(odd, empty, brute, monkeypatch, size):
    """Slices of all texts and of one or two, so that counts come from many slices and tasks."""
    monkeypatch.setattr(alignment, "SLICE", size)
    made = alignment.Alignment(odd)
    docs = odd.collect()
    want, counts = brute.corpus([r.text for r in docs])
    got = [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in made.documents.collect()]
    assert sorted(got) == sorted(want)
    assert {(r.a, r.b): r.n for r in made.pairs().collect()} == dict(counts)
    assert alignment.Alignment(empty).documents.count() == 0


def test_a_pair_may_be_in_the_map_and_in_no_group_of_its_own(session, brute):
    """Texts without blanks, in other scripts, and with pairs that only some documents hold regularly."""
    accents = "".join(map(chr, (0xE9, 0x65E5, 0x672C, 0x8A9E, 0x1F600)))
    texts = ["banana" * 9, "nanab", "ana na an", accents * 5, accents[1:] + " a", "a" * 50, "aaaa aaa", "x " * 30, None, "banana" * 9]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want, counts = brute.corpus(texts)
    made = alignment.Alignment(docs)
    assert {r.doc_id: (*r[1:5], r.n_best, r.count_sum, r.groups) for r in made.documents.collect()} == dict(enumerate(want))
    assert {(r.a, r.b): r.n for r in made.pairs().collect()} == dict(counts)


def test_only_other_pairs_are_shuffled(odd, shared):
    made = alignment.Alignment(odd)
    assert made._counts.count()
    assert not any(shared.identity[r.a] == r.a * shared.n_b + r.b for r in made._counts.collect())


def test_query(spark, brute):
    rows = {r.doc_id: r for r in QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute.corpus([d.text for d in docs])
    assert len(rows) == len(docs)
    for doc, (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) in zip(docs, want, strict=True):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        r = rows[doc.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (
            n_a, n_b, n_groups, n_links, n_best, count_sum, digest)
