"""Streaming byte-pair encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import transducer
from quayside.llm.catalogue import QUERIES

CHARS = " \n\t.,'!|#<>stremvlaAB12" + "".join(map(chr, (
    0xE9, 0xDF, 0x130, 0x1C5, 0x3A3, 0x300, 0x308, 0x65E5, 0xAC00, 0x1100, 0x1161, 0x11A8, 0x3000, 0x2003, 0xA0, 0x85, 0x1C)))
TEXT = st.lists(st.one_of(
    st.text(CHARS, max_size=12), st.text(st.characters(codec="utf-8"), max_size=4), st.text("aehrtins'", max_size=60),
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|endof", "don't", "'re", "!'ve", "x" * 40])), max_size=8).map("".join)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(transducer.default_path())


@pytest.fixture(scope="module")
def shared():
    return transducer.Transducer(transducer.default_path())


def ids_of(parts):
    return np.frombuffer(b"".join(parts), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(TEXT, st.sampled_from([1, 2, 5, 64]), st.sampled_from([1, 3, 20, 256]), st.sampled_from([1, 7, 1000]))
@example("a'" * 30 + "re 'll" + "!'s" * 9, 2, 3, 1)
@example("<|endoftext|>" * 9 + "<|endof", 2, 3, 1)
def test_stream(library, shared, text, piece, long, part):
    held = transducer.PIECE_CHARS, transducer.LONG_CHARS, transducer.PART_IDS
    transducer.PIECE_CHARS, transducer.LONG_CHARS, transducer.PART_IDS = piece, long, part
    try:
        parts = list(transducer.streamed(shared, text))
    finally:
        transducer.PIECE_CHARS, transducer.LONG_CHARS, transducer.PART_IDS = held
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(parts) == want
    decoder = transducer.Decoder(transducer.default_path())
    assert "".join([decoder.feed(ids_of([p])) for p in parts]) + decoder.finish() == library.decode(want, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from(["ab", "aehrtins", "01", "!?'"]), st.integers(1, 9000))
def test_stable_tokens_of_open_words(shared, seed, letters, n):
    """What goes out of an open word is what merging the whole word gives, with the lookahead cut to the bound."""
    rng = random.Random(seed)
    symbols = "".join(rng.choices(letters, k=n))
    word, out = transducer.Word(shared.merges), []
    at = 0
    while at < n:
        step = rng.randint(1, 2000)
        out += word.feed(symbols[at: at + step])
        at += step
    assert out + word.finish() == shared.merges.merged(shared.merges.symbols(symbols, True))[0]


def test_lookahead_is_reached_from_the_list(tmp_path):
    """A chain of merges in which each begins with the result of the one before."""
    vocab = {c: i for i, c in enumerate(["a", "b", "c", "d", "a</w>", "b</w>", "c</w>", "d</w>", "cd", "bc", "ab"])}
    spec = {"model": {"end_of_word_suffix": "</w>", "vocab": vocab, "merges": [["c", "d"], ["b", "c"], ["a", "b"]]}}
    path = tmp_path / "merges.json"
    path.write_text(json.dumps(spec))
    merges = transducer.MergeList(str(path))
    # "abc" and what follows: d decides on c, this on b, and this on a.
    assert merges.lookahead == 1 + 3
    assert merges.merged([0, 1, 2])[0] == [0, 9] and merges.merged([0, 1, 2, 3])[0] == [10, 8]
    spec["model"]["merges"] = [["ab", "c"], ["a", "b"]]
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        transducer.MergeList(str(path))


def test_long_runs_take_constant_memory(shared):
    """What is held does not grow with the text, whether it has blanks or not."""
    def most(pieces: int) -> int:
        stream, rng = transducer.Stream(shared), random.Random(4)
        tracemalloc.start()
        for _ in range(pieces):
            stream.feed("".join(rng.choices("aehrtins", k=4000)))
        stream.finish()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak

    most(4)
    assert most(40) < 1.5 * most(8)


def test_bytes_to_text(library, shared):
    """The machine over bytes holds a character until its bytes have come."""
    text = "h" + chr(0xE9) + "llo " + chr(0x65E5) + chr(0x672C) + chr(0x8A9E) + " x"
    ids = library.encode(text, add_special_tokens=False).ids
    decoder = transducer.Decoder(transducer.default_path(), entries=False)
    pieces = [decoder.feed([i]) for i in ids]
    assert "".join(pieces) + decoder.finish() == text + " "
    assert "" in pieces
    broken = transducer.Decoder(transducer.default_path(), entries=False)
    lead = transducer.byte_symbols()[0xE6]
    assert broken.feed([shared.merges.ids[lead]]) + broken.finish() == chr(0xFFFD)


def test_documents(odd, empty, library):
    def digests(docs):
        return transducer.decoded(transducer.encoded(docs)).mapInArrow(transducer._digest, transducer.DIGESTS).collect()

    def want(key, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return str(key), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    assert sorted((str(r.doc_id), *r[1:]) for r in digests(odd)) == sorted(want(r.doc_id, r.text) for r in odd.collect())
    assert digests(empty) == []
    long = odd.sparkSession.createDataFrame([(1, "word " * 400_000), (2, ""), (3, None)], "doc_id long, text string")
    parts = transducer.encoded(long.coalesce(1))
    assert parts.groupBy("doc_id").agg(F.max("part")).collect()[0][1] > 1
    assert sorted((str(r.doc_id), *r[1:]) for r in digests(long)) == sorted(want(r.doc_id, r.text) for r in long.collect())


def test_query(spark, library):
    rows = {r.doc_id: r for r in QUERIES["op13_streaming_bpe"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        assert rows[doc.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
