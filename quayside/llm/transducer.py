"""Encoding and decoding by byte pairs as a stream, in constant memory.

*Lookahead.* Two texts that begin alike are merged alike up to some place before they differ. That place moves
left when a merge (T, S) happens across it in one of them only, and then by the length of T. Rules
apply in the order of the list, and S must hold, at its left end, the part that moved the place last.
So the longest chain of such rules bounds how far what follows can reach back: ``MergeList.lookahead``
is computed from the list by one pass over it. It holds for lists whose parts are made before they are
used and whose results are made once, which is checked.

*Encoding.* Symbols of an open word are held until there are several times the lookahead; tokens
that end further back than it are then the same whatever comes, so they go out. What is held is
bounded by the lookahead, not by word or text. Words that end soon are looked up among those seen lately.
Text comes in pieces, which are cut where neither a special token, a composed character nor a
contraction can lie across; beyond ASCII, words are told apart by the tokenizer's own normalizer and splitter, so
that classes of characters are the library's. Only a run of combining marks has no such place and is held whole.

*Decoding.* A machine over bytes: each id stands for some bytes, a character whose bytes have not all
come is held, and bytes that are no character become U+FFFD.

A document comes out in parts of up to ``PART_IDS`` ids, one row each, the first one with ``part`` 0.

Results by case: a NULL or empty text is one part without ids; texts of any length are streamed; rows
that repeat come out once each, NULL ids like others; a table without rows gives none; other columns
are not looked at.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm.base import query, table

PIECE_CHARS = 1 << 16
PART_IDS = 1 << 16
#: Longer runs without a blank are streamed and not remembered.
LONG_CHARS = 256
#: Texts are taken together up to this.
TOGETHER_CHARS = 1 << 20
KNOWN_MOST = 120_000
#: Characters looked through for a place to cut at before more are read.
CUT_CHARS = 64
ENCODED = "doc_id long, part int, ids binary"
DECODED = "doc_id long, part int, ids binary, text string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# What Unicode calls white space.
_WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WHITE = "".join(map(chr, _WHITE_SPACE))
_RUN = re.compile(f"[^{_WHITE}]+")
_BLANK = re.compile(f"[{_WHITE}]")
# These compose with a character before them although they are letters (Hangul parts, Kirat Rai vowels).
_JOINS_BEFORE = frozenset(map(chr, [*range(0x1160, 0x1200), *range(0xD7B0, 0xD7FC), *range(0x16D63, 0x16D6B)]))


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class MergeList:
    """The merges of a tokenizer file, as ids, and how far what follows can reach back."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self._rules: dict[tuple[int, int], tuple[int, int]] = {}
        self.lookahead = 1 + self._reach(model["merges"])
        rules = sorted((a * len(self.ids) + b, rank, made) for (a, b), (rank, made) in self._rules.items())
        self._keys, self._ranks = (np.array([r[k] for r in rules], np.int64) for k in (0, 1))
        self._none = len(rules)
        # Ids of the symbols within a word and at its end.
        symbols = byte_symbols()
        self._inner, self._last = np.zeros((2, 1 + max(map(ord, symbols))), np.int64)
        for symbol in symbols:
            self._inner[ord(symbol)], self._last[ord(symbol)] = self.ids.get(symbol, -1), self.ids.get(symbol + self.suffix, -1)
        #: What each rule makes, by rank.
        self._made = np.array([made for _, made in sorted(self._rules.values())], np.int64)

    def _reach(self, merges: list[list[str]]) -> int:
        """The longest chain of rules by which a difference moves left; fills the rules."""
        left: dict[str, str] = {}
        moved: dict[str, int] = {}
        most = 0
        for rank, (a, b) in enumerate(merges):
            for part in (a, b):
                if part not in left and len(part.removesuffix(self.suffix)) != 1:
                    raise ValueError(f"{part!r} is merged before it is made")
            if a + b in left:
                raise ValueError(f"{a + b!r} is made by two rules")
            before, part = 0, b
            while part is not None:
                before = max(before, moved.get(part, 0))
                part = left.get(part)
            reach = before + len(a)
            moved[a] = max(moved.get(a, 0), reach)
            most = max(most, reach)
            left[a + b] = a
            self._rules[self.ids[a], self.ids[b]] = rank, self.ids[a + b]
        return most

    def symbols(self, part: str, ends: bool) -> list[int]:
        if not ends:
            return [self.ids[c] for c in part]
        return [*(self.ids[c] for c in part[:-1]), self.ids[part[-1] + self.suffix]]

    def merged(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """Tokens, and the number of symbols in each: lowest rank first, then leftmost."""
        n, rules = len(symbols), self._rules
        token, size = list(symbols), [1] * n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        found = ((rules.get((token[i], token[i + 1])), i) for i in range(n - 1))
        heap = [(rule[0], i, token[i], token[i + 1], rule[1]) for rule, i in found if rule]
        heapify(heap)

        def offer(i: int, j: int) -> None:
            rule = rules.get((token[i], token[j]))
            if rule:
                heappush(heap, (rule[0], i, token[i], token[j], rule[1]))

        while heap:
            _, i, a, b, new = heappop(heap)
            j = after[i]
            # An offer is stale when one of its two tokens is no more.
            if not size[i] or j >= n or token[i] != a or token[j] != b:
                continue
            token[i], size[i], size[j] = new, size[i] + size[j], 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        held = [i for i in range(n) if size[i]]
        return [token[i] for i in held], [size[i] for i in held]

    def merged_words(self, words: list[str]) -> list[bytes]:
        """Ids of many whole words: in each pass every word has its merge of lowest rank everywhere."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(word) for word in words], np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        token = self._inner[letters]
        last = np.cumsum(sizes) - 1
        token[last] = self._last[letters[last]]
        which = np.arange(len(words))
        while len(which):
            first = np.concatenate(([0], np.cumsum(sizes)))
            key = token[:-1] * len(self.ids) + token[1:]
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            rank = np.full(len(token), self._none)
            rank[:-1] = np.where(self._keys[at] == key, self._ranks[at], self._none)
            rank[first[1:] - 1] = self._none
            lowest = np.minimum.reduceat(rank, first[:-1])
            more = lowest < self._none
            for i in np.flatnonzero(~more).tolist():
                out[which[i]] = token[first[i]: first[i + 1]].astype("<u4").tobytes()
            owner = np.repeat(np.arange(len(which)), sizes)
            kept, merge = more[owner], (rank == lowest[owner]) & (rank < self._none)
            # Of merges that overlap, as in "aaa", the first, third and so on happen.
            places = np.flatnonzero(merge)
            begins = np.concatenate(([True], np.diff(places) != 1)) if len(places) else np.zeros(0, bool)
            index = np.arange(len(places))
            places = places[(index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0]
            token[places] = self._made[rank[places]]
            kept[places + 1] = False
            sizes = np.bincount(owner[kept], minlength=len(which))[more]
            token, which = token[kept], which[more]
        return out


class Word:
    """An open word: symbols come in, tokens go out once nothing that follows can change them."""

    def __init__(self, merges: MergeList) -> None:
        self._merges, self._held = merges, ""

    def feed(self, symbols: str) -> list[int]:
        out: list[int] = []
        reach = self._merges.lookahead
        for at in range(0, len(symbols), 3 * reach):
            self._held += symbols[at: at + 3 * reach]
            if len(self._held) < 4 * reach:
                continue
            tokens, sizes = self._merges.merged(self._merges.symbols(self._held, False))
            stable, done = len(self._held) - reach, 0
            for token, size in zip(tokens, sizes, strict=True):
                if done + size > stable:
                    break
                out.append(token)
                done += size
            self._held = self._held[done:]
        return out

    def finish(self) -> list[int]:
        held, self._held = self._held, ""
        return self._merges.merged(self._merges.symbols(held, True))[0] if held else []


class Transducer:
    """What the streams of one tokenizer file share: its merges, its splitter, and runs seen lately."""

    def __init__(self, path: str) -> None:
        self.merges = MergeList(path)
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        added = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self.special = added
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        self._heads = {text[:n] for text in added for n in range(1, len(text))}
        self._longest = max(map(len, added))
        self._runs: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        """Text and special tokens in turn."""
        return self._special.split(text)

    def words(self, normal: str) -> list[str]:
        """Words of a normalized text in the symbols of the merges."""
        return [word for word, _ in self._split(normal)]

    def normal(self, text: str) -> str:
        return self._normalize(text)

    def run_kind(self, char: str) -> str:
        """A character that a word can go on with where ``char`` is its last; none if it ends there."""
        return next((guard for guard in ("a", "!") if len(self._split(guard + char)) == 1), "")

    def cut(self, text: str) -> int:
        """The last place at which a run may be cut, 0 if there is none near its end."""
        near = range(max(len(text) - self._longest + 1, 0), len(text))
        end = next((i for i in near if text[i:] in self._heads), len(text))
        low = max(end - CUT_CHARS, 0)
        inside = {i for m in self._special.finditer(text, max(low - self._longest, 0)) for i in range(m.start() + 1, m.end())}
        for i in range(end if end < len(text) else end - 1, low, -1):
            if i in inside:
                continue
            kind = unicodedata.category(text[i])
            # An unassigned character may be one that a later version of Unicode composes.
            if kind[0] != "M" and kind != "Cn" and not unicodedata.combining(text[i]) and text[i] not in _JOINS_BEFORE:
                return i
        return 0

    def runs(self, texts: list[str]) -> list[bytes]:
        """Ids of runs that end at both sides and are short enough to be remembered."""
        known = self._runs
        missing = set(texts).difference(known)
        if missing:
            known.update(self._learn(missing))
        found = list(map(known.__getitem__, texts))
        if len(known) > KNOWN_MOST:
            self._older, self._runs = known, {}
        return found

    def _learn(self, texts: set[str]) -> dict[str, bytes]:
        older = self._older
        made = {text: older[text] for text in texts if text in older}
        plain, lists, other = [], [], []
        for text in texts.difference(made):
            if "<|" in text and self._special.search(text):
                made[text] = b"".join(
                    np.uint32(self.special[part]).tobytes() if k % 2 else b"".join(self.words_ids(self.words(self.normal(part))))
                    for k, part in enumerate(self.parts(text)))
            elif text.isascii() and text.isprintable():
                plain.append(text)
                lists.append(_ASCII_WORD.findall(text.lower()))
            else:
                other.append(text)
        if other:
            # Blanks hold for normalizer and splitter, so all these runs go through them as one text.
            normal = self.normal(" ".join(other))
            ends = np.cumsum([len(run) + 1 for run in normal.split(" ")])
            split = self._split(normal)
            first = np.searchsorted(np.fromiter((at[0] for _, at in split), np.int64, len(split)), ends).tolist()
            plain += other
            lists += [[word for word, _ in split[a:b]] for a, b in zip([0, *first], first, strict=False)]
        ids = iter(self.words_ids([word for words in lists for word in words]))
        made.update((run, b"".join(islice(ids, len(words)))) for run, words in zip(plain, lists, strict=True))
        return made

    def words_ids(self, words: list[str]) -> list[bytes]:
        """Ids of whole words, in symbols."""
        known = self._words
        new = list(set(words).difference(known))
        if len(known) + len(new) > KNOWN_MOST:
            known = self._words = {word: known[word] for word in words if word in known}
        known.update(zip(new, self.merges.merged_words(new), strict=True))
        return list(map(known.__getitem__, words))


class Stream:
    """Ids of one text that comes in pieces."""

    def __init__(self, shared: Transducer) -> None:
        self._shared = shared
        self._raw = ""
        self._normal = ""
        self._long = False
        self._word = Word(shared.merges)
        self._guard = ""

    def feed(self, piece: str) -> bytes:
        return self._read(self._raw + piece, False)

    def finish(self) -> bytes:
        return self._read(self._raw, True)

    def _read(self, text: str, last: bool) -> bytes:
        out: list[bytes] = []
        at = 0
        if self._long:
            # The run goes on up to the first blank.
            blank = _BLANK.search(text)
            if blank is None and not last:
                return self._go_on(text)
            at = blank.start() if blank else len(text)
            out.append(self._close(text[:at]))
        runs = _RUN.findall(text, at)
        self._raw = runs.pop() if runs and not last and not _BLANK.match(text[-1]) else ""
        if all(len(run) <= LONG_CHARS for run in runs):
            out += self._shared.runs(runs)
        else:
            for run in runs:
                out += self._shared.runs([run]) if len(run) <= LONG_CHARS else [self._close(run)]
        if len(self._raw) > LONG_CHARS:
            out.append(self._go_on(self._raw))
        return b"".join(out)

    def _go_on(self, text: str) -> bytes:
        """Ids of an unfinished run as far as they are certain; the rest is held."""
        self._long = True
        cut = self._shared.cut(text)
        self._raw = text[cut:]
        return self._some(text[:cut], False)

    def _close(self, text: str) -> bytes:
        ids = self._some(text, True)
        self._long = False
        return ids

    def _some(self, text: str, last: bool) -> bytes:
        out: list[int] = []
        parts = self._shared.parts(text)
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self._shared.special[part])
            else:
                out += self._plain(self._shared.normal(part), last or k + 1 < len(parts))
        return np.array(out, "<u4").tobytes()

    def _plain(self, normal: str, last: bool) -> list[int]:
        """Ids of normalized text without special tokens; ``last`` if nothing of the kind follows it."""
        out: list[int] = []
        normal, self._normal = self._normal + normal, ""
        words = self._shared.words(self._guard + normal) if normal else []
        if self._guard:
            # The first word is the open one and the guard, which is one symbol.
            more = words[0][1:] if words else ""
            out += self._word.feed(more)
            if len(words) > 1 or last:
                out += self._word.finish()
                self._guard = ""
                words = words[1:]
            else:
                return out
        if not words:
            return out
        if not last:
            # A contraction may go on; nothing before it is open then.
            held = next((n for n in (2, 1) if normal[-n:] in _CONTRACTED[n] and words[-n:] == list(normal[-n:])), 0)
            if held:
                words, self._normal = words[:-held], normal[-held:]
            elif words[-1][0] != "'" or len(words[-1]) == 1 or words[-1] not in _CONTRACTIONS:
                self._guard = self._shared.run_kind(normal[-1])
        opened = words.pop() if self._guard else ""
        for word in words:
            out += self._word.feed(word) + self._word.finish()
        return out + self._word.feed(opened)


# What the splitter finds in visible ASCII characters, which are symbols as they are.
_ASCII_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# Its contractions, and how they begin: one, or two characters that are words by themselves.
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_CONTRACTED = {1: ("'",), 2: ("'r", "'v", "'l")}


class Decoder:
    """Text of ids that come in pieces.

    ``entries`` puts out the vocabulary's entries with a space between them, which is what the
    library's ``decode`` does for a file that names no decoder; otherwise the bytes that the entries
    stand for, with a space for the end of a word.
    """

    def __init__(self, path: str, entries: bool = True) -> None:
        self._bytes = decoding(path, entries)
        self._text = codecs.getincrementaldecoder("utf-8")("replace")
        self._drop = entries

    def feed(self, ids: list[int]) -> str:
        data = b"".join(map(self._bytes.__getitem__, ids))
        if self._drop and data:
            data, self._drop = data[1:], False
        return self._text.decode(data)

    def finish(self) -> str:
        return self._text.decode(b"", True)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


@cache
def decoding(path: str, entries: bool) -> list[bytes]:
    """What each id puts out."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    suffix, special = spec["model"]["end_of_word_suffix"] or "", {t["content"]: t["id"] for t in spec["added_tokens"]}
    number = {symbol: b for b, symbol in enumerate(byte_symbols())}
    out = []
    for name, _ in sorted((spec["model"]["vocab"] | special).items(), key=lambda item: item[1]):
        if entries:
            out.append(b" " + name.encode())
        elif name in special:
            out.append(name.encode())
        else:
            ends = bool(suffix) and name.endswith(suffix)
            out.append(bytes(number[c] for c in name.removesuffix(suffix)) + b" " * ends)
    return out


@cache
def transducer(path: str) -> Transducer:
    """One per worker process, as what it has seen serves later tasks too."""
    return Transducer(path)


def streamed(shared: Transducer, text: str) -> Iterator[bytes]:
    """Parts of the ids of one text; at least one."""
    stream, held = Stream(shared), []
    size = 0
    for at in range(0, len(text), PIECE_CHARS):
        held.append(stream.feed(text[at: at + PIECE_CHARS]))
        size += len(held[-1])
        if size >= 4 * PART_IDS:
            yield b"".join(held)
            held, size = [], 0
    yield b"".join([*held, stream.finish()])


def together(shared: Transducer, texts: list[str]) -> Iterator[Iterator[bytes]]:
    """The same for several texts; what is new in the short ones is learnt at once."""
    runs = [_RUN.findall(text) if len(text) <= PIECE_CHARS else None for text in texts]
    short = [found is not None and max(map(len, found), default=0) <= LONG_CHARS for found in runs]
    ids = iter(shared.runs([run for found, ok in zip(runs, short, strict=True) if ok for run in found]))
    for text, found, ok in zip(texts, runs, short, strict=True):
        yield iter([b"".join(islice(ids, len(found)))]) if ok else streamed(shared, text)


def _encode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = transducer(path)
        out = _Rows(ENCODED)

        def rows(keys: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
            for key, parts in zip(keys, together(shared, texts), strict=True):
                for part, ids in enumerate(parts):
                    yield from out.add((key, part, ids), len(ids))

        for batch in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                keys.append(key.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= TOGETHER_CHARS:
                    yield from rows(keys, texts)
                    keys, texts, size = [], [], 0
            yield from rows(keys, texts)
        yield from out.rest()
    return run


def _decode(path: str, entries: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(DECODED)
        decoder: Decoder | None = None
        # A part is held until it is known whether its document goes on.
        held: tuple | None = None
        for batch in batches:
            for key, part, ids in zip(*(batch.column(i) for i in range(3)), strict=True):
                if held is not None:
                    text = held[3] + decoder.finish() if part.as_py() == 0 else held[3]
                    yield from out.add((*held[:3], text), len(held[2]) + len(text))
                if part.as_py() == 0:
                    decoder = Decoder(path, entries)
                raw = ids.as_py()
                held = key.as_py(), part.as_py(), raw, decoder.feed(np.frombuffer(raw, "<u4").tolist())
        if held is not None:
            yield from out.add((*held[:3], held[3] + decoder.finish()), 0)
        yield from out.rest()
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, from its parts in order."""
    out = _Rows(DIGESTS)
    key, n, ids_hash, text_hash = None, 0, None, None
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(4)), strict=True):
            if row[1].as_py() == 0:
                if ids_hash is not None:
                    yield from out.add((key, n, ids_hash.hexdigest(), text_hash.hexdigest()), 200)
                key, n, ids_hash, text_hash = row[0].as_py(), 0, hashlib.sha256(), hashlib.sha256()
            ids = row[2].as_py()
            n += len(ids) // 4
            ids_hash.update(ids)
            text_hash.update(row[3].as_buffer())
    if ids_hash is not None:
        yield from out.add((key, n, ids_hash.hexdigest(), text_hash.hexdigest()), 200)
    yield from out.rest()


class _Rows:
    """Rows gathered into batches of bounded size."""

    _TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}

    def __init__(self, schema: str) -> None:
        fields = [field.split() for field in schema.split(", ")]
        self._names, self._types = [f[0] for f in fields], [self._TYPES[f[1]] for f in fields]
        self._rows: list[tuple] = []
        self._size = 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self._rows.append(row)
        self._size += size + 50
        if self._size > 4_000_000:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        rows, self._rows, self._size = self._rows, [], 0
        if rows:
            columns = zip(zip(*rows, strict=True), self._types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], self._names)


def encoded(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """Ids of every text, little-endian unsigned 32-bit numbers (see ``ENCODED``)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_encode(path or default_path()), ENCODED)


def decoded(parts: DataFrame, path: str | None = None, entries: bool = True) -> DataFrame:
    """``encoded`` rows with their text; parts of a document follow one another in a partition, as there."""
    return parts.select("doc_id", "part", "ids").mapInArrow(_decode(path or default_path(), entries), DECODED)


@query("op13_streaming_bpe")
def op13_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its ids, and digest of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decoded(encoded(docs)).mapInArrow(_digest, DIGESTS)
