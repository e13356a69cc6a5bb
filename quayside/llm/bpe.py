"""Token ids of many texts at once, inside Python tasks.

The byte-level tokenizer splits a text by a pattern before it merges bytes. A space followed by
something that is no blank always begins a new part, so a text may be cut there and the cuts
encoded on their own. Cuts repeat a lot: each distinct one is encoded once per worker, and all
the rest is array work. The result equals that of encoding the whole text (a test compares).
"""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import tiktoken

from quayside.llm.words import byte_values, run_hashes, spans

#: Text that the tokenizer takes as one id wherever it stands.
SPECIAL, SPECIAL_ID = b"<|endoftext|>", 50256
VOCABULARY = 50257
KNOWN_MOST = 400_000
# After a space: blanks, and first bytes of characters among which are blanks.
_NO_CUT = np.zeros(256, bool)
_NO_CUT[: 0x21] = True
_NO_CUT[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the cuts of all texts of a slice begin; the first of a text at its first byte."""
    cut = np.zeros(len(data) + 1, bool)
    cut[:-2] = (data[:-1] == 0x20) & ~_NO_CUT[data[1:]]
    # A space at the end of a text belongs to what is before it.
    inner = offsets[1:-1]
    cut[inner[inner > 0] - 1] = False
    cut[offsets[:-1]] = True
    cut[len(data)] = False
    return np.flatnonzero(cut)


def texts_with_special(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The numbers of the texts of a slice that hold ``SPECIAL``."""
    raw, found, at = data.tobytes(), set(), -1
    while (at := raw.find(SPECIAL, at + 1)) >= 0:
        text = int(np.searchsorted(offsets, at, "right")) - 1
        if at + len(SPECIAL) <= offsets[text + 1]:
            found.add(text)
    return np.array(sorted(found), np.int64)


class Encoder:
    """Encodes slices of texts; keeps the ids of some ``KNOWN_MOST`` cuts, those used last."""

    def __init__(self, ranks_path: str) -> None:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(VOCABULARY, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)
        self._hash = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._count = np.zeros(0, np.int64)
        self._used = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint16)
        self._slices = 0

    def _forget(self) -> None:
        """Keeps the half of the cuts that were used last."""
        kept = np.sort(np.argpartition(-self._used, KNOWN_MOST // 2)[: KNOWN_MOST // 2])
        self._ids = self._ids[spans(self._at[kept], self._count[kept])]
        self._hash, self._count, self._used = self._hash[kept], self._count[kept], self._used[kept]
        self._at = np.cumsum(self._count) - self._count

    def whole(self, text: bytes) -> list[int]:
        """Ids of one text, without the cuts."""
        ids: list[int] = []
        for i, part in enumerate(text.split(SPECIAL)):
            if i:
                ids.append(SPECIAL_ID)
            ids += self._bpe.encode_ordinary(part.decode("utf-8", "replace"))
        return ids

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and where each text's ids begin and end."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(n + 1, np.int64)
        starts, counts, ids = self.parts(data, offsets)
        before = np.concatenate(([0], np.cumsum(counts)))
        return ids, before[np.searchsorted(starts, offsets)]

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the parts of all texts begin, the number of ids of each, and all ids. The parts are the
        cuts; a text that holds ``SPECIAL`` is one part, whatever stands next to it in the slice."""
        odd = texts_with_special(data, offsets)
        if not len(odd):
            starts, place, counts = self.cuts(data, offsets)
            return starts, counts, self._ids[spans(place, counts)]
        raw = data.tobytes()
        wholes = [np.array(self.whole(raw[offsets[i]: offsets[i + 1]]), np.uint16) for i in odd]
        starts = counts = place = np.zeros(0, np.int64)
        plain = np.setdiff1d(np.arange(len(offsets) - 1), odd)
        lengths = np.diff(offsets)[plain]
        if lengths.sum():
            inner = np.concatenate(([0], np.cumsum(lengths)))
            starts, place, counts = self.cuts(data[spans(offsets[plain], lengths)], inner)
            # Back to places in the whole slice; empty texts begin no cut.
            text = np.searchsorted(inner, starts, "right") - 1
            starts = starts - inner[text] + offsets[plain][text]
        kept = self._ids[spans(place, counts)]
        sizes = np.array([len(w) for w in wholes], np.int64)
        all_starts, all_counts = np.concatenate((starts, offsets[odd])), np.concatenate((counts, sizes))
        order = np.argsort(all_starts)
        first = np.cumsum(all_counts) - all_counts
        ids = np.concatenate((kept, *wholes))[spans(first[order], all_counts[order])]
        return all_starts[order], all_counts[order], ids

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the cuts of texts without ``SPECIAL`` begin, and place and number of each one's ids."""
        raw, starts = data.tobytes(), cut_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = run_hashes(byte_values()[data], starts, ends)
        found, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        self._learn(found, first, starts, ends, raw)
        known = np.searchsorted(self._hash, found)
        self._used[known] = self._slices
        place = known[which]
        return starts, self._at[place], self._count[place]

    def _learn(self, found: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray, raw: bytes) -> None:
        self._slices += 1
        if len(self._hash) > KNOWN_MOST:
            self._forget()
        at = np.searchsorted(self._hash, found)
        known = np.zeros(len(found), bool)
        inside = at < len(self._hash)
        known[inside] = self._hash[at[inside]] == found[inside]
        new = np.flatnonzero(~known)
        if not len(new):
            return
        ids, counts = self._encoded(raw, starts[first[new]], ends[first[new]])
        places = len(self._ids) + np.cumsum(counts) - counts
        self._ids = np.concatenate((self._ids, ids))
        hashes = np.concatenate((self._hash, found[new]))
        order = np.argsort(hashes)
        self._hash = hashes[order]
        self._at = np.concatenate((self._at, places))[order]
        self._count = np.concatenate((self._count, counts))[order]
        self._used = np.concatenate((self._used, np.zeros(len(new), np.int64)))[order]

    def _encoded(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some cuts, one after the other, and how many each has.

        Cuts that begin with a space and no blank behind it begin a part after any text, so they are
        encoded in one go. The others, and bytes that are no text, are encoded on their own.
        """
        data = np.frombuffer(raw + b"  ", np.uint8)
        joined = (data[starts] == 0x20) & ~_NO_CUT[data[starts + 1]] & (ends > starts + 1)
        counts, parts = np.zeros(len(starts), np.int64), [np.zeros(0, np.uint16)] * 2
        together, alone = np.flatnonzero(joined), np.flatnonzero(~joined)
        if len(together):
            lengths = ends[together] - starts[together]
            try:
                text = data[spans(starts[together], lengths)].tobytes().decode("utf-8")
            except UnicodeDecodeError:
                together, alone = together[:0], np.arange(len(starts))
            else:
                parts[0] = np.array(self._bpe.encode_ordinary(text), np.uint16)
                after = np.searchsorted(np.cumsum(self._bytes[parts[0]]), np.cumsum(lengths), "right")
                # A token ends where a cut ends, so this is the number of tokens up to there.
                counts[together] = np.diff(after, prepend=0)
        if len(alone):
            lists = [self._bpe.encode_ordinary(raw[a:b].decode("utf-8", "replace")) for a, b in zip(starts[alone], ends[alone], strict=True)]
            counts[alone] = [len(x) for x in lists]
            parts[1] = np.fromiter((i for x in lists for i in x), np.uint16, int(counts[alone].sum()))
        # From those in one go and those on their own to the order of the cuts.
        asked = np.concatenate((together, alone))
        place = np.zeros(len(starts), np.int64)
        place[asked] = np.cumsum(counts[asked]) - counts[asked]
        return np.concatenate(parts)[spans(place, counts)], counts
