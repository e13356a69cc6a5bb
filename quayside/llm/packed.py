"""Several arrays as one value of a binary column."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(parts: list[np.ndarray], compress: bool = True) -> bytes:
    head = np.array([len(parts), *(p.nbytes for p in parts)], np.int64)
    raw = b"".join([head.tobytes(), *(p.tobytes() for p in parts)])
    return zstandard.ZstdCompressor(level=3).compress(raw) if compress else raw


def unpack(blob: bytes, compress: bool = True) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob) if compress else blob
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.int64, n, 8)) + 8 * (n + 1)
    return [raw[a:b] for a, b in zip([8 * (n + 1), *ends[:-1]], ends, strict=True)]
