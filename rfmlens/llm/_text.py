"""Vectorised text helpers for tasks: byte-level words and 64-bit hashes.

A chunk of documents is one ``uint8`` buffer plus offsets (what Arrow already
holds); words are found and hashed with whole-array numpy operations, so a
task never loops over words in Python.  Memory is about 30 bytes per byte of
text in the chunk: chunks hold ``CHUNK_BYTES`` of text, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 4 << 20
SPACE_BYTES = (32, 9, 10, 11, 12, 13)

_rng = np.random.default_rng(7)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BYTE_CODE[65:91] = BYTE_CODE[97:123]          # A-Z hash as a-z
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACE_BYTES)] = False
# ASCII letters and every byte of a multi-byte character
LETTER_BYTE = np.zeros(256, bool)
LETTER_BYTE[65:91] = LETTER_BYTE[97:123] = True
LETTER_BYTE[128:] = True

_P = U(0x9E3779B97F4A7C15)
_PI = U(pow(int(_P), -1, 2**64))
_pow: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective, well spread)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        for i, p in enumerate((_P, _PI)):
            a = np.full(n, p, np.uint64)
            a[0] = 1
            _pow[i] = np.multiply.accumulate(a)
    return _pow[0][:n], _pow[1][:n]


def chunks(batch: pa.RecordBatch, text: str, max_bytes: int = CHUNK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) slices of a batch; a null text is empty."""
    col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield (batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        lo = hi


def word_spans(buf: np.ndarray, offs: np.ndarray, in_word: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, ends and document index of maximal runs of ``in_word``."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = in_word[buf]
    first = np.empty(n, bool)
    first[0], first[1:] = True, ~w[:-1]
    last = np.empty(n, bool)
    last[-1], last[:-1] = True, ~w[1:]
    cut = offs[1:-1]
    first[cut[cut < n]] = True
    last[cut[cut > 0] - 1] = True
    starts = np.flatnonzero(w & first)
    ends = np.flatnonzero(w & last) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """What ``span_hashes`` adds up; worth keeping for several calls on one buffer."""
    pw, _ = _powers(len(buf) + 1)
    s = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_CODE[buf] * pw[:len(buf)], out=s[1:])
    return s


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None
                ) -> np.ndarray:
    """64-bit hash of each span's bytes, A-Z as a-z."""
    _, ip = _powers(len(buf) + 1)
    s = prefix_sums(buf) if sums is None else sums
    h = (s[ends] - s[starts]) * ip[starts]
    return mix(h + U(0x1234567) * (ends - starts).astype(np.uint64))


def counts_by(index: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(index, weights=weights, minlength=n)[:n]
