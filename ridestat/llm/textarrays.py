"""Whole Arrow text columns as flat numpy arrays: words, lines, hashes, windows.

A text column is cut into chunks of whole rows (about ``CHUNK`` bytes each; one longer row is a
chunk of its own), so temporaries stay a small multiple of ``CHUNK`` whatever the batch size.
Words are runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``; those bytes never occur inside
a UTF-8 sequence, so no decoding is needed. Hashes are 64-bit: a polynomial with an odd base
modulo 2**64, read off one running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Bytes hashed at a time; powers of the base are kept for so many places.
BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        with np.errstate(over="ignore"):
            up = np.full(BLOCK + 1, _BASE, np.uint64)
            down = np.full(BLOCK + 1, _UNBASE, np.uint64)
            up[0] = down[0] = 1
            _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte span; spans are ascending and do not overlap."""
    up, down = _powers()
    out = np.empty(len(starts), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(starts):
            at = int(starts[lo])
            hi = int(np.searchsorted(ends, at + BLOCK, side="right"))
            if hi <= lo:  # one span longer than a block: block by block
                h = np.uint64(0)
                for p in range(at, int(ends[lo]), BLOCK):
                    piece = data[p : min(p + BLOCK, int(ends[lo]))].astype(np.uint64) + np.uint64(1)
                    h = h * up[BLOCK] + (piece * up[: len(piece)]).sum(dtype=np.uint64)
                out[lo] = h
                lo += 1
                continue
            block = data[at : int(ends[hi - 1])].astype(np.uint64)
            block += np.uint64(1)
            block *= up[: len(block)]
            total = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(block, out=total[1:])
            s, e = starts[lo:hi] - at, ends[lo:hi] - at
            out[lo:hi] = (total[e] - total[s]) * down[s]
            lo = hi
        return mix(out + (ends - starts).astype(np.uint64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Flat places of ``lengths[i]`` items from ``starts[i]`` on, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and ``n + 1`` offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets from 0)`` of whole-row chunks."""
    data, offsets = text_buffers(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def owners(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The row each byte place lies in (empty rows own none)."""
    return np.searchsorted(offsets, places, side="right") - 1


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of true bytes; a row's border always cuts."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = member.copy()
    first[1:] &= ~member[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(member)]
    first[cuts] = member[cuts]
    last = member.copy()
    last[:-1] &= ~member[1:]
    stops = offsets[1:][offsets[1:] > 0] - 1
    last[stops] = member[stops]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


@dataclass
class Words:
    """Words of a chunk in order: byte spans, hashes, and each row's range of words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    #: n + 1 places: words of row i are first[i] : first[i + 1].
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    start, end = runs(~IS_SPACE[data], offsets)
    return Words(start, end, span_hashes(data, start, end), np.searchsorted(start, offsets))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows that stay in one row, and each window's first word."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = w.row
    at = np.flatnonzero(row[:n] == row[size - 1 :])
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), np.uint64)
        for j in range(size):
            h = h * _BASE + w.hash[at + j]
    return mix(h), at
