"""Word hashing over whole Arrow batches: numpy passes over the text bytes, no loop per word.

A word is a run of bytes that the separator table leaves standing. Non-ASCII bytes never separate,
so working on UTF-8 bytes gives the same words as working on characters.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Everything in ASCII but digits and small letters, for the words of lower-cased texts.
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Drawn by the driver and sent with the functions, so all tasks of a run share it.
_KEYS = tuple(np.uint64(secrets.randbits(64)) for _ in range(4))
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Texts are hashed in pieces of about so many bytes; one text is never cut.
PIECE_BYTES = 1 << 20


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    edge = np.ones(len(data) + 2, dtype=bool)
    edge[1:-1] = table[data]
    flips = np.flatnonzero(edge[1:] != edge[:-1])
    return flips[0::2], flips[1::2]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """One 64-bit hash per span: eight bytes at a time, each mixed in with a key that only this run knows.

    Mixing between the blocks leaves no algebra by which different spans could be made to meet. ``lane`` 0 and 1 are independent.
    """
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    blocks = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    sizes = ends - starts
    value = mix(sizes.astype(np.uint64) * _BASE + _KEYS[2 * lane])
    left, at, rest = None, starts, sizes
    while len(rest):
        block = blocks[at] & _MASKS[np.minimum(rest, 8)]
        own = value if left is None else value[left]
        own = mix((own ^ block) * _BASE + _KEYS[2 * lane + 1])
        if left is None:
            value = own
        else:
            value[left] = own
        more = np.flatnonzero(rest > 8)
        left = more if left is None else left[more]
        at, rest = at[more] + 8, rest[more] - 8
    return value


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` consecutive words from each position; shorter by size - 1.

    Windows of a power of two of words are doubled, and those that make up ``size`` are joined, with a mix at every step.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    part, span, out, done = hashes, 1, None, 0
    while True:
        if size & span:
            out = part[:n] if out is None else mix(out * _BASE + part[done : done + n])
            done += span
        if done == size:
            return mix(out + np.uint64(size))
        part, span = mix(part[:-span] * _BASE + part[span:]), 2 * span


def text_pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about PIECE_BYTES of text: first row, end row, bytes, offsets. A null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(at, at[row] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def hashed_rows(column: pa.Array, table: np.ndarray, lower: bool = False, lanes: int = 1) -> Iterator[tuple]:
    """For each piece: its first row, word hashes of all rows in each lane, and where each row's words begin.

    The words of row ``first + i`` are ``hashes[at[i]:at[i + 1]]``. Rows are kept apart by a separator.
    """
    lowered = np.frombuffer(LOWER, dtype=np.uint8)
    for first, end, data, offsets in text_pieces(column):
        n = end - first
        space = int(np.flatnonzero(table)[0])
        # A separator after each row, so that no word runs from one row into the next.
        apart = np.full(len(data) + n, space, dtype=np.uint8)
        lengths = np.diff(offsets)
        keep = np.ones(len(apart), dtype=bool)
        keep[offsets[1:] + np.arange(n)] = False
        apart[keep] = lowered[data] if lower else data
        starts, ends = word_bounds(apart, table)
        at = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths + 1)]))
        yield first, *[hash_spans(apart, starts, ends, lane) for lane in range(lanes)], at
