"""Words and their 64-bit hashes from UTF-8 bytes, vectorised over a block of texts.

A word class is a table of 256 booleans, one per byte; the classes here are exact on UTF-8, since
every byte of a character beyond ASCII is at least 0x80.  ``blocks`` cuts Arrow batches into pieces
of bounded bytes, so what a task holds does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that one block holds at most, unless a single text is longer.
BLOCK_BYTES = 2 << 20
#: Bytes whose hashes are computed at once.
HASH_BYTES = 1 << 18

_U = np.uint64
_RANDOM = np.random.default_rng(0x5EED)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

#: Words are whatever stands between space and the control characters tab to carriage return.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of digits, lower-case letters and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower case for A to Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 and so on, modulo 2**64."""
    out = np.full(max(n, 1), _U(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(_BASE, HASH_BYTES)
_INVERSES = powers(_BASE_INVERSE, HASH_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def spans(data: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of word bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = word[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span; ``starts`` ascend and spans do not overlap."""
    out = np.empty(len(starts), dtype=_U)
    at = 0
    while at < len(starts):
        first = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, first + HASH_BYTES, side="right")))
        piece = data[first : ends[stop - 1]]
        if len(piece) <= HASH_BYTES:
            up, down = _POWERS, _INVERSES
        else:  # one word alone is longer than a block
            up, down = powers(_BASE, len(piece)), _INVERSES
        total = np.zeros(len(piece) + 1, dtype=_U)
        np.cumsum(_BYTE_VALUE[piece] * up[: len(piece)], out=total[1:])
        lo, hi = starts[at:stop] - first, ends[at:stop] - first
        out[at:stop] = (total[hi] - total[lo]) * down[lo] + (hi - lo).astype(_U)
        at = stop
    return mix(out)


def joined(*words: np.ndarray) -> np.ndarray:
    """Hash of the words of each row, of which the n-th column holds the n-th."""
    out = np.zeros(len(words[0]), dtype=_U)
    for k, word in enumerate(words, 1):
        out = longer(out, word, k)
    return out


def longer(out: np.ndarray, word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the words of each row and a further one, the k-th."""
    return mix(out * _U(0xD6E8FEB86659FD93) + word + _U(k))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; shorter by n - 1 than ``words``."""
    if len(words) < n:
        return np.empty(0, dtype=_U)
    return joined(*(words[k : len(words) - n + 1 + k] for k in range(n)))


@dataclass
class Block:
    """Some texts, one after another with a line feed behind each, and their words."""

    rows: np.ndarray  # place of each text in the batch
    data: np.ndarray  # bytes
    starts: np.ndarray  # of words
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word; one more entry than texts

    def owners(self) -> np.ndarray:
        """The text, counted in the block, of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashed(self) -> np.ndarray:
        return hashes(self.data, self.starts, self.ends)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def block_of(texts: list[bytes], rows: np.ndarray, word: np.ndarray, lower: bool) -> Block:
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    if lower:
        data = LOWER[data]
    starts, ends = spans(data, word)
    edge = np.cumsum([0, *(len(x) + 1 for x in texts)])
    return Block(rows, data, starts, ends, np.searchsorted(starts, edge))


def blocks(texts: list[bytes], word: np.ndarray, lower: bool, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts in order, in blocks of at most ``most`` bytes or one text."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= most):
            size += len(texts[stop])
            stop += 1
        yield block_of(texts[at:stop], np.arange(at, stop), word, lower)
        at = stop


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and how many belong to each row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
