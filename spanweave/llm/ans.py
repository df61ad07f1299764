"""Range asymmetric numeral system with static frequencies, interleaved over lanes, in numpy.

A lane's state is a 64-bit number; coding a symbol of frequency f out of 2^PRECISION grows it by that factor, and 32-bit
words leave it before it overflows.  Ids go round the lanes, so that a step codes one id of every lane at once.  All lanes
share one stream of words.  At checkpoints the lanes' states, the place in the stream and the CRC-32 of the ids up to the
next one are noted: decoding can begin at each of them.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

PRECISION = 20
MOST_LANES = 2048
CHECK_STEPS = 256

_U = np.uint64
_LOW = _U(1 << 32)


class Frequencies:
    """Frequencies that sum to 2^PRECISION, at least one for every symbol that occurs."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.int64)
        used, total = int((counts > 0).sum()), 1 << PRECISION
        if used > total:
            raise ValueError("more symbols than frequencies")
        # One each, the rest in proportion; what rounding leaves goes to the most frequent.
        share = counts.astype(object) * (total - used) // max(int(counts.sum()), 1)
        self.freq = np.where(counts > 0, share.astype(np.int64) + 1, 0).astype(np.uint64)
        if used:
            self.freq[np.argmax(counts)] += _U(total - int(self.freq.sum()))
        self.start = np.cumsum(self.freq, dtype=np.uint64) - self.freq
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), self.freq.astype(np.int64))


class Block(NamedTuple):
    n: int
    lanes: int
    words: bytes  # 32-bit, little-endian
    states: bytes  # of every checkpoint, one after the other
    places: list[int]  # of every checkpoint in words
    crcs: list[int]


def encode(ids: np.ndarray, table: Frequencies) -> Block:
    n = len(ids)
    lanes = max(1, min(MOST_LANES, n // 64))
    steps = -(-n // lanes)
    state = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = []
    states: list[bytes] = []
    marks: list[int] = []
    for step in range(steps - 1, -1, -1):
        own = ids[step * lanes : (step + 1) * lanes]
        x, f = state[: len(own)], table.freq[own]
        full = (x >> _U(64 - PRECISION)) >= f
        words.append((x[full] & (_LOW - _U(1))).astype(np.uint32))
        x = np.where(full, x >> _U(32), x)
        high = x // f
        state[: len(own)] = (high << _U(PRECISION)) + (x - high * f) + table.start[own]
        if step % CHECK_STEPS == 0:
            states.append(state.tobytes())
            marks.append(len(words))
    sizes = np.cumsum([0] + [len(w) for w in words])
    segments = range(0, n, CHECK_STEPS * lanes)
    return Block(
        n,
        lanes,
        b"".join(w.tobytes() for w in reversed(words)),
        b"".join(reversed(states)),
        [int(sizes[-1] - sizes[m]) for m in reversed(marks)],
        [crc(ids[s : s + CHECK_STEPS * lanes]) for s in segments],
    )


def decode(block: Block, table: Frequencies, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids from checkpoint first up to checkpoint last, by default all.  Raises if a checksum fails."""
    words, lanes = np.frombuffer(block.words, np.uint32), block.lanes
    last = len(block.places) if last is None else last
    mask, out = _U((1 << PRECISION) - 1), []
    for check in range(first, last):
        state = np.frombuffer(block.states, np.uint64)[check * lanes : (check + 1) * lanes].copy()
        at, low = block.places[check], check * CHECK_STEPS * lanes
        high = min(block.n, low + CHECK_STEPS * lanes)
        ids = np.empty(high - low, np.uint32)
        for begin in range(0, high - low, lanes):
            x = state[: min(lanes, high - low - begin)]
            slot = x & mask
            own = table.symbol[slot.astype(np.int64)]
            ids[begin : begin + len(x)] = own
            x = table.freq[own] * (x >> _U(PRECISION)) + slot - table.start[own]
            empty = np.flatnonzero(x < _LOW)
            x[empty] = (x[empty] << _U(32)) | words[at : at + len(empty)]
            at += len(empty)
            state[: len(x)] = x
        if crc(ids) != block.crcs[check]:
            raise ValueError("checksum of a block does not match")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def crc(ids: np.ndarray, before: int = 0) -> int:
    """Unsigned CRC-32 of ids as little-endian 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes(), before)


def _times(matrix: list[int], vector: int) -> int:
    found = 0
    for row in matrix:
        if vector & 1:
            found ^= row
        vector >>= 1
    return found


def join_crcs(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings one after the other, from their CRCs and the size of the second."""
    bit = [0xEDB88320] + [1 << i for i in range(31)]  # appending one zero bit, as a matrix over two elements
    steps = size * 8
    while steps:
        if steps & 1:
            first = _times(bit, first)
        bit = [_times(bit, row) for row in bit]
        steps >>= 1
    return first ^ second
