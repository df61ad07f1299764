"""Words of many texts at once as 64-bit hashes, in numpy, inside the tasks.

A word's hash is the sum, modulo 2^64, of a value of each byte times a key of its place in the word, read off one running
sum over a chunk of texts.  Keys are drawn per place, so no pattern of bytes makes terms cancel, as patterns do in a
polynomial modulo 2^64 whatever its base.  Two given words share a hash with a chance of 2^-56 at most, most with one of
2^-62; among 10^8 distinct words any two do with a chance of about one in 500.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_U = np.uint64
SPACE = [0x20, *range(0x09, 0x0E)]
#: Classes of bytes: 0 parts, runs of one other class are tokens.
BY_SPACE = np.ones(256, np.uint8)
BY_SPACE[SPACE] = 0
#: Letters, digits and all of UTF-8 beyond ASCII apart from punctuation.
BY_KIND = np.full(256, 2, np.uint8)
BY_KIND[SPACE] = 0
BY_KIND[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_", *range(0x80, 0x100)]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_VALUE = LOWER.astype(np.uint64) + _U(1)


def scramble(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a hash over all of them."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _place_keys(n: int) -> np.ndarray:
    """Odd keys of the first n places of a word."""
    return scramble(scramble(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))) | _U(1)


_KEYS = _place_keys(1 << 12)


def token_hashes(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray = BY_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts data[bounds[i]:bounds[i + 1]], and where each text's tokens start (one more)."""
    first, n = int(bounds[0]), int(bounds[-1] - bounds[0])
    bounds = bounds - first
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    data = data[first : first + n]
    kind = kinds[data]
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[bounds[bounds < n]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], n)
    sizes = ends - starts
    places = np.arange(n, dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
    longest = int(sizes.max())
    keys = _KEYS if longest <= len(_KEYS) else _place_keys(longest)
    token = kind[starts] != 0
    starts, ends = starts[token], ends[token]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * keys[places], out=total[1:])
    return scramble(total[ends] - total[starts]), np.searchsorted(starts, bounds)


def text_chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, bounds) of a few texts at a time, all in order; null is empty.  A chunk has CHUNK_BYTES or is one text."""
    if not len(texts):
        return
    if not (pa.types.is_string(texts.type) or pa.types.is_binary(texts.type)):
        texts = texts.cast(pa.binary())
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_BYTES, side="right")) - 1)
        to = min(to, len(texts))
        yield data, bounds[at : to + 1]
        at = to


def windows(hashes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size tokens within a text, and where each text's runs start (one more)."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    runs = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        runs = runs * _U(0x2545F4914F6CDD1D) + hashes[j : n - size + 1 + j]
    counts = np.maximum(np.diff(starts) - (size - 1), 0)
    inside = np.ones(n, bool)
    for j in range(1, size):  # the last size - 1 tokens of a text start no run
        ends = starts[1:] - j
        inside[ends[(ends >= 0) & (ends >= starts[:-1])]] = False
    runs = runs[inside[: n - size + 1]]
    return scramble(runs), np.concatenate([[0], np.cumsum(counts)])
