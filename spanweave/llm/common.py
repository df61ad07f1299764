"""What the text operators share: columns, words and hashes that Spark and DuckDB compute alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = str(8 << 20)
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Python workers get BATCH_BYTES at once: with long texts Spark's default takes much memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def bits60(key: Column) -> Column:
    """A hash in 0..2^60-1 that other engines can compute: the first 15 digits of the MD5."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of sizes[0] numbers, then those of starts[1], and so on."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Remembered:
    """Strings and what find() makes of them: those asked for lately, at most twice most."""

    def __init__(self, find: Callable[[list[str]], list[bytes]], most: int):
        self.find, self.most = find, most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, strings: list[str]) -> list[bytes]:
        """What find() makes of strings, which are all different."""
        new = list(filterfalse(self.known.__contains__, strings))
        if len(self.known) + len(new) > self.most:
            self.older, self.known, new = self.known, {}, strings
        known, older = self.known, self.older
        if older:
            again = list(filter(older.__contains__, new))
            known.update(zip(again, map(older.__getitem__, again), strict=True))
            new = list(filterfalse(older.__contains__, new))
        known.update(zip(new, self.find(new), strict=True))
        return list(map(known.__getitem__, strings))


def chunks(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """texts in slices of some size bytes, or of one longer text."""
    chunk = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(texts)]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if high > low:
            yield texts.slice(low, high - low)


def _kinds() -> np.ndarray:
    """0: bytes of letters, namely those of ASCII and U+00C0 to U+023F; 1: other ASCII characters; 2: other bytes."""
    kinds = np.full(256, 2, np.uint8)
    kinds[:0x80] = 1
    for low, high in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0xC0), (0xC3, 0xC9)):
        kinds[low:high] = 0
    return kinds


_KINDS = _kinds()
LETTER_BYTES = np.flatnonzero(_KINDS == 0).tolist()


def cut_letters(words: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Of each word the letters that it begins with, the rest, and whether there are no such letters.

    They count only if an ASCII character that is no letter, or nothing, follows.  Letters are those of ASCII and U+00C0 to
    U+023F, without the signs of multiplication and division.
    """
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    starts, ends = bounds[:-1], bounds[1:]
    octets = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: ends[-1]]
    kinds = _KINDS[octets]
    sign = np.flatnonzero((octets[1:] == 0x97) | (octets[1:] == 0xB7))
    kinds[sign[octets[sign] == 0xC3]] = 2
    stops = np.flatnonzero(kinds)
    at = np.minimum(np.append(stops, len(octets))[np.searchsorted(stops, starts)], ends)
    at = np.where((at < ends) & (np.append(kinds, 1)[at] == 2), starts, at).astype(np.int32)
    both = np.append(np.stack([starts, at], 1).ravel(), ends[-1])
    halves = pa.StringArray.from_buffers(2 * len(words), pa.py_buffer(both), words.buffers()[2])
    cores, rests = halves.take(pa.array(np.arange(0, len(both) - 1, 2))), halves.take(pa.array(np.arange(1, len(both), 2)))
    return cores, rests, pa.array(at == starts)
