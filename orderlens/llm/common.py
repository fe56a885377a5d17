"""Helpers that several operators share: tables of a folder, Arrow batches in slices, words as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SLICE_BYTES = 2 << 20  # text that one vectorised step holds; a single longer text is a slice of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def row_key(*columns: str) -> Column:
    """A hash that spreads rows over blocks, equal only for rows equal in ``columns``."""
    return F.xxhash64(*columns)


def text_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of Arrow batches with the UTF-8 bytes of ``column`` and the rows' offsets into them.

    A null text has no bytes. Whole rows only, ``SLICE_BYTES`` at most unless one text is longer.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        _, places, data = texts.buffers()
        ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(texts):
            stop = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, "right")) - 1
            stop = min(max(stop, start + 1), len(texts))
            yield batch.slice(start, stop - start), data[ends[start] : ends[stop]], ends[start : stop + 1] - ends[start]
            start = stop


def _byte_table(separators: list[tuple[int, int]]) -> np.ndarray:
    word = np.ones(256, bool)
    for low, high in separators:
        word[low : high + 1] = False
    return word


#: Bytes of words: all but white space; digits, letters and non-ASCII characters.
SPACED = _byte_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _byte_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE_HASH = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MUL1, _MUL2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MUL1
    x = x ^ (x >> np.uint64(27))
    x = x * _MUL2
    return x ^ (x >> np.uint64(31))


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of the odd step of the hash, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 64) * 2 - 1, _STEP)]))
    return _powers[:n]


class Words:
    """The words of a slice: byte places, 64-bit hashes, and each row's first word.

    ``first[r]`` to ``first[r + 1]`` are the words of row r. A word never crosses rows.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.data = FOLD[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = kind[data]
        inside = inside.view(bool)
        begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        begins[cut] |= inside[1:-1][cut]
        stops[cut - 1] |= inside[1:-1][cut - 1]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.stop - self.start
        where = np.repeat(self.start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        place = where - np.repeat(self.start, size)
        value = _BYTE_HASH[self.data[where]] * powers(int(size.max()))[place]
        return mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))

    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def grams(hashes: np.ndarray, k: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hashes of ``k`` consecutive words, at every start that has k words from it on or at ``starts`` only."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n if starts is None else len(starts), np.uint64)
    for i in range(k):
        out = out * _STEP + (hashes[i : i + n] if starts is None else hashes[starts + i])
    return mix(out + np.uint64(k))
