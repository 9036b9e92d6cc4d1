"""Small helpers on raw text that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Translation table that lower-cases A-Z and nothing else.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Bytes of text that a task turns into Python objects at a time (one longer text is one chunk).
CHUNK_BYTES = 4 << 20


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in ``column``; no row is lost or copied."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named by position (c0, c1 and so on), and the new name of each, so
    that a column that an operator adds cannot clash with one of the table."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names, strict=True))


def named_again(numbered: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names, without any that were added."""
    return numbered.select(*[F.col(f"c{i}") for i in range(len(docs.columns))]).toDF(*docs.columns)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered. Cleared when it holds ``limit`` words, which only costs time."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


#: An odd 64-bit multiplier for polynomial hashes; any odd number gives right results.
BASE = 0x9E3779B97F4A7C15


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` values (mod 2**64), at the run's first position."""
    total, covered, span, step = None, 0, values, 1
    whole = 1 << 64
    while True:
        if width & step:
            if total is None:
                total = span
            else:
                n = len(span) - covered
                total = total[: max(0, n)] + span[covered:] * np.uint64(pow(BASE, covered, whole))
            covered += step
        if step * 2 > width:
            return total[: max(0, len(values) - width + 1)]
        span = span[: max(0, len(span) - step)] + span[step:] * np.uint64(pow(BASE, step, whole))
        step *= 2


def scrambled(values: np.ndarray) -> np.ndarray:
    """A fixed bijection on 64-bit values that makes their order look random."""
    x = values ^ (values >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:]) if len(out) > span else out[:0]
        span *= 2
    rest = width - span
    if rest:
        out = np.minimum(out[:-rest], out[rest:]) if len(out) > rest else out[:0]
    return out
