"""Harmonic packing of tokenised documents into fixed-length sequences.

A piece of length n belongs to class k = capacity // n, so that k pieces of class k always fit
in one sequence. Every sequence of class k takes exactly k pieces and nothing else; a task
therefore needs to know only its own open sequences, one per class, and no two tasks have to
talk to each other. Nothing is shuffled.

Documents may be cut, so :func:`cut` takes lengths at which the classes have no waste: full
capacities first, then the powers of two in the remainder, largest first. k pieces of
capacity / k fill a sequence to the last place. What a task has left of a class when its input
ends is closed in groups of a power of two, so these shorter sequences need no padding either
where a length that is a power of two is allowed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx
from lociweave.llm import tokenizer

CAPACITY = 2048
END_ID = 1


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document: whole capacities, then descending powers of two."""
    whole, rest = divmod(length, capacity)
    return [capacity] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


class HarmonicBins:
    """One worker's open sequences. ``add`` and ``close`` return finished sequences as
    (sequence id, pieces); a piece is a tuple whose first value is its length."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}

    def _finish(self, pieces: list[tuple]) -> tuple[int, list[tuple]]:
        self.next_id += 1
        return self.next_id - 1, pieces

    def add(self, piece: tuple) -> tuple[int, list[tuple]] | None:
        size = self.capacity // piece[0]
        held = self.open.setdefault(size, [])
        held.append(piece)
        return self._finish(self.open.pop(size)) if len(held) == size else None

    def close(self) -> Iterator[tuple[int, list[tuple]]]:
        for size in sorted(self.open):
            held = self.open[size]
            while held:
                take = 1 << (len(held).bit_length() - 1)
                yield self._finish(held[:take])
                held = held[take:]
        self.open.clear()


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: id, start, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    A document's ids are those of the tokenizer file for its whole text, without added special
    tokens, followed by ``end_id``. ``sequence_id`` holds the task in its high bits and a
    counter in its low 33; a task that runs again reads the same rows in the same order and
    gives the same numbers.

    Null text: empty, so one piece with the end id alone. A null id is kept. Repeated rows are
    packed as often as they appear. An empty table gives no rows. Very long texts are tokenised
    whole, one at a time. A task holds at most 2 * capacity pieces that wait for a full sequence.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("start", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokenizer.encoder(tokenizer_path)
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 33)
        rows: list[tuple] = []

        def place(finished) -> None:
            if finished:
                sequence, pieces = finished
                offset = 0
                for size, doc, start, ids, total in pieces:
                    rows.append((doc, start, ids, total, sequence, offset))
                    offset += size

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            rows.clear()
            kinds = [id_arrow, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names
            )

        id_arrow = None
        for batch in tx.chunks(batches, "text"):
            id_arrow = batch.column("id").type
            docs_in = batch.column("id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, ids in zip(docs_in, encode(texts), strict=True):
                ids.append(end_id)
                data, at = np.array(ids, dtype="<u4").tobytes(), 0
                for size in cut(len(ids), capacity):
                    place(bins.add((size, doc, at, data[4 * at : 4 * (at + size)], len(ids))))
                    at += size
            if len(rows) >= 5_000:
                yield flush()
        for finished in bins.close():
            place(finished)
        if rows:
            yield flush()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
