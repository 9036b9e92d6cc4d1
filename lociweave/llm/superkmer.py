"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``k`` consecutive words of one document. Its minimiser is the smallest hash among
its runs of ``m`` words, so equal windows have equal minimisers. Consecutive windows with one
minimiser form a super-k-mer: one string of words instead of one per window. It travels to the
bucket of its minimiser, where the windows are sorted by hash, equal hashes are compared word for
word, and all but the earliest window of a kind are marked.

Before travelling, equal super-k-mers of a task are collapsed: only the earliest travels and the
others are marked at once, since each of their windows starts earlier in the one that stays. A
passage that thousands of documents share reaches its bucket once per chunk of text at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx

WINDOW = 20
MINIMISER = 3
#: Buckets per input partition: one bucket is what a task holds at a time.
BUCKETS_PER_PARTITION = 6
#: Bytes of text that a task cuts at a time, and how hard it squeezes what it sends.
CHUNK_BYTES, SQUEEZE = 4 << 20, 6
#: A document is named by its id (nulls last) and 32 bits of a hash of its text, which tell rows
#: with equal ids apart.
DOC = ["no_id", "doc", "text_key"]


def _runs(flags_end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs, given the positions after which a run ends."""
    return np.concatenate([[0], flags_end + 1]).astype(np.int64), np.concatenate([flags_end + 1, [n]]).astype(np.int64)


def _intervals(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window intervals of documents, merged where they touch."""
    if not len(doc):
        return doc, start, count
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + count)[order]
    cuts = np.flatnonzero((doc[1:] != doc[:-1]) | (start[1:] > end[:-1]))
    a, b = _runs(cuts, len(doc))
    return doc[a], start[a], end[b - 1] - start[a]


class SuperKmers:
    """Super-k-mers of a chunk of documents, as parallel arrays and slices of one string."""

    def __init__(self, texts: list[bytes], k: int, m: int, hashes: tx.WordHashes):
        words: list[bytes] = []
        sizes = []
        for t in texts:
            own = t.split()
            if len(own) >= k:
                words += own
                sizes.append(len(own))
            else:
                sizes.append(0)
        sizes = np.array(sizes, dtype=np.int64)
        self.joined = b" ".join(words)
        self.offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
        base = np.concatenate([[0], np.cumsum(sizes)])
        if not words:
            self.doc = self.first = self.count = self.begin = self.minimum = np.zeros(0, np.int64)
            return
        low = tx.sliding_min(tx.scrambled(tx.rolling(hashes.of(words), m)), k - m + 1)
        # windows that lie in one document, and the document of each
        owner = np.repeat(np.arange(len(texts)), sizes)
        window = np.arange(len(low))
        inside = owner[window] == owner[window + k - 1]
        window, owner, low = window[inside], owner[: len(low)][inside], low[inside]
        a, b = _runs(np.flatnonzero((low[1:] != low[:-1]) | (owner[1:] != owner[:-1])), len(low))
        self.doc, self.count, self.minimum = owner[a], b - a, low[a]
        self.begin = window[a]
        self.first = self.begin - base[self.doc]
        self.stop = self.begin + self.count + k - 1

    def strings(self) -> list[bytes]:
        joined = self.joined
        return [
            joined[a:b]
            for a, b in zip(self.offset[self.begin].tolist(), (self.offset[self.stop] - 1).tolist(), strict=True)
        ] if len(self.doc) else []


def _pack(columns: list[np.ndarray], strings: list[bytes]) -> bytes:
    """Columns DOC, first window and count of super-k-mers, each in as few bytes per value as the
    largest needs, and the strings."""
    parts = [np.array([len(strings)], dtype=np.int64).tobytes()]
    for c in columns:
        kind = np.min_scalar_type(int(c.max())) if c.min() >= 0 else np.dtype(np.int64)
        parts += [kind.str[1:].encode(), c.astype(kind).tobytes()]
    return b"".join([*parts, b" ".join(strings)])


def _unpack(data: bytes) -> tuple[np.ndarray, bytes]:
    n, at, columns = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for _ in range(len(DOC) + 2):
        kind = np.dtype(data[at : at + 2].decode())
        columns.append(np.frombuffer(data, kind, n, at + 2).astype(np.int64))
        at += 2 + n * kind.itemsize
    return np.stack(columns), data[at:]


def repeated_windows(docs: DataFrame, k: int = WINDOW, m: int = MINIMISER, buckets: int | None = None) -> DataFrame:
    """Windows that also start earlier, as intervals (no_id, doc, text_key, start, windows).

    ``docs`` has the columns DOC and ``text`` (binary). Earlier: by DOC, then by start.
    """
    if buckets is None:
        buckets = BUCKETS_PER_PARTITION * max(8, docs.rdd.getNumPartitions())
    schema = T.StructType(
        [T.StructField("bucket", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in [*DOC, "start", "windows"]]
        + [T.StructField("packed", T.BinaryType())]
    )
    names = schema.names

    def rows(columns: list[np.ndarray]) -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.array(c.astype(np.int64)) for c in columns] + [pa.nulls(n, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, squeeze = tx.WordHashes(), zstandard.ZstdCompressor(level=SQUEEZE)
        for batch in tx.chunks(batches, "text", CHUNK_BYTES):
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in DOC])
            # chunk documents in their order, so that an earlier index is an earlier document;
            # repeated rows get one index
            order = np.lexsort(keys[::-1])
            same = np.r_[False, (keys[:, order[1:]] == keys[:, order[:-1]]).all(0)]
            order = order[~same]
            keys = keys[:, order]
            texts = batch.column("text")
            found = SuperKmers([texts[int(i)].as_py() or b"" for i in order], k, m, hashes)
            strings = found.strings()
            earliest: dict[bytes, int] = {}
            stays = np.fromiter((earliest.setdefault(s, i) == i for i, s in enumerate(strings)), bool, len(strings))
            doc, start, windows = _intervals(found.doc[~stays], found.first[~stays], found.count[~stays])
            if len(doc):  # marks go along under a bucket of their own
                spread = tx.scrambled(keys[1, doc].view(np.uint64)) >> np.uint64(48)
                yield rows([-1 - spread.astype(np.int64), *keys[:, doc], start, windows])
            kept = np.flatnonzero(stays)
            bucket = (found.minimum[kept].astype(np.uint64) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            kept, bucket = kept[by], bucket[by]
            out, ids = [], []
            a, b = _runs(np.flatnonzero(np.diff(bucket)), len(kept)) if len(kept) else ([], [])
            for i, j in zip(a, b, strict=True):
                mine = kept[i:j]
                columns = [keys[c, found.doc[mine]] for c in range(len(DOC))]
                columns += [found.first[mine], found.count[mine]]
                body = _pack(columns, [strings[x] for x in mine.tolist()])
                out.append(squeeze.compress(body))
                ids.append(int(bucket[i]))
            if out:
                n = len(out)
                arrays = [pa.array(ids, pa.int64())] + [pa.nulls(n, pa.int64())] * (len(DOC) + 2) + [pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    def count(bodies: list[bytes], hashes: tx.WordHashes) -> list[np.ndarray]:
        """Marks of one bucket: the columns DOC, start, windows."""
        parts = [_unpack(b) for b in bodies]
        table = np.concatenate([t for t, _ in parts], axis=1)
        joined = b" ".join(s for _, s in parts)
        words = joined.split(b" ")
        windows = table[-1]
        offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
        whole = tx.rolling(hashes.of(words), k)
        del words
        super_start = np.concatenate([[0], np.cumsum(windows + k - 1)])[:-1]
        owner = np.repeat(np.arange(len(windows)), windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        place = super_start[owner] + within
        value = whole[place]
        order = np.argsort(value)
        ordered = value[order]
        tied = np.zeros(len(ordered), bool)
        equal = ordered[1:] == ordered[:-1]
        tied[1:] |= equal
        tied[:-1] |= equal
        some = order[tied]
        if not len(some):
            return [np.zeros(0, np.int64)] * (len(DOC) + 2)
        start = table[-2][owner[some]] + within[some]
        doc = [table[c][owner[some]] for c in range(len(DOC))]
        by = np.lexsort((start, *doc[::-1], value[some]))
        some, start, doc = some[by], start[by], [c[by] for c in doc]
        head = np.r_[True, value[some][1:] != value[some][:-1]]
        lead = np.maximum.accumulate(np.where(head, np.arange(len(some)), 0))
        begins, ends = offset[place[some]], offset[place[some] + k] - 1
        at, to = begins.tolist(), ends.tolist()
        repeat = np.fromiter(
            (i != j and joined[at[i] : to[i]] == joined[at[j] : to[j]] for i, j in enumerate(lead.tolist())), bool, len(some)
        )
        odd = np.flatnonzero(~repeat & ~head)
        if len(odd):  # different windows under one hash: compare these groups by their words
            for j in np.unique(lead[odd]).tolist():
                known: set[bytes] = set()
                for i in np.flatnonzero(lead == j).tolist():
                    words_of = joined[at[i] : to[i]]
                    repeat[i] = words_of in known
                    known.add(words_of)
        # one super-k-mer or its repeated row is not earlier than itself
        self_row = np.ones(len(some), bool)
        for c in [*doc, start]:
            self_row &= c == c[lead]
        repeat &= ~self_row
        marked = [c[repeat] for c in doc]
        names_, index = np.unique(np.stack(marked), axis=1, return_inverse=True) if repeat.any() else (np.zeros((len(DOC), 0), np.int64), np.zeros(0, np.int64))
        doc_i, begin, n = _intervals(index.reshape(-1), start[repeat], np.ones(int(repeat.sum()), np.int64))
        return [*(names_[:, doc_i]), begin, n]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, expand = tx.WordHashes(), zstandard.ZstdDecompressor()
        current, held = None, []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
            ready = batch.filter(pa.array(bucket < 0)).select(names[1:-1])
            if ready.num_rows:
                yield ready
            packed = batch.column("packed")
            for i in np.flatnonzero(bucket >= 0).tolist():
                if bucket[i] != current:
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in count(held, hashes)], names=names[1:-1])
                    current, held = bucket[i], []
                held.append(expand.decompress(packed[i].as_py()))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in count(held, hashes)], names=names[1:-1])

    moved = docs.mapInArrow(cut, schema).repartition("bucket").sortWithinPartitions("bucket")
    return moved.mapInArrow(mark, T.StructType(schema.fields[1:-1]))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns DOC (all long) and ``text`` in bytes."""
    return docs.select(
        F.col(id_col).isNull().cast("long").alias("no_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(F.col(text_col)).bitwiseAND(0xFFFFFFFF).alias("text_key"),
        F.col(text_col).cast("binary").alias("text"),
        *[F.col(c).alias(f"_row_{i}") for i, c in enumerate(docs.columns)],
    )


def _covered(spans: list[dict] | None, n: int, k: int) -> np.ndarray | None:
    """Which of n words a repeated window covers; None if no span is given."""
    if not spans:
        return None
    change = np.zeros(n + 1, dtype=np.int64)
    for s in spans:
        change[s["start"]] += 1
        change[s["start"] + s["windows"] + k - 1] -= 1
    return np.cumsum(change[:n]) > 0


def _with_spans(docs: DataFrame, id_col: str, text_col: str, k: int, m: int, buckets: int | None) -> DataFrame:
    named = _named(docs, id_col, text_col)
    spans = (
        repeated_windows(named.select(*DOC, "text"), k, m, buckets)
        .groupBy(*DOC)
        .agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    )
    return named.join(spans, DOC, "left")


def removal_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = WINDOW,
    m: int = MINIMISER,
    buckets: int | None = None,
) -> DataFrame:
    """Id, n_words, n_removed and kept_sha256 of every row.

    Words are runs of bytes other than ASCII white space. A word goes if a window over it also
    starts in a document with a smaller id, or earlier in its own document; windows are judged
    on the input. Null text: no words. Documents with a null id come after all others. Rows with
    equal id and text count as one document, listed as often as they appear; rows with equal ids
    and different texts are ordered by a hash of the text. An empty table gives no rows.
    """
    with_spans = _with_spans(docs.select(id_col, text_col), id_col, text_col, k, m, buckets)
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "text"):
            total, removed, digests = [], [], []
            for data, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = (data or b"").split()
                gone = _covered(spans, len(words), k)
                kept = words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                total.append(len(words))
                removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row_0"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=schema.names,
            )

    return with_spans.select("_row_0", "text", "spans").mapInArrow(run, schema)


#: What stands between two words, as in ``bytes.split``.
SPACE = b" \t\n\r\x0b\x0c"


def without_words(data: bytes, gone: np.ndarray) -> bytes:
    """``data`` without the marked words. Kept words keep the white space before them."""
    out, at = [], 0
    for word, drop in zip(data.split(), gone.tolist(), strict=True):
        begin = data.index(word, at)
        end = begin + len(word)
        if not drop:
            out.append(data[at:end])
        at = end
    tail = data[at:]
    return (b"".join(out) + tail).strip(SPACE)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = WINDOW,
    m: int = MINIMISER,
    buckets: int | None = None,
) -> DataFrame:
    """``docs`` with repeated windows cut out of the texts, all other columns as they were.

    A text without repeats is unchanged. Nulls, repeated rows and the order of documents: as in
    :func:`removal_report`. A text of which nothing is left is empty; the row stays.
    """
    with_spans = _with_spans(docs, id_col, text_col, k, m, buckets)
    schema = T.StructType([T.StructField("kept", T.StringType())] + [
        T.StructField(f"_row_{i}", f.dataType) for i, f in enumerate(docs.schema.fields)
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "text"):
            kept = []
            for data, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if data is None:
                    kept.append(None)
                    continue
                gone = _covered(spans, len(data.split()), k)
                kept.append((data if gone is None else without_words(data, gone)).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.string()), *(batch.column(c) for c in schema.names[1:])], names=schema.names
            )

    cut = with_spans.select("text", "spans", *schema.names[1:]).mapInArrow(run, schema)
    return cut.select(
        *[(F.col("kept") if c == text_col else F.col(f"_row_{i}")).alias(c) for i, c in enumerate(docs.columns)]
    )
