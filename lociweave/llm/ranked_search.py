"""Ranked lexical search: term-at-a-time with a limited set of accumulators.

One pass over the documents turns each text into postings of the query terms (how often a term
occurs, how long the text is); corpus counts and document frequencies come from these. A second
pass scores blocks of postings: for every query the terms are taken rarest first, documents get an
accumulator when a term finds them, and once all remaining terms together cannot lift a document
from nothing to the k-th best partial score, no accumulators are created any more; those that
exist are still updated by every remaining term, so their scores are exact. The k-th best score of
the blocks before is carried along, which stops later blocks earlier. A block hands on its best k
of each query, and one ranking over these gives the result.

Score of a document with n terms for a query term found tf times in it and in df of N documents,
with L terms in all documents together:

    w = floor(1000 ln((2N + 2) / (2 df + 1)))        m = 75 + (25 n N) div L
    w * ((1000000000 tf) div (1000 tf + 12 m))

and the score of a query is the sum over its terms, repeats included.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lociweave.llm import text as tx
from lociweave.session import materialise

TOP = 20
#: Bytes of query texts that are searched for in one pass over the documents. A longer query is a pass of its own.
QUERY_BYTES = 2 << 20
#: Postings that are scored at a time (one longer document is one block).
BLOCK_POSTINGS = 1_000_000
#: Bytes of a text that are cut into terms at a time.
SLICE_BYTES = 4 << 20

#: ASCII letters and digits and everything beyond ASCII, on UTF-8 bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def terms(data: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z lower-cased, in lists of bounded size."""
    data, at = data or b"", 0
    while at < len(data):
        gap = GAP.search(data, min(len(data), at + SLICE_BYTES))
        end = gap.start() if gap else len(data)
        yield TERM.findall(data[at:end].translate(tx.LOWER_ASCII))
        at = end


@dataclass
class Queries:
    """A block of queries: their ids, the numbers of their terms and the terms' numbers."""

    ids: list
    vocabulary: dict[bytes, int]
    counts: list[dict[int, int]]

    @classmethod
    def of(cls, rows: list[tuple]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        counts = []
        for _, text in rows:
            found: Counter = Counter()
            for part in terms(text):
                found.update(part)
            counts.append({vocabulary.setdefault(t, len(vocabulary)): n for t, n in found.items()})
        return cls([i for i, _ in rows], vocabulary, counts)


def blocks_of(queries: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[Queries]:
    """The queries in blocks of at most ``limit`` bytes; the driver holds one block."""
    held, size = [], 0
    for r in queries.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).toLocalIterator():
        text = bytes(r["text"] or b"")
        if held and size + len(text) > limit:
            yield Queries.of(held)
            held, size = [], 0
        held.append((r["id"], text))
        size += len(text)
    if held:
        yield Queries.of(held)


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, length, terms, counts) of every document with a term: how many terms it has, and
    which numbers of the vocabulary occur how often."""
    names = ["doc_id", "length", "terms", "counts"]
    long, ints = T.LongType(), T.ArrayType(T.IntegerType())
    fields = [docs.schema[id_col].dataType, long, ints, T.ArrayType(long)]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, fields, strict=True)])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in tx.chunks(batches, "text"):
            kept, lengths, ends, which, often = [], [], [0], [], []
            for i, data in enumerate(batch.column("text").to_pylist()):
                length, found = 0, Counter()
                for part in terms(data):
                    length += len(part)
                    found.update(filter(None.__ne__, map(number, part)))
                if length:
                    kept.append(i)
                    lengths.append(length)
                    which.extend(found.keys())
                    often.extend(found.values())
                    ends.append(len(which))
            if kept:
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(kept)),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(which, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64())),
                    ],
                    names=names,
                )

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(run, schema)


class Accumulators:
    """The partial scores of one query over one block's documents, numbered from 0."""

    def __init__(self, size: int):
        self.score = np.zeros(size, np.int64)
        self.made = np.zeros(size, bool)
        self.open = True
        self.alive: np.ndarray | None = None

    def kth(self, k: int) -> int:
        """The k-th best partial score, 0 if there are fewer accumulators."""
        scores = self.score[self.made]
        return int(np.partition(scores, len(scores) - k)[-k]) if len(scores) >= k else 0

    def close(self) -> None:
        self.open, self.alive = False, np.flatnonzero(self.made)

    def add(self, docs: np.ndarray, gains: np.ndarray) -> None:
        """One term's postings, by ascending document. A document occurs once."""
        if self.open:
            self.score[docs] += gains
            self.made[docs] = True
            return
        if 8 * len(self.alive) < len(docs):  # few survivors look themselves up in a long list
            at = np.minimum(np.searchsorted(docs, self.alive), len(docs) - 1)
            hit = docs[at] == self.alive
            self.score[self.alive[hit]] += gains[at[hit]]
        else:
            hit = self.made[docs]
            self.score[docs[hit]] += gains[hit]


class Block:
    """Postings of some documents, by term, with the factor of each that does not depend on a query."""

    def __init__(self, lengths: np.ndarray, ends: np.ndarray, which: np.ndarray, often: np.ndarray, documents: int, all_terms: int):
        self.size = len(lengths)
        m = 75 + (25 * lengths * documents) // all_terms
        doc = np.repeat(np.arange(self.size), np.diff(ends))
        order = np.argsort(which, kind="stable")
        self.docs = doc[order]
        tf = often[order]
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs])
        self.terms, self.starts = np.unique(which[order], return_index=True)
        self.stops = np.append(self.starts[1:], len(order))
        self.most = np.maximum.reduceat(self.impact, self.starts) if len(order) else np.zeros(0, np.int64)
        self.place = {int(t): i for i, t in enumerate(self.terms)}

    def best(self, wanted: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best k, and their exact scores, all above 0.

        ``wanted`` are (term, weight) with the rarest first, the weight times its repeats.
        ``floor`` is a score that k documents of other blocks reach; documents below it are left out.
        """
        lists = [(self.place[t], w) for t, w in wanted if w and t in self.place]
        bounds = [w * int(self.most[i]) for i, w in lists]
        rest = sum(bounds)
        found = Accumulators(self.size)
        for (i, w), bound in zip(lists, bounds, strict=True):
            # only a score above rest is safe from a document that has no accumulator yet
            if found.open and rest < max(floor, found.kth(k)):
                found.close()
            if not found.open and not len(found.alive):
                break
            cut = slice(self.starts[i], self.stops[i])
            found.add(self.docs[cut], w * self.impact[cut])
            rest -= bound
        docs = np.flatnonzero(found.made)
        least = max(1, floor, found.kth(k))
        docs = docs[found.score[docs] >= least]
        return docs, found.score[docs]


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def scored(lists: DataFrame, queries: Queries, frequency: dict[int, int], documents: int, all_terms: int, id_type, k: int, block: int) -> DataFrame:
    """(query, doc_id, score): the best k of each query in each task."""
    plans = []
    for counts in queries.counts:
        rarest = sorted((frequency[t], t) for t in counts if t in frequency)
        plans.append([(t, counts[t] * weight(documents, df)) for df, t in rarest])
    shared = lists.sparkSession.sparkContext.broadcast(plans)
    schema = T.StructType([T.StructField("query", T.IntegerType()), lists.schema["doc_id"], T.StructField("score", T.LongType())])
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo = shared.value
        best: list[list[tuple]] = [[] for _ in todo]  # per query (score, no id, id), the best k so far, best first
        held, count = [], 0

        def solve(parts: list[pa.RecordBatch]) -> None:
            ids = [i for p in parts for i in p.column("doc_id").to_pylist()]
            lengths = np.concatenate([p.column("length").to_numpy() for p in parts])
            sizes = np.concatenate([np.diff(p.column("terms").offsets.to_numpy()) for p in parts])
            which, often = (np.concatenate([p.column(c).flatten().to_numpy() for p in parts]) for c in ("terms", "counts"))
            own = Block(lengths, np.append(0, np.cumsum(sizes)), which, often, documents, all_terms)
            for q, wanted in enumerate(todo):
                floor = best[q][k - 1][0] if len(best[q]) >= k else 0
                docs, scores = own.best(wanted, k, floor)
                if len(docs):
                    new = [(s, ids[d] is None, ids[d]) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)]
                    best[q] = sorted(best[q] + new, key=lambda e: (-e[0], e[1], 0 if e[1] else e[2]))[:k]

        for batch in batches:
            for part in pieces(batch):
                held.append(part)
                count += len(part.column("terms").flatten())
                if count >= block:
                    solve(held)
                    held, count = [], 0
        if held:
            solve(held)
        rows = [(q, e[2], e[0]) for q, found in enumerate(best) for e in found]
        if rows:
            q, ids, scores = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, arrow_id), pa.array(scores, pa.int64())], names=schema.names)

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        group = (batch.column("terms").offsets.to_numpy()[1:].astype(np.int64) - batch.column("terms").offsets.to_numpy()[0]) // block
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)

    return lists.mapInArrow(run, schema)


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    query_id: str = "item_id",
    doc_text: str = "text",
    query_text: str = "text",
    query_bytes: int = QUERY_BYTES,
    block: int = BLOCK_POSTINGS,
) -> DataFrame:
    """The ``k`` best documents of every query: query id, rank (from 1), document id, score.

    Only scores above 0 count; equal scores go by ascending document id, null ids last. A query
    without a term that occurs gives no rows; null and empty texts have no terms. Repeated rows are
    documents and queries of their own. An empty table gives no rows. Whole texts are read, long
    ones in slices. Queries come in blocks of ``query_bytes``, each a pass over the documents; a
    task holds one block of postings and k rows of each query of a block.
    """
    spark = docs.sparkSession
    kinds = docs.schema[doc_id], queries.schema[query_id]
    names = [query_id, "rank", doc_id, "score"]
    total = None
    for number, batch in enumerate(blocks_of(queries, query_id, query_text, query_bytes)):
        lists = materialise(postings(docs, batch.vocabulary, doc_id, doc_text), "postings")
        documents, all_terms = lists.agg(F.count(F.lit(1)), F.sum("length")).first()
        if not documents:
            continue
        # one number per term of this block of queries
        held = lists.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        frequency = {r["term"]: r["df"] for r in held.collect()}
        found = scored(lists, batch, frequency, documents, all_terms, kinds[0].dataType, k, block)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, q) for i, q in enumerate(batch.ids)], T.StructType([T.StructField("query", T.IntegerType()), T.StructField("id", kinds[1].dataType)]))
        rows = ranked.join(ids, "query").select(F.col("id").alias(names[0]), "rank", F.col("doc_id").alias(names[2]), "score")
        rows = materialise(rows, f"ranked{number}")
        total = rows if total is None else total.unionByName(rows)
    if total is None:
        fields = zip(names, (kinds[1].dataType, T.IntegerType(), kinds[0].dataType, T.LongType()), strict=True)
        return spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in fields]))
    return total
