"""Nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, so K centroids a half make K * K cells. A
query visits cells in the order of the sum of its two centroid distances, which a heap yields
without sorting all pairs, until the cells hold enough entries; the entries are reranked by
their exact distance.

How many entries are enough is measured: a bounded sample of the queries is answered by brute
force in one pass over the entries, and the number is set so that the cells of the sample hold
the wanted share of the true neighbours. Clustered vectors need few entries, vectors without
structure need many.

Equal vectors are one entry with their smallest ids, of which no more than the answer can hold
are kept; a vector that a third of all rows share costs one entry. A crowded cell is cut into
strips of entries that its queries visit one by one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that the centroids are fitted on (those with the smallest hashes) and rounds of k-means.
SAMPLE, ROUNDS = 20_000, 12
#: Share of the true neighbours that the visited cells should hold, the queries on which it is
#: measured (those with the smallest hashes), and the least number of entries to visit.
RECALL, PROBED, LEAST = 0.96, 100, 1_000
#: Entries a cell should hold on average, and the limits of centroids per half.
PER_CELL, FEWEST, MOST = 64, 4, 256
#: Entries of one cell that a task holds.
STRIP = 4_096


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spaced points; the same points give the same."""
    distinct = np.unique(points, axis=0)
    k = min(k, len(distinct))
    centres = distinct[np.random.default_rng(0).permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        near = nearest(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=k)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres."""
    flat = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
    return np.maximum(flat, 0)


def traversal(first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(cell, entries held so far) of the cells with entries, by the sum of first[i] and second[j].
    Cell: i * len(second) + j."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    width, held = len(b), 0
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * width + b[j]
        if sizes[cell]:
            held += int(sizes[cell])
            yield cell, held
        if j + 1 < width:
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):  # each pair is pushed once
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def visited(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells in the order of :func:`traversal` until they hold ``enough`` entries."""
    out = []
    for cell, held in traversal(first, second, sizes):
        out.append(cell)
        if held >= enough:
            break
    return out


def closest(probes: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probe, known, distance) of at least the ``k`` closest of every probe, ties with the last
    included. Distances are sums of squared differences, not their expanded form."""
    rough = nearest(probes, known)
    if rough.shape[1] > k:
        last = np.partition(rough, k - 1, axis=1)[:, k - 1]
        slack = 1e-9 * ((probes**2).sum(1) + (known**2).sum(1).max())
        i, j = np.nonzero(rough <= (last + slack)[:, None])
    else:
        i, j = (x.ravel() for x in np.indices(rough.shape))
    return i, j, np.sqrt(((probes[i] - known[j]) ** 2).sum(1))


class Best:
    """The ``k`` closest entries of every query that a task has met, over all its cells.

    Held until there are ``limit`` of them, so a task hands on a few rows per query and not a few
    per query and cell, in bounded memory.
    """

    def __init__(self, k: int, limit: int = 200_000):
        self.k, self.limit, self.parts, self.count = k, limit, [], 0

    def add(self, uids: np.ndarray, scores: np.ndarray, ids: pa.Array) -> None:
        self.parts.append((uids, scores, ids))
        self.count += len(uids)

    def _shrink(self) -> None:
        uids, scores = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        ids = pa.concat_arrays([p[2] for p in self.parts])
        smallest = pa.compute.list_element(ids, 0).to_numpy(zero_copy_only=False)
        order = np.lexsort((smallest, scores, uids))
        first = np.flatnonzero(np.r_[True, uids[order][1:] != uids[order][:-1]])
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        kept = order[rank < self.k]
        self.parts, self.count = [(uids[kept], scores[kept], ids.take(pa.array(kept)))], len(kept)

    def full(self) -> bool:
        """Whether there are too many to hold even when only the closest are kept."""
        if self.count < self.limit:
            return False
        self._shrink()
        return self.count >= self.limit // 2

    def take(self) -> pa.RecordBatch:
        if self.parts:
            self._shrink()
        empty = (np.zeros(0, np.int64), np.zeros(0), pa.array([], pa.list_(pa.int64())))
        uids, scores, ids = self.parts[0] if self.parts else empty
        self.parts, self.count = [], 0
        return pa.RecordBatch.from_arrays([pa.array(uids), pa.array(scores), ids], names=["uid", "score", "ids"])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)


def search(
    vectors: DataFrame,
    is_query: Column,
    materialise,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    recall: float = RECALL,
    sample: int = SAMPLE,
    strip: int = STRIP,
) -> DataFrame:
    """query_id, rank, ``id_col`` and score of the ``k`` nearest found of every query.

    Queries: rows where ``is_query`` holds; candidates: all rows but those with the query's id.
    Score: Euclidean distance in double precision of the vectors as given; ties go to the smaller
    id; ranks start at 1. If there are at most ``k`` candidates, all are found.

    Vectors that are null or zero, or hold null or non-finite components, take no part, nor do
    rows without an id or with another number of components than most rows have. Rows with equal
    id and vector count once; rows with equal ids and different vectors are candidates each. An
    empty table gives no rows. ``materialise`` writes a table and reads it back.
    """
    vector = F.transform(vector_col, lambda x: x + F.lit(0).cast("float"))  # -0.0 becomes 0.0
    rows = materialise(
        vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.col(id_col).alias("id"), vector.alias("vector"), is_query.alias("query"))
        .withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(1), "vector"), "dims": F.size("vector")}),
        "vectors",
    )
    common = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    dims = common["dims"]
    rows = rows.filter(F.col("dims") == dims)

    from pyspark.sql import Window

    in_order = Window.partitionBy("h", "g").orderBy("id")
    few = rows.groupBy("h", "g", "id").agg(F.first("vector").alias("vector"), F.max("query").alias("query"))
    first_ids = few.withColumn("n", F.row_number().over(in_order)).filter(F.col("n") <= k + 1)
    distinct = first_ids.groupBy("h", "g").agg(
        F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids")
    )
    asked = few.filter("query").select("h", "g").distinct().withColumn("asked", F.lit(True))
    distinct = materialise(distinct.join(asked, ["h", "g"], "left"), "entries")

    total = distinct.count()
    per_half = max(FEWEST, min(MOST, round(math.sqrt(total / PER_CELL))))
    picked = distinct.orderBy("h", "g").limit(sample).select("vector").toPandas()["vector"]
    points = np.stack([np.asarray(v, np.float64) for v in picked])
    half = max(1, dims // 2)
    books = [kmeans(points[:, :half], per_half), kmeans(points[:, half:], per_half) if dims > 1 else np.zeros((1, 0))]
    width = len(books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), dims)
            cell = nearest(x[:, :half], books[0]).argmin(1) * width + nearest(x[:, half:], books[1]).argmin(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), *(batch.column(c) for c in ("vector", "ids", "asked"))],
                names=["cell", "vector", "ids", "asked"],
            )

    layout = "cell long, vector array<float>, ids array<long>, asked boolean"
    placed = materialise(distinct.select("vector", "ids", "asked").mapInArrow(assign, layout), "cells")
    sizes = np.zeros(len(books[0]) * width, np.int64)
    for r in placed.groupBy("cell").count().collect():  # at most one row per cell
        sizes[r["cell"]] = r["count"]
    strips = np.maximum(1, -(-sizes // strip))

    # how many entries the cells of a query must hold, from a sample of queries
    some = placed.filter("asked").orderBy(F.xxhash64("vector"), "vector").limit(PROBED).select("vector").toPandas()["vector"]
    if not len(some):
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    asking = np.stack([np.asarray(v, np.float64) for v in some])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                i, j, gap = closest(asking, _matrix(batch.column("vector"), dims), k + 1)
                cell = batch.column("cell").to_numpy(zero_copy_only=False)[j]
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(cell), pa.array(gap)], names=["i", "cell", "gap"])

    nearest_of = Window.partitionBy("i").orderBy("gap", "cell")
    measured = (
        placed.select("cell", "vector")
        .mapInArrow(measure, "i long, cell long, gap double")
        .withColumn("n", F.row_number().over(nearest_of))
        .filter(F.col("n") <= k + 1)
        .collect()  # at most PROBED * (k + 1) rows
    )
    needed = []
    halves = nearest(asking[:, :half], books[0]), nearest(asking[:, half:], books[1])
    for i in range(len(asking)):
        held_at = dict(traversal(halves[0][i], halves[1][i], sizes))
        needed += [held_at[r["cell"]] for r in measured if r["i"] == i]
    entries = max(LEAST, int(np.quantile(needed, recall, method="higher")))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), dims)
            one, two = nearest(x[:, :half], books[0]), nearest(x[:, half:], books[1])
            for i in range(batch.num_rows):
                cells = visited(one[i], two[i], sizes, entries)
                taken = np.repeat(np.arange(len(cells)), strips[cells])
                at = np.concatenate([np.arange(strips[c]) for c in cells])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(cells)[taken]),
                        pa.array(at),
                        batch.column("ids").slice(i, 1).take(pa.array(np.zeros(len(at), np.int64))),
                        batch.column("vector").slice(i, 1).take(pa.array(np.zeros(len(at), np.int64))),
                    ],
                    names=["cell", "strip", "ids", "vector"],
                )

    probes = placed.filter("asked").select("vector", "ids").mapInArrow(
        probe, "cell long, strip long, ids array<long>, vector array<float>"
    )
    crowded = [(int(c), int(strips[c])) for c in np.flatnonzero(strips > 1)]  # at most one row per cell
    crowded = placed.sparkSession.createDataFrame(crowded, "cell long, strips int")
    own_strip = F.pmod(F.xxhash64("vector"), F.coalesce("strips", F.lit(1)))
    held = placed.join(F.broadcast(crowded), "cell", "left").select(
        "cell", own_strip.alias("strip"), "ids", "vector", F.lit(False).alias("probe")
    )
    both = held.union(probes.select("cell", "strip", "ids", "vector", F.lit(True).alias("probe")))
    # entries come first in their strip; its queries follow and are answered in blocks
    ordered = both.repartition("cell", "strip").sortWithinPartitions("cell", "strip", "probe")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, ids = None, [], []
        known = np.zeros((0, dims))
        best = Best(k + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, at, is_probe = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "strip", "probe"))
            x, names = _matrix(batch.column("vector"), dims), batch.column("ids")
            cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(at) != 0) | (np.diff(is_probe.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(cell)], strict=True):
                if (cell[a], at[a]) != key:
                    key, parts, ids = (cell[a], at[a]), [], []
                if not is_probe[a]:
                    parts.append(x[a:b])
                    ids.append(names.slice(a, b - a))
                    known = None
                    continue
                if known is None:
                    known, mine = np.concatenate(parts), pa.concat_arrays(ids)
                uids = np.array([v[0].as_py() for v in names.slice(a, b - a)])
                step = max(1, (4 << 20) // len(known))
                for c in range(a, b, step):
                    i, j, gap = closest(x[c : min(b, c + step)], known, k + 1)
                    best.add(uids[c - a + i], gap, mine.take(pa.array(j)))
                    if best.full():
                        yield best.take()
        yield best.take()

    near = ordered.mapInArrow(rerank, "uid long, score double, ids array<long>")
    by_score = Window.partitionBy("uid").orderBy("score", "id")
    answers = (
        near.select("uid", "score", F.explode("ids").alias("id"))
        .withColumn("n", F.row_number().over(by_score))
        .filter(F.col("n") <= k + 1)
        .groupBy("uid")
        .agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("found"))
    )
    uids = distinct.filter("asked").select("h", "g", F.col("ids")[0].alias("uid"))
    own = few.filter("query").select("id", "h", "g").join(uids, ["h", "g"]).join(answers, "uid")
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k)
    return own.select(F.col("id").alias("query_id"), F.posexplode(others).alias("place", "hit")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias(id_col),
        F.col("hit.score").alias("score"),
    )
