"""SimHash fingerprints, linked with BK-trees.

Equal fingerprints are collapsed first. Two fingerprints that differ in at most ``radius`` bits
agree on at least ``bands - radius`` of ``bands`` bit bands, so every pair of linked fingerprints
meets under one of the band choices. A choice with its bits names a *shard*; a shard's
fingerprints become a BK-tree, whose children are keyed by their integer Hamming distance to the
parent, and a search follows only edges within the radius of the distance just measured.

A shard larger than ``shard_size`` is cut into strips. Each strip's tree is sent to every strip
of that shard, one task each, so a crowded shard spreads over tasks and no tree grows beyond the
limit. A tree hands on a minimum spanning forest of the links it finds, closest pairs first, not
all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx
from lociweave.llm.graph import star_components
from lociweave.session import materialise

SEED = 42
RADIUS = 2
BANDS = 4
SHARD_SIZE = 4096
#: Shingles whose bits are counted at a time.
BLOCK = 1024
#: Rows of complete shards that a task solves at a time, and nodes that its probes may meet at once.
AT_ONCE, VISITS = 50_000, 2_000_000


def fingerprint(words: list[bytes], shingle: int) -> int:
    """64 bits; a bit is 1 if set in over half of the shingles' XXH64. No words: 0."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    size = min(shingle, len(words))
    total, n = np.zeros(64, dtype=np.int64), len(words) - size + 1
    for at in range(0, n, 64 * BLOCK):
        to = min(n, at + 64 * BLOCK)
        cut = zip(starts[at:to].tolist(), (ends[at + size - 1 : to + size - 1] - 1).tolist(), strict=True)
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cut], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Id and ``fingerprint`` (the 64 bits as a signed long) of every row.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; shingles are runs of
    ``shingle`` words, repeats included; fewer words make one shingle. Null text: empty, 0.
    """
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fingerprint", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "text"):
            marks = [
                fingerprint((t or b"").translate(tx.LOWER_ASCII).split(), shingle)
                for t in batch.column("text").to_pylist()
            ]
            bits = pa.array(np.array(marks, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), bits], names=schema.names)

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(run, schema)


class BKTrees:
    """The BK-trees of many shards, in flat arrays.

    Node i stands for ``values[i]``. ``roots[i]`` is the root of its tree, the tree's first node in
    ``nodes``. A child is keyed by parent and Hamming distance; the trees grow level by level, all
    at once, to what inserting their nodes in order gives.
    """

    WIDTH = 65

    def __init__(self, values: np.ndarray, nodes: np.ndarray, roots: np.ndarray):
        self.values = values
        waiting, at = nodes[nodes != roots[nodes]], roots[nodes[nodes != roots[nodes]]]
        keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(waiting):
            own = at * self.WIDTH + np.bitwise_count(values[waiting] ^ values[at])
            edges, first, edge = np.unique(own, return_index=True, return_inverse=True)
            keys.append(edges)
            children.append(waiting[first])
            below = np.ones(len(waiting), bool)  # all but the first of an edge go on below it
            below[first] = False
            waiting, at = waiting[below], waiting[first][edge][below]
        order = np.argsort(np.concatenate(keys))
        self.keys, self.children = np.concatenate(keys)[order], np.concatenate(children)[order]

    def _below(self, node: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Child of each node at each distance, or -1."""
        key = node * self.WIDTH + distance
        place = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        if not len(self.keys):
            return np.full(len(key), -1)
        return np.where((self.keys[place] == key) & (distance >= 0) & (distance < self.WIDTH), self.children[place], -1)

    def search(self, probes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(probe, node, distance) of all pairs within ``radius``. Each probe, a place in
        ``values``, walks the tree whose root is in ``starts`` and has ``sizes`` nodes; as many
        walk at a time as meet at most ``VISITS`` nodes."""
        block = np.cumsum(sizes) // VISITS
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(probes)], strict=True):
            probe, node = probes[a:b], starts[a:b]
            while len(probe):
                distance = np.bitwise_count(self.values[probe] ^ self.values[node]).astype(np.int64)
                near = distance <= radius
                if near.any():
                    yield probe[near], node[near], distance[near].astype(np.int8)
                ahead = []
                for d in range(-radius, radius + 1):
                    below = self._below(node, distance + d)
                    ahead.append((probe[below >= 0], below[below >= 0]))
                probe = np.concatenate([p for p, _ in ahead])
                node = np.concatenate([n for _, n in ahead])


def joined_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (index of the smallest member) after also linking a[i] with b[i]."""
    while True:
        low = np.minimum(labels[a], labels[b])
        if np.array_equal(low, labels[a]) and np.array_equal(low, labels[b]):
            return labels
        for end in (a, b):
            np.minimum.at(labels, labels[end], low)
            np.minimum.at(labels, end, low)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]


def _spanning(links: list[tuple[np.ndarray, ...]], size: int, radius: int) -> tuple[np.ndarray, ...]:
    """A minimum spanning forest of links (a, b, distance) between ``size`` places."""
    a, b, apart = (np.concatenate(c) for c in zip(*links, strict=True))
    labels = np.arange(size)
    kept = [np.zeros(0, np.int64)]
    for d in range(radius + 1):
        left = np.flatnonzero(apart == d)
        while len(left):
            one, two = labels[a[left]], labels[b[left]]
            left, top = left[one != two], np.maximum(one, two)[one != two]
            if not len(left):
                break
            # one link for each component that has a smaller neighbour; these cannot close a circle
            chosen = left[np.unique(top, return_index=True)[1]]
            kept.append(chosen)
            labels = joined_labels(labels, a[chosen], b[chosen])
    edges = np.concatenate(kept)
    return a[edges], b[edges], apart[edges]


def _forest(cell: np.ndarray, mark: np.ndarray, probe: np.ndarray, alone: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum spanning forests, by Hamming distance, of the links in each of many cells.

    Rows are sorted by cell. In a cell of one strip (``alone``) all rows are tree and probes; in one
    of two strips the rows marked ``probe`` walk the tree of the others.
    """
    group = np.cumsum(np.r_[False, cell[1:] != cell[:-1]])
    nodes = np.flatnonzero(~probe)
    with_tree, first = np.unique(group[nodes], return_index=True)
    root = np.full(group[-1] + 1, -1)
    root[with_tree] = nodes[first]
    size = np.bincount(group[nodes], minlength=len(root))
    roots = root[group]
    walkers = np.flatnonzero((alone | probe) & (roots >= 0) & (size[group] + probe > 1))
    forest = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8))
    hits, count = [forest], 0
    for a, b, distance in BKTrees(mark, nodes, roots).search(walkers, roots[walkers], size[group[walkers]], radius):
        new = (a > b) | probe[a]  # in one strip each pair is met from both ends
        hits.append((a[new], b[new], distance[new]))
        count += len(hits[-1][0])
        if count > VISITS:  # the forest of a part holds all that the forest of the whole takes from it
            hits, count = [_spanning(hits, len(mark), radius)], 0
    a, b, _ = _spanning(hits, len(mark), radius)
    return mark[a], mark[b]


def links(
    distinct: DataFrame,
    radius: int = RADIUS,
    bands: int = BANDS,
    kept_bands: int | None = None,
    shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """Edges (u, v) between distinct fingerprints within ``radius`` of each other.

    ``distinct`` has one column ``fingerprint`` without repeats. A shard keeps ``kept_bands`` of
    the ``bands``. With the default, bands - radius, the closure of the edges links all pairs
    within the radius. A larger number makes shards smaller and may miss distant pairs.
    """
    if kept_bands is None:
        kept_bands = bands - radius
    if not 1 <= kept_bands <= bands <= 64:
        raise ValueError("1 <= kept_bands <= bands <= 64")
    edges_of = [64 * i // bands for i in range(bands + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges_of, edges_of[1:])]  # noqa: B905
    shards = []
    for number, kept in enumerate(combinations(masks, kept_bands)):
        mask = sum(kept)
        signed = mask - (1 << 64) if mask >> 63 else mask
        value = F.col("fingerprint").bitwiseAND(F.lit(signed).cast("long"))
        shards.append(F.xxhash64(F.lit(number), value))
    keyed = distinct.select("fingerprint", F.explode(F.array(*shards)).alias("shard"))
    crowds = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    strips = F.ceil(F.col("n") / shard_size).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("strips")).cast("int")
    other = F.sequence(F.lit(0), F.col("strips") - 1)
    cells = (
        keyed.join(crowds, "shard")
        .select("fingerprint", "shard", strips.alias("strips"))
        .select("fingerprint", "shard", own.alias("own"), F.explode(other).alias("other"))
        # the smaller strip of a cell is its tree, the larger one probes it
        .select(
            "fingerprint",
            F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            (F.col("own") > F.col("other")).alias("probe"),
            (F.col("own") == F.col("other")).alias("alone"),
        )
    )
    schema = "u long, v long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("cell", "fingerprint", "probe", "alone")
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def solve(cell, mark, probe, alone) -> Iterator[pa.RecordBatch]:
            u, v = _forest(cell, mark.view(np.uint64), probe, alone, radius)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in names))
                count += batch.num_rows
            if count >= AT_ONCE and held[-1][0][-1] != held[0][0][0]:  # all cells but the last are complete
                joined = [np.concatenate(c) for c in zip(*held, strict=True)]
                cut = int(np.searchsorted(joined[0], joined[0][-1]))
                yield from solve(*(c[:cut] for c in joined))
                held, count = [tuple(c[cut:] for c in joined)], len(joined[0]) - cut
        if held:
            yield from solve(*(np.concatenate(c) for c in zip(*held, strict=True)))

    ordered = cells.repartition("cell").sortWithinPartitions("cell")
    return ordered.select("cell", "fingerprint", "probe", "alone").mapInArrow(run, schema).distinct()


def component_roots(distinct: DataFrame, radius: int, bands: int, shard_size: int) -> DataFrame:
    """``distinct`` (fingerprint, first) with ``root``, the smallest fingerprint of its component."""
    roots = star_components(links(distinct.select("fingerprint"), radius, bands, None, shard_size))
    return distinct.join(roots.withColumnRenamed("u", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("v", "fingerprint").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = RADIUS,
    bands: int = BANDS,
    shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """Id, fingerprint (16 hexadecimal digits) and component_id of every row.

    component_id is the smallest id that can be reached over links, the row's own included. Null
    ids are never the smallest; a component of null ids has a null component_id. Null and empty
    texts have fingerprint zero and are linked like any other. Repeated rows share a component.
    An empty table gives no rows. Memory per task: one shard strip of ``shard_size``.
    """
    marks = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialise(marks.groupBy("fingerprint").agg(F.min(id_col).alias("first")), "distinct")
    rooted = component_roots(distinct, radius, bands, shard_size)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return marks.join(classes, "fingerprint").select(
        id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = RADIUS,
    bands: int = BANDS,
    shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """``docs`` with one row of each component of :func:`near_duplicates`: that with the smallest id.

    Texts without a word (null, empty, white space) have one fingerprint. Ids that are null come
    last; rows with equal ids are ordered by a digest of the text, and of rows equal in both one
    stays. All columns stay as they are. An empty table gives no rows.
    """
    rows, name = tx.numbered(docs)
    text = F.coalesce(F.col(name[text_col]), F.lit("")).cast("binary")
    rows = rows.withColumns({"doc": F.col(name[id_col]), "node": F.unhex(F.md5(text)), "words": text})
    marks = materialise(fingerprints(rows.select(F.struct("doc", "node").alias("row"), "words"), "row", "words", shingle), "marks")
    order = F.struct(F.col("row.doc").isNull().alias("no_id"), F.col("row.doc").alias("doc"), F.col("row.node").alias("node"))
    distinct = materialise(marks.groupBy("fingerprint").agg(F.min(order).alias("first")), "distinct")
    stays = component_roots(distinct, radius, bands, shard_size).groupBy("root").agg(F.min("first").alias("first"))
    # the place of an id, null or not; ids of one text that share it are told apart below
    place = F.xxhash64(F.col("doc").isNull(), "doc")
    stays = stays.select("first.node", F.col("first.doc").alias("doc")).select("node", place.alias("place"), F.col("doc").alias("stays"))
    kept = rows.withColumn("place", place).join(stays, ["node", "place"]).filter(F.col("doc").eqNullSafe(F.col("stays")))
    again = F.row_number().over(Window.partitionBy("node", "place").orderBy(F.lit(0)))
    return tx.named_again(kept.withColumn("again", again).filter("again = 1"), docs)
