"""Repeated passages by sparse suffix arrays.

Only suffixes that start at minimisers are kept: the runs of ``SEED`` words with the smallest
hash of their neighbourhood. Content selects them, so a passage that occurs twice and is at
least ``LEAST`` words long has a kept suffix at the same place in both copies. Suffixes whose
seed occurs once cannot match and go first. The others are sorted, by range over all tasks, and
each is compared with the ones before it; a match is extended to the right along the suffixes
and to the left along the words before them. That order knows the words on the right only, so where
a seed has more kept suffixes than one meets (``REACH`` and itself) the windows of ``LEAST`` words
whose smallest seed it is are matched too, by 128 bits of hash, whatever stands between them in the order.

Suffixes carry a bounded number of words to either side. Longer passages hold several kept
suffixes whose matches overlap, and are put together per document.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx
from lociweave.operators.skew import grid_join

#: Least words of a passage, words of a seed, words that a suffix carries, and how many suffixes
#: before it each one is compared with.
LEAST, SEED, RIGHT, REACH = 50, 16, 64, 3
#: A window that occurs over ``EDGE_OF_WINDOW`` ** 2 times spreads over tasks in the join.
EDGE_OF_WINDOW = 100


def selected(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places that are the leftmost minimum of some run of ``span`` hashes."""
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    low = tx.sliding_min(hashes, span)
    # a place is the minimum of a run if no run that holds it has a larger minimum than its hash
    sides = np.zeros(span - 1, hashes.dtype)
    highest = ~tx.sliding_min(~np.concatenate([sides, low, sides]), span)
    chosen = np.flatnonzero(highest == hashes)
    values = hashes[chosen]
    if not ((values[1:] == values[:-1]) & (np.diff(chosen) < span)).any():
        return chosen
    # equal minima in one run: the leftmost place of each run, by doubling
    at, width = np.arange(len(hashes)), 1
    while width < span:
        step = min(width, span - width)
        one, two = at[:-step], at[step:]
        at = np.where(hashes[one] <= hashes[two], one, two)
        width += step
    return np.unique(at)


def by_seed(seeds: np.ndarray, places: np.ndarray) -> list[tuple[int, list[int]]]:
    """Each seed of a text once, with all its places."""
    order = np.argsort(seeds, kind="stable")
    own, at = seeds[order], places[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(own)].astype(np.int64)
    return [(int(own[a]), at[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _seeds(docs: DataFrame, least: int, seed: int) -> DataFrame:
    """Per row: no_id, doc, text_key, n_words and its kept suffixes as (seed, places), each seed once."""
    schema = "no_id long, doc long, text_key long, n_words long, kept array<struct<seed: long, places: array<long>>>"
    kind = pa.list_(pa.struct([("seed", pa.int64()), ("places", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = tx.WordHashes()
        for batch in tx.chunks(batches, "text"):
            sizes, kept = [], []
            for data in batch.column("text").to_pylist():
                words = (data or b"").split()
                sizes.append(len(words))
                found = []
                if len(words) >= least:
                    grams = tx.scrambled(tx.rolling(hashes.of(words), seed))
                    at = selected(grams, least - seed + 1)
                    found = [{"seed": s, "places": p} for s, p in by_seed(grams[at].view(np.int64), at)]
                kept.append(found)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("no_id", "doc", "text_key")), pa.array(sizes, pa.int64()), pa.array(kept, kind)],
                names=["no_id", "doc", "text_key", "n_words", "kept"],
            )

    return docs.mapInArrow(run, schema)


def _suffixes(texts: DataFrame, left: int, right: int) -> DataFrame:
    """(seed, text_key, place, before, suffix) of every kept suffix of the rows (text_key, text,
    kept): the words before it, nearest last, and its first words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "text", tx.CHUNK_BYTES // 4):
            rows = []
            for key, data, kept in zip(*(batch.column(c).to_pylist() for c in ("text_key", "text", "kept")), strict=True):
                words = (data or b"").split()
                for k in kept:
                    for p in k["places"]:
                        rows.append((k["seed"], key, p, b" ".join(words[max(0, p - left) : p]), b" ".join(words[p : p + right])))
                        if len(rows) == 5_000:
                            yield _batch(rows)
                            rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["seed", "text_key", "place", "before", "suffix"],
        )

    return texts.mapInArrow(run, "seed long, text_key long, place long, before binary, suffix binary")


def common(a: bytes, b: bytes) -> int:
    """How many words of two texts with one space between words are the same from the beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        same = n
    else:  # the first byte that differs lies in [same, beyond)
        same, beyond = 0, n
        while beyond - same > 1:
            middle = (same + beyond) // 2
            if a[same:middle] == b[same:middle]:
                same = middle
            else:
                beyond = middle
    if not same:
        return 0
    whole = a[same : same + 1] in (b"", b" ") and b[same : same + 1] in (b"", b" ")
    return a.count(b" ", 0, same) + whole


class Suffix:
    """A suffix in sorted order, with the matches found for it."""

    __slots__ = ("seed", "key", "place", "before", "suffix", "found")

    def __init__(self, seed: int, key: int, place: int, before: bytes, suffix: bytes):
        self.seed, self.key, self.place = seed, key, place
        self.before, self.suffix = before[::-1], suffix
        self.found: list[tuple[int, int, int, int]] = []

    def meet(self, other: Suffix, least: int) -> None:
        """Notes the passage that both share, unless it lies within one noted before."""
        if (self.key, self.place) == (other.key, other.place):
            return
        right = common(self.suffix, other.suffix)
        left = common(self.before, other.before)
        if left + right >= least:
            for one, two in ((self, other), (other, self)):
                start, end = one.place - left, one.place + right
                if not any(s <= start and end <= s + n for s, n, _, _ in one.found):
                    one.found.append((start, left + right, two.key, two.place - left))


def _neighbours(rows: Iterator[Suffix], reach: int, least: int) -> Iterator[Suffix]:
    """The suffixes, each after it has met the ``reach`` before and after it with its seed."""
    recent: deque[Suffix] = deque()
    for s in rows:
        for other in recent:
            if other.seed == s.seed:
                other.meet(s, least)
        recent.append(s)
        if len(recent) > reach:
            yield recent.popleft()
    yield from recent


MATCH = "text_key long, start long, words long, other_key long, other_start long"
EDGE = "task long, side int, seed long, place long, before binary, suffix binary"


def _matches(ordered: DataFrame, reach: int, least: int) -> DataFrame:
    """Matches (MATCH) of sorted suffixes; rows with ``side`` are instead the first (0) and last
    (1) suffixes of a task, whose neighbours may lie in the next one."""
    names = ["text_key", "start", "words", "other_key", "other_start", "task", "side", "seed", "place", "before", "suffix"]
    kinds = [*[pa.int64()] * 6, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        rows: list[tuple] = []
        ends: deque[tuple] = deque(maxlen=reach)

        def read() -> Iterator[Suffix]:
            count = 0
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("seed", "text_key", "place", "before", "suffix")), strict=True):
                    seed, key, place, before, suffix = row
                    if count < reach:
                        rows.append((key, None, None, None, None, task, 0, seed, place, before, suffix))
                    ends.append((key, None, None, None, None, task, 1, seed, place, before, suffix))
                    count += 1
                    yield Suffix(*row)

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )
            rows.clear()
            return out

        for s in _neighbours(read(), reach, least):
            rows += [(s.key, *f, *[None] * 6) for f in s.found]
            if len(rows) >= 5_000:
                yield flush()
        rows += ends
        if rows:
            yield flush()

    return ordered.mapInArrow(run, f"{MATCH}, {EDGE}")


def _across(edges: DataFrame, reach: int, least: int) -> DataFrame:
    """Matches between the last suffixes of a task and the first of the ``reach`` tasks after it that
    have any, as a task may hold fewer than ``reach``. ``edges`` holds 2 * reach rows per task."""
    tasks = sorted(r["task"] for r in edges.select("task").distinct().collect())  # one number per task
    if len(tasks) < 2:
        return edges.sparkSession.createDataFrame([], MATCH)
    order = edges.sparkSession.createDataFrame([(t, i) for i, t in enumerate(tasks)], "task long, number long")
    back = F.when(F.col("side") == 0, F.sequence(F.lit(1), F.lit(reach))).otherwise(F.array(F.lit(0)))
    seams = edges.join(order, "task").withColumn("back", F.explode(back)).withColumn("seam", F.col("number") - F.col("back"))

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["seed", "suffix", "text_key", "place", "side", "before"]).to_pylist(), key=lambda r: (r["side"], r["seed"], r["suffix"], r["text_key"], r["place"]))
        sides = [[Suffix(r["seed"], r["text_key"], r["place"], r["before"], r["suffix"]) for r in rows if r["side"] == x] for x in (1, 0)]
        for a in sides[0]:
            for b in sides[1]:
                if a.seed == b.seed:
                    a.meet(b, least)
        found = [(s.key, *f) for side in sides for s in side for f in s.found]
        names = ["text_key", "start", "words", "other_key", "other_start"]
        columns = zip(*found, strict=True) if found else [[]] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    return seams.groupBy("seam").applyInArrow(run, MATCH)


class SecondHashes(tx.WordHashes):
    """Word -> another 64-bit hash, so that two windows agree on 128 bits."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 1)
        return value


def _windows(texts: DataFrame, least: int, seed: int) -> DataFrame:
    """(one, two, text_key, start) of the windows of the rows (text_key, text, crowded) whose
    smallest seed is among ``crowded``; equal windows have the same smallest seed."""
    names = ["one", "two", "text_key", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tx.WordHashes(), SecondHashes()
        for batch in tx.chunks(batches, "text"):
            for key, data, crowded in zip(*(batch.column(c).to_pylist() for c in ("text_key", "text", "crowded")), strict=True):
                words = (data or b"").split()
                own = first.of(words)
                low = tx.sliding_min(tx.scrambled(tx.rolling(own, seed)), least - seed + 1)
                at = np.flatnonzero(np.isin(low.view(np.int64), np.array(crowded, dtype=np.int64)))
                one, two = (tx.scrambled(tx.rolling(h, least))[at].view(np.int64) for h in (own, second.of(words)))
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(np.full(len(at), key, np.int64)), pa.array(at)], names=names)

    return texts.mapInArrow(run, "one long, two long, text_key long, start long")


def _window_matches(windows: DataFrame, materialise, least: int) -> DataFrame:
    """Matches (MATCH) of the windows that occur at several places, each with the first place of
    its window, and that with the last."""
    place = F.struct("text_key", "start")
    ends = windows.groupBy("one", "two").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low != high")
    met = grid_join(windows, materialise(ends, "ends"), ["one", "two"], edge=EDGE_OF_WINDOW)
    other = F.when(place == F.col("low"), F.col("high")).otherwise(F.col("low"))
    return met.select(
        "text_key", "start", F.lit(least).cast("long").alias("words"), other["text_key"].alias("other_key"), other["start"].alias("other_start")
    )


def lengthened(matches: list[dict]) -> list[dict]:
    """Matches with the same partner at the same distance that touch, put together."""
    out: list[dict] = []
    for m in sorted(matches, key=lambda m: (m["other_key"], m["other_start"] - m["start"], m["start"])):
        last = out[-1] if out else None
        if last and (last["other_key"], last["other_start"] - last["start"]) == (m["other_key"], m["other_start"] - m["start"]) and m["start"] <= last["start"] + last["words"]:
            last["words"] = max(last["words"], m["start"] + m["words"] - last["start"])
        else:
            out.append(dict(m))
    return out


def merged(matches: list[dict], n: int) -> list[tuple[int, int, int, int]]:
    """Passages (start, words, other_key, other_start) of one text: matches that touch are put
    together, and the partner is that of the longest match."""
    out: list[list[int]] = []
    for m in sorted(lengthened(matches), key=lambda m: (m["start"], -m["words"], m["other_key"], m["other_start"])):
        start, end = m["start"], m["start"] + m["words"]
        if out and start <= out[-1][1]:
            last = out[-1]
            last[1] = max(last[1], end)
            if m["words"] > last[2]:
                last[2:] = [m["words"], m["other_key"], m["other_start"] - (start - last[0])]
        else:
            out.append([start, end, m["words"], m["other_key"], m["other_start"]])
    return [(s, min(e, n) - s, key, max(0, at)) for s, e, _, key, at in out]


def repeated_passages(
    docs: DataFrame,
    materialise,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    seed: int = SEED,
    right: int = RIGHT,
    reach: int = REACH,
) -> DataFrame:
    """(id, start, words, other_id, other_start): the passages of at least ``least`` words that a
    document shares with another place, in words from its beginning.

    Words are runs of bytes other than ASCII white space. ``other_id`` is a document that holds
    the longest match found in the passage, ``other_start`` where the passage would begin there. Equal
    texts are searched once: a text of at least ``least`` words that several documents have is one
    passage of all its words, and the documents share what is found for the text.

    Null, empty and shorter texts have no passages. A null id is kept and comes last in every
    order. Rows equal in id and text count as one document. An empty table gives no rows.
    ``materialise`` writes a table and reads it back.
    """
    if seed >= least or right < least:
        raise ValueError("seed < least <= right")
    named = docs.select(
        F.col(id_col).isNull().cast("long").alias("no_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(text_col).alias("text_key"),
        F.col(text_col).cast("binary").alias("text"),
    )
    who = F.struct("no_id", "doc")
    texts = materialise(
        _seeds(named, least, seed)
        .groupBy("text_key")
        .agg(
            F.min(who).alias("first"),
            F.max(who).alias("last"),
            F.first("n_words").alias("n_words"),
            F.first("kept").alias("kept"),
        )
        .filter(F.col("n_words") >= least),
        "texts",
    )
    kept = texts.select("text_key", F.explode("kept").alias("k")).select("text_key", "k.seed", "k.places")
    often = kept.groupBy("seed").agg(F.sum(F.size("places")).alias("n")).filter("n > 1")
    some = kept.join(often, "seed").groupBy("text_key").agg(
        F.collect_list(F.struct("seed", "places")).alias("kept"),
        F.collect_list(F.when(F.col("n") > reach + 1, F.col("seed"))).alias("crowded"),
    )
    some = some.join(texts.select("text_key", "first.no_id", "first.doc"), "text_key")
    own = named.join(some, ["text_key", "no_id", "doc"]).select("text_key", "text", "kept", "crowded")
    order = ["seed", "suffix", "text_key", "place"]
    windows = materialise(_windows(own.filter(F.size("crowded") > 0).select("text_key", "text", "crowded"), least, seed), "windows")
    ordered = _suffixes(own.select("text_key", "text", "kept"), least - seed, right).repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialise(_matches(ordered, reach, least), "matches")
    edges = materialise(found.filter("side is not null"), "edges")
    matches = found.filter("side is null").select("text_key", "start", "words", "other_key", "other_start")
    matches = matches.union(_across(edges, reach, least)).union(_window_matches(windows, materialise, least))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text_key", "start", "words", "other_key", "other_start"]
        for batch in batches:
            rows = []
            for key, n, own_ in zip(*(batch.column(c).to_pylist() for c in ("text_key", "n_words", "matches")), strict=True):
                rows += [(key, *m) for m in merged(own_, n)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    single = texts.filter(F.col("first") == F.col("last"))
    passages = (
        matches.groupBy("text_key")
        .agg(F.collect_set(F.struct("start", "words", "other_key", "other_start")).alias("matches"))
        .join(single.select("text_key", "n_words", "first"), "text_key")
    )
    parts = passages.select("text_key", "n_words", "matches").mapInArrow(put_together, MATCH)
    partner = texts.select(F.col("text_key").alias("other_key"), F.col("first").alias("other"))
    of_single = (
        parts.join(partner, "other_key")
        .join(single.select("text_key", "first"), "text_key")
        .select("first", "start", "words", "other", "other_start")
    )
    members = named.select("no_id", "doc", "text_key").distinct()
    of_copies = members.join(texts.filter(F.col("first") != F.col("last")), "text_key").select(
        who.alias("first"),
        F.lit(0).cast("long").alias("start"),
        F.col("n_words").alias("words"),
        F.when(F.struct("no_id", "doc") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias("other"),
        F.lit(0).cast("long").alias("other_start"),
    )
    kind = docs.schema[id_col].dataType

    def id_of(c: str):
        return F.when(F.col(f"{c}.no_id") == 0, F.col(f"{c}.doc")).cast(kind)

    return of_single.union(of_copies).select(
        id_of("first").alias(id_col), "start", "words", id_of("other").alias("other_id"), "other_start"
    )
