"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders, so a question whose parameters
were changed keeps its template. Windows of template words are hash-joined between documents and
benchmark items. Along one alignment of a document with an item a name must stand for one name:
windows that hold a name with several are void, as the template agrees by chance there. Numbers and
units are parameters of their own: equal ones may become different and different ones equal. A
document is contaminated by an item if the other windows cover enough of the item's words.

Each window is matched as a typed template and, where it has placeholders, word for word as well,
so that a copy with other capitals is still found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx

#: Words per window, least words of an item, and the share of an item's words to be covered.
WINDOW, LEAST_WORDS, COVERAGE = 8, 5, 0.6
#: Window hashes of the benchmark that are broadcast at a time (8 bytes each); a larger benchmark
#: is matched in several passes.
BROADCAST_HASHES = 2_000_000

# Words that stand for numbers, units after a number, and frequent given names.
NUMBER_WORDS = """
zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred
thousand million billion
"""
UNITS = """
mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton
tons ounce ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute
minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros
percent degree degrees mph kmh hz khz mhz kb mb gb tb v w kw j n pa
"""
NAMES = """
Adam Alex Alice Amy Anna Anne Ben Bob Carl Carol Charles Chris Claire Dan Daniel David Emily Emma
Eric Eva Frank Fred George Grace Hannah Harry Helen Henry Jack James Jane Jean Jim Joe John Julia
Karen Kate Kevin Laura Lily Linda Lisa Lucy Luis Maria Mark Martin Mary Max Mia Michael Mike Nick
Nina Olivia Oscar Paul Peter Rachel Robert Rosa Ryan Sam Sara Sarah Simon Sofia Steve Susan Thomas
Tim Tom Victor William
"""

NUMBER, NAME, UNIT = 1, 2, 3
PLACEHOLDERS = {NUMBER: "<number>", NAME: "<name>", UNIT: "<unit>"}
#: What a word may be; which it is depends on the word before it.
IS_NUMBER, IS_TITLE, IS_NAME, IS_UNIT, ENDS = 1, 2, 4, 8, 16


class Words(dict):
    """Raw word -> (plain form, hash of it, flags). Cleared when it holds ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit
        self.trim = re.compile(r"^[\W_]+|[\W_]+$")
        self.number = re.compile(r"[0-9][0-9.,:/]*(st|nd|rd|th)?")
        self.number_words = frozenset(NUMBER_WORDS.split())
        self.units = frozenset(UNITS.split())
        self.names = frozenset(NAMES.split())

    def __missing__(self, word: str) -> tuple[str, int, int]:
        if len(self) >= self.limit:
            self.clear()
        bare = self.trim.sub("", word)
        plain = bare.lower()
        flags = 0
        if self.number.fullmatch(plain) or plain in self.number_words:
            flags |= IS_NUMBER
        elif bare[:1].isupper() and bare[1:].islower():
            flags |= IS_TITLE | (IS_NAME if bare in self.names else 0)
        if plain in self.units or word[-1:] in "%°":
            flags |= IS_UNIT
        if word[-1:] in ".!?:":
            flags |= ENDS
        value = self[word] = (plain, xxhash.xxh64_intdigest(plain.encode()), flags)
        return value


def kinds(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Placeholder of each word, or 0. ``first``: words that start a text."""
    before = np.r_[0, flags[:-1]]
    before[first] = ENDS
    number = (flags & IS_NUMBER) > 0
    named = ((flags & IS_NAME) > 0) | (((flags & IS_TITLE) > 0) & ((before & ENDS) == 0))
    unit = ((flags & IS_UNIT) > 0) & ((before & IS_NUMBER) > 0)
    return np.select([number, unit, named], [NUMBER, UNIT, NAME], 0)


class Windows:
    """Windows of a chunk of texts: hashes, and template and slot values on demand."""

    def __init__(self, texts: list[str], words: Words):
        self.plain: list[str] = []
        hashes, flags, sizes = [], [], []
        for t in texts:
            known = [words[w] for w in t.split()]
            known = [k for k in known if k[0]]
            self.plain += [k[0] for k in known]
            hashes += [k[1] for k in known]
            flags += [k[2] for k in known]
            sizes.append(len(known))
        self.sizes = np.array(sizes, dtype=np.int64)
        self.base = np.cumsum(self.sizes) - self.sizes
        self.literal = np.array(hashes, dtype=np.uint64)
        self.kind = kinds(np.array(flags, dtype=np.int64), self.base[self.sizes > 0]) if flags else np.zeros(0, np.int64)
        stand_in = np.array([0, *(xxhash.xxh64_intdigest(p) for p in PLACEHOLDERS.values())], dtype=np.uint64)
        self.typed = np.where(self.kind > 0, stand_in[self.kind], self.literal)
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)

    def hashes(self, width: int) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
        """(typed, first words, hashes): all windows word for word, and those with placeholders,
        unless more than half of their words are, as templates."""
        n = len(self.literal) - width + 1
        if n <= 0:
            return
        at = np.arange(n)
        at = at[self.owner[:n] == self.owner[width - 1 :]]
        yield False, at, tx.scrambled(tx.rolling(self.literal, width))[at]
        slots = np.r_[0, np.cumsum(self.kind > 0)]
        filled = (slots[width:] - slots[:-width])[at]
        at = at[(filled > 0) & (2 * filled <= width)]
        yield True, at, tx.scrambled(tx.rolling(self.typed, width))[at]

    def row(self, typed: bool, at: int, width: int) -> tuple[int, str, list[str]]:
        """(first word in its text, template, slot values) of a window. Templates and plain
        windows never look alike, nor do windows of different widths."""
        own = range(at, at + width)
        start = at - int(self.base[self.owner[at]])
        if not typed:
            return start, " ".join(self.plain[at : at + width]), []
        shown = [PLACEHOLDERS.get(int(self.kind[i]), self.plain[i]) for i in own]
        return start, " ".join(shown), [f"{self.kind[i]}:{self.plain[i]}" for i in own if self.kind[i]]


WINDOW_ROW = [
    T.StructField("start", T.LongType()),
    T.StructField("width", T.LongType()),
    T.StructField("typed", T.BooleanType()),
    T.StructField("template", T.StringType()),
    T.StructField("slots", T.ArrayType(T.StringType())),
]
ARROW_ROW = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string())]


def _item_windows(items: DataFrame, width: int, least: int) -> DataFrame:
    """All windows of the benchmark: item, n_words, WINDOW_ROW, hash. An item shorter than the
    width is one window; items under ``least`` words have none."""
    schema = T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("n_words", T.LongType()), *WINDOW_ROW, T.StructField("hash", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in tx.chunks(batches, "text"):
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = Windows([text or ""], words)
                n = int(own.sizes[0])
                if n < least:
                    continue
                size = min(n, width)
                for typed, at, value in own.hashes(size):
                    for i, h in zip(at.tolist(), value.view(np.int64).tolist(), strict=True):
                        start, template, slots = own.row(typed, i, size)
                        rows.append((item, n, start, size, typed, template, slots, h))
            if rows:
                kinds_ = [pa.int64(), pa.int64(), *ARROW_ROW, pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds_, strict=True)], names=schema.names
                )

    return items.mapInArrow(run, schema)


class HashSet:
    """Membership of many hashes at once: a table of bits first, then a sorted array."""

    BITS = 22

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.bit = np.zeros(1 << self.BITS, dtype=bool)
        self.bit[self.sorted >> np.uint64(64 - self.BITS)] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Indices of the hashes that are in the set."""
        maybe = np.flatnonzero(self.bit[hashes >> np.uint64(64 - self.BITS)])
        place = np.searchsorted(self.sorted, hashes[maybe])
        place[place == len(self.sorted)] = 0
        return maybe[self.sorted[place] == hashes[maybe]] if len(self.sorted) else maybe[:0]


def _document_windows(docs: DataFrame, hashes: np.ndarray, widths: list[int]) -> DataFrame:
    """Windows of documents (doc, text_key, text) whose hash is among ``hashes``."""
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("text_key", T.LongType()), *WINDOW_ROW])
    wanted = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = Words(), HashSet(wanted.value)
        for batch in tx.chunks(batches, "text"):
            doc, key = batch.column("doc").to_pylist(), batch.column("text_key").to_pylist()
            own = Windows([t or "" for t in batch.column("text").to_pylist()], words)
            rows = []
            for width in widths:
                for typed, at, value in own.hashes(width):
                    for i in at[known.holds(value)].tolist():
                        d = int(own.owner[i])
                        start, template, slots = own.row(typed, i, width)
                        rows.append((doc[d], key[d], start, width, typed, template, slots))
            if rows:
                kinds_ = [pa.int64(), pa.int64(), *ARROW_ROW]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds_, strict=True)], names=schema.names
                )

    return docs.mapInArrow(run, schema)


def consistent(pairs: list[tuple[str, str]]) -> bool:
    """Whether (item value, document value) pairs are one to one."""
    there: dict[str, str] = {}
    back: dict[str, str] = {}
    return all(there.setdefault(a, b) == b and back.setdefault(b, a) == a for a, b in pairs)


def fitting(windows: list[dict]) -> list[dict]:
    """The typed windows of one alignment without those that hold a name of the item for which the
    document has several."""
    slots = [list(zip(w["item_slots"], w["doc_slots"], strict=True)) for w in windows]
    if consistent([p for own in slots for p in own]):
        return windows
    stands: dict[str, set[str]] = {}
    for a, b in (p for own in slots for p in own):
        if a.startswith(f"{NAME}:"):
            stands.setdefault(a, set()).add(b)
    return [w for w, own in zip(windows, slots, strict=True) if all(len(stands.get(a, ())) < 2 for a, _ in own)]


def covered_words(windows: list[dict]) -> tuple[int, bool]:
    """Words of an item that a document's fitting windows cover, and whether some are covered
    only with changed parameters. Windows of one alignment are judged together."""
    lines: dict[int, list[dict]] = {}
    for w in windows:
        lines.setdefault(w["doc_start"] - w["item_start"], []).append(w)
    exact: set[int] = set()
    changed: set[int] = set()
    for own in lines.values():
        for w in own:
            if not w["typed"]:
                exact.update(range(w["item_start"], w["item_start"] + w["width"]))
        for w in fitting([w for w in own if w["typed"]]):
            changed.update(range(w["item_start"], w["item_start"] + w["width"]))
    return len(exact | changed), not changed <= exact


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    least: int = LEAST_WORDS,
    coverage: float = COVERAGE,
    broadcast_hashes: int = BROADCAST_HASHES,
) -> DataFrame:
    """(id, text_key, item, covered_words, item_words, coverage, changed) of every document and
    benchmark item it gives away; ``text_key`` is xxhash64 of the text and tells rows with equal
    ids apart. Clean documents have no row.

    Words are compared without case and outer punctuation. Null and empty texts are clean, items
    under ``least`` words match nothing, items without an id take no part. A document without an
    id is reported with a null id. Repeated rows are reported once, repeated items too. An empty
    table on either side gives no rows.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    of_items = _item_windows(items.filter("item is not null"), window, least)
    sizes = of_items.agg(F.count(F.lit(1)).alias("n"), F.collect_set("width").alias("widths")).first()
    widths = sorted(sizes["widths"])  # at most window - least + 1 values
    named = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")
    )
    passes = max(1, -(-sizes["n"] // broadcast_hashes))
    found = None
    for part in range(passes):
        rows = of_items.filter(F.pmod("hash", F.lit(passes)) == part).select("hash").distinct().toPandas()["hash"]
        own = _document_windows(named, rows.to_numpy(dtype=np.int64).view(np.uint64), widths)
        found = own if found is None else found.union(own)
    # the join is on the words themselves, so equal hashes of different windows do no harm
    matched = found.withColumnsRenamed({"start": "doc_start", "slots": "doc_slots"}).join(
        of_items.withColumnsRenamed({"start": "item_start", "slots": "item_slots"}).drop("hash"),
        ["template", "typed", "width"],
    )
    pairs = matched.groupBy("doc", "text_key", "item", "n_words").agg(
        F.collect_set(F.struct("doc_start", "item_start", "width", "typed", "doc_slots", "item_slots")).alias("windows")
    )
    schema = T.StructType(
        [
            T.StructField(id_col, T.LongType()),
            T.StructField("text_key", T.LongType()),
            T.StructField(item_col, T.LongType()),
            T.StructField("covered_words", T.LongType()),
            T.StructField("item_words", T.LongType()),
            T.StructField("changed", T.BooleanType()),
        ]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [covered_words(w) for w in batch.column("windows").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc", "text_key", "item")),
                    pa.array([n for n, _ in told], pa.int64()),
                    batch.column("n_words"),
                    pa.array([c for _, c in told], pa.bool_()),
                ],
                names=schema.names,
            )

    share = F.col("covered_words") / F.col("item_words")
    return pairs.mapInArrow(judge, schema).withColumn("coverage", share).filter(F.col("coverage") >= coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents; all columns and all other rows stay."""
    marked = contaminated(docs, benchmark, id_col, text_col, **options)
    gone = marked.select(F.col(id_col).alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    rows, name = tx.numbered(docs)
    same = rows[name[id_col]].cast("long").eqNullSafe(F.col("gone_id")) & (F.xxhash64(rows[name[text_col]]) == F.col("gone_key"))
    return tx.named_again(rows.join(gone, same, "left_anti"), docs)
