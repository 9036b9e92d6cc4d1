"""Token counts by byte-pair merging with a heap and a linked list.

A word starts as a list of its byte symbols. A heap holds the adjacent pairs that have a merge
rule, by rank and then position; the pair on top is merged, the two new neighbours are pushed,
and entries whose symbols have changed meanwhile are skipped. The count of a word is its number
of symbols minus the number of merges; no token ids are made. Words repeat, so a task remembers
the counts of a bounded number of them.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx
from lociweave.llm import tokenizer

#: Words whose counts a task remembers before it starts anew; affects time and memory only.
REMEMBERED = 800_000


PLACE_BITS = 40
PLACE = (1 << PLACE_BITS) - 1


class Rules:
    """Merge rules over own symbol numbers: a byte is its value, other symbols follow."""

    def __init__(self, spec: dict):
        number = {letter: b for b, letter in enumerate(tokenizer.byte_letters())}
        merges = tokenizer.merges_of(spec)
        for a, b in merges:
            number.setdefault(a + b, len(number))
        #: left symbol -> {right symbol: rank}
        self.ranks: list[dict[int, int]] = [{} for _ in number]
        #: rank -> symbol that the rule makes
        self.made = [number[a + b] for a, b in merges]
        for rank, (a, b) in enumerate(merges):
            self.ranks[number[a]][number[b]] = rank


def merged_length(word: bytes, rules: Rules) -> int:
    """Number of symbols left of a word after all merges.

    A heap entry is rank << PLACE_BITS | position of the left symbol.
    """
    ranks, made, n = rules.ranks, rules.made, len(word)
    heap = []
    for i, (a, b) in enumerate(zip(word, word[1:])):  # noqa: B905
        rank = ranks[a].get(b)
        if rank is not None:
            heap.append(rank << PLACE_BITS | i)
    if not heap:
        return n
    heapq.heapify(heap)
    push, pop = heapq.heappush, heapq.heappop
    symbols, after, before = list(word), list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = pop(heap)
        i, j = entry & PLACE, after[entry & PLACE]
        rank = entry >> PLACE_BITS
        if j >= n or symbols[i] < 0 or ranks[symbols[i]].get(symbols[j]) != rank:
            continue
        merges += 1
        new = symbols[i] = made[rank]
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks[new].get(symbols[k])
            if rank is not None:
                push(heap, rank << PLACE_BITS | i)
        h = before[i]
        if h >= 0:
            rank = ranks[symbols[h]].get(new)
            if rank is not None:
                push(heap, rank << PLACE_BITS | h)
    return n - merges


class WordCounts(dict):
    """Word -> number of tokens, by merging when it is not remembered."""

    def __init__(self, spec: dict, limit: int = REMEMBERED):
        super().__init__()
        self.limit, self.rules = limit, Rules(spec)

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = merged_length(word.encode(), self.rules)
        if len(word) <= 64:
            self[word] = value
        return value


class TextCounter:
    """Token count of a whole text under a byte-level BPE file."""

    def __init__(self, path: str):
        import regex

        spec = tokenizer.load(path)
        if not tokenizer.is_plain_byte_bpe(spec):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        self.words = WordCounts(spec)
        self.split = regex.compile(tokenizer.SPLIT)
        self.path, self.known, self.library = path, set(), None
        contents = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, contents))) if contents else None

    def _splits(self, text: str) -> list[str]:
        """Words of a text. Code points that this Python does not know are left to the
        library's own splitter, as Unicode versions differ on them."""
        new = set(text) - self.known
        if any(unicodedata.category(c) == "Cn" for c in new):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        self.known |= new
        return self.split.findall(text)

    def __call__(self, text: str) -> int:
        parts, specials = [text], 0
        if self.special and self.special.search(text):
            specials = len(self.special.findall(text))
            parts = self.special.split(text)
        return specials + sum(sum(map(self.words.__getitem__, self._splits(p))) for p in parts)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, n_bytes (UTF-8), n_tokens of every row.

    Special strings inside a text count one token each, as the library does by default.
    Null text: empty, 0 tokens. Repeated rows and null ids are kept. An empty table gives none.
    Texts are counted whole, whatever their length; one word of any length costs n log n.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TextCounter(tokenizer_path)
        for batch in tx.chunks(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([count(t) for t in texts], pa.int64()),
                ],
                names=schema.names,
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
