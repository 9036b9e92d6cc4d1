"""Repair of conversation structure by weighted interval parsing.

A repaired conversation is an optional system turn and then user and assistant turns in turn. Its
grammar is in Chomsky normal form over *intervals*: the symbol [p, q] derives a run of edits that
takes the conversation from state p to state q.

    [p, q] -> [p, r] [r, q]         for every state r between
    [p, q] -> an edit of one turn   keep, give another role, delete
    [p, q] -> an inserted turn      over an empty span

A cell holds, for every symbol, the minimum (cost, audit) over its span, the audit being the
initials of the edits; equal costs take the least audit. Cells are closed under insertion: runs of
inserted turns may stand before, behind and between. Cells of one turn come first, and cells of
longer spans are combined from two neighbours, by doubling span length. One split per span is
enough: the binary rules exist for every r, so all splits of a span derive the same runs of edits.
That makes the work linear in the turns, and a long conversation can be cut anywhere: tasks parse
pieces of it, and a conversation's cells are combined from its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lociweave.session import materialise

#: Symbol -> (cost, audit); symbols that derive nothing over a span are absent.
Cell = dict[tuple[str, str], tuple[int, str]]

#: Turns that a task parses as one piece.
PIECE = 1024


@dataclass(frozen=True)
class Grammar:
    """States of a conversation, what leads from one to the next, and what edits cost.

    ``steps`` are (state, role, state); ``insertable`` roles can be inserted and given to turns.
    """

    start: str = "0"
    steps: tuple[tuple[str, str, str], ...] = (
        ("0", "system", "s"),
        ("0", "user", "u"),
        ("s", "user", "u"),
        ("u", "assistant", "a"),
        ("a", "user", "u"),
    )
    final: tuple[str, ...] = ("0", "a")
    insertable: tuple[str, ...] = ("user", "assistant")
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1

    @cached_property
    def states(self) -> tuple[str, ...]:
        return tuple(sorted({self.start, *(s for p, _, q in self.steps for s in (p, q))}))

    def better(self, cell: Cell, symbol: tuple[str, str], value: tuple[int, str]) -> bool:
        """Puts a derivation into a cell if it is cheaper, or as cheap with a lesser audit."""
        if symbol not in cell or value < cell[symbol]:
            cell[symbol] = value
            return True
        return False

    def joined(self, left: Cell, right: Cell) -> Cell:
        """[p, q] -> [p, r] [r, q] over two neighbouring spans."""
        out: Cell = {}
        for (p, r), (cost, audit) in left.items():
            for q in self.states:
                behind = right.get((r, q))
                if behind is not None:
                    self.better(out, (p, q), (cost + behind[0], audit + behind[1]))
        return out

    @cached_property
    def empty(self) -> Cell:
        """The cell of the empty span: nothing, or inserted turns, to a fixed point."""
        cell: Cell = {(p, p): (0, "") for p in self.states}
        single = {(p, q): (self.insert, "I") for p, role, q in self.steps if role in self.insertable}
        while any([self.better(cell, s, v) for s, v in self.joined(cell, single).items()]):
            pass
        return cell

    def turn(self, initial: str, must_go: bool, truncated: bool) -> Cell:
        """The cell of one turn, closed under insertion."""
        cell: Cell = {(p, p): (self.delete, "D") for p in self.states}
        if not must_go:
            extra = self.truncated if truncated else 0
            for p, role, q in self.steps:
                if initial == role[:1]:
                    self.better(cell, (p, q), (extra, "K"))
                if role in self.insertable:
                    self.better(cell, (p, q), (self.rerole + extra, "R"))
        return self.joined(self.joined(self.empty, cell), self.empty)

    def gone(self, times: int) -> Cell:
        """The cell of so many turns that all have to go."""
        cell: Cell = {(p, p): (self.delete * times, "D" * times) for p in self.states}
        return self.joined(self.joined(self.empty, cell), self.empty)

    def parse(self, cells: list[Cell]) -> Cell:
        """The cell of a whole span from the cells of its turns, by doubling span length."""
        if not cells:
            return self.empty
        while len(cells) > 1:
            pairs = [self.joined(a, b) for a, b in zip(cells[::2], cells[1::2])]  # noqa: B905
            cells = pairs + cells[len(pairs) * 2 :]
        return cells[0]

    def best(self, cell: Cell) -> tuple[int, str]:
        """The cheapest (cost, audit) that ends a conversation."""
        return min(cell[self.start, q] for q in self.final if (self.start, q) in cell)

    def follow(self, state: str, edit: str, role: str) -> tuple[str, str | None]:
        """State after an edit, and the role of the turn that it leaves, None if it leaves none."""
        if edit == "D":
            return state, None
        if edit == "K":
            return next(q for p, r, q in self.steps if p == state and r[:1] == role[:1]), role
        return next((q, r) for p, r, q in self.steps if p == state and r in self.insertable)


CHAT = Grammar()

#: What damage does to a turn, by the remainder of its checksum.
DROP, BLANK, TRUNCATE, REPEAT, AS_USER = range(5)


def damaged(rows: DataFrame, modulus: int = 20) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults that depend on each turn's key only.

    Nulls count as one space, in the key, the role and the text. ``copies`` is how often a row
    stands in the result: 0 for a dropped turn, 2 for a repeated one.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % modulus
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    cut = F.when(kind == BLANK, F.lit("")).when(kind == TRUNCATE, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == AS_USER, F.lit("user")).otherwise(role).alias("role"),
        cut.alias("text"),
        F.when(kind == DROP, 0).when(kind == REPEAT, 2).otherwise(1).cast("long").alias("copies"),
    )


#: White space that does not make a turn.
WHITE = "\\x20\\x09-\\x0D"


def digest(text: Column) -> Column:
    """What stands for a text where it is only compared: 128 bits, as text."""
    return F.md5(text.cast("binary"))


def light(rows: DataFrame) -> DataFrame:
    """What parsing needs of each different row: (conv_id, turn, role, mark, blank, truncated, n, fresh).

    Equal rows are one with their number ``n``. ``fresh``: no earlier turn has its role and text.
    Both come from sums over keys that hold the turn, or from minima that combine before the
    shuffle, so no text that a conversation repeats without end gathers in one task.
    """
    last = F.regexp_extract("text", f"([^{WHITE}])[{WHITE}]*\\z", 1)
    there = F.col("copies") > 0
    marked = rows.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.col("role")).alias("role"),
        F.when(there, digest(F.col("text"))).alias("mark"),
        F.when(there, F.when(last == "", "blank").when(last.isin(*".!?"), "sound").otherwise("truncated")).alias("state"),
        F.col("copies").alias("n"),
        F.lit(False).alias("fresh"),
    )
    first = marked.filter("n > 0").groupBy("conv_id", "role", "mark", "state")
    first = first.agg(F.max(F.col("turn").isNull()).alias("no_turn"), F.min("turn").alias("turn"))
    first = first.withColumns({"turn": F.when(~F.col("no_turn"), F.col("turn")), "n": F.lit(0).cast("long"), "fresh": F.lit(True)})
    both = marked.unionByName(first.select(*marked.columns))
    return both.groupBy("conv_id", "turn", "role", "mark", "state").agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh"))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


#: Symbols in the order in which pieces keep their cells.
def _symbols(grammar: Grammar) -> list[tuple[str, str]]:
    return [(p, q) for p in grammar.states for q in grammar.states]


COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
LEGAL = ("su", "ua", "au")


def _longs(names) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def pieces(rows: DataFrame, grammar: Grammar = CHAT, piece: int = PIECE) -> DataFrame:
    """Cells and counts of pieces of at most ``piece`` different rows, in the order of ``part``, ``at``.

    ``rows`` come from :func:`light`. They are dealt out by range, so a long conversation spreads
    over tasks.
    """
    fields = [rows.schema["conv_id"], T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())]
    ends = [T.StructField(n, T.StringType()) for n in ("first_role", "last_role")]
    turns = _longs(("min_turn", "max_turn"))
    cells = [T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))]
    schema = T.StructType([*fields, *_longs(COUNTS), *ends, *turns, *cells])
    symbols = _symbols(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_cell = lru_cache(maxsize=4096)(grammar.turn)
        joined = lru_cache(maxsize=4096)(lambda kinds: grammar.parse([turn_cell(*k) for k in kinds]))
        held: list[tuple] = []
        at = 0

        def solve() -> tuple:
            conv, part = held[0][:2]
            counts = dict.fromkeys(COUNTS, 0)
            kinds, cells, before, seen_turn = [], [], None, None
            low, high = None, None
            first = None
            for _, _, turn, role, state, n, fresh in held:
                if not n:
                    continue
                initial = role[:1]
                counts["rows"] += n
                counts["blank"] += n if state == "blank" else 0
                again = 0 if state == "blank" else n - fresh
                counts["duplicate"] += again
                counts["truncated"] += state == "truncated" and fresh
                counts["illegal"] += (n - 1) * (initial + initial not in LEGAL) + (before is not None and before + initial not in LEGAL)
                if first is None:
                    first = initial
                before = initial
                if turn is not None:
                    counts["turns"] += turn != seen_turn
                    seen_turn, high = turn, turn
                    low = turn if low is None else low
                must_go = state == "blank" or not fresh
                if must_go and n == 1:
                    kinds.append(("", True, False))
                else:
                    if not must_go:
                        kinds.append((initial, False, state == "truncated"))
                    left = n if must_go else n - 1
                    if left == 1:
                        kinds.append(("", True, False))
                    elif left:
                        cells += [*runs(kinds), grammar.gone(left)]
                        kinds = []
            cell = grammar.parse([*cells, *runs(kinds)])
            values = [cell.get(s) for s in symbols]
            return (conv, part, at, *counts.values(), first, before, low, high, [v and v[0] for v in values], [v and v[1] for v in values])

        def runs(kinds: list[tuple]) -> list:
            """Cells of spans of eight turns; the same eight kinds of turns have one cell."""
            return [joined(tuple(kinds[i : i + 8])) for i in range(0, len(kinds), 8)]

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "part", "turn", "role", "state", "n", "fresh"))
            for row in zip(*columns, strict=True):
                if held and (row[0] != held[0][0] or len(held) >= piece):
                    out.append(solve())
                    held, at = [], at + 1
                held.append(row)
            if out:
                yield _batch(out, schema)
        if held:
            yield _batch([solve()], schema)

    order = ("conv_id", "turn", "role", "mark")
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, 64), F.when(F.length("role") < 64, F.col("mark")))
    ordered = dealt.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return ordered.select("conv_id", "part", "turn", "role", "state", "n", "fresh").mapInArrow(run, schema)


def verdicts(parsed: DataFrame, grammar: Grammar = CHAT) -> DataFrame:
    """One row per conversation from its pieces: counts, ``gaps``, ``illegal``, ``cost`` and ``audit``."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([parsed.schema["conv_id"], *_longs(names), T.StructField("audit", T.StringType())])
    symbols = _symbols(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def done() -> tuple:
            cost, audit = grammar.best(now["cell"])
            low, high = now["min_turn"], now["max_turn"]
            gaps = 0 if low is None else high - low + 1 - now["turns"]
            return (now["conv_id"], gaps, *(now[c] for c in names[1:5]), cost, audit)

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                own = {s: (c, a) for s, c, a in zip(symbols, r["costs"], r["audits"], strict=True) if c is not None}
                if now is None or now["conv_id"] != r["conv_id"]:
                    if now is not None:
                        out.append(done())
                    # only what starts a conversation is needed of the span so far
                    now = {**r, "cell": {s: v for s, v in own.items() if s[0] == grammar.start}}
                    continue
                now["cell"] = grammar.joined(now["cell"], own)
                for c in COUNTS:
                    now[c] += r[c]
                if None not in (now["last_role"], r["first_role"]):
                    now["illegal"] += now["last_role"] + r["first_role"] not in LEGAL
                now["last_role"] = now["last_role"] if r["last_role"] is None else r["last_role"]
                if r["min_turn"] is not None:
                    now["turns"] -= now["max_turn"] == r["min_turn"]  # one turn on both sides of the cut
                    now["max_turn"] = r["max_turn"]
                    now["min_turn"] = r["min_turn"] if now["min_turn"] is None else now["min_turn"]
            if out:
                yield _batch(out, schema)
        if now is not None:
            yield _batch([done()], schema)

    ordered = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return ordered.mapInArrow(run, schema)


def repaired(rows: DataFrame, verdict: DataFrame, grammar: Grammar = CHAT) -> DataFrame:
    """The repaired turns: (conv_id, position, role, text, edit), edit being the initial in the audit.

    The turns of a conversation follow its verdict to one task, as a stream: the audit and one turn
    at a time are in memory. Inserted turns have an empty text.
    """
    kind = rows.schema["conv_id"]
    strings = [T.StructField(n, T.StringType()) for n in ("role", "text", "edit")]
    schema = T.StructType([kind, T.StructField("position", T.LongType()), *strings])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, position = None, "", 0, grammar.start, 0

        def inserted() -> Iterator[tuple]:
            nonlocal at, state, position
            while at < len(audit) and audit[at] == "I":
                state, role = grammar.follow(state, "I", "")
                yield (conv, position, role, "", "I")
                at, position = at + 1, position + 1

        for batch in batches:
            for part in _bounded(batch):
                out = []
                columns = (part.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))
                for own, told, role, text in zip(*columns, strict=True):
                    if told is not None:  # a conversation begins
                        out += inserted()
                        conv, audit, at, state, position = own, told, 0, grammar.start, 0
                        continue
                    out += inserted()
                    edit, at = audit[at], at + 1
                    state, new = grammar.follow(state, edit, role)
                    if new is not None:
                        out.append((conv, position, new, text, edit))
                        position += 1
                if out:
                    yield _batch(out, schema)
        rest = list(inserted())
        if rest:
            yield _batch(rest, schema)

    turns = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    turns = turns.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", digest(F.col("text")).alias("mark"))
    heads = verdict.select("conv_id", "audit").withColumns({c: F.lit(None).cast(turns.schema[c].dataType) for c in ("turn", "role", "text", "mark")})
    both = turns.unionByName(heads).withColumn("follows", F.col("audit").isNull())
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "follows", "turn", "role", "mark")
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(run, schema)


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    from lociweave.llm import text as tx

    return tx.chunks([batch], "text")


def repair(rows: DataFrame, grammar: Grammar = CHAT, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Verdicts, one row per conversation, and the repaired turns.

    ``rows`` has conv_id, turn, role, text and, optionally, ``copies``; a row with no copies only
    names its conversation. Turns follow ``turn`` (nulls first), then role, then a digest of the
    text. The first fault of a turn counts: ``blank`` (nothing but white space), ``duplicate`` (an
    earlier turn has its role and text), ``truncated`` (the last character but white space is not
    ``.``, ``!`` or ``?``). ``gaps`` are numbers missing between the first and the last turn,
    ``illegal`` neighbours that cannot follow each other. A conversation without turns has zeros and
    an empty audit, one whose turns all go has no repaired turns. Null roles and texts are one
    space; rows of a null conv_id are one conversation; an empty table gives no rows.
    """
    own = {"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))}
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).cast("long")
    turns = rows.select("conv_id", "turn", own["role"].alias("role"), own["text"].alias("text"), copies.alias("copies"))
    verdict = materialise(verdicts(pieces(light(turns), grammar, piece), grammar), "verdicts")
    return verdict, repaired(turns, verdict, grammar)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired turns: ``role:text``, joined by line breaks."""
    import hashlib

    schema = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "position", "role", "text"))
            for conv, position, role, text in zip(*columns, strict=True):
                if position == 0:
                    if now is not None:
                        out.append((now[0], now[1].hexdigest()))
                    now = (conv, hashlib.sha256(f"{role}:{text}".encode()))
                else:
                    now[1].update(f"\n{role}:{text}".encode())
            if out:
                yield _batch(out, schema)
        if now is not None:
            yield _batch([(now[0], now[1].hexdigest())], schema)

    return turns.mapInArrow(run, schema)
