"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and its reply
is the only trainable part. :func:`expand` writes each example out, with the whole text of its
prefix, as a row of its own with its trainable range, and :func:`read_back` reads these rows. The
examples of a conversation are prefixes of each other, so the output grows with the square of its
turns; they are formed in the task that streams the conversation and pass no shuffle.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside texts and roles get a
backslash behind their first character, and a string that has backslashes there already gets one
more, so that no text can look like a mark and taking one away again gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx

#: Control strings of common chat templates (fixed values of those formats).
CONTROLS = (
    "<s>",
    "</s>",
    "<unk>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
    "<|startoftext|>",
)


@dataclass(frozen=True)
class Template:
    """Marks around a turn. ``begin``, role, line break, text, ``end``, line break.

    ``begin`` and ``end`` have to be among the ``controls``; a control string has two characters or
    more and no backslash.
    """

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>"
    controls: tuple[str, ...] = CONTROLS
    target: str = "assistant"

    def __post_init__(self):
        if not {self.begin, self.end} <= set(self.controls):
            raise ValueError("the marks of a turn must be control strings")
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("control strings have two characters or more and no backslash")

    @property
    def pattern(self) -> str:
        """Matches first character, backslashes and rest of a control string, for Java and Python."""

        def literal(t: str) -> str:
            return "".join("\\" + c if c in "\\^$.|?*+()[]{}" else c for c in t)

        firsts = "".join(sorted({"\\" + c if c in "[]^\\-&" else c for c in (t[0] for t in self.controls)}))
        rests = sorted({t[1:] for t in self.controls}, key=lambda r: (-len(r), r))
        return f"([{firsts}])(\\\\*)({'|'.join(map(literal, rests))})"

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.pattern), F.lit(r"$1\\$2$3"))

    def segment(self, role: Column, text: Column) -> Column:
        """A formatted turn."""
        one_line = F.replace(F.replace(self.escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
        return F.concat(F.lit(self.begin), one_line, F.lit("\n"), self.escaped(text), F.lit(self.end + "\n"))

    def reader(self):
        """``text -> [(role, text)]`` of a formatted text."""
        added = re.compile(self.pattern.replace(r"(\\*)", r"\\(\\*)", 1))
        in_role = re.compile(r"\\(.)")
        turn = re.compile(f"{re.escape(self.begin)}([^\n]*)\n(.*?){re.escape(self.end)}\n", re.DOTALL)

        def plain(text: str) -> str:
            return added.sub(r"\1\2\3", text)

        def read(text: str) -> list[tuple[str, str]]:
            turns, at = [], 0
            for m in turn.finditer(text):
                if m.start() != at:
                    break
                role = in_role.sub(lambda e: "\n" if e[1] == "n" else e[1], m[1])
                turns.append((plain(role), plain(m[2])))
                at = m.end()
            if at != len(text):
                raise ValueError("not a formatted conversation")
            return turns

        return read, plain


CHATML = Template()


def expand(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per example of ``conversations`` (conv_id, turn, role, text).

    * ``example``: its number in the conversation, from 0. An assistant turn ends one, and so does
      the last turn of a conversation that another role closes, so every turn is in an example;
    * ``text``: all turns up to that one, formatted;
    * ``loss_start``, ``loss_end``: trainable code points of ``text``, null where none are;
    * ``chars``: its code points.

    Turns follow ``turn`` (nulls first), then role, then text. Null roles and texts are empty; rows
    of a null conv_id are one conversation; repeated rows are turns of their own; an assistant turn
    without text ends an example with an empty trainable range; an empty table gives no rows. The
    rows of a conversation pass one task as a stream, in the order of their examples; a task holds
    the text of one conversation and a few MB of examples.
    """
    kind = conversations.schema["conv_id"].dataType
    schema = T.StructType(
        [T.StructField("conv_id", kind), T.StructField("example", T.LongType()), T.StructField("text", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in ("loss_start", "loss_end", "chars")]
    )
    target, close = template.target, len(template.end) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, size, examples, reply = None, None, 0, 0, True
        out, held = [], 0

        def example(loss: tuple) -> None:
            nonlocal parts, held, examples
            parts = ["".join(parts)]
            out.append((group, examples, parts[0], *loss, size))
            held, examples = held + size, examples + 1

        for batch in batches:
            for part in tx.chunks([batch], "segment"):
                columns = (part.column(c).to_pylist() for c in ("conv", "role", "head", "segment"))
                for conv, role, head, segment in zip(*columns, strict=True):
                    if parts is None or conv != group:
                        if not reply:
                            example((None, None))
                        group, parts, size, examples = conv, [], 0, 0
                    start, size, reply = size, size + len(segment), role == target
                    parts.append(segment)
                    if reply:
                        example((start + head, size - close))
                    if held >= tx.CHUNK_BYTES:
                        yield table(out)
                        out, held = [], 0
        if not reply:
            example((None, None))
        if out:
            yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in schema]
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(F.col("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    # the text is the end of the segment, so what stands before it is known from the two lengths
    segment = template.segment(F.col("role"), F.col("text"))
    formatted = ordered.select("conv", "role", segment.alias("segment"), F.length(template.escaped(F.col("text"))).alias("size"))
    head = F.length("segment") - F.col("size") - F.lit(close)
    return formatted.select("conv", "role", head.alias("head"), "segment").mapInArrow(run, schema)


def render(expanded: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end) of every example of ``expand``."""
    return expanded.select("conv_id", "example", "text", "loss_start", "loss_end")


def read_back(expanded: DataFrame, template: Template = CHATML) -> DataFrame:
    """What the examples of ``expand`` say, one row per conversation.

    ``n_turns`` and ``turns_sha256`` (role, line break, text, line break of each turn) come from the
    text of a conversation's last example, which has all turns; ``loss_chars`` and ``loss_sha256``
    from the trainable ranges of all examples, unescaped; ``formatted_chars`` is the length of all
    their texts.

    ``expanded`` has to come from :func:`expand` as it is: its rows are read in their order.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    long, string = T.LongType(), T.StringType()
    schema = T.StructType([expanded.schema["conv_id"], *(T.StructField(c, string if "sha" in c else long) for c in names[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, plain = template.reader()
        now = None

        def done() -> list:
            conv, text, chars, loss, total = now
            turns = read(text)
            told = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode())
            return [conv, len(turns), told.hexdigest(), chars, loss.hexdigest(), total]

        for batch in batches:
            out = []
            for part in tx.chunks([batch], "text"):
                columns = (part.column(c).to_pylist() for c in ("conv_id", "example", "text", "loss_start", "loss_end"))
                for conv, example, text, start, end in zip(*columns, strict=True):
                    if example == 0:
                        if now is not None:
                            out.append(done())
                        now = [conv, "", 0, hashlib.sha256(), 0]
                    now[1] = text
                    if start is not None:
                        own = plain(text[start:end])
                        now[2] += len(own)
                        now[3].update(own.encode())
                    now[4] += len(text)
            if out:
                yield table(out, batch.schema.field("conv_id").type)
        if now is not None:
            yield table([done()], batch.schema.field("conv_id").type)

    def table(out: list[list], conv: pa.DataType) -> pa.RecordBatch:
        types = [conv, *(pa.string() if "sha" in c else pa.int64() for c in names[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return expanded.mapInArrow(run, schema)
