"""Dropping rows of a large table that cannot match, before they are shuffled.

A Bloom filter of fixed size: its bits are computed by Spark from the keys of the small side and
read as a scalar subquery by the scan of the large side. The plan is the same for any number of
keys and nothing is counted while it is built. More keys than the filter is made for let more rows
pass, which the join then drops; a row that matches always passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a filter: 2 MiB, the most that any task is sent for it. Five million keys let
# about a fifth of the other rows pass.
BITS = 1 << 24
HASHES = 2

# Words that are put in order together.
STRETCH = 512


class KeyFilter:
    """Bloom filter of one or more sets of keys, all columns of the same rows.

    ``sets`` names the columns of each. Nulls are hashed like on the other side, so a filter
    serves null-safe joins as well. Columns must have the types of those they are compared with.
    """

    def __init__(self, rows: DataFrame, sets: dict[str, list[str]], bits: int = BITS):
        if bits < 64 * STRETCH or bits & (bits - 1):
            raise ValueError(f"bits must be a power of two of at least {64 * STRETCH}")
        self.bits = bits
        places = [at for name, columns in sets.items() for at in self._places(name, columns)]
        word = F.shiftright("at", 6).cast("int").alias("word")
        marks = rows.select(F.explode(F.array(*places)).alias("at")).select(
            word, F.expr("shiftleft(1L, cast(at & 63 as int))").alias("mark")
        )
        empty = rows.sparkSession.range(bits // 64).select(
            F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("mark")
        )
        in_order = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
        stretches = (
            marks.unionAll(empty)
            .groupBy(F.floor(F.col("word") / STRETCH).alias("stretch"), "word")
            .agg(F.bit_or("mark").alias("mark"))
            .groupBy("stretch")
            .agg(in_order("word", "mark").alias("w"))
            .select("stretch", F.col("w.mark").alias("marks"))
        )
        # one array of bits / 64 numbers, whatever the number of keys
        packed = stretches.agg(in_order("stretch", "marks").alias("s"))
        self.words = packed.select(F.flatten(F.col("s.marks")).alias("words"))
        self._lookup = self.words.scalar()

    def _places(self, name: str, columns: list) -> list[Column]:
        return [
            F.xxhash64(F.lit(f"{name}{i}"), *columns).bitwiseAND(F.lit(self.bits - 1))
            for i in range(HASHES)
        ]

    def passes(self, name: str, columns: list) -> Column:
        """Whether a row's key may be among the keys called ``name``."""
        tests = [
            F.getbit(
                F.get(self._lookup, F.shiftright(at, 6).cast("int")),
                at.bitwiseAND(F.lit(63)).cast("int"),
            )
            == 1
            for at in self._places(name, columns)
        ]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out
