"""Joins and lookups that stay balanced when a few keys dominate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key whose two sides would meet in more than EDGE * EDGE row pairs is split.
EDGE = 2_000

# Largest table that may be broadcast on the strength of a row count.
BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``max_rows`` rows; the probe stops after one more."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a row count proves the table small.

    Beyond the bound the table is returned without a hint and the join falls back to a shuffle.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def hashed_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner equi-join that sorts by a hash of the keys first.

    A sort-merge join compares rows by its first key before it looks at the others.
    Keys that start with a chromosome or a study tie nearly always; led by a hash of all
    of them, the first comparison decides. The keys themselves are still compared.
    """
    keyed = [df.withColumn("_h", F.xxhash64(*on)) for df in (left, right)]
    return keyed[0].join(keyed[1], ["_h", *on]).drop("_h")


def grid_join(
    left: DataFrame, right: DataFrame, on: list[str], condition=None, edge: int = EDGE
) -> DataFrame:
    """Inner equi-join whose hot keys are cut into a grid of cells.

    For a key with l left and r right rows and l * r > edge**2, left rows are
    hashed into ceil(l / edge) strips and right rows into ceil(r / edge) strips;
    each left row is copied once per right strip and the other way round, so every
    pair still meets exactly once, in a cell of about edge**2 pairs. Copies cost at
    most 2 / edge of the pairs the key has to produce anyway. All other keys have
    a single cell. Nothing is dropped and nothing is random, so a recomputed task
    repeats the same cells.

    The table of hot keys is broadcast: every entry stands for more than edge**2
    pairs, hence it is smaller than the join's work by that factor.

    ``condition`` is a residual predicate over the joined columns.
    """
    l_sizes = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_nl"))
    r_sizes = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_nr"))
    hot = (
        l_sizes.join(r_sizes, on)
        .filter(F.col("_nl").cast("double") * F.col("_nr") > float(edge) * edge)
        .select(
            *on,
            F.ceil(F.col("_nl") / edge).cast("int").alias("_cl"),
            F.ceil(F.col("_nr") / edge).cast("int").alias("_cr"),
        )
    )

    def cells(df: DataFrame, own: str, other: str, own_strip: str, other_strip: str):
        payload = [F.col(f"`{c}`") for c in df.columns]
        strip = F.pmod(F.xxhash64(*payload), F.coalesce(F.col(own), F.lit(1))).cast("int")
        copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return df.join(F.broadcast(hot), on, "left").select(
            *payload, strip.alias(own_strip), F.explode(copies).alias(other_strip)
        )

    joined = hashed_join(
        cells(left, "_cl", "_cr", "_ls", "_rs"),
        cells(right, "_cr", "_cl", "_rs", "_ls"),
        [*on, "_ls", "_rs"],
    )
    if condition is not None:
        joined = joined.filter(condition)
    return joined.drop("_ls", "_rs")
