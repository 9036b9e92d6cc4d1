"""Connected components as repeated joins of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.session import materialise


def star_components(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex u of ``edges`` (u, v) but the smallest of its component, with v the
    smallest.

    Alternates the large-star and small-star steps: each hangs a vertex's neighbours below the
    smallest one, first the larger neighbours, then the others, until nothing changes. Each round
    is written to the shared folder, so a lost executor costs a re-read; edges never come to the
    driver, only their count and check sum do.
    """

    def state(df: DataFrame) -> tuple:
        mix = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(df.agg(F.count(F.lit(1)), F.sum(mix)).first())

    now = materialise(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    was, seen = None, state(now)
    while seen[0] and seen != was:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        now = materialise(small.select("e.u", "e.v").filter("u != v").distinct(), "edges")
        was, seen = seen, state(now)
    return now
