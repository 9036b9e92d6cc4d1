"""Linkage disequilibrium: panel windows and correlations between variants.

The panel is a table of carriers, ``chrom, pos, ref, alt, sample_id, dosage`` with
dosage 1 or 2; a sample without a row for a variant has dosage 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lociweave.functions.scalars import parse_variant_id, to_ld_variant_id, variant_id
from lociweave.operators.skew import broadcast_if_small
from lociweave.schemas import GRCH38_CHROM_LENGTHS, VARIANT

WINDOW_SIZE = 3_000_000
WINDOW_STEP = 1_000_000

# Largest tile of the panel for the correlation kernel, in rows and in variants.
TILE_CARRIERS = 250_000
TILE_VARIANTS = 1_000
SAMPLE_BLOCK = 16_384


def grch38_lengths(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GRCH38_CHROM_LENGTHS.items()), "chrom string, length int")


def _whole(df: DataFrame, column: str) -> str:
    """The type of whole numbers that hold a column of positions: 64 bits only where it has them."""
    return "bigint" if df.schema[column].dataType == LongType() else "int"


def ld_windows(lengths: DataFrame, size: int = WINDOW_SIZE, step: int = WINDOW_STEP) -> DataFrame:
    """Overlapping windows per chromosome: starts every ``step`` while the part of the
    window beyond its last step still lies inside the chromosome."""
    last = F.col("length") - (size - step) - 1
    whole = _whole(lengths, "length")
    return (
        lengths.filter(last >= 0)
        .select(
            "chrom",
            F.explode(F.sequence(F.lit(0).cast(whole), last.cast(whole), F.lit(step).cast(whole))).alias("start"),
        )
        .withColumn("end", F.col("start") + size)
    )


def panel_window_assign(
    panel: DataFrame, windows: DataFrame, size: int = WINDOW_SIZE, step: int = WINDOW_STEP
) -> DataFrame:
    """Each panel row once per window that covers it (both ends inclusive).

    Window starts lie on a grid, so the at most size / step + 1 candidates of a
    position are computed and matched by equality.
    """
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - size) / step)).cast("int")
    last = F.floor(F.col("pos") / step).cast("int")
    candidates = panel.withColumn("_step", F.explode(F.sequence(first, last)))
    candidates = candidates.withColumn("start", F.col("_step").cast(_whole(windows, "start")) * step).drop("_step")
    return candidates.join(broadcast_if_small(windows), ["chrom", "start"])


def signal_window_lookup(
    signals: DataFrame, windows: DataFrame, step: int = WINDOW_STEP
) -> DataFrame:
    """The window to use for each signal: the one that starts a step before the lead's
    own step, else the first existing one of the two before it. Null if none exists."""
    own = F.greatest(F.lit(1), F.floor(F.col("lead_pos") / step)).cast(_whole(windows, "start"))
    candidates = signals.select(
        "sid",
        F.col("lead_chrom").alias("chrom"),
        F.explode(F.array(*[(own - 1 - back) * step for back in range(3)])).alias("start"),
    )
    found = (
        candidates.join(broadcast_if_small(windows), ["chrom", "start"])
        .groupBy("sid")
        .agg(F.max_by(F.struct("start", "end"), "start").alias("w"))
        .select("sid", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    )
    return signals.join(found, "sid", "left")


def index_variants(coloc: DataFrame) -> DataFrame:
    """Distinct left lead variants of a result table."""
    return coloc.select(*[F.col(f"left_{c}").alias(c) for c in VARIANT]).distinct()


def variant_vectors(panel: DataFrame) -> DataFrame:
    """One row per variant with its carriers; at most one entry per panel sample."""
    carrier = F.struct("sample_id", F.col("dosage").cast("float").alias("dosage"))
    return (
        panel.groupBy(*VARIANT)
        .agg(F.collect_list(carrier).alias("c"))
        .select(*VARIANT, F.col("c.sample_id").alias("samples"), F.col("c.dosage").alias("dosages"))
    )


def _tiles(vectors: DataFrame, tile_bp: int) -> DataFrame:
    """Variants with tile and sub-tile. Crowded tiles get as many sub-tiles as keep each
    within the tile limits."""
    tiled = vectors.withColumn("tile", F.floor(F.col("pos") / tile_bp).cast("int"))
    crowded = (
        tiled.groupBy("chrom", "tile")
        .agg(F.sum(F.size("samples")).alias("n"), F.count(F.lit(1)).alias("v"))
        .select(
            "chrom",
            "tile",
            F.greatest(
                F.ceil(F.col("n") / TILE_CARRIERS), F.ceil(F.col("v") / TILE_VARIANTS)
            ).cast("int").alias("subs"),
        )
        .filter("subs > 1")
    )
    # every entry stands for a full tile's worth of carriers or variants
    return tiled.join(F.broadcast(crowded), ["chrom", "tile"], "left").select(
        *vectors.columns,
        "tile",
        F.pmod(F.xxhash64(*VARIANT), F.coalesce("subs", F.lit(1))).cast("int").alias("sub"),
    )


def _dosages(tile: pd.DataFrame, samples: np.ndarray):
    """Dosage sums per variant of a tile, and its dosages for a range of samples."""
    rows = np.repeat(np.arange(len(tile)), [len(x) for x in tile["samples"]])
    cols = np.searchsorted(samples, np.concatenate(tile["samples"].to_list()))
    dosage = np.concatenate(tile["dosages"].to_list()).astype(np.float32)
    total = np.bincount(rows, weights=dosage, minlength=len(tile))
    squares = np.bincount(rows, weights=dosage * dosage, minlength=len(tile))

    def block(lo: int, hi: int) -> np.ndarray:
        inside = (cols >= lo) & (cols < hi)
        out = np.zeros((len(tile), hi - lo), dtype=np.float32)
        out[rows[inside], cols[inside] - lo] = dosage[inside]
        return out

    return total, squares, block


def _tile_correlations(n_samples: int, window_bp: int, min_r2: float):
    """Correlations between the index variants of one tile and the variants of another."""
    names = ["chrom", "lead_pos", "lead_ref", "lead_alt", "tag_pos", "tag_ref", "tag_alt", "r"]

    def run(index: pd.DataFrame, tags: pd.DataFrame) -> pd.DataFrame:
        if index.empty or tags.empty:
            return pd.DataFrame({c: [] for c in names})
        tags = tags.rename(columns=lambda c: c.removeprefix("tag_"))
        samples = np.unique(np.concatenate([*index["samples"], *tags["samples"]]))
        isum, isq, iblock = _dosages(index, samples)
        tsum, tsq, tblock = _dosages(tags, samples)
        shared = np.zeros((len(index), len(tags)))
        for lo in range(0, len(samples), SAMPLE_BLOCK):
            hi = min(lo + SAMPLE_BLOCK, len(samples))
            shared += iblock(lo, hi) @ tblock(lo, hi).T
        cov = n_samples * shared - np.outer(isum, tsum)
        var = np.outer(n_samples * isq - isum * isum, n_samples * tsq - tsum * tsum)
        with np.errstate(divide="ignore", invalid="ignore"):
            r = cov / np.sqrt(var)
        gap = np.abs(np.subtract.outer(index["pos"].to_numpy(), tags["pos"].to_numpy()))
        i, j = np.nonzero((var > 0) & (gap <= window_bp) & (r * r >= min_r2))
        out = {"chrom": np.repeat(index["chrom"].iat[0], len(i))}
        out |= {f"lead_{c}": index[c].to_numpy()[i] for c in VARIANT[1:]}
        out |= {f"tag_{c}": tags[c].to_numpy()[j] for c in VARIANT[1:]}
        return pd.DataFrame({**out, "r": r[i, j]})

    return run


def panel_size(samples: DataFrame) -> int:
    """Number of samples in a sample list. A panel in long form leaves out samples that carry
    nothing, so its own rows are a list only if every sample carries something."""
    return samples.select("sample_id").distinct().count()


def ld_pairs(
    index: DataFrame,
    panel: DataFrame,
    window_kb: int,
    min_r2: float = 0.05,
    n_samples: int | None = None,
    tags: DataFrame | None = None,
) -> DataFrame:
    """Correlation of each index variant with every variant within ``window_kb``.

    ``n_samples`` is the number of samples in the panel, with those that carry nothing. ``tags``
    names the variants wanted besides the index variants; without it all of the panel are.

    Returns ``lead_{chrom,pos,ref,alt}, tag_{...}, r, r2`` for r2 >= ``min_r2``,
    each index variant itself included; variants without variation have no row.

    Spark cuts the panel into tiles as wide as the window, crowded ones into sub-tiles
    of bounded size, and brings every tile of index variants together with its own and
    the two next to it; a task multiplies two dosage blocks.
    The alternative, joining carriers sample by sample, would shuffle one row per
    sample and pair of variants. Dosage sums are exact integers either way.
    """
    if n_samples is None:
        raise ValueError("the number of samples in the panel is needed")
    window_bp = tile_bp = 1000 * window_kb
    wanted = index.select(*VARIANT).distinct()
    if tags is not None:
        panel = panel.join(tags.select(*VARIANT).union(wanted).distinct(), VARIANT, "left_semi")
    vectors = variant_vectors(panel)
    tiled = _tiles(vectors, tile_bp)
    # index variants are cut by their own number, so that few of them make few chunks and each
    # sub-tile of the panel is sent to these only
    index_rows = _tiles(vectors.join(wanted, VARIANT, "left_semi"), tile_bp)

    near = (
        index_rows.select("chrom", "tile", "sub")
        .distinct()
        .withColumn("tile2", F.explode(F.sequence(F.col("tile") - 1, F.col("tile") + 1)))
    )
    present = tiled.select(
        "chrom", F.col("tile").alias("tile2"), F.col("sub").alias("sub2")
    ).distinct()
    meets = near.join(present, ["chrom", "tile2"])
    cell = ["chrom", "tile", "sub", "tile2", "sub2"]
    whole = _whole(panel, "pos")
    left = index_rows.join(meets, ["chrom", "tile", "sub"])
    right = tiled.withColumnsRenamed({"tile": "tile2", "sub": "sub2"}).join(
        meets, ["chrom", "tile2", "sub2"]
    )
    # both sides come from the same panel: rename one so that columns stay apart
    right = right.select(*[F.col(c).alias(f"tag_{c}") for c in right.columns])
    found = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*[f"tag_{c}" for c in cell]))
        .applyInPandas(
            _tile_correlations(n_samples, window_bp, min_r2),
            f"chrom string, lead_pos {whole}, lead_ref string, lead_alt string,"
            f" tag_pos {whole}, tag_ref string, tag_alt string, r double",
        )
    )
    return found.select(
        F.col("chrom").alias("lead_chrom"),
        "lead_pos",
        "lead_ref",
        "lead_alt",
        F.col("chrom").alias("tag_chrom"),
        "tag_pos",
        "tag_ref",
        "tag_alt",
        "r",
        (F.col("r") * F.col("r")).alias("r2"),
    )


def to_ld_file(ld: DataFrame) -> DataFrame:
    """The four-column form LD tables are exchanged in."""
    vid = lambda p: to_ld_variant_id(variant_id(*[f"{p}_{c}" for c in VARIANT]))
    return ld.select(
        vid("lead").alias("index_variant_id"),
        vid("tag").alias("tag_variant_id"),
        F.col("r").alias("R_EUR"),
        F.col("r2").alias("R2_EUR"),
    )


def parse_ld(ld_file: DataFrame, far: bool = False) -> DataFrame:
    """LD file rows with both variant ids split into their parts."""
    return ld_file.select(
        "R_EUR",
        "R2_EUR",
        *parse_variant_id(F.col("index_variant_id"), "lead", far=far),
        *parse_variant_id(F.col("tag_variant_id"), "tag", far=far),
    )
