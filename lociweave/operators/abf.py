"""Approximate-Bayes-factor colocalisation of all pairs at once.

Per pair and shared variant, with V = se^2, z = beta / se and a prior sd W:

    r = W^2 / (W^2 + V),  lABF = (ln(1 - r) + r z^2) / 2

The five hypotheses need only log-sum-exps of lABF per pair, so the whole test is
grouped sums. W is 0.2 for case-control data and 0.15 sdY for quantitative traits,
with sdY estimated from the pair's shared variants.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.functions.scalars import eaf_to_maf, is_number
from lociweave.functions.stats import z_from_p
from lociweave.operators.skew import grid_join, hashed_join
from lociweave.operators.sumstats import filter_null_beta
from lociweave.schemas import VARIANT

PAIR = ["left_sid", "right_sid"]

# A cell: pairs of one region whose signals a task holds together.
CELL = ["region", "left_strip", "right_strip"]

# Signals' rows that a cell holds at most on each side (a single signal may have more).
ROWS_PER_CELL = 500_000

# Pairs are grouped by where their left signal begins; signals travel in stretches.
REGION_BP = 1_000_000
BLOCK_BP = 250_000
BLOCK_COLUMNS = ["key", "pos", "v", "z", "h"]

# Width of an exponent bucket. exp() of anything inside half a bucket of its
# centre is far from overflow and underflow.
EXP_BUCKET = 256.0


def study_type_prop(reduced: DataFrame) -> DataFrame:
    """Per signal: N, whether it is case-control, the case proportion and row count.

    Taken from the signal's first row by position, then by a hash of the alleles. The
    order is one number, which keeps this a hash aggregation: ordering by a struct
    would sort all rows. ``region`` is a number for where the signal begins.
    """
    # 28 bits of the hash leave 35 for the position and one for the sign
    allele = F.shiftright(F.xxhash64("ref", "alt").bitwiseAND(F.lit(0xFFFFFFFF)), 4)
    order = F.shiftleft(F.col("pos").cast("long"), 28) + allele
    cases = F.least(F.col("n_cases"), F.col("n") - F.col("n_cases"))
    return (
        filter_null_beta(reduced)
        .groupBy("sid")
        .agg(
            F.min_by("n_total", order).alias("n"),
            F.min_by("n_cases", order).alias("n_cases"),
            F.min_by("is_cc", order).alias("is_cc"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min(F.xxhash64("chrom")).alias("chrom"),
            F.min("pos").alias("pos"),
        )
        .select(
            "sid",
            "n_rows",
            F.xxhash64("chrom", F.floor(F.col("pos") / REGION_BP)).alias("region"),
            "n",
            F.coalesce("is_cc", F.lit(False)).alias("is_cc"),
            F.try_divide(cases, F.col("n")).alias("s"),
        )
    )


def is_usable() -> Column:
    """Whether the test can use a row: known beta, positive standard error, 0 < maf < 1."""
    maf = eaf_to_maf(F.col("eaf"))
    return (
        is_number(F.col("beta"))
        & is_number(F.col("se"))
        & (F.col("se") > 0)
        & is_number(F.col("eaf"))
        & (maf > 0)
        & (maf < 1)
    )


def usable_rows(reduced: DataFrame) -> DataFrame:
    """Rows the test can use, see :func:`is_usable`."""
    return reduced.filter(is_usable())


def unusable_rows(reduced: DataFrame) -> DataFrame:
    """Per signal, how many rows with a beta the test has to leave out."""
    return usable_counts(reduced).filter("n_unusable > 0")


def usable_counts(reduced: DataFrame) -> DataFrame:
    """Per signal: ``n_rows`` with a beta and how many of these the test leaves out
    (``n_unusable``), in one pass. A signal without any beta has zeros."""
    counts = reduced.groupBy("sid").agg(
        F.count_if(is_number(F.col("beta"))).alias("n_rows"), F.count_if(is_usable()).alias("n_used")
    )
    return counts.select("sid", "n_rows", (F.col("n_rows") - F.col("n_used")).alias("n_unusable"))


def harmonise_pair(
    pairs: DataFrame,
    reduced: DataFrame,
    cols=("beta", "se", "eaf"),
    right_reduced: DataFrame | None = None,
) -> DataFrame:
    """The variants both signals of a pair have, with both sides' statistics.

    ``pairs`` has the two signal ids; anything else it holds is kept. Each signal's
    rows are centred on its own lead. To centre both on the left lead, pass rows of a
    wider window as ``right_reduced``: the left rows then set the window. The first
    join is on the left signal, where one popular signal can meet very many pairs,
    so it is cut into cells; the second is on (right signal, variant).
    """
    left = reduced.select(
        F.col("sid").alias("left_sid"), *VARIANT, *[F.col(c).alias(f"left_{c}") for c in cols]
    )
    right = (reduced if right_reduced is None else right_reduced).select(
        F.col("sid").alias("right_sid"), *VARIANT, *[F.col(c).alias(f"right_{c}") for c in cols]
    )
    return hashed_join(grid_join(pairs, left, ["left_sid"]), right, ["right_sid", *VARIANT])


def sdy_estimate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Trait sd from varbeta, MAF and N: the slope of 2 N maf (1 - maf) on 1 / varbeta.

    ``rows`` needs ``se``, ``eaf`` and ``n_total``.
    """
    v = F.col("se") * F.col("se")
    maf = eaf_to_maf(F.col("eaf"))
    nvx = 2 * F.col("n_total") * maf * (1 - maf)
    return rows.groupBy(*keys).agg(F.sqrt(F.sum(nvx / v) / F.sum(1 / (v * v))).alias("sdy"))


def log_abf(v: Column, z: Column, prior_sd: Column) -> Column:
    w = prior_sd * prior_sd
    r = w / (w + v)
    return 0.5 * (F.log(v / (w + v)) + r * z * z)


def log_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: count and log-sum-exp of ``l1``, ``l2`` and ``l1 + l2``.

    A maximum would need a second pass over the rows. Instead each term is scaled
    by the centre of its exponent bucket, which is known from the term itself, and
    summed per bucket: an ordinary sum that combines before the shuffle. Nearly all
    rows share the bucket around zero; the few bucket sums of a key are then scaled
    to its largest bucket.
    """
    terms = {"1": F.col("l1"), "2": F.col("l2"), "12": F.col("l1") + F.col("l2")}
    bucket = lambda t: F.floor(t / EXP_BUCKET + 0.5)
    scaled = rows.select(
        *keys,
        *[bucket(t).alias(f"b{k}") for k, t in terms.items()],
        *[F.exp(t - EXP_BUCKET * bucket(t)).alias(f"e{k}") for k, t in terms.items()],
    )
    sums = scaled.groupBy(*keys, "b1", "b2", "b12").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"e{k}").alias(f"e{k}") for k in terms]
    )
    w = Window.partitionBy(*keys)
    top = sums.withColumns({f"t{k}": F.max(f"b{k}").over(w) for k in terms})
    return top.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[
            (
                F.log(F.sum(F.col(f"e{k}") * F.exp(EXP_BUCKET * (F.col(f"b{k}") - F.col(f"t{k}")))))
                + EXP_BUCKET * F.max(f"t{k}")
            ).alias(f"s{k}")
            for k in terms
        ],
    )


def posteriors(sums: DataFrame, p1: float, p2: float, p12: float) -> DataFrame:
    """Replace ``n``, ``s1``, ``s2``, ``s12`` by the number of variants and H0..H4."""
    s1, s2, s12 = F.col("s1"), F.col("s2"), F.col("s12")
    lit_log = lambda p: F.log(F.lit(float(p)))
    # With a single shared variant S1 + S2 = S12 and H3 is impossible.
    distinct = s1 + s2 - s12
    out = sums.withColumns(
        {
            "h0": F.lit(0.0),
            "h1": lit_log(p1) + s1,
            "h2": lit_log(p2) + s2,
            "h3": F.when(
                (F.col("n") > 1) & (distinct > 0),
                lit_log(p1) + lit_log(p2) + s1 + s2 + F.log(-F.expm1(s12 - s1 - s2)),
            ),
            "h4": lit_log(p12) + s12,
        }
    )
    out = out.withColumn("_m", F.greatest("h0", "h1", "h2", "h3", "h4"))
    hs = ["h0", "h1", "h2", "h3", "h4"]
    out = out.withColumns({h: F.coalesce(F.exp(F.col(h) - F.col("_m")), F.lit(0.0)) for h in hs})
    total = sum((F.col(h) for h in hs[1:]), F.col("h0"))
    out = out.withColumn("_t", total).withColumns(
        {f"coloc_{h}": F.col(h) / F.col("_t") for h in hs}
    )
    return out.withColumn("coloc_n_vars", F.col("n").cast("int")).drop(
        "n", "s1", "s2", "s12", "_m", "_t", *hs
    )


def coloc_abf(
    pairs: DataFrame,
    reduced: DataFrame,
    p1: float = 1e-4,
    p2: float = 1e-4,
    p12: float = 1e-5,
    rows_per_cell: int = ROWS_PER_CELL,
    right_reduced: DataFrame | None = None,
    keep=lambda df, name: df,
) -> DataFrame:
    """Five posteriors per pair: ``left_sid, right_sid, coloc_n_vars, coloc_h0..h4``.

    A signal's rows travel as column blocks, one row per signal and stretch of positions. Pairs are
    grouped by the region of their left signal, and each region's signals go there once, however
    many pairs they are in; a region with more rows than ``rows_per_cell`` on a side is cut into a
    grid of cells by signal. A task matches the sorted variants of two signals and hands on four
    numbers per pair, so what is shuffled does not grow with pairs times variants. A pair without
    shared variants has no row. ``keep`` may materialise the two small tables that several steps
    read: what is known of each signal and each pair's cell.
    """
    usable, info = usable_rows(reduced), keep(study_type_prop(reduced), "signal_info")
    sides = {"left": (info, usable), "right": (info, usable)}
    if right_reduced is not None:
        right_info = keep(study_type_prop(right_reduced), "signal_info")
        sides["right"] = (right_info, usable_rows(right_reduced))
    tests = keep(_in_cells(pairs, sides["left"][0], sides["right"][0], rows_per_cell), "tests")
    wanted = {
        side: tests.select(*CELL, F.col(f"{side}_sid").alias("sid")).distinct() for side in sides
    }
    if right_reduced is None:
        both = wanted["left"].union(wanted["right"]).distinct()
        shipped = both.join(column_blocks(usable), "sid").withColumn("side", F.lit("both"))
    else:
        shipped = reduce(
            DataFrame.unionByName,
            [
                wanted[side].join(column_blocks(rows), "sid").withColumn("side", F.lit(side))
                for side, (_, rows) in sides.items()
            ],
        )
    # both sides come from the pairs: rename one so that columns stay apart
    asked = tests.select(*[F.col(c).alias(f"test_{c}") for c in CELL], *PAIR, "left_k", "right_k")
    sums = (
        shipped.groupBy(*CELL)
        .cogroup(asked.groupBy(*[f"test_{c}" for c in CELL]))
        .applyInArrow(
            _cell_sums, "left_sid binary, right_sid binary, n long, s1 double, s2 double, s12 double"
        )
    )
    return posteriors(sums, p1, p2, p12)


def column_blocks(rows: DataFrame, block_bp: int = BLOCK_BP) -> DataFrame:
    """One row per signal and stretch of positions, with arrays of what the test needs: ``key``
    (a hash of the variant, whose position is compared too), ``pos``, ``v`` = se^2, ``z`` and
    ``h`` = 2 maf (1 - maf)."""
    maf = eaf_to_maf(F.col("eaf"))
    entry = F.struct(
        F.xxhash64(*VARIANT).alias("key"),
        F.col("pos"),
        (F.col("se") * F.col("se")).alias("v"),
        (F.col("beta") / F.col("se")).alias("z"),
        (2 * maf * (1 - maf)).alias("h"),
    )
    stretch = F.floor(F.col("pos") / block_bp).alias("block")
    return (
        rows.select("sid", stretch, entry.alias("e"))
        .groupBy("sid", "block")
        .agg(F.collect_list("e").alias("e"))
        .select("sid", *[F.col(f"e.{c}").alias(c) for c in BLOCK_COLUMNS])
    )


def _in_cells(pairs: DataFrame, left: DataFrame, right: DataFrame, rows_per_cell: int) -> DataFrame:
    """Distinct pairs with the cell that tests them and, per side, N where the prior depends on sdY
    (null for case-control data)."""
    tests = pairs.select(*PAIR).distinct()
    for side, info in (("left", left), ("right", right)):
        own = info.select(
            F.col("sid").alias(f"{side}_sid"),
            F.when(~F.col("is_cc"), F.col("n").cast("double")).alias(f"{side}_k"),
            F.col("n_rows").alias(f"{side}_rows"),
            *(["region"] if side == "left" else []),
        )
        tests = tests.join(own, f"{side}_sid")
    grid = None
    for side in ("left", "right"):
        rows = tests.select("region", f"{side}_sid", f"{side}_rows").distinct().groupBy("region")
        strips = F.ceil(F.sum(f"{side}_rows") / rows_per_cell).cast("int").alias(f"{side}_strips")
        own = rows.agg(strips)
        grid = own if grid is None else grid.join(own, "region")
    strip = {
        side: F.pmod(F.xxhash64(f"{side}_sid"), F.col(f"{side}_strips")).cast("int").alias(f"{side}_strip")
        for side in ("left", "right")
    }
    return tests.join(grid, "region").select(
        "region", strip["left"], strip["right"], *PAIR, "left_k", "right_k"
    )


def _signal_arrays(blocks: pa.Table) -> dict[tuple, tuple[np.ndarray, ...]]:
    """(side, sid) -> its columns, sorted by key."""
    parts: dict[tuple, list] = {}
    for batch in blocks.to_batches():
        columns = []
        for c in BLOCK_COLUMNS:
            lists = batch.column(c)
            columns.append((lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)))
        for i, name in enumerate(zip(batch.column("side").to_pylist(), batch.column("sid").to_pylist(), strict=True)):
            parts.setdefault(name, []).append([values[at[i] : at[i + 1]] for at, values in columns])
    out = {}
    for name, pieces in parts.items():
        joined = [np.concatenate(c) for c in zip(*pieces, strict=True)]
        order = np.argsort(joined[0], kind="stable")
        out[name] = tuple(c[order] for c in joined)
    return out


def _matches(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal variants in two signals, every combination of repeated ones."""
    if len(a[0]) > len(b[0]):
        ib, ia = _matches(b, a)
        return ia, ib
    first, last = np.searchsorted(b[0], a[0], "left"), np.searchsorted(b[0], a[0], "right")
    times = last - first
    ia = np.repeat(np.arange(len(times)), times)
    ib = np.arange(len(ia)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
    same = a[1][ia] == b[1][ib]
    return ia[same], ib[same]


def _log_factors(signal: tuple[np.ndarray, ...], at: np.ndarray, k: float | None) -> np.ndarray:
    v, z, h = (c[at] for c in signal[2:])
    prior = 0.2 if k is None else 0.15 * math.sqrt(k * np.sum(h / v) / np.sum(1 / (v * v)))
    w = prior * prior
    return 0.5 * (np.log(v / (w + v)) + w / (w + v) * z * z)


def _log_sum(x: np.ndarray) -> float:
    top = x.max()
    return float(top + np.log(np.exp(x - top).sum()))


def _cell_sums(blocks: pa.Table, tests: pa.Table) -> pa.Table:
    """Number of shared variants and the three log-sum-exps of every pair of a cell."""
    signals = _signal_arrays(blocks)
    found = []
    for pair in tests.select([*PAIR, "left_k", "right_k"]).to_pylist():
        own = [signals.get((side, pair[f"{side}_sid"])) or signals.get(("both", pair[f"{side}_sid"])) for side in ("left", "right")]
        if None in own:
            continue
        places = _matches(*own)
        if not len(places[0]):
            continue
        l1, l2 = (_log_factors(o, at, pair[f"{s}_k"]) for o, at, s in zip(own, places, ("left", "right"), strict=True))
        found.append((pair["left_sid"], pair["right_sid"], len(l1), _log_sum(l1), _log_sum(l2), _log_sum(l1 + l2)))
    columns = list(zip(*found, strict=True)) if found else [[]] * 6
    types = [pa.binary(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    names = [*PAIR, "n", "s1", "s2", "s12"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def pvalue_dataset(rows: DataFrame) -> DataFrame:
    """Effect scale for rows that only have p-values.

    ``rows`` needs ``pval``, ``eaf``, ``n_total``, ``is_cc`` and, where that is true, ``s`` (the
    case proportion). Adds ``z``, ``v`` and ``prior_sd``; the effect's variance is approximated
    from the allele frequency and N. Each row is taken by its own study's type; a null
    ``is_cc`` is a quantitative trait, as in :func:`study_type_prop`.
    """
    maf = eaf_to_maf(F.col("eaf"))
    per_sample = 2 * F.col("n_total") * maf * (1 - maf)
    cases = F.coalesce("is_cc", F.lit(False))
    informative = F.when(cases, per_sample * F.col("s") * (1 - F.col("s"))).otherwise(per_sample)
    return rows.withColumns(
        {
            "z": z_from_p(F.col("pval")),
            "v": F.try_divide(F.lit(1.0), informative),
            "prior_sd": F.when(cases, 0.2).otherwise(0.15),
        }
    )


def coloc_abf_pvalues(rows: DataFrame, keys: list[str], p1=1e-4, p2=1e-4, p12=1e-5) -> DataFrame:
    """Posteriors from harmonised rows whose sides carry ``z``, ``v`` and ``prior_sd``."""
    factors = rows.select(
        *keys,
        log_abf(F.col("left_v"), F.col("left_z"), F.col("left_prior_sd")).alias("l1"),
        log_abf(F.col("right_v"), F.col("right_z"), F.col("right_prior_sd")).alias("l2"),
    )
    return posteriors(log_sums(factors, keys), p1, p2, p12)
