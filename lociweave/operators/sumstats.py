"""Selecting each signal's summary statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import (
    eaf_to_maf,
    in_window,
    is_number,
    maf_at_least,
    variant_id,
)
from lociweave.operators.keyfilter import KeyFilter
from lociweave.operators.skew import hashed_join
from lociweave.schemas import SUMSTATS, VARIANT

# Positions are joined by bucket first; finer than the windows, so that few rows
# outside a window are ever paired with it.
BUCKET_BP = 250_000

# Which of phenotype and bio-feature a signal gives.
PATTERNS = ("--", "p-", "-b", "pb")


def select_sumstats(
    sumstats: DataFrame,
    study_id: str,
    phenotype_id: str | None = None,
    bio_feature: str | None = None,
    chrom: str | None = None,
    start: int | None = None,
    end: int | None = None,
    min_maf: float | None = None,
) -> DataFrame:
    """One dataset's rows. An omitted phenotype or bio-feature matches any value.

    All predicates are plain comparisons, so they become partition filters and
    Parquet row-group filters.
    """
    out = sumstats.select(*SUMSTATS.names).filter(F.col("study_id") == study_id)
    if phenotype_id:
        out = out.filter(F.col("phenotype_id") == phenotype_id)
    if bio_feature:
        out = out.filter(F.col("bio_feature") == bio_feature)
    if chrom:
        out = out.filter(F.col("chrom") == str(chrom))
    if start:
        out = out.filter(F.col("pos") >= start)
    if end:
        out = out.filter(F.col("pos") <= end)
    if min_maf:
        out = out.filter(maf_at_least(F.col("eaf"), min_maf))
    return out.withColumn("variant_id", variant_id())


def filter_min_maf(sumstats: DataFrame, min_maf: float = 0.01) -> DataFrame:
    return sumstats.filter(maf_at_least(F.col("eaf"), min_maf))


def filter_null_beta(sumstats: DataFrame) -> DataFrame:
    return sumstats.filter(is_number(F.col("beta")))


def add_maf(sumstats: DataFrame) -> DataFrame:
    return sumstats.withColumn("maf", eaf_to_maf(F.col("eaf")))


def _wildcard_keys(phenotype, bio_feature):
    """Which optional keys a signal gives, as a two-letter pattern."""
    return F.concat(
        F.when(phenotype.isNull(), "-").otherwise("p"),
        F.when(bio_feature.isNull(), "-").otherwise("b"),
    )


def window_join(
    signals: DataFrame,
    rows: DataFrame,
    window_kb: int | Column,
    min_maf: float | None = None,
    bucket_bp: int = BUCKET_BP,
) -> DataFrame:
    """Each signal's dataset rows within ``window_kb`` of its lead variant.

    ``window_kb`` is a number or a column over ``signals``.
    Returns ``sid``, ``lead_pos`` and the columns of ``rows`` that are not dataset
    keys. ``rows`` is any per-dataset variant table (summary statistics, top loci).

    A null phenotype or bio-feature of the signal is a wildcard. To keep that an
    equi-join, signals are keyed by the pattern of keys they give, and a row has a candidate
    key for each of the four patterns; those that no signal has are dropped at once.

    Signals are copied to the position buckets their window touches; a row has
    exactly one bucket. One filter of fixed size holds what signals touch: studies with
    chromosomes, which leaves out whole directories of a table laid out by them, buckets of
    these, and full keys. So only rows near a window of their own dataset are shuffled, the
    plan is the same at every size, and no job runs while it is built. Hot buckets are left
    to the adaptive skew join, which can split the large side because nothing above relies on
    this join's partitioning.
    """
    half = F.lit(window_kb) if isinstance(window_kb, int) else window_kb
    lo, hi = F.col("lead_pos") - F.col("span"), F.col("lead_pos") + F.col("span")
    keyed = signals.select(
        "sid",
        "study_id",
        F.col("lead_chrom").alias("chrom"),
        "lead_pos",
        (1000 * half).alias("span"),
        _wildcard_keys(F.col("phenotype_id"), F.col("bio_feature")).alias("pattern"),
        F.coalesce("phenotype_id", F.lit("")).alias("pk"),
        F.coalesce("bio_feature", F.lit("")).alias("bk"),
    ).withColumn(
        "bucket",
        F.explode(
            F.sequence(
                F.floor(lo / bucket_bp).cast("int"), F.floor(hi / bucket_bp).cast("int")
            )
        ),
    )
    payload = [c for c in rows.columns if c not in ("type", "study_id", "phenotype_id", "bio_feature")]
    if min_maf:
        rows = rows.filter(maf_at_least(F.col("eaf"), min_maf))
    place, near = ["study_id", "chrom"], ["study_id", "chrom", "bucket"]
    on = ["study_id", "pattern", "pk", "bk", "chrom", "bucket"]
    touched = KeyFilter(keyed, {"place": place, "near": near, "key": on})
    sources = (
        rows.filter(touched.passes("place", place))
        .withColumn("bucket", F.floor(F.col("pos") / bucket_bp).cast("int"))
        .filter(touched.passes("near", near))
        .withColumn("pattern", F.explode(F.array(*[F.lit(p) for p in PATTERNS])))
        .withColumn("pk", F.when(F.col("pattern").startswith("p"), F.col("phenotype_id")).otherwise(""))
        .withColumn("bk", F.when(F.col("pattern").endswith("b"), F.col("bio_feature")).otherwise(""))
        .filter(touched.passes("key", on))
        .select(*on[:-2], "bucket", *payload)
    )
    return (
        hashed_join(keyed, sources, on)
        .filter(F.col("pos").between(lo, hi))
        .select("sid", "lead_pos", *payload)
    )


def extract_window(rows: DataFrame, window_kb: int) -> DataFrame:
    """Narrow rows that carry their signal's ``lead_pos`` to a smaller window."""
    return rows.filter(in_window(F.col("pos"), F.col("lead_pos"), window_kb))


def cond_list(signals: DataFrame, windowed: DataFrame, top_loci: DataFrame, window_kb: int) -> DataFrame:
    """Variants each signal has to be conditioned on.

    The other top loci of the same dataset that are among the signal's windowed
    variants; the signal's own lead is left out. One row per (sid, variant), with
    the variant's own statistics from ``windowed``, whose other rows a filter of fixed size leaves
    out before they are shuffled.
    """
    index = signals.select(
        "sid", *[F.col(f"lead_{c}").alias(f"own_{c}") for c in VARIANT]
    )
    loci = top_loci.select("study_id", "phenotype_id", "bio_feature", *VARIANT).distinct()
    others = (
        window_join(signals, loci, window_kb)
        .select("sid", *VARIANT)
        .distinct()
        .join(index, "sid")
        .filter(
            ~(
                (F.col("chrom") == F.col("own_chrom"))
                & (F.col("pos") == F.col("own_pos"))
                & (F.col("ref") == F.col("own_ref"))
                & (F.col("alt") == F.col("own_alt"))
            )
        )
        .select("sid", *VARIANT)
    )
    key = ["sid", *VARIANT]
    wanted = KeyFilter(others, {"lead": key})
    return hashed_join(windowed.filter(wanted.passes("lead", key)), others, key)
