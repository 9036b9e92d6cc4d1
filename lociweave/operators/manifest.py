"""From overlapping pairs to the list of tests that still have to be run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import (
    ld_eligible,
    none_to_null,
    null_safe_equal,
    signal_id,
    study_class,
)
from lociweave.schemas import MANIFEST_KEYS, SIGNAL, both_sides

NULLABLE = both_sides(["phenotype_id", "bio_feature"])


def filter_overlap_prop(overlap: DataFrame, threshold: float | None = 0.01) -> DataFrame:
    if not threshold:
        return overlap
    return overlap.filter(F.greatest("left_overlap_prop", "right_overlap_prop") >= threshold)


def filter_credset_size(overlap: DataFrame, max_size: int | None = None) -> DataFrame:
    if not max_size:
        return overlap
    return overlap.filter(F.greatest("left_num_tags", "right_num_tags") <= max_size)


def filter_custom_studies(overlap: DataFrame, studies: DataFrame | None) -> DataFrame:
    """Overlaps whose left or right study is listed in ``studies.study_id``."""
    if studies is None:
        return overlap
    listed = studies.select("study_id").distinct()
    left = listed.select(F.col("study_id").alias("left_study_id"), F.lit(True).alias("_l"))
    right = listed.select(F.col("study_id").alias("right_study_id"), F.lit(True).alias("_r"))
    return (
        overlap.join(left, "left_study_id", "left")
        .join(right, "right_study_id", "left")
        .filter(F.col("_l").isNotNull() | F.col("_r").isNotNull())
        .select(*overlap.columns)
    )


def manifest_build(
    overlap: DataFrame, method: str = "conditional", no_ld_prefix: str = "FINNGEN"
) -> DataFrame:
    """One row per test: both signals, sumstat class and LD eligibility per side."""
    ids = [c for c in ("left_sid", "right_sid") if c in overlap.columns]
    derived = []
    for s in ("left", "right"):
        derived.append(study_class(F.col(f"{s}_type")).alias(f"{s}_study_class"))
        derived.append(ld_eligible(F.col(f"{s}_study_id"), no_ld_prefix).alias(f"{s}_has_ld"))
    return overlap.select(*ids, *both_sides(SIGNAL), *derived, F.lit(method).alias("method"))


def previous_tests(coloc: DataFrame) -> DataFrame:
    """Distinct tests of an earlier result table, in manifest column names."""
    names = {"study": "study_id", "phenotype": "phenotype_id", "bio_feature": "bio_feature"}
    names |= {c: f"lead_{c}" for c in ("chrom", "pos", "ref", "alt")}
    cols = []
    for s in ("left", "right"):
        for old, new in names.items():
            col = F.col(f"{s}_{old}")
            if old in ("phenotype", "bio_feature"):
                col = none_to_null(col)
            cols.append(col.alias(f"{s}_{new}"))
    return coloc.select(*cols).distinct()


def manifest_anti_previous(manifest: DataFrame, coloc: DataFrame | None) -> DataFrame:
    """Drop tests that an earlier result table already holds (null matches null)."""
    if coloc is None:
        return manifest
    clean = manifest.withColumns({c: none_to_null(F.col(c)) for c in NULLABLE})
    done = previous_tests(coloc)
    return clean.join(
        done, null_safe_equal(clean, done, [(c, c) for c in MANIFEST_KEYS]), "left_anti"
    )


def distinct_signals(manifest: DataFrame, only_type: str | None = None) -> DataFrame:
    """Every signal once, however many tests use it."""
    sides = []
    for s in ("left", "right"):
        sides.append(
            manifest.select(
                *[F.col(f"{s}_{c}").alias(c) for c in SIGNAL], F.col(f"{s}_has_ld").alias("has_ld")
            )
        )
    out = sides[0].unionByName(sides[1])
    if only_type is not None:
        out = out.filter(F.col("type") == only_type)
    return out.distinct().withColumn("sid", signal_id())


def pending_signals(signals: DataFrame, finished: DataFrame) -> DataFrame:
    """Signals without cached summary statistics."""
    return signals.join(finished.select("sid").distinct(), "sid", "left_anti")


def finished_signals(signals: DataFrame, finished: DataFrame) -> DataFrame:
    return signals.join(finished.select("sid").distinct(), "sid", "left_semi")
