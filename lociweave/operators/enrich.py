"""Adding effect sizes to results, and checking results against lead variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import none_to_null
from lociweave.operators.keyfilter import KeyFilter
from lociweave.operators.process import best_first, keep_rank
from lociweave.schemas import DEDUP_KEYS_ENRICHED, VARIANT

BETA_COLUMNS = {
    "beta": "left_var_right_study_beta",
    "se": "left_var_right_study_se",
    "pval": "left_var_right_study_pval",
    "is_cc": "left_var_right_isCC",
}


MATCHED = ["study_id", "phenotype_id", "bio_feature", *VARIANT]


def relevant_sumstats(coloc: DataFrame, sumstats: DataFrame) -> DataFrame:
    """Statistics rows that can match a left lead variant in the right dataset.

    The statistics are by far the larger table. A filter over the keys of the results drops rows
    while scanning, and whole directories of other studies and chromosomes where the table is laid
    out by them. Few rows without a match may pass.
    """
    keys = coloc.select(
        F.col("right_study").alias("study_id"),
        F.col("right_phenotype").alias("phenotype_id"),
        F.col("right_bio_feature").alias("bio_feature"),
        *[F.col(f"left_{c}").alias(c) for c in VARIANT],
    ).select(*[F.col(c).cast(sumstats.schema[c].dataType).alias(c) for c in MATCHED])
    place = ["study_id", "chrom"]
    wanted = KeyFilter(keys, {"place": place, "row": MATCHED})
    return sumstats.filter(wanted.passes("place", place)).filter(wanted.passes("row", MATCHED))


def join_betas(coloc: DataFrame, sumstats: DataFrame) -> DataFrame:
    """Effect of the *left* lead variant in the *right* dataset (left join)."""
    stats = relevant_sumstats(coloc, sumstats).select(
        *[F.col(c).alias(f"_{c}") for c in [*VARIANT, "study_id", "phenotype_id", "bio_feature"]],
        *[F.col(c).alias(new) for c, new in BETA_COLUMNS.items()],
    )
    match = (
        (coloc["right_study"] == stats["_study_id"])
        & coloc["right_phenotype"].eqNullSafe(stats["_phenotype_id"])
        & coloc["right_bio_feature"].eqNullSafe(stats["_bio_feature"])
    )
    for c in VARIANT:
        match = match & (coloc[f"left_{c}"] == stats[f"_{c}"])
    return coloc.join(stats, match, "left").select(*coloc.columns, *BETA_COLUMNS.values())


def _order(df: DataFrame):
    rest = ["left_pos", "left_ref", "left_alt", "left_var_right_study_pval", "left_var_right_study_beta"]
    return [*best_first(df), *[F.asc(c) for c in rest]]


def dedup_keep_rank(
    df: DataFrame, rank: int, keys: list[str] = DEDUP_KEYS_ENRICHED
) -> DataFrame:
    return keep_rank(df, keys, _order(df), rank)


def keep_duplicates(df: DataFrame, keys: list[str] = DEDUP_KEYS_ENRICHED) -> DataFrame:
    """The second row of every duplicated test, for auditing."""
    return dedup_keep_rank(df, 2, keys)


def enrich(
    coloc: DataFrame, sumstats: DataFrame, keys: list[str] = DEDUP_KEYS_ENRICHED
) -> tuple[DataFrame, DataFrame]:
    """(results with effect sizes, audit of duplicates)."""
    merged = join_betas(coloc, sumstats)
    return dedup_keep_rank(merged, 1, keys), keep_duplicates(merged, keys)


def rows_added(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many rows a join has added; more than none means duplicates in its input."""
    signed = before.select(F.lit(-1).alias("n")).unionAll(after.select(F.lit(1).alias("n")))
    return signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_added"))


def filter_top_loci_match(
    coloc: DataFrame, top_loci: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(tests whose both leads are listed top loci, number of tests left out)."""
    loci = top_loci.select(
        "study_id",
        none_to_null(F.col("phenotype_id")).alias("phenotype_id"),
        none_to_null(F.col("bio_feature")).alias("bio_feature"),
        *VARIANT,
    ).distinct()
    kept = coloc
    for side in ("left", "right"):
        match = (
            (kept[f"{side}_study"] == loci["study_id"])
            & none_to_null(kept[f"{side}_phenotype"]).eqNullSafe(loci["phenotype_id"])
            & none_to_null(kept[f"{side}_bio_feature"]).eqNullSafe(loci["bio_feature"])
        )
        for c in VARIANT:
            match = match & (kept[f"{side}_{c}"] == loci[c])
        kept = kept.join(loci, match, "left_semi")
    counts = coloc.select(F.lit(1).alias("n")).unionAll(kept.select(F.lit(-1).alias("n")))
    return kept, counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_filtered_out"))
