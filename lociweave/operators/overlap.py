"""Which pairs of association signals share a credible-set variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import none_to_null, signal_id, signal_key, variant_id
from lociweave.operators.skew import grid_join
from lociweave.schemas import LEAD, SIGNAL, TAG


def filter_credset(credset: DataFrame, which: str = "95") -> DataFrame:
    """Rows in the 95 % or 99 % credible set."""
    if which not in ("95", "99"):
        raise ValueError("which must be '95' or '99'")
    return credset.filter(F.col(f"is{which}_credset"))


def filter_method(credset: DataFrame, method: str = "all") -> DataFrame:
    if method not in ("all", "conditional", "distance"):
        raise ValueError("method must be 'all', 'conditional' or 'distance'")
    return credset if method == "all" else credset.filter(F.col("multisignal_method") == method)


def tag_counts(credset: DataFrame) -> DataFrame:
    """One row per signal: identity, key and number of tag variants."""
    return (
        credset.groupBy(*SIGNAL)
        .agg(F.count("tag_chrom").alias("num_tags"))
        .select(signal_id().alias("sid"), signal_key().alias("key"), *SIGNAL, "num_tags")
    )


def shared_tags(credset: DataFrame, max_dist: int | None = None) -> DataFrame:
    """(left_sid, right_sid, weight) for every tag two comparable signals share.

    One side is always a GWAS, so the join is GWAS rows against all rows: pairs of
    two molecular traits, the bulk of a square self-join, are never formed. The
    residual predicates (different study, upper triangle, lead distance) run inside
    the join. Tags that thousands of signals share are split by ``grid_join``;
    repeated rows are collapsed to a weight first.
    """
    rows = (
        credset.select(
            signal_id().alias("sid"),
            signal_key().alias("key"),
            (F.col("type") == "gwas").alias("is_gwas"),
            "study_id",
            "lead_pos",
            *TAG,
        )
        .groupBy("sid", "key", "is_gwas", "study_id", "lead_pos", *TAG)
        .agg(F.count(F.lit(1)).alias("w"))
    )

    def side(df: DataFrame, p: str) -> DataFrame:
        names = ["sid", "key", "is_gwas", "study_id", "lead_pos", "w"]
        return df.select(*TAG, *[F.col(c).alias(f"{p}_{c}") for c in names])

    gwas, other = side(rows.filter("is_gwas"), "g"), side(rows, "o")
    keep = (F.col("g_study_id") != F.col("o_study_id")) & (
        # two GWAS signals meet twice, once from each side: keep one meeting
        F.when(F.col("o_is_gwas"), F.col("g_key") > F.col("o_key")).otherwise(
            F.col("g_key") != F.col("o_key")
        )
    )
    if max_dist:
        keep = keep & (F.abs(F.col("g_lead_pos") - F.col("o_lead_pos")) <= max_dist)

    gwas_is_left = F.col("g_key") > F.col("o_key")
    return grid_join(gwas, other, TAG, keep).select(
        F.when(gwas_is_left, F.col("g_sid")).otherwise(F.col("o_sid")).alias("left_sid"),
        F.when(gwas_is_left, F.col("o_sid")).otherwise(F.col("g_sid")).alias("right_sid"),
        (F.col("g_w") * F.col("o_w")).alias("weight"),
    )


def overlap_counts(credset: DataFrame, max_dist: int | None = None) -> DataFrame:
    """(left_sid, right_sid, num_overlapping) per pair of signals."""
    return (
        shared_tags(credset, max_dist)
        .groupBy("left_sid", "right_sid")
        .agg(F.sum("weight").alias("num_overlapping"))
    )


def attach_signals(pairs: DataFrame, signals: DataFrame, cols) -> DataFrame:
    """Add ``left_<col>`` and ``right_<col>`` of each pair's signals."""
    for side in ("left", "right"):
        named = signals.select(
            F.col("sid").alias(f"{side}_sid"), *[F.col(c).alias(f"{side}_{c}") for c in cols]
        )
        pairs = pairs.join(named, f"{side}_sid")
    return pairs


def overlap_table(
    credset: DataFrame,
    which: str = "95",
    method: str = "all",
    max_dist: int | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """The overlap table: both signals, counts and overlap proportions."""
    chosen = filter_method(filter_credset(credset, which), method)
    pairs = attach_signals(
        overlap_counts(chosen, max_dist), tag_counts(chosen), [*SIGNAL, "num_tags"]
    )
    out = pairs.withColumns(
        {
            f"{s}_overlap_prop": F.col("num_overlapping") / F.col(f"{s}_num_tags")
            for s in ("left", "right")
        }
    )
    cols = [f"{s}_{c}" for s in ("left", "right") for c in SIGNAL] + [
        "num_overlapping",
        "left_num_tags",
        "right_num_tags",
        "left_overlap_prop",
        "right_overlap_prop",
    ]
    return out.select(*(["left_sid", "right_sid"] if with_ids else []), *cols)


def lead_pvals(top_loci: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest p-value per key, so that joining it cannot multiply rows."""
    nullable = [k for k in keys if k in ("phenotype_id", "bio_feature")]
    clean = top_loci.withColumns({k: none_to_null(F.col(k)) for k in nullable})
    return clean.groupBy(*keys).agg(F.min("pval").alias("pval"))


def overlap_low_p(overlap: DataFrame, top_loci: DataFrame, below_p: float = 1e-300) -> DataFrame:
    """Overlaps where at least one lead variant has p < ``below_p``.

    The left lead is looked up by study and variant, the right one by its whole
    dataset, with a null phenotype or bio-feature matching null.
    """
    low = top_loci.filter(F.col("pval") < below_p)
    lead = lambda s: variant_id(*[f"{s}_{c}" for c in LEAD])
    out = overlap.withColumns({"_lv": lead("left"), "_rv": lead("right")})
    left = lead_pvals(low, ["study_id", "variant_id"]).withColumnRenamed("pval", "left_pval")
    right = lead_pvals(
        low, ["study_id", "variant_id", "phenotype_id", "bio_feature"]
    ).withColumnRenamed("pval", "right_pval")
    out = out.join(
        left,
        (out["left_study_id"] == left["study_id"]) & (out["_lv"] == left["variant_id"]),
        "left",
    ).select(out["*"], "left_pval")
    out = out.join(
        right,
        (out["right_study_id"] == right["study_id"])
        & (out["_rv"] == right["variant_id"])
        & out["right_phenotype_id"].eqNullSafe(right["phenotype_id"])
        & out["right_bio_feature"].eqNullSafe(right["bio_feature"]),
        "left",
    ).select(out["*"], "right_pval")
    hit = F.col("left_pval").isNotNull() | F.col("right_pval").isNotNull()
    return out.filter(hit).drop("_lv", "_rv", "left_pval", "right_pval")
