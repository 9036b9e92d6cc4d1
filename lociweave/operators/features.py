"""LD-overlap features of signal pairs, to predict colocalisation without testing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import neg_log10_pval, none_to_null
from lociweave.operators.overlap import lead_pvals
from lociweave.operators.skew import grid_join
from lociweave.schemas import COLOC_KEYS, COLOC_SIGNAL, TAG, VARIANT, sided

# r2 thresholds of the overlap proportions, as they appear in names.
R2_THRESHOLDS = [
    "0.1", "0.2", "0.3", "0.4", "0.5", "0.6", "0.7",
    "0.75", "0.8", "0.85", "0.9", "0.95", "0.975", "1.0",
]

# Width of a place, tags of a strip and tags multiplied at once, when shared tags are counted.
PLACE_BP = 1_000_000
CELL_TAGS = 50_000
TAG_BLOCK = 4_096

FEATURE_COLUMNS = [
    "total_overlap",
    *[f"prop_overlap_{t}" for t in R2_THRESHOLDS],
    "left_num_tags",
    "right_num_tags",
    "left_prop_total_overlap",
    "right_prop_total_overlap",
    "abs_distance",
    "left_log_pval",
    "right_log_pval",
    "left_is_gwas",
    "right_is_gwas",
]


def feature_input_filter(coloc: DataFrame, min_vars: int = 200) -> DataFrame:
    """Tests with more than ``min_vars`` variants and a GWAS on the left."""
    keys = [c for c in COLOC_KEYS if c.endswith(("phenotype", "bio_feature"))]
    clean = coloc.withColumns({c: none_to_null(F.col(c)) for c in keys})
    return clean.filter((F.col("coloc_n_vars") > min_vars) & (F.col("left_type") == "gwas"))


def side_leads(coloc: DataFrame, side: str) -> DataFrame:
    return coloc.select(*sided(side, VARIANT)).distinct()


def ld_tags(coloc: DataFrame, ld: DataFrame, side: str) -> DataFrame:
    """LD tags of every distinct lead variant of one side, with their r2.

    Tags belong to lead variants: signals that share a lead share its tags, so the
    work below is done once per lead and not once per signal.
    """
    named = ld.select(
        *[F.col(f"lead_{c}").alias(f"{side}_{c}") for c in VARIANT],
        *TAG,
        F.col("r2").alias(f"{side}_R2_EUR"),
    )
    return named.join(side_leads(coloc, side), sided(side, VARIANT))


def signal_tags(coloc: DataFrame, ld: DataFrame, side: str) -> DataFrame:
    """LD tags of every distinct signal of one side."""
    signals = coloc.select(*sided(side, COLOC_SIGNAL)).distinct()
    return signals.join(ld_tags(coloc, ld, side), sided(side, VARIANT))


def ld_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tags that a left and a right lead variant have in common."""
    return grid_join(left, right, TAG)


def prop_overlap_at_r2(intersection: DataFrame, keys: list[str]) -> DataFrame:
    """Common tags per pair and the share of them tagged on both sides at each r2."""
    both = F.least("left_R2_EUR", "right_R2_EUR")
    known = F.col("left_R2_EUR").isNotNull() & F.col("right_R2_EUR").isNotNull()
    at_least = lambda t: F.count_if(known & (both >= float(t)))
    n = F.count("left_R2_EUR")
    return intersection.groupBy(*keys).agg(
        at_least("0").alias("total_overlap"),
        *[(at_least(t) / n).alias(f"prop_overlap_{t}") for t in R2_THRESHOLDS],
    )


def _strips(tags: DataFrame, side: str, counts: DataFrame) -> DataFrame:
    """Tags dealt into the strips of their place that the other side's strips meet them in."""
    names = [f"{side}_{c}" for c in VARIANT]
    other = "right" if side == "left" else "left"
    own, theirs = f"{side}_strip", f"{other}_strip"
    return tags.join(counts, "place").select(
        *names,
        # both sides come from the same table: names of their own keep the columns apart
        *[F.col(c).alias(f"{side}_{c}") for c in TAG],
        f"{side}_R2_EUR",
        "place",
        F.pmod(F.xxhash64(*names), F.col(f"{side}_n")).cast("int").alias(own),
        F.explode(F.sequence(F.lit(0), F.col(f"{other}_n") - 1)).alias(theirs),
    )


def _shared_tags(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each pair of leads of a cell, how many tags they share at each r2 threshold."""
    leads = {}
    for side, rows in (("left", left), ("right", right)):
        names = [f"{side}_{c}" for c in VARIANT]
        groups = rows.groupby(names, sort=True)
        leads[side] = (groups.ngroup().to_numpy(), groups.size().reset_index()[names])
    tags = [rows[sided(s, TAG)].set_axis(TAG, axis=1) for s, rows in (("left", left), ("right", right))]
    tag_ids = pd.concat(tags).groupby(TAG, sort=False).ngroup().to_numpy()
    at = {"left": tag_ids[: len(left)], "right": tag_ids[len(left) :]}
    # only tags of both sides count
    kept = {s: np.isin(at[s], at["right" if s == "left" else "left"]) for s in at}
    shared, where = np.unique(np.concatenate([at[s][kept[s]] for s in at]), return_inverse=True)
    cut = int(kept["left"].sum())
    column = {"left": where[:cut], "right": where[cut:]}
    row = {s: leads[s][0][kept[s]] for s in at}
    r2 = {
        s: rows[f"{s}_R2_EUR"].to_numpy(dtype=float, na_value=np.nan)[kept[s]]
        for s, rows in (("left", left), ("right", right))
    }
    size = {s: len(leads[s][1]) for s in at}

    def counts(test) -> np.ndarray:
        total = np.zeros((size["left"], size["right"]))
        for lo in range(0, len(shared), TAG_BLOCK):
            planes = []
            for s in ("left", "right"):
                inside = test(s) & (column[s] >= lo) & (column[s] < lo + TAG_BLOCK)
                plane = np.zeros((size[s], min(TAG_BLOCK, len(shared) - lo)), dtype=np.float32)
                np.add.at(plane, (row[s][inside], column[s][inside] - lo), 1)
                planes.append(plane)
            total += planes[0] @ planes[1].T
        return total

    every = counts(lambda s: np.ones(len(r2[s]), dtype=bool))
    i, j = np.nonzero(every)
    out = {f"left_{c}": leads["left"][1][f"left_{c}"].to_numpy()[i] for c in VARIANT}
    out |= {f"right_{c}": leads["right"][1][f"right_{c}"].to_numpy()[j] for c in VARIANT}
    known = counts(lambda s: ~np.isnan(r2[s]) if s == "left" else np.ones(len(r2[s]), dtype=bool))
    out["n"] = known[i, j].astype(np.int64)
    for k, t in enumerate(["0", *R2_THRESHOLDS]):
        out[f"n{k}"] = counts(lambda s: r2[s] >= float(t))[i, j].astype(np.int64)
    return pd.DataFrame(out)


def shared_tag_props(left: DataFrame, right: DataFrame) -> DataFrame:
    """``prop_overlap_at_r2`` of all pairs of a left and a right lead, without the shared tags
    themselves: only a pair's counts leave a task.

    Tags are dealt by place (1 Mb of a chromosome); a crowded place is cut by lead into strips of
    both sides, which meet in cells of about ``CELL_TAGS`` by ``CELL_TAGS`` rows. A lead with tags in
    several places has counts from each, which are added. A task multiplies 0/1 planes of leads by
    tags, one for each threshold.
    """
    place = F.concat_ws(":", "tag_chrom", F.floor(F.col("tag_pos") / PLACE_BP))
    places = {s: df.withColumn("place", place) for s, df in (("left", left), ("right", right))}
    cell = ["place", "left_strip", "right_strip"]
    sizes = [
        df.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / CELL_TAGS).cast("int").alias(f"{s}_n"))
        for s, df in places.items()
    ]
    counts = sizes[0].join(sizes[1], "place")
    one, two = (_strips(df, s, counts) for s, df in places.items())
    keys = sided("left", VARIANT) + sided("right", VARIANT)
    types = {c: (left if c in left.columns else right).schema[c].dataType for c in keys}
    numbers = ["n", *[f"n{k}" for k in range(len(R2_THRESHOLDS) + 1)]]
    schema = ", ".join([*[f"{c} {t.simpleString()}" for c, t in types.items()], *[f"{c} long" for c in numbers]])
    found = one.groupBy(*cell).cogroup(two.groupBy(*cell)).applyInPandas(
        lambda l, r: _shared_tags(l, r) if len(l) and len(r) else pd.DataFrame({c: [] for c in [*keys, *numbers]}),
        schema,
    )
    total = found.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers])
    return total.select(
        *keys,
        F.col("n0").alias("total_overlap"),
        *[F.try_divide(F.col(f"n{k}"), F.col("n")).alias(f"prop_overlap_{t}") for k, t in enumerate(R2_THRESHOLDS, 1)],
    )


def side_tag_counts(tags: DataFrame, side: str) -> DataFrame:
    return tags.groupBy(*sided(side, VARIANT)).agg(
        F.count("tag_chrom").alias(f"{side}_num_tags")
    )


def lead_pair_features(coloc: DataFrame, ld: DataFrame) -> DataFrame:
    """Overlap counts and proportions per pair of lead variants."""
    tags = {s: ld_tags(coloc, ld, s) for s in ("left", "right")}
    out = shared_tag_props(tags["left"], tags["right"])
    for s in ("left", "right"):
        out = out.join(side_tag_counts(tags[s], s), sided(s, VARIANT))
    return out.withColumns(
        {f"{s}_prop_total_overlap": F.col("total_overlap") / F.col(f"{s}_num_tags") for s in tags}
    ).withColumn("abs_distance", F.abs(F.col("left_pos") - F.col("right_pos")))


def log_pvals(top_loci: DataFrame) -> DataFrame:
    """-log10 p of every dataset's lead variants (the smallest p if listed twice)."""
    return lead_pvals(
        top_loci, ["study_id", "phenotype_id", "bio_feature", *VARIANT]
    ).select(
        "study_id", "phenotype_id", "bio_feature", *VARIANT, neg_log10_pval(F.col("pval")).alias("log_pval")
    )


def join_log_pvals(df: DataFrame, top_loci: DataFrame, side: str) -> DataFrame:
    """Add ``<side>_log_pval`` of the side's lead; rows without a listed lead drop out."""
    pvals = log_pvals(top_loci)
    match = (
        (df[f"{side}_study"] == pvals["study_id"])
        & df[f"{side}_phenotype"].eqNullSafe(pvals["phenotype_id"])
        & df[f"{side}_bio_feature"].eqNullSafe(pvals["bio_feature"])
    )
    for c in VARIANT:
        match = match & (df[f"{side}_{c}"] == pvals[c])
    return df.join(pvals, match).select(*[df[c] for c in _quoted(df)], F.col("log_pval").alias(f"{side}_log_pval"))


def _quoted(df: DataFrame) -> list[str]:
    return [f"`{c}`" if "." in c else c for c in df.columns]


def is_gwas_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"{s}_is_gwas": F.when(F.col(f"{s}_type") == "gwas", 1).otherwise(0) for s in ("left", "right")}
    )


def create_features(coloc: DataFrame, ld: DataFrame, top_loci: DataFrame) -> DataFrame:
    """Features of every pair of a left and a right signal whose leads share a tag.

    Each side's signals first get their p-value; a lead pair's features are then
    handed to the signals of those leads.
    """
    out = lead_pair_features(coloc, ld)
    for s in ("left", "right"):
        signals = join_log_pvals(coloc.select(*sided(s, COLOC_SIGNAL)).distinct(), top_loci, s)
        out = grid_join(out, signals, sided(s, VARIANT))
    return is_gwas_flags(out).select(*COLOC_KEYS, *[f"`{c}`" for c in FEATURE_COLUMNS])


def features_outer_coloc(features: DataFrame, coloc: DataFrame) -> DataFrame:
    """Full outer join of features and test results on both signals."""
    stats = coloc.select(
        *[F.col(k).alias(f"_{k}") for k in COLOC_KEYS],
        "coloc_h3",
        "coloc_h4",
        "coloc_log2_h4_h3",
    )
    match = None
    for k in COLOC_KEYS:
        eq = features[k].eqNullSafe(stats[f"_{k}"])
        match = eq if match is None else match & eq
    joined = features.join(stats, match, "full_outer")
    return joined.select(
        *[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in COLOC_KEYS],
        *[f"`{c}`" for c in FEATURE_COLUMNS],
        "coloc_h3",
        "coloc_h4",
        "coloc_log2_h4_h3",
    )


def feature_set(outer: DataFrame) -> DataFrame:
    """Rows with both features and a test result."""
    return outer.filter(F.col("total_overlap").isNotNull() & F.col("coloc_log2_h4_h3").isNotNull())


def match_counts(outer: DataFrame) -> DataFrame:
    """How many pairs have features only, a result only, and both."""
    ld, tested = F.col("total_overlap").isNotNull(), F.col("coloc_log2_h4_h3").isNotNull()
    return outer.agg(
        F.count_if(ld & ~tested).alias("ld_only"),
        F.count_if(~ld & tested).alias("coloc_only"),
        F.count_if(ld & tested).alias("both"),
    )
