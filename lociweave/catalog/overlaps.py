"""Registered queries: overlaps and the manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.common import (
    CLEAN_KEYS_SQL,
    KEY_SQL,
    MAX_DIST,
    OVERLAP_CTES,
    csv,
    manifest,
    overlap,
    r6,
    rounded,
    same,
    sides,
    signals,
)
from lociweave.catalog.registry import query
from lociweave.functions import scalars as S
from lociweave.operators import manifest as M
from lociweave.operators import overlap as O
from lociweave.schemas import LEAD, MANIFEST_KEYS, SIGNAL

SIDED = sides(SIGNAL)
PROPS = ["left_overlap_prop", "right_overlap_prop"]
CREDSET_COLS = csv(SIGNAL) + ", tag_chrom, tag_pos, tag_ref, tag_alt"


@query("filter_credset", f"select {CREDSET_COLS}, multisignal_method from credset where is99_credset", ["credset"])
def _(t):
    return O.filter_credset(t("credset"), "99").drop("is95_credset", "is99_credset")


@query(
    "filter_method",
    f"select {CREDSET_COLS}, is95_credset, is99_credset, multisignal_method from credset where multisignal_method = 'conditional'",
    ["credset"],
)
def _(t):
    return O.filter_method(t("credset"), "conditional")


@query("signal_key", f"select distinct {csv(SIGNAL)}, {KEY_SQL} as signal_key from credset", ["credset"])
def _(t):
    return t("credset").select(*SIGNAL).distinct().withColumn("signal_key", S.signal_key())


@query(
    "credset_overlap",
    f"select a.k as left_key, b.k as right_key, count(*) as n from ck a join ck b on a.tag_chrom=b.tag_chrom and a.tag_pos=b.tag_pos and a.tag_ref=b.tag_ref and a.tag_alt=b.tag_alt where a.study_id<>b.study_id and (a.type='gwas' or b.type='gwas') and a.k>b.k group by a.k, b.k",
    ["credset"],
    [("ck", f"select *, {KEY_SQL} as k from credset where is99_credset")],
)
def _(t):
    rows = O.filter_credset(t("credset"), "99")
    counts = O.overlap_counts(rows)
    keyed = O.attach_signals(counts, O.tag_counts(rows), ["key"])
    return keyed.select("left_key", "right_key", F.col("num_overlapping").alias("n"))


@query(
    "lead_distance_filter",
    f"select {csv(SIDED)}, num_overlapping from ov_n",
    ["credset"],
    OVERLAP_CTES[:2],
)
def _(t):
    rows = O.filter_credset(t("credset"), "95")
    return O.attach_signals(
        O.overlap_counts(rows, MAX_DIST), O.tag_counts(rows), SIGNAL
    ).select(*SIDED, "num_overlapping")


@query(
    "overlap_counts",
    f"select {csv(SIDED)}, num_overlapping from ov_n",
    ["credset"],
    [OVERLAP_CTES[0], ("ov_n", OVERLAP_CTES[1][1].replace(f" and abs(a.lead_pos-b.lead_pos)<={MAX_DIST}", ""))],
)
def _(t):
    rows = O.filter_credset(t("credset"), "95")
    return O.attach_signals(O.overlap_counts(rows), O.tag_counts(rows), SIGNAL).select(
        *SIDED, "num_overlapping"
    )


@query("tag_counts", f"select {csv(SIGNAL)}, num_tags from ov_t", ["credset"], OVERLAP_CTES[:3:2])
def _(t):
    return O.tag_counts(O.filter_credset(t("credset"), "95")).select(*SIGNAL, "num_tags")


@query(
    "join_tag_counts",
    f"select {csv(SIDED)}, num_overlapping, left_num_tags, right_num_tags from overlap",
    ["credset"],
    OVERLAP_CTES,
)
def _(t):
    return overlap(t, with_ids=False).drop(*PROPS)


@query(
    "overlap_props",
    f"select {csv(SIDED)}, num_overlapping, left_num_tags, right_num_tags, {r6(PROPS[0])}, {r6(PROPS[1])} from overlap",
    ["credset"],
    OVERLAP_CTES,
)
def _(t):
    return rounded(overlap(t, with_ids=False), *PROPS)


# -- manifest ---------------------------------------------------------------

@query(
    "filter_overlap_prop",
    f"select {csv(SIDED)}, num_overlapping from overlap where greatest(left_overlap_prop, right_overlap_prop) >= 0.25",
    ["credset"],
    OVERLAP_CTES,
)
def _(t):
    return M.filter_overlap_prop(overlap(t), 0.25).select(*SIDED, "num_overlapping")


@query(
    "filter_credset_size",
    f"select {csv(SIDED)}, num_overlapping from overlap where greatest(left_num_tags, right_num_tags) <= 8",
    ["credset"],
    OVERLAP_CTES,
)
def _(t):
    return M.filter_credset_size(overlap(t), 8).select(*SIDED, "num_overlapping")


@query(
    "filter_custom_studies",
    f"select {csv(SIDED)}, num_overlapping from overlap o where left_study_id in (select study_id from custom) or right_study_id in (select study_id from custom)",
    ["credset"],
    [*OVERLAP_CTES, ("custom", "select distinct study_id from sumstats where is_cc or type = 'pqtl'")],
)
def _(t):
    custom = t("sumstats").filter("is_cc or type = 'pqtl'").select("study_id").distinct()
    return M.filter_custom_studies(overlap(t), custom).select(*SIDED, "num_overlapping")


@query(
    "study_class",
    "select distinct type, case when type = 'gwas' then 'gwas' else 'molecular_trait' end as study_class, study_id from credset",
    ["credset"],
)
def _(t):
    return (
        t("credset").select("type", S.study_class(F.col("type")).alias("study_class"), "study_id").distinct()
    )


@query(
    "ld_eligible",
    "select distinct study_id, not starts_with(study_id, 'ST1') as has_ld from credset",
    ["credset"],
)
def _(t):
    return t("credset").select(
        "study_id", S.ld_eligible(F.col("study_id"), "ST1").alias("has_ld")
    ).distinct()


MANIFEST_SQL = (
    "select "
    + csv(SIDED)
    + ", "
    + ", ".join(
        f"case when {s}_type = 'gwas' then 'gwas' else 'molecular_trait' end as {s}_study_class,"
        f" not starts_with({s}_study_id, 'FINNGEN') as {s}_has_ld"
        for s in ("left", "right")
    )
    + ", 'conditional' as method from overlap where greatest(left_overlap_prop, right_overlap_prop) >= 0.01"
)
MANIFEST_CTES = [*OVERLAP_CTES, ("manifest", MANIFEST_SQL)]


@query("manifest_build", "select * from manifest", ["credset"], MANIFEST_CTES)
def _(t):
    return manifest(t).drop("left_sid", "right_sid")


_PREV = {"study_id": "study", "phenotype_id": "phenotype", "bio_feature": "bio_feature"} | {
    f"lead_{c}": c for c in ("chrom", "pos", "ref", "alt")
}
PREVIOUS_SQL = "select distinct " + ", ".join(
    (f"nullif({s}_{old}, 'None')" if old in ("phenotype", "bio_feature") else f"{s}_{old}")
    + f" as {s}_{new}"
    for s in ("left", "right")
    for new, old in _PREV.items()
) + " from release_old"


@query(
    "manifest_anti_previous",
    f"select * from manifest m where not exists (select 1 from prev p where {same('m', 'p', MANIFEST_KEYS)})",
    ["credset", "release_old"],
    [*MANIFEST_CTES, ("prev", PREVIOUS_SQL)],
)
def _(t):
    return M.manifest_anti_previous(manifest(t), t("release_old")).drop("left_sid", "right_sid")


SIGNALS_SQL = " union ".join(
    "select " + ", ".join(f"{s}_{c} as {c}" for c in SIGNAL) + f", {s}_has_ld as has_ld from manifest"
    for s in ("left", "right")
)


@query("distinct_signals", "select * from signals", ["credset"], [*MANIFEST_CTES, ("signals", SIGNALS_SQL)])
def _(t):
    return signals(t).drop("sid")


_DONE = (
    "select " + ", ".join(f"left_{c} as {c}" for c in SIGNAL) + " from overlap where num_overlapping >= 2"
)


def _finished(t):
    """Signals an earlier run is taken to have cached."""
    return overlap(t).filter("num_overlapping >= 2").select(F.col("left_sid").alias("sid"))


@query(
    "pending_signals",
    f"select * from signals s where not exists (select 1 from done d where {same('s', 'd', SIGNAL)})",
    ["credset"],
    [*MANIFEST_CTES, ("signals", SIGNALS_SQL), ("done", _DONE)],
)
def _(t):
    return M.pending_signals(signals(t), _finished(t)).drop("sid")


@query(
    "finished_signals",
    f"select * from signals s where exists (select 1 from done d where {same('s', 'd', SIGNAL)})",
    ["credset"],
    [*MANIFEST_CTES, ("signals", SIGNALS_SQL), ("done", _DONE)],
)
def _(t):
    return M.finished_signals(signals(t), _finished(t)).drop("sid")


_LV, _RV = (
    f"concat_ws(':', {s}_lead_chrom, cast({s}_lead_pos as varchar(12)), {s}_lead_ref, {s}_lead_alt)"
    for s in ("left", "right")
)


@query(
    "overlap_low_p",
    f"""select {csv(SIDED)}, num_overlapping from overlap o
 where exists (select 1 from top_loci l where l.pval < 1e-8 and l.study_id = o.left_study_id and l.variant_id = {_LV})
 or exists (select 1 from top_loci r where r.pval < 1e-8 and r.study_id = o.right_study_id and r.variant_id = {_RV}
  and r.phenotype_id is not distinct from o.right_phenotype_id and r.bio_feature is not distinct from o.right_bio_feature)""",
    ["credset", "top_loci"],
    OVERLAP_CTES,
)
def _(t):
    return O.overlap_low_p(overlap(t), t("top_loci"), 1e-8).select(*SIDED, "num_overlapping")
