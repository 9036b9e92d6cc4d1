"""Registered queries: processing, merging, enriching and auditing results."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.common import CLEAN_KEYS_SQL, MAX_DIST, csv, r6, rounded, same
from lociweave.catalog.registry import query
from lociweave.catalog.signals import COND_NEEDS, CONDITIONED_ABF_CTES, n_samples
from lociweave.config import Config
from lociweave.functions import scalars as S
from lociweave.operators import audit, enrich, merge
from lociweave.operators import process as P
from lociweave.plans import coloc
from lociweave.plans.coloc import Inputs
from lociweave.schemas import (
    COLOC_KEYS,
    COLOC_STATS,
    DEDUP_KEYS,
    MERGE_KEYS,
    MERGE_KEYS_PROCESSED,
    SIGNAL_TO_COLOC,
    VARIANT,
)
from lociweave.sources.writers import range_layout

KEYS = csv(COLOC_KEYS)
STATS = csv(COLOC_STATS)
ALL = [*COLOC_STATS, *COLOC_KEYS]
H = ["coloc_h0", "coloc_h1", "coloc_h2", "coloc_h3", "coloc_h4"]
MIN_VARS = 100

RATIO = "coloc_h4 / nullif(coloc_h3, 0)"
LOG_RATIO = f"case when {RATIO} > 0 then ln({RATIO}) / ln(2.0) end"


def _r(*cols: str) -> str:
    return ", ".join(r6(c) for c in cols)


def _flip_sql(src: str, cols) -> str:
    def other(c):
        return c.replace("left_", "right_") if c.startswith("left_") else c.replace("right_", "left_")

    straight = f"select {csv(cols)}, false as is_flipped from {src}"
    flipped = "select " + ", ".join(
        f"{other(c)} as {c}" if c.startswith(("left_", "right_")) else c for c in cols
    ) + f", true as is_flipped from {src}"
    return straight + " union all " + flipped


# Left and right dataset of one chromosome: coarse enough that tests share a key.
COARSE_KEYS = ["left_study", "left_chrom", "right_type", "right_study", "right_bio_feature", "right_phenotype"]
TIE = "right_chrom, right_pos, right_ref, right_alt, is_flipped"
GENE = (
    "case when {s}_type = 'eqtl' then coalesce({s}l.gene_id, {s}_phenotype)"
    " when {s}_type = 'sqtl' then nullif(split_part({s}_phenotype, '^', 5), '') end"
)


def _process_ctes(min_vars: int):
    return [
        ("ratio", f"select *, {RATIO} as coloc_h4_h3, {LOG_RATIO} as coloc_log2_h4_h3 from coloc_raw where coloc_n_vars >= {min_vars}"),
        ("sym", _flip_sql("ratio", [*ALL, "coloc_h4_h3", "coloc_log2_h4_h3"])),
        ("gwas_left", "select * from sym where left_type = 'gwas'"),
        (
            "best",
            f"select * exclude (rn) from (select *, row_number() over (partition by {csv(DEDUP_KEYS)} order by coloc_h4 desc, {TIE}) as rn from gwas_left) x where rn = 1",
        ),
        (
            "genes",
            "select b.*, "
            + ", ".join(
                f"case when starts_with({GENE.format(s=s)}, 'ENSG') then {GENE.format(s=s)} end as {s}_gene_id"
                for s in ("left", "right")
            )
            + " from best b left join gene_lut leftl on leftl.phenotype_id = left_phenotype left join gene_lut rightl on rightl.phenotype_id = right_phenotype",
        ),
        (
            "processed",
            "select * exclude (left_phenotype, left_bio_feature, right_phenotype, right_bio_feature, left_gene_id),"
            " nullif(right_phenotype, 'None') as right_phenotype, nullif(right_bio_feature, 'None') as right_bio_feature"
            " from genes where coloc_h3 is not null and coloc_h4 is not null and coloc_log2_h4_h3 is not null",
        ),
    ]


PROCESS_CTES = _process_ctes(MIN_VARS)
PROC_KEYS = [c for c in COLOC_KEYS if c not in ("left_phenotype", "left_bio_feature")]
PROC_OUT = [*PROC_KEYS, "coloc_n_vars", "is_flipped", "right_gene_id"]


def processed(t, min_vars: int | None = MIN_VARS):
    return t.derived(
        f"processed_{min_vars}",
        lambda: P.process_results(
            t("coloc_raw"), t("gene_lut"), Config(min_overlapping_vars=min_vars)
        ),
    )


@query(
    "rename_coloc_stats",
    f"select {STATS}, {KEYS} from coloc_raw",
    ["coloc_raw"],
)
def _(t):
    names = {f"coloc_h{h}": f"PP.H{h}.abf" for h in range(5)} | {"coloc_n_vars": "nsnps"}
    return P.rename_coloc_stats(t("coloc_raw").withColumnsRenamed(names))


@query(
    "h4_h3_ratio",
    f"select {KEYS}, round({RATIO}, 6) + 0.0 as coloc_h4_h3, round({LOG_RATIO}, 6) + 0.0 as coloc_log2_h4_h3 from coloc_raw",
    ["coloc_raw"],
)
def _(t):
    out = S.h4_h3(t("coloc_raw")).select(*COLOC_KEYS, "coloc_h4_h3", "coloc_log2_h4_h3")
    return rounded(out, "coloc_h4_h3", "coloc_log2_h4_h3")


@query(
    "filter_min_overlap",
    f"select {KEYS}, coloc_n_vars from coloc_raw where coloc_n_vars >= {MIN_VARS}",
    ["coloc_raw"],
)
def _(t):
    return P.filter_min_overlap(t("coloc_raw"), MIN_VARS).select(*COLOC_KEYS, "coloc_n_vars")


@query(
    "make_symmetric",
    f"select {csv(ALL)}, is_flipped from sym",
    ["coloc_raw"],
    [("sym", _flip_sql("coloc_raw", ALL))],
)
def _(t):
    return P.make_symmetric(t("coloc_raw")).select(*ALL, "is_flipped")


@query("left_gwas_only", f"select {csv(ALL)} from coloc_raw where left_type = 'gwas'", ["coloc_raw"])
def _(t):
    return P.left_gwas_only(t("coloc_raw"))


@query(
    "dedup_keep_best",
    f"select {csv(ALL)}, is_flipped from best",
    ["coloc_raw"],
    _process_ctes(0)[:4],
)
def _(t):
    sym = P.left_gwas_only(P.make_symmetric(t("coloc_raw")))
    return P.dedup_keep_best(sym).select(*ALL, "is_flipped")


@query(
    "dedup_keep_best_dataset",
    f"select {csv(ALL)}, is_flipped from (select *, row_number() over (partition by {csv(COARSE_KEYS)} order by coloc_h4 desc, left_pos, left_ref, left_alt, {TIE}) as rn from gwas_left) x where rn = 1",
    ["coloc_raw"],
    _process_ctes(0)[:3],
)
def _(t):
    sym = P.left_gwas_only(P.make_symmetric(t("coloc_raw")))
    order = [F.desc("coloc_h4"), F.asc("left_pos"), F.asc("left_ref"), F.asc("left_alt"), *P.best_first(sym)[1:]]
    return P.keep_rank(sym, COARSE_KEYS, order).select(*ALL, "is_flipped")


@query(
    "gene_id_map",
    f"select {KEYS}, is_flipped, left_gene_id, right_gene_id from genes",
    ["coloc_raw", "gene_lut"],
    _process_ctes(0)[:5],
)
def _(t):
    best = P.dedup_keep_best(P.left_gwas_only(P.make_symmetric(t("coloc_raw"))))
    return P.gene_id_map(best, t("gene_lut")).select(
        *COLOC_KEYS, "is_flipped", "left_gene_id", "right_gene_id"
    )


@query("none_to_null", f"select {STATS}, {CLEAN_KEYS_SQL} from coloc_raw", ["coloc_raw"])
def _(t):
    return P.none_to_null_columns(t("coloc_raw"))


@query(
    "null_to_none",
    f"select {csv(VARIANT)}, study_id, coalesce(phenotype_id, 'None') as phenotype_id, coalesce(bio_feature, 'None') as bio_feature from top_loci",
    ["top_loci"],
)
def _(t):
    return t("top_loci").select(
        *VARIANT,
        "study_id",
        S.null_to_none(F.col("phenotype_id")).alias("phenotype_id"),
        S.null_to_none(F.col("bio_feature")).alias("bio_feature"),
    )


@query(
    "drop_null_stats",
    f"select {KEYS}, coloc_n_vars, {_r('coloc_h3', 'coloc_h4')} from coloc_raw where {LOG_RATIO} is not null",
    ["coloc_raw"],
)
def _(t):
    out = P.drop_null_stats(S.h4_h3(t("coloc_raw"))).select(
        *COLOC_KEYS, "coloc_n_vars", "coloc_h3", "coloc_h4"
    )
    return rounded(out, "coloc_h3", "coloc_h4")


@query(
    "drop_columns",
    f"select {csv(PROC_KEYS)}, coloc_h4 from coloc_raw where left_type = 'gwas'",
    ["coloc_raw"],
)
def _(t):
    df = P.left_gwas_only(t("coloc_raw")).drop("left_gene_id", "left_bio_feature", "left_phenotype")
    return df.select(*PROC_KEYS, "coloc_h4")


@query(
    "process_results",
    f"select {csv(PROC_OUT)}, {_r(*H, 'coloc_h4_h3', 'coloc_log2_h4_h3')} from processed",
    ["coloc_raw", "gene_lut"],
    PROCESS_CTES,
)
def _(t):
    out = P.process_results(t("coloc_raw"), t("gene_lut"), Config(min_overlapping_vars=MIN_VARS))
    return rounded(out, *H, "coloc_h4_h3", "coloc_log2_h4_h3")


# -- a whole run ----------------------------------------------------------------

RUN_MIN_VARS = 10
#: Digits to which a run's raw results are compared, also where processing ranks them.
RAW_DIGITS = 9
_RAW_SIDE = ", ".join(
    f"{{a}}.{old} as {{s}}_{new}" for old, new in SIGNAL_TO_COLOC.items()
)
RUN_CTES = [
    *CONDITIONED_ABF_CTES,
    (
        "coloc_raw",
        "select cast(n as int) as coloc_n_vars, "
        + ", ".join(f"round(exp(h{i}-g)/t, {RAW_DIGITS}) + 0.0 as coloc_h{i}" for i in range(5))
        + f", {_RAW_SIDE.format(a='l', s='left')}, {_RAW_SIDE.format(a='r', s='right')}"
        + " from ht join sig l on l.sid = ht.ls join sig r on r.sid = ht.rs",
    ),
    *_process_ctes(RUN_MIN_VARS),
]


@query(
    "coloc_run",
    f"select {csv(PROC_OUT)}, {_r(*H, 'coloc_log2_h4_h3')} from processed",
    [*COND_NEEDS, "gene_lut"],
    RUN_CTES,
)
def _(t):
    """From credible sets to processed results: overlap, windows, conditioning, test, processing."""
    inputs = Inputs(
        t("credset"), t("sumstats"), t("top_loci"), t("gene_lut"), t("panel"), n_samples=n_samples(t)
    )
    config = Config(max_lead_distance=MAX_DIST, min_overlapping_vars=RUN_MIN_VARS)
    out = coloc.run(inputs, config, digits=RAW_DIGITS)
    columns = [*PROC_OUT, *H, "coloc_log2_h4_h3"]
    return rounded(out.coloc_processed.select(*columns), *H, "coloc_log2_h4_h3")


@query(
    "range_layout",
    f"select {STATS}, {KEYS} from coloc_raw",
    ["coloc_raw"],
)
def _(t):
    return range_layout(t("coloc_raw"))


# -- merging releases ---------------------------------------------------------

MSAME = same("a", "b", MERGE_KEYS)
OLD = [*ALL, "release_note"]


def _dedup_order(cols, keys) -> str:
    named = ("coloc_h4", "coloc_h3", "coloc_n_vars")
    rest = sorted(c for c in cols if c not in keys and c not in named)
    return ", ".join([f"{c} desc" for c in named] + [f"{c} nulls first" for c in rest])


def _merge_sql(new: str, prev: str, new_cols, prev_cols, keys) -> str:
    cols = list(dict.fromkeys([*new_cols, *prev_cols]))
    pick = lambda have: ", ".join(c if c in have else f"null as {c}" for c in cols)
    return (
        f"select {csv(cols)} from (select *, row_number() over (partition by {csv(keys)} order by src, {_dedup_order(cols, keys)}) as rn from"
        f" (select {pick(new_cols)}, 0 as src from {new} union all select {pick(prev_cols)}, 1 as src from {prev}) u) x where rn = 1"
    )


_PAIR_KEYS = ["left_study", "left_chrom", "left_ref", "right_study", "right_phenotype"]


@query(
    "drop_duplicates_subset",
    f"select {csv([*_PAIR_KEYS, 'coloc_h4', 'right_pos', 'left_pos'])} from (select *, row_number() over (partition by {csv(_PAIR_KEYS)} order by {_dedup_order(ALL, _PAIR_KEYS)}) as rn from coloc_raw) x where rn = 1",
    ["coloc_raw"],
)
def _(t):
    return merge.drop_duplicates_subset(t("coloc_raw"), _PAIR_KEYS).select(
        *_PAIR_KEYS, "coloc_h4", "right_pos", "left_pos"
    )


@query(
    "drop_exact_duplicates",
    f"select distinct left_study, left_phenotype, left_bio_feature, left_chrom, left_pos, right_study from coloc_raw",
    ["coloc_raw"],
)
def _(t):
    return t("coloc_raw").select(
        "left_study", "left_phenotype", "left_bio_feature", "left_chrom", "left_pos", "right_study"
    ).distinct()


@query(
    "merge_missing",
    f"select {csv(ALL)} from release_new a where not exists (select 1 from release_old b where {MSAME})",
    ["release_new", "release_old"],
)
def _(t):
    return merge.merge_missing(t("release_new"), t("release_old"))


@query(
    "merge_present",
    f"select {csv(OLD)} from release_old a where exists (select 1 from release_new b where {MSAME})",
    ["release_new", "release_old"],
)
def _(t):
    return merge.merge_present(t("release_new"), t("release_old"))


@query(
    "merge_overlap_compare",
    f"select {csv(MERGE_KEYS, 'a.')}, {r6('a.coloc_h4', 'prev_coloc_h4')}, {r6('b.coloc_h4', 'new_coloc_h4')} from release_old a join release_new b on {MSAME}",
    ["release_new", "release_old"],
)
def _(t):
    out = merge.merge_overlap_compare(t("release_new"), t("release_old")).select(
        *MERGE_KEYS, "prev_coloc_h4", "new_coloc_h4"
    )
    return rounded(out, "prev_coloc_h4", "new_coloc_h4")


@query(
    "merge_raw",
    _merge_sql("release_new", "release_old", ALL, OLD, MERGE_KEYS),
    ["release_new", "release_old"],
)
def _(t):
    return merge.merge_raw(t("release_new"), t("release_old"))


_PCOLS = [*PROC_OUT, *H]


@query(
    "merge_processed",
    f"select {csv(PROC_OUT)}, {_r(*H)} from ({_merge_sql('pnew', 'pold', _PCOLS, _PCOLS, MERGE_KEYS_PROCESSED)}) m",
    ["coloc_raw", "gene_lut"],
    [
        *PROCESS_CTES,
        ("pnew", f"select {csv(_PCOLS)} from processed where left_alt = 'T' or not (right_ref = 'A' or left_ref = 'C')"),
        (
            "pold",
            f"select {csv([c for c in _PCOLS if c != 'coloc_h4'])}, coloc_h4 * 0.5 as coloc_h4 from processed where right_ref = 'A' or left_ref = 'C'",
        ),
    ],
)
def _(t):
    base = processed(t).select(*_PCOLS)
    new = base.filter("left_alt = 'T' or not (right_ref = 'A' or left_ref = 'C')")
    old = base.filter("right_ref = 'A' or left_ref = 'C'").withColumn(
        "coloc_h4", F.col("coloc_h4") * 0.5
    )
    return rounded(merge.merge_processed(new, old), *H)


@query(
    "schema_drift_report",
    " union all ".join(
        f"select '{c}' as column_name, true as in_previous, {str(c in ALL).lower()} as in_new,"
        f" (select count({c}) from release_old) as previous_values, "
        + (f"(select count({c}) from release_new)" if c in ALL else "cast(null as bigint)")
        + " as new_values"
        for c in OLD
    ),
    ["release_new", "release_old"],
)
def _(t):
    return merge.schema_drift_report(t("release_new"), t("release_old"))


@query(
    "combine_results",
    f"select {csv(ALL)} from release_new union all select {csv(ALL)} from release_old",
    ["release_new", "release_old"],
)
def _(t):
    return t("release_new").select(*ALL).unionByName(t("release_old").select(*ALL))


# -- enriching ------------------------------------------------------------------

BETA_JOIN = (
    "select c.*, s.beta as left_var_right_study_beta, s.se as left_var_right_study_se, s.pval as left_var_right_study_pval, s.is_cc as left_var_right_isCC"
    " from proc0 c left join sumstats s on s.chrom = c.left_chrom and s.pos = c.left_pos and s.ref = c.left_ref and s.alt = c.left_alt and s.study_id = c.right_study"
    " and s.phenotype_id is not distinct from c.right_phenotype and s.bio_feature is not distinct from c.right_bio_feature"
)
ENRICH_CTES = [
    *_process_ctes(0)[:3],
    (
        "proc0",
        "select * exclude (left_phenotype, left_bio_feature, right_phenotype, right_bio_feature), nullif(right_phenotype, 'None') as right_phenotype, nullif(right_bio_feature, 'None') as right_bio_feature from gwas_left",
    ),
    ("withbeta", BETA_JOIN),
    (
        "ranked",
        f"select *, row_number() over (partition by {csv(COARSE_KEYS)} order by coloc_h4 desc, {TIE}, left_pos, left_ref, left_alt, left_var_right_study_pval nulls first, left_var_right_study_beta nulls first) as rn from withbeta",
    ),
]
BETAS = ["left_var_right_study_beta", "left_var_right_study_se", "left_var_right_study_pval"]
ENRICH_OUT = [*PROC_KEYS, "is_flipped", "left_var_right_isCC"]


def _undeduplicated(t):
    """Symmetric GWAS-left results, before any deduplication."""
    df = P.left_gwas_only(P.make_symmetric(t("coloc_raw")))
    return P.none_to_null_columns(df).drop("left_phenotype", "left_bio_feature")


def _enrich_sql(where: str) -> str:
    return f"select {csv(ENRICH_OUT)}, {_r('coloc_h4', *BETAS)} from ranked where {where}"


def _enrich_out(df):
    return rounded(df.select(*ENRICH_OUT, "coloc_h4", *BETAS), "coloc_h4", *BETAS)


@query("join_betas", _enrich_sql("true"), ["coloc_raw", "sumstats"], ENRICH_CTES)
def _(t):
    return _enrich_out(enrich.join_betas(_undeduplicated(t), t("sumstats")))


@query(
    "join_betas_rows_added",
    "select (select count(*) from withbeta) - (select count(*) from proc0) as n_added",
    ["coloc_raw", "sumstats"],
    ENRICH_CTES,
)
def _(t):
    before = _undeduplicated(t)
    return enrich.rows_added(before, enrich.join_betas(before, t("sumstats")))


@query("dedup_keep_rank", _enrich_sql("rn = 1"), ["coloc_raw", "sumstats"], ENRICH_CTES)
def _(t):
    return _enrich_out(enrich.enrich(_undeduplicated(t), t("sumstats"), COARSE_KEYS)[0])


@query("keep_duplicates", _enrich_sql("rn = 2"), ["coloc_raw", "sumstats"], ENRICH_CTES)
def _(t):
    return _enrich_out(enrich.enrich(_undeduplicated(t), t("sumstats"), COARSE_KEYS)[1])


_LOCI = [
    (
        "loci",
        "select distinct study_id, phenotype_id, bio_feature, chrom, pos, ref, alt from top_loci",
    )
]


def _has_locus(s: str) -> str:
    return (
        f"exists (select 1 from loci l where l.study_id = {s}_study and l.phenotype_id is not distinct from nullif({s}_phenotype, 'None')"
        f" and l.bio_feature is not distinct from nullif({s}_bio_feature, 'None') and l.chrom = {s}_chrom and l.pos = {s}_pos and l.ref = {s}_ref and l.alt = {s}_alt)"
    )


@query(
    "filter_top_loci_match",
    f"select {csv(ALL)} from coloc_raw c where {_has_locus('left')} and {_has_locus('right')}",
    ["coloc_raw", "top_loci"],
    _LOCI,
)
def _(t):
    return enrich.filter_top_loci_match(t("coloc_raw"), t("top_loci"))[0]


@query(
    "filter_top_loci_removed",
    f"select count(*) as n_filtered_out from coloc_raw c where not ({_has_locus('left')} and {_has_locus('right')})",
    ["coloc_raw", "top_loci"],
    _LOCI,
)
def _(t):
    return enrich.filter_top_loci_match(t("coloc_raw"), t("top_loci"))[1]


# -- auditing -------------------------------------------------------------------

@query(
    "row_counts_audit",
    " union all ".join(
        f"select '{n}' as dataset, count(*) as n_rows from {n}"
        for n in ("sumstats", "credset", "top_loci", "coloc_raw", "release_old", "release_new")
    ),
    ["sumstats", "credset", "top_loci", "coloc_raw", "release_old", "release_new"],
)
def _(t):
    names = ("sumstats", "credset", "top_loci", "coloc_raw", "release_old", "release_new")
    return audit.row_counts_audit({n: t(n) for n in names})


@query(
    "step_audit",
    "select *, coalesce(lag(n_rows) over (order by step_no) - n_rows, 0) as n_removed from ("
    + " union all ".join(
        f"select {i} as step_no, '{step}' as step, count(*) as n_rows from {src}"
        for i, (step, src) in enumerate(
            [("symmetric", "sym"), ("left gwas", "gwas_left"), ("deduplicated", "best"), ("complete", "processed")]
        )
    )
    + ") x",
    ["coloc_raw", "gene_lut"],
    _process_ctes(0),
)
def _(t):
    sym = P.make_symmetric(S.h4_h3(t("coloc_raw")))
    gwas = P.left_gwas_only(sym)
    best = P.dedup_keep_best(gwas)
    return audit.step_audit(
        [("symmetric", sym), ("left gwas", gwas), ("deduplicated", best), ("complete", P.drop_null_stats(best))]
    )


@query(
    "log_time_mean",
    "select i as iteration, round(m, 6) + 0.0 as mean_sec from (select row_number() over (order by file) - 1 as i,"
    " avg(sec) over (order by file rows between unbounded preceding and 1 preceding) as m from (select file,"
    " cast(split_part(split_part(line, ': ', 2), ':', 1) as int) * 3600 + cast(split_part(split_part(line, ': ', 2), ':', 2) as int) * 60 + cast(split_part(split_part(line, ': ', 2), ':', 3) as double) as sec from logs) y) x where i > 0 and i % 1000 = 0",
    ["logs"],
)
def _(t):
    logs = t("logs").withColumnRenamed("line", "text")
    return rounded(audit.log_time_mean(logs, 1000), "mean_sec")
