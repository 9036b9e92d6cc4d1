"""Registered queries: LD-overlap features and regressions on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.catalog.common import csv, r6, rounded, same, sides
from lociweave.catalog.registry import query
from lociweave.catalog.signals import INDEX_SQL, LD_CTES, LD_KEYS, PANEL_CTES, ld_table, n_samples
from lociweave.functions import scalars as S
from lociweave.operators import features as FE
from lociweave.operators import ld as L
from lociweave.operators import ml
from lociweave.plans import prediction
from lociweave.schemas import COLOC_KEYS, COLOC_SIGNAL, TAG, VARIANT
from lociweave.session import materialise, scratch_path

LEFT, RIGHT = [f"left_{c}" for c in VARIANT], [f"right_{c}" for c in VARIANT]
PROPS = [f"prop_overlap_{r}" for r in FE.R2_THRESHOLDS]

# Both sides' leads have to be in the LD table here, not only the left ones.
BOTH_INDEX = f"{INDEX_SQL} union select distinct right_chrom, right_pos, right_ref, right_alt from coloc_raw"
FE_CTES = [
    *PANEL_CTES,
    ("idx", BOTH_INDEX),
    *LD_CTES[3:],
    ("ld05", "select * from ld where r2 >= 0.05"),
    (
        "tested",
        "select * exclude (left_phenotype, left_bio_feature, right_phenotype, right_bio_feature), "
        + ", ".join(f"nullif({c}, 'None') as {c}" for c in COLOC_KEYS if c.endswith(("phenotype", "bio_feature")))
        + ", case when coloc_h3 > 0 and coloc_h4 > 0 then ln(coloc_h4 / coloc_h3) / ln(2.0) end as coloc_log2_h4_h3"
        " from coloc_raw where coloc_n_vars > 50 and left_type = 'gwas'",
    ),
    *[
        (
            f"{s}_tags",
            f"select s.*, {csv(TAG)}, r2 as {s}_r2 from (select distinct {csv([f'{s}_{c}' for c in COLOC_SIGNAL])} from tested) s join ld05 on "
            + " and ".join(f"lead_{c} = {s}_{c}" for c in VARIANT),
        )
        for s in ("left", "right")
    ],
    (
        "inter",
        f"select l.* exclude ({csv(TAG)}), r.* exclude ({csv(TAG)}) from left_tags l join right_tags r on "
        + " and ".join(f"l.{c} = r.{c}" for c in TAG),
    ),
    (
        "props",
        f"select {csv(COLOC_KEYS)}, count(*) as total_overlap, "
        + ", ".join(
            f'count(case when left_r2 >= {r} and right_r2 >= {r} then 1 end) / count(*) as "prop_overlap_{r}"'
            for r in FE.R2_THRESHOLDS
        )
        + " from inter group by all",
    ),
    *[
        (
            f"{s}_n",
            f"select {csv(k := [f'{s}_{c}' for c in COLOC_SIGNAL])}, count(*) as {s}_num_tags from {s}_tags group by all",
        )
        for s in ("left", "right")
    ],
    (
        "lp",
        f"select study_id, phenotype_id, bio_feature, {csv(VARIANT)}, coalesce(case when min(pval) > 0 then -log10(min(pval)) end, {S.MAX_NEG_LOG10!r}) as log_pval from top_loci group by all",
    ),
    (
        "feat",
        "select p.*, ln.left_num_tags, rn.right_num_tags, total_overlap / left_num_tags as left_prop_total_overlap, total_overlap / right_num_tags as right_prop_total_overlap,"
        " abs(p.left_pos - p.right_pos) as abs_distance, lpv.log_pval as left_log_pval, rpv.log_pval as right_log_pval,"
        " case when p.left_type = 'gwas' then 1 else 0 end as left_is_gwas, case when p.right_type = 'gwas' then 1 else 0 end as right_is_gwas from props p"
        f" join left_n ln on {same('ln', 'p', [f'left_{c}' for c in COLOC_SIGNAL])} join right_n rn on {same('rn', 'p', [f'right_{c}' for c in COLOC_SIGNAL])}"
        + "".join(
            f" join lp {a} on {a}.study_id = p.{s}_study and {a}.phenotype_id is not distinct from p.{s}_phenotype and {a}.bio_feature is not distinct from p.{s}_bio_feature and "
            + " and ".join(f"{a}.{c} = p.{s}_{c}" for c in VARIANT)
            for s, a in (("left", "lpv"), ("right", "rpv"))
        ),
    ),
    (
        "outerj",
        "select "
        + ", ".join(f"coalesce(f.{c}, t.{c}) as {c}" for c in COLOC_KEYS)
        + ", "
        + ", ".join(f'f."{c}"' for c in FE.FEATURE_COLUMNS)
        + f", t.coloc_h3, t.coloc_h4, t.coloc_log2_h4_h3 from feat f full join tested t on {same('f', 't', COLOC_KEYS)}",
    ),
]
NEEDS = ["coloc_raw", "panel", "top_loci"]
FRACTIONS = [*PROPS, "left_prop_total_overlap", "right_prop_total_overlap", "left_log_pval", "right_log_pval"]


def _r(cols) -> str:
    return ", ".join(f'round("{c}", 6) + 0.0 as "{c}"' for c in cols)


def _round(df, cols):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) + F.lit(0.0) for c in cols})


def _upto(name: str):
    names = [n for n, _ in FE_CTES]
    return FE_CTES[: names.index(name) + 1]


def both_ld(t):
    """LD of every left and right lead variant."""

    def build():
        raw = t("coloc_raw")
        index = L.index_variants(raw).union(raw.select(*RIGHT)).distinct()
        return L.ld_pairs(index, t("panel"), 500, 0.05, n_samples(t))

    return t.derived("ld_both_sides", build)


def tested(t):
    return FE.feature_input_filter(S.h4_h3(t("coloc_raw")), 50)


def features(t):
    return t.derived(
        "features", lambda: FE.create_features(tested(t), both_ld(t), t("top_loci"))
    )


def model_input(t):
    return FE.feature_set(FE.features_outer_coloc(features(t), tested(t)))


@query(
    "feature_input_filter",
    f"select {csv(COLOC_KEYS)}, coloc_n_vars from (select * exclude (left_phenotype, left_bio_feature, right_phenotype, right_bio_feature), nullif(left_phenotype, 'None') as left_phenotype, nullif(left_bio_feature, 'None') as left_bio_feature, nullif(right_phenotype, 'None') as right_phenotype, nullif(right_bio_feature, 'None') as right_bio_feature from coloc_raw) x where coloc_n_vars > 200 and left_type = 'gwas'",
    ["coloc_raw"],
)
def _(t):
    return FE.feature_input_filter(t("coloc_raw"), 200).select(*COLOC_KEYS, "coloc_n_vars")


@query(
    "neg_log10_pval",
    f"select {csv(VARIANT)}, study_id, phenotype_id, bio_feature, round(case when p > 0 then -log10(p) else {S.MAX_NEG_LOG10!r} end, 6) + 0.0 as log_pval"
    " from (select *, case when pval < 1e-9 then 0.0 else pval end as p from top_loci) x",
    ["top_loci"],
)
def _(t):
    # p-values below 1e-9 recorded as 0
    p = F.when(F.col("pval") < 1e-9, 0.0).otherwise(F.col("pval"))
    out = t("top_loci").select(
        *VARIANT, "study_id", "phenotype_id", "bio_feature", S.neg_log10_pval(p).alias("log_pval")
    )
    return rounded(out, "log_pval")


@query(
    "abs_distance",
    f"select {csv(COLOC_KEYS)}, abs(left_pos - right_pos) as abs_distance from coloc_raw",
    ["coloc_raw"],
)
def _(t):
    return t("coloc_raw").select(
        *COLOC_KEYS, F.abs(F.col("left_pos") - F.col("right_pos")).alias("abs_distance")
    )


@query(
    "is_gwas_flag",
    f"select {csv(COLOC_KEYS)}, case when left_type = 'gwas' then 1 else 0 end as left_is_gwas, case when right_type = 'gwas' then 1 else 0 end as right_is_gwas from coloc_raw",
    ["coloc_raw"],
)
def _(t):
    return FE.is_gwas_flags(t("coloc_raw")).select(*COLOC_KEYS, "left_is_gwas", "right_is_gwas")


@query(
    "ld_tags",
    " union all ".join(
        f"select '{s}' as side, {', '.join(f'{s}_{c} as {c}' for c in COLOC_SIGNAL)}, {csv(TAG)}, {r6(f'{s}_r2', 'r2')} from {s}_tags"
        for s in ("left", "right")
    ),
    NEEDS,
    _upto("right_tags"),
)
def _(t):
    sides = []
    for s in ("left", "right"):
        tags = FE.signal_tags(tested(t), both_ld(t), s)
        names = [F.col(f"{s}_{c}").alias(c) for c in COLOC_SIGNAL]
        sides.append(tags.select(F.lit(s).alias("side"), *names, *TAG, F.col(f"{s}_R2_EUR").alias("r2")))
    return rounded(sides[0].unionAll(sides[1]), "r2")


@query(
    "ld_intersection",
    f"select distinct {csv([*LEFT, *RIGHT, *TAG])}, {r6('left_r2', 'left_R2_EUR')}, {r6('right_r2', 'right_R2_EUR')} from (select l.*, r.* exclude ({csv(TAG)}) from left_tags l join right_tags r on "
    + " and ".join(f"l.{c} = r.{c}" for c in TAG)
    + ") x",
    NEEDS,
    _upto("right_tags"),
)
def _(t):
    left, right = (FE.ld_tags(tested(t), both_ld(t), s) for s in ("left", "right"))
    out = FE.ld_intersection(left, right).select(*LEFT, *RIGHT, *TAG, "left_R2_EUR", "right_R2_EUR")
    return rounded(out, "left_R2_EUR", "right_R2_EUR")


@query(
    "prop_overlap_at_r2",
    f"select distinct {csv([*LEFT, *RIGHT])}, total_overlap, {_r(PROPS)} from props",
    NEEDS,
    _upto("props"),
)
def _(t):
    left, right = (FE.ld_tags(tested(t), both_ld(t), s) for s in ("left", "right"))
    return _round(FE.shared_tag_props(left, right), PROPS)


@query(
    "side_tag_counts",
    " union all ".join(
        f"select distinct '{s}' as side, {', '.join(f'{s}_{c} as {c}' for c in VARIANT)}, {s}_num_tags as num_tags from {s}_n"
        for s in ("left", "right")
    ),
    NEEDS,
    _upto("right_n"),
)
def _(t):
    sides = []
    for s in ("left", "right"):
        counts = FE.side_tag_counts(FE.ld_tags(tested(t), both_ld(t), s), s)
        names = [F.col(f"{s}_{c}").alias(c) for c in VARIANT]
        sides.append(counts.select(F.lit(s).alias("side"), *names, F.col(f"{s}_num_tags").alias("num_tags")))
    return sides[0].unionAll(sides[1])


@query(
    "join_log_pvals",
    f"select {csv(COLOC_KEYS)}, {_r(['left_log_pval', 'right_log_pval'])} from (select p.*, lpv.log_pval as left_log_pval, rpv.log_pval as right_log_pval from tested p"
    + "".join(
        f" join lp {a} on {a}.study_id = p.{s}_study and {a}.phenotype_id is not distinct from p.{s}_phenotype and {a}.bio_feature is not distinct from p.{s}_bio_feature and "
        + " and ".join(f"{a}.{c} = p.{s}_{c}" for c in VARIANT)
        for s, a in (("left", "lpv"), ("right", "rpv"))
    )
    + ") x",
    NEEDS,
    [c for c in FE_CTES if c[0] in ("tested", "lp")],
)
def _(t):
    df = tested(t).select(*COLOC_KEYS)
    # sQTL phenotypes are packed in results, so those rows have no listed lead
    for s in ("left", "right"):
        df = FE.join_log_pvals(df, t("top_loci"), s)
    return _round(df, ["left_log_pval", "right_log_pval"])


@query(
    "create_features",
    f"select {csv(COLOC_KEYS)}, total_overlap, {_r(FRACTIONS)}, left_num_tags, right_num_tags, abs_distance, left_is_gwas, right_is_gwas from feat",
    NEEDS,
    _upto("feat"),
)
def _(t):
    return _round(FE.create_features(tested(t), both_ld(t), t("top_loci")), FRACTIONS)


@query(
    "features_outer_coloc",
    f"select {csv(COLOC_KEYS)}, total_overlap, left_num_tags, right_num_tags, {_r(['coloc_h3', 'coloc_h4', 'coloc_log2_h4_h3'])} from outerj",
    NEEDS,
    FE_CTES,
)
def _(t):
    out = FE.features_outer_coloc(features(t), tested(t)).select(
        *COLOC_KEYS, "total_overlap", "left_num_tags", "right_num_tags", "coloc_h3", "coloc_h4", "coloc_log2_h4_h3"
    )
    return rounded(out, "coloc_h3", "coloc_h4", "coloc_log2_h4_h3")


@query(
    "feature_run",
    f"select {csv(COLOC_KEYS)}, total_overlap, {_r(FRACTIONS)}, left_num_tags, right_num_tags, abs_distance, left_is_gwas, right_is_gwas, {_r(['coloc_h3', 'coloc_h4', 'coloc_log2_h4_h3'])} from outerj",
    NEEDS,
    FE_CTES,
)
def _(t):
    # the plan from results to its written feature table, LD included
    spark = t("coloc_raw").sparkSession
    written = prediction.feature_files(
        spark, t("coloc_raw"), t("panel"), t("top_loci"), scratch_path(spark, "feature_run"), n_samples(t), min_vars=50, fits=False
    )
    return _round(written["features_outer"], [*FRACTIONS, "coloc_h3", "coloc_h4", "coloc_log2_h4_h3"])


@query(
    "feature_match_counts",
    "select count(case when total_overlap is not null and coloc_log2_h4_h3 is null then 1 end) as ld_only, count(case when total_overlap is null and coloc_log2_h4_h3 is not null then 1 end) as coloc_only,"
    " count(case when total_overlap is not null and coloc_log2_h4_h3 is not null then 1 end) as both from outerj".replace(" as both", ' as "both"'),
    NEEDS,
    FE_CTES,
)
def _(t):
    return FE.match_counts(FE.features_outer_coloc(features(t), tested(t)))


@query(
    "feature_matrix",
    f"select {csv(COLOC_KEYS)}, {r6('coloc_h4', 'label')}, feature, round(value, 6) + 0.0 as value from (unpivot (select {csv(COLOC_KEYS)}, coloc_h4, "
    + ", ".join(f'cast("{c}" as double) as "{c}"' for c in FE.FEATURE_COLUMNS)
    + " from outerj where total_overlap is not null and coloc_log2_h4_h3 is not null and right_type <> 'gwas') on "
    + ", ".join(f'"{c}"' for c in FE.FEATURE_COLUMNS)
    + " into name feature value value) u",
    NEEDS,
    FE_CTES,
)
def _(t):
    matrix = ml.feature_matrix(model_input(t), "h4", "molecular_trait")
    return rounded(ml.matrix_rows(matrix), "label", "value")


_SEED_KEY = "md5(concat('123', " + ", ".join(f"'|', coalesce(cast({c} as varchar(400)), '~')" for c in COLOC_KEYS) + "))"


@query(
    "shuffle_sample",
    f"select {csv(COLOC_KEYS)}, total_overlap, row_number() over (order by {_SEED_KEY}) - 1 as place from outerj where total_overlap is not null and coloc_log2_h4_h3 is not null",
    NEEDS,
    FE_CTES,
)
def _(t):
    return ml.shuffle_sample(model_input(t)).select(*COLOC_KEYS, "total_overlap", "place")


# Model fits have no SQL form; tests check them against bounds.

def every_prediction(t) -> DataFrame:
    """Held-out predictions of the whole grid: subsets x outcomes x regressors."""
    return t.derived("cv_predictions", lambda: ml.cv_predictions(model_input(t), keep=materialise))


@query("cv_predictions")
def _(t):
    return every_prediction(t)


@query("cv_regress")
def _(t):
    return ml.cv_scores(every_prediction(t))


def _every_target(fit) -> DataFrame:
    parts = [fit(target).withColumn("target", F.lit(target)) for target in ml.TARGETS]
    return reduce(DataFrame.unionByName, parts)


@query("feature_importance")
def _(t):
    data = model_input(t)
    return _every_target(lambda target: ml.feature_importance(data, target))


# Linear fits in SQL: sums of products per group, added up to training sets and swept.
_SHARE = "('0x' || substr(md5(concat_ws('|', '{salt}', " + ", ".join(f"{c}::varchar" for c in COLOC_KEYS) + ")), 1, 5))::int"
_K = len(FE.FEATURE_COLUMNS) + 1  # features and the constant
_STEP = "case " + " ".join(f"when u < {f}::double then {i}" for i, f in enumerate(ml.FRACTIONS)) + " end"
GRAM_CTES = [
    *FE_CTES,
    (
        "drawn",
        f"select *, {_SHARE.format(salt=123)} % 5 as fold, {_SHARE.format(salt=321)} / {ml.HASH_RANGE}::double as u, right_type = 'gwas' as gwas"
        " from outerj where total_overlap is not null and coloc_log2_h4_h3 is not null",
    ),
    (
        "z",
        " union all ".join(
            f"select '{t}' as target, gwas, fold, {_STEP} as step, [1.0::double, "
            + ", ".join(f'"{c}"::double' for c in FE.FEATURE_COLUMNS)
            + f", {column}] as z from drawn where {column} is not null"
            for t, column in ml.TARGETS.items()
        ),
    ),
    ("places", f"select unnest(range(1, {_K + 2})) as i"),
    ("sums", "select target, gwas, fold, step, p.i, q.i as j, sum(z.z[p.i] * z.z[q.i]) as v from z, places p, places q group by all"),
    ("subsets(subset, gwas)", "values ('all', true), ('all', false), ('gwas', true), ('molecular_trait', false)"),
    ("shares(step, fraction)", "values " + ", ".join(f"({i}, {f}::double)" for i, f in enumerate(ml.FRACTIONS))),
    ("held(held_out)", "select unnest(range(5))"),
    (
        "trained",
        "select subset, target, h.step, fraction, held_out, i, j, sum(v) as v from sums join subsets using (gwas) join shares h on sums.step <= h.step join held on held_out <> fold group by all",
    ),
    ("tested_on", "select subset, target, fold as held_out, i, j, sum(v) as v from sums join subsets using (gwas) group by all"),
]
for _name in ("trained", "tested_on"):
    _by = "subset, target, held_out" + (", step, fraction" if _name == "trained" else "")
    GRAM_CTES.append(
        (f"{_name}_m", f"select {_by}, list(r order by i) as m from (select {_by}, i, list(v order by j) as r from {_name} group by all) x group by all")
    )
GRAM_CTES += [
    (
        "swept_fits",
        "select subset, target, held_out, step, fraction, 0 as p, m, [m[i][i] for i in range(1, len(m) + 1)] as own, []::bigint[] as kept from trained_m"
        f" union all select subset, target, held_out, step, fraction, p + 1, case when m[p + 1][p + 1] <= {ml.COLLINEAR} * own[p + 1] then m else"
        " [[case when a = p + 1 and b = p + 1 then -1 / m[a][b] when a = p + 1 or b = p + 1 then m[a][b] / m[p + 1][p + 1]"
        " else m[a][b] - m[a][p + 1] * m[p + 1][b] / m[p + 1][p + 1] end for b in range(1, len(m) + 1)] for a in range(1, len(m) + 1)] end, own,"
        f" case when m[p + 1][p + 1] <= {ml.COLLINEAR} * own[p + 1] then kept else list_append(kept, p + 1) end from swept_fits where p < {_K}",
    ),
    (
        "fits",
        f"select f.* exclude (m), t.m as train, e.m as test, [case when list_contains(f.kept, a) then f.m[a][{_K + 1}] else 0 end for a in range(1, {_K + 1})] as b from swept_fits f"
        " join trained_m t using (subset, target, held_out, step) join tested_on_m e using (subset, target, held_out) where f.p = " + str(_K),
    ),
    (
        "r2",
        "select subset, target, fraction, held_out, "
        + ", ".join(
            f"case when {s}[{_K + 1}][{_K + 1}] - {s}[1][{_K + 1}] ** 2 / {s}[1][1] > 1e-12 * {s}[{_K + 1}][{_K + 1}] then"
            f" 1 - ({s}[{_K + 1}][{_K + 1}] - 2 * list_sum([b[a] * {s}[a][{_K + 1}] for a in range(1, {_K + 1})])"
            f" + list_sum([list_sum([b[a] * b[c] * {s}[a][c] for c in range(1, {_K + 1})]) for a in range(1, {_K + 1})]))"
            f" / ({s}[{_K + 1}][{_K + 1}] - {s}[1][{_K + 1}] ** 2 / {s}[1][1]) end as {s}_r2"
            for s in ("train", "test")
        )
        + " from fits",
    ),
]
#: Scores are compared to 3 digits, those of fits that fail (far below 0) to whole numbers: the sums
#: of nearly collinear features cost digits.
R2_DIGITS, FAILED = 3, 10


def _score_sql(expr: str) -> str:
    return f"case when abs({expr}) > {FAILED} then round({expr}) else round({expr}, {R2_DIGITS}) end + 0.0"


def _scores(df):
    def short(c):
        return F.when(F.abs(c) > FAILED, F.round(c)).otherwise(F.round(c, R2_DIGITS)) + F.lit(0.0)

    return df.withColumns({c: short(c) for c in _MEAN_NAMES})


_MEANS = ", ".join(
    f"{_score_sql(f'{agg}({s}_r2)')} as {s}_r2_{label}"
    for s in ("train", "test")
    for agg, label in (("avg", "mean"), ("stddev_pop", "sd"))
)
_MEAN_NAMES = [f"{s}_r2_{label}" for s in ("train", "test") for label in ("mean", "sd")]


@query("cv_regress_ols", f"select subset, target, {_MEANS} from r2 where fraction = 1.0 group by subset, target", NEEDS, GRAM_CTES)
def _(t):
    scores = ml.mean_scores(ml.ols_scores(t.derived("model_input", lambda: model_input(t)), fractions=(1.0,))).drop("fraction")
    return _scores(scores)


@query("learning_curve", f"select subset, target, fraction, {_MEANS} from r2 group by subset, target, fraction", NEEDS, GRAM_CTES)
def _(t):
    return _scores(ml.mean_scores(ml.ols_scores(t.derived("model_input", lambda: model_input(t)))))
