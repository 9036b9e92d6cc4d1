"""Pieces several registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import signal_id
from lociweave.operators import manifest as M
from lociweave.operators.overlap import overlap_table
from lociweave.operators.sumstats import window_join
from lociweave.schemas import COLOC_KEYS, SIGNAL

MAX_DIST = 500_000


def r6(expr: str, alias: str | None = None) -> str:
    """SQL: rounded to 6 digits, without a negative zero."""
    return f"round({expr}, 6) + 0.0 as {alias or expr}"


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


def sides(cols) -> list[str]:
    return [f"{s}_{c}" for s in ("left", "right") for c in cols]


def csv(cols, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in cols)


def same(a: str, b: str, cols, prefix_a: str = "", prefix_b: str = "") -> str:
    """SQL: null-safe equality of the named columns of two relations."""
    return " and ".join(f"{a}.{prefix_a}{c} is not distinct from {b}.{prefix_b}{c}" for c in cols)




def key_sql(p: str = "") -> str:
    """SQL: the readable signal key, of columns with prefix ``p``."""
    return (
        f"concat_ws('_', {p}type, {p}study_id, {p}phenotype_id, {p}bio_feature, {p}lead_chrom, "
        f"cast({p}lead_pos as varchar(12)), {p}lead_ref, {p}lead_alt)"
    )


KEY_SQL = key_sql()

# The overlap table in SQL, over the recipe ``credset``.
OVERLAP_CTES = [
    ("ck", f"select *, {KEY_SQL} as k from credset where is95_credset"),
    (
        "ov_n",
        "select "
        + ", ".join(f"a.{c} as left_{c}" for c in SIGNAL)
        + ", "
        + ", ".join(f"b.{c} as right_{c}" for c in SIGNAL)
        + ", count(*) as num_overlapping from ck a join ck b on a.tag_chrom=b.tag_chrom and a.tag_pos=b.tag_pos"
        " and a.tag_ref=b.tag_ref and a.tag_alt=b.tag_alt where a.study_id<>b.study_id and (a.type='gwas' or b.type='gwas')"
        f" and a.k>b.k and abs(a.lead_pos-b.lead_pos)<={MAX_DIST} group by all",
    ),
    ("ov_t", f"select {csv(SIGNAL)}, count(*) as num_tags from ck group by all"),
    (
        "overlap",
        "select o.*, l.num_tags as left_num_tags, r.num_tags as right_num_tags,"
        " num_overlapping / l.num_tags as left_overlap_prop, num_overlapping / r.num_tags as right_overlap_prop"
        f" from ov_n o join ov_t l on {same('l', 'o', SIGNAL, '', 'left_')} join ov_t r on {same('r', 'o', SIGNAL, '', 'right_')}",
    ),
]

# Coloc keys with 'None' turned back into null.
CLEAN_KEYS_SQL = ", ".join(
    f"nullif({c}, 'None') as {c}" if c.endswith(("phenotype", "bio_feature")) else c
    for c in COLOC_KEYS
)


def overlap(t, with_ids: bool = True) -> DataFrame:
    return t.derived(
        "overlap_with_ids",
        lambda: overlap_table(t("credset"), max_dist=MAX_DIST, with_ids=True),
    ) if with_ids else overlap_table(t("credset"), max_dist=MAX_DIST)


def manifest(t) -> DataFrame:
    return M.manifest_build(M.filter_overlap_prop(overlap(t)))


def signals(t) -> DataFrame:
    return t.derived("signals", lambda: M.distinct_signals(manifest(t)))


def all_signals(t) -> DataFrame:
    """Every signal of the 95 % credible sets, whether or not it overlaps another."""
    return (
        t("credset").filter("is95_credset").select(*SIGNAL).distinct().withColumn("sid", signal_id())
    )


def reduced(t) -> DataFrame:
    """Every tested signal's summary statistics within 500 kb, unconditioned."""
    return t.derived(
        "reduced_unconditioned", lambda: window_join(signals(t), t("sumstats"), 500, 0.01)
    )
