"""Registered queries: summary statistics, LD, conditioning and the ABF test."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.common import (
    KEY_SQL,
    all_signals,
    csv,
    key_sql,
    manifest,
    overlap,
    r6,
    reduced,
    rounded,
    sides,
    signals,
)
from lociweave.catalog.overlaps import MANIFEST_CTES, SIGNALS_SQL
from lociweave.catalog.registry import query
from lociweave.functions import scalars as S
from lociweave.operators import abf as A
from lociweave.operators import conditional as C
from lociweave.operators import ld as L
from lociweave.operators import manifest as M
from lociweave.operators import sumstats as SS
from lociweave.operators.audit import run_failures
from lociweave.operators.overlap import attach_signals
from lociweave.schemas import COLOC_KEYS, SIGNAL, SUMSTATS, VARIANT
from lociweave.session import materialise, scratch_path
from lociweave.sources import readers as R
from lociweave.sources import writers as W

V = csv(VARIANT)
MAF = "case when eaf <= 0.5 then eaf else 1 - eaf end"
VID = "concat_ws(':', chrom, cast(pos as varchar(12)), ref, alt)"
SIGNAL_CTES = [
    *MANIFEST_CTES,
    ("signals", SIGNALS_SQL),
    ("sig", f"select *, {KEY_SQL} as sid from signals"),
]


def window_sql(half_bp, rows: str = "sumstats", where: str = "true") -> str:
    return (
        f"select s.sid, s.lead_pos, ss.* from sig s join {rows} ss on ss.study_id = s.study_id"
        " and (s.phenotype_id is null or s.phenotype_id = ss.phenotype_id)"
        " and (s.bio_feature is null or s.bio_feature = ss.bio_feature)"
        f" and ss.chrom = s.lead_chrom and ss.pos between s.lead_pos - {half_bp} and s.lead_pos + {half_bp} where {where}"
    )


RED_CTES = [*SIGNAL_CTES, ("red", window_sql(500_000, where=f"not ({MAF} < 0.01)"))]


def named_signals(t):
    """The signals with their readable key behind the 16 bytes of their id: rows then need no join
    to show it (:func:`_named`), and the ids still tell all signals apart."""
    return signals(t).withColumn("sid", F.concat("sid", S.signal_key().cast("binary")))


def _named(df):
    """Rows of ``named_signals`` with the readable key instead of the id."""
    return df.withColumn("sid", F.expr("cast(substring(sid, 17) as string)"))


def _keyed(t, df):
    """Replace the binary signal id by the readable key."""
    keys = signals(t).select("sid", S.signal_key().alias("key"))
    return df.join(keys, "sid").drop("sid").withColumnRenamed("key", "sid")


# p-values are compared as logarithms: to 6 decimals most would be 0
LOG_P = "round(log10(nullif(pval, 0)), 6) + 0.0 as log_p"


def log_p(df):
    return df.withColumn("log_p", F.round(F.log10("pval"), 6) + F.lit(0.0)).drop("pval")


# -- summary statistics -----------------------------------------------------

@query(
    "scan_sumstats",
    f"select study_id, phenotype_id, bio_feature, {V}, beta, se, {LOG_P}, n_total, n_cases, eaf, is_cc, {VID} as variant_id from sumstats where study_id = 'ST5' and bio_feature = 'BRAIN' and pos >= 100000 and pos <= 1500000 and not ({MAF} < 0.05)",
    ["sumstats"],
)
def _(t):
    rows = SS.select_sumstats(
        t("sumstats"), "ST5", bio_feature="BRAIN", start=100_000, end=1_500_000, min_maf=0.05
    )
    return log_p(rows)


@query("variant_id", f"select distinct {V}, {VID} as variant_id from sumstats", ["sumstats"])
def _(t):
    return t("sumstats").select(*VARIANT).distinct().withColumn("variant_id", S.variant_id())


@query(
    "variant_id_translate",
    f"select variant_id, replace(variant_id, ':', '_') as ld_id, variant_id as back from (select distinct {VID} as variant_id from sumstats) x",
    ["sumstats"],
)
def _(t):
    ids = t("sumstats").select(S.variant_id().alias("variant_id")).distinct()
    ids = ids.withColumn("ld_id", S.to_ld_variant_id(F.col("variant_id")))
    return ids.withColumn("back", S.from_ld_variant_id(F.col("ld_id")))


@query(
    "parse_variant_id",
    "select distinct ld_id, split_part(ld_id, '_', 1) as v_chrom, cast(split_part(ld_id, '_', 2) as int) as v_pos, split_part(ld_id, '_', 3) as v_ref, split_part(ld_id, '_', 4) as v_alt from x",
    ["sumstats"],
    [("x", f"select replace({VID}, ':', '_') as ld_id from sumstats")],
)
def _(t):
    ids = t("sumstats").select(S.to_ld_variant_id(S.variant_id()).alias("ld_id")).distinct()
    return ids.select("ld_id", *S.parse_variant_id(F.col("ld_id"), "v", far=t.far))


@query(
    "eaf_to_maf",
    f"select {V}, study_id, phenotype_id, bio_feature, {r6(MAF, 'maf')} from sumstats",
    ["sumstats"],
)
def _(t):
    out = SS.add_maf(t("sumstats")).select(*VARIANT, "study_id", "phenotype_id", "bio_feature", "maf")
    return rounded(out, "maf")


@query(
    "chrom_to_string",
    "select case chrom when '5' then 'X' when '4' then 'MT' else chrom end as chrom, study_id, pos, beta from sumstats",
    ["sumstats"],
)
def _(t):
    # chromosomes as directory names, of which most look like numbers, read back as text
    named = F.when(F.col("chrom") == "5", "X").when(F.col("chrom") == "4", "MT").otherwise(F.col("chrom"))
    out = scratch_path(t.spark, "sumstats_by_chrom")
    W.partition_sumstats(t("sumstats").select(*SUMSTATS.names).withColumn("chrom", named), out)
    return R.scan_sumstats_table(t.spark, out, t.far).select("chrom", "study_id", "pos", "beta")


@query(
    "filter_min_maf",
    f"select {V}, study_id, phenotype_id, bio_feature, beta, se from sumstats where not ({MAF} < 0.1)",
    ["sumstats"],
)
def _(t):
    return SS.filter_min_maf(t("sumstats"), 0.1).select(
        *VARIANT, "study_id", "phenotype_id", "bio_feature", "beta", "se"
    )


_GAPPY = ("gappy", "select *, case when pval > 0.9 then null else beta end as b2 from sumstats")


@query(
    "filter_null_beta",
    f"select {V}, study_id, phenotype_id, bio_feature, b2 as beta from gappy where b2 is not null",
    ["sumstats"],
    [_GAPPY],
)
def _(t):
    gappy = t("sumstats").withColumn("beta", F.when(F.col("pval") > 0.9, None).otherwise(F.col("beta")))
    return SS.filter_null_beta(gappy).select(
        *VARIANT, "study_id", "phenotype_id", "bio_feature", "beta"
    )


@query(
    "optional_key_filter",
    "select sid, study_id, count(*) as n, count(distinct phenotype_id) as n_ph from w group by sid, study_id",
    ["credset", "sumstats"],
    [
        (
            "sig",
            f"select distinct {KEY_SQL} as sid, study_id, case when type = 'eqtl' then phenotype_id end as phenotype_id,"
            " case when type = 'sqtl' then bio_feature end as bio_feature, lead_chrom, lead_pos from credset where is95_credset",
        ),
        ("w", window_sql(250_000)),
    ],
)
def _(t):
    # eQTL signals without a bio-feature, sQTL signals without a phenotype,
    # others without either: a missing key matches every value
    sig = (
        all_signals(t)
        .withColumn("key", S.signal_key())
        .withColumns(
            {
                "phenotype_id": F.expr("case when type = 'eqtl' then phenotype_id end"),
                "bio_feature": F.expr("case when type = 'sqtl' then bio_feature end"),
            }
        )
    )
    rows = t("sumstats").withColumn("ph", F.col("phenotype_id"))
    hits = SS.window_join(sig, rows, 250)
    return (
        hits.join(sig.select("sid", "key", "study_id"), "sid")
        .groupBy(F.col("key").alias("sid"), "study_id")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ph").alias("n_ph"))
    )


_RED_COLS = ["sid", *VARIANT, "beta", "se", "eaf"]


@query(
    "signal_sumstats",
    f"select {csv(_RED_COLS)}, lead_pos from w",
    ["credset", "sumstats"],
    [*SIGNAL_CTES, ("w", window_sql(500_000, where=f"not ({MAF} < 0.01)"))],
)
def _(t):
    return _named(SS.window_join(named_signals(t), t("sumstats"), 500, 0.01)).select(*_RED_COLS, "lead_pos")


@query(
    "window_extract",
    f"select {csv(_RED_COLS)} from w where pos between lead_pos - 100000 and lead_pos + 100000",
    ["credset", "sumstats"],
    [*SIGNAL_CTES, ("w", window_sql(500_000, where=f"not ({MAF} < 0.01)"))],
)
def _(t):
    return _keyed(t, SS.extract_window(reduced(t), 100)).select(*_RED_COLS)


def cond_ctes(half_bp: int):
    return [
        *SIGNAL_CTES,
        ("w", window_sql(half_bp, where=f"not ({MAF} < 0.01)")),
        ("lw", window_sql(half_bp, "(select distinct study_id, phenotype_id, bio_feature, chrom, pos, ref, alt from top_loci)")),
        (
            "cond",
            "select distinct l.sid, l.chrom, l.pos, l.ref, l.alt, w.beta, w.eaf, w.n_total, w.pval from lw l"
            " join sig s on s.sid = l.sid join w on w.sid = l.sid and w.chrom = l.chrom and w.pos = l.pos and w.ref = l.ref and w.alt = l.alt"
            " where not (l.chrom = s.lead_chrom and l.pos = s.lead_pos and l.ref = s.lead_ref and l.alt = s.lead_alt)",
        ),
    ]


@query(
    "cond_list",
    f"select sid, {V}, beta, {LOG_P} from cond",
    ["credset", "sumstats", "top_loci"],
    cond_ctes(1_000_000),
)
def _(t):
    windowed = SS.window_join(named_signals(t), t("sumstats"), 1000, 0.01)
    conds = SS.cond_list(named_signals(t), windowed, t("top_loci"), 1000)
    return log_p(_named(conds).select("sid", *VARIANT, "beta", "pval"))


# -- LD ---------------------------------------------------------------------

LENGTHS = "select chrom, max(pos) as length from sumstats group by chrom"
SIZE, STEP = 300_000, 100_000
WINDOWS_SQL = (
    "select chrom, cast(unnest(range(0, cast(length - {gap} as bigint), {step})) as int) as start from ({l}) x"
).format(gap=SIZE - STEP, step=STEP, l=LENGTHS)
WINDOW_CTES = [
    ("wstart", WINDOWS_SQL),
    ("windows", f"select chrom, start, start + {SIZE} as \"end\" from wstart"),
]


def _windows(t):
    lengths = t("sumstats").groupBy("chrom").agg(F.max("pos").alias("length"))
    return L.ld_windows(lengths, SIZE, STEP)


@query("ld_windows", 'select chrom, start, "end" from windows', ["sumstats"], WINDOW_CTES)
def _(t):
    return _windows(t)


@query(
    "panel_window_assign",
    'select p.chrom, p.pos, p.ref, p.alt, w.start, w."end", count(*) as n_carriers from panel p join windows w on p.chrom = w.chrom and p.pos between w.start and w."end" group by all',
    ["panel", "sumstats"],
    WINDOW_CTES,
)
def _(t):
    # a variant's carriers are counted once and not in each of its windows
    carriers = t("panel").groupBy(*VARIANT).agg(F.count(F.lit(1)).alias("n_carriers"))
    return L.panel_window_assign(carriers, _windows(t), SIZE, STEP).select(*VARIANT, "start", "end", "n_carriers")


@query(
    "signal_window_lookup",
    f'select s.sid, max(w.start) as window_start, max(w."end") as window_end from s left join windows w on w.chrom = s.lead_chrom and w.start in (s.own, s.own - {STEP}, s.own - {2 * STEP}) group by s.sid',
    ["credset", "sumstats"],
    [
        *SIGNAL_CTES,
        *WINDOW_CTES,
        ("s", f"select sid, lead_chrom, (greatest(1, cast(floor(lead_pos / {STEP}.0) as int)) - 1) * {STEP} as own from sig"),
    ],
)
def _(t):
    found = L.signal_window_lookup(signals(t), _windows(t), STEP)
    return _keyed(t, found).select("sid", "window_start", "window_end")


INDEX_SQL = "select distinct left_chrom as chrom, left_pos as pos, left_ref as ref, left_alt as alt from coloc_raw"
PANEL_CTES = [
    ("n", "select count(distinct sample_id) as n from panel"),
    ("pv", f"select {V}, sum(dosage) as s, sum(dosage * dosage) as ss from panel group by all"),
]


def corr_ctes(pairs: str):
    """CTEs ``shared`` and ``ld`` over the variant pairs of relation ``pairs``."""
    keys = csv(sides2 := [f"{s}_{c}" for s in ("lead", "tag") for c in VARIANT])
    on_lead = " and ".join(f"a.{c} = p.lead_{c}" for c in VARIANT)
    on_tag = " and ".join(f"b.{c} = p.tag_{c}" for c in VARIANT)
    back = " and ".join(f"q.{c} = p.{c}" for c in sides2)
    p_keys = csv(sides2, "p.")
    return [
        (
            "shared",
            f"select {p_keys}, sum(a.dosage * b.dosage) as sab from {pairs} p join panel a on {on_lead} join panel b on {on_tag} and b.sample_id = a.sample_id group by all",
        ),
        (
            "ld",
            f"select {keys}, r, r * r as r2 from (select {p_keys}, (n.n * coalesce(q.sab, 0) - a.s * b.s) / nullif(sqrt(cast(n.n * a.ss - a.s * a.s as double) * cast(n.n * b.ss - b.s * b.s as double)), 0.0) as r"
            f" from {pairs} p join pv a on {on_lead} join pv b on {on_tag} left join shared q on {back} cross join n) x where r is not null",
        ),
    ]


LD_KEYS = [f"{s}_{c}" for s in ("lead", "tag") for c in VARIANT]
LD_CTES = [
    *PANEL_CTES,
    ("idx", INDEX_SQL),
    (
        "vp",
        "select i.chrom as lead_chrom, i.pos as lead_pos, i.ref as lead_ref, i.alt as lead_alt, v.chrom as tag_chrom, v.pos as tag_pos, v.ref as tag_ref, v.alt as tag_alt"
        " from idx i join pv v on v.chrom = i.chrom and v.pos between i.pos - 500000 and i.pos + 500000",
    ),
    # carriers of an index variant meet the carriers around it by sample, not pair by pair
    (
        "shared",
        "select a.chrom as lead_chrom, a.pos as lead_pos, a.ref as lead_ref, a.alt as lead_alt, b.chrom as tag_chrom, b.pos as tag_pos, b.ref as tag_ref, b.alt as tag_alt, sum(a.dosage * b.dosage) as sab"
        " from (select p.* from panel p join idx i on i.chrom = p.chrom and i.pos = p.pos and i.ref = p.ref and i.alt = p.alt) a"
        " join panel b on b.sample_id = a.sample_id and b.chrom = a.chrom and b.pos between a.pos - 500000 and a.pos + 500000 group by all",
    ),
    corr_ctes("vp")[1],
]
LD_OUT = ("ld05", "select * from ld where r2 >= 0.05")


def n_samples(t) -> int:
    """Samples of the fixture's panel, where every sample carries something."""
    return L.panel_size(t("panel"))


def ld_table(t):
    return t.derived(
        "ld_pairs",
        lambda: L.ld_pairs(L.index_variants(t("coloc_raw")), t("panel"), 500, 0.05, n_samples(t)),
    )


@query("index_variants", INDEX_SQL, ["coloc_raw"])
def _(t):
    return L.index_variants(t("coloc_raw"))


@query(
    "ld_pairs",
    f"select {csv(LD_KEYS)}, {r6('r')}, {r6('r2')} from ld05",
    ["coloc_raw", "panel"],
    [*LD_CTES, LD_OUT],
)
def _(t):
    found = L.ld_pairs(L.index_variants(t("coloc_raw")), t("panel"), 500, 0.05, n_samples(t))
    return rounded(found, "r", "r2")


# -- conditioning -----------------------------------------------------------

@query(
    "gcta_projection",
    f"select sid, {VID} as SNP, alt as A1, ref as A2, eaf as freq, beta as b, se, {r6('pval', 'p')}, n_total as N from red where pval <= 0.01",
    ["credset", "sumstats"],
    RED_CTES,
)
def _(t):
    rows = _keyed(t, reduced(t)).withColumn("variant_id", S.variant_id())
    return rounded(C.cojo_input(rows, 0.01, keep=["sid"]), "p")


COND_KB = 1000
D = "2 * {p}eaf * (1 - {p}eaf) * {p}n_total"
VARIANT_SAME = " and ".join(f"{{a}}.{c} = {{b}}.{c}" for c in VARIANT)
LEAD_IS = " and ".join(f"ld.lead_{c} = c.{c}" for c in VARIANT)
TAG_IS = " and ".join(f"ld.tag_{c} = w.{c}" for c in VARIANT)
# Conditioning on any number of leads. The correlations of a signal's leads, bordered by sqrt(D) b,
# are swept by one lead after another, strongest first, as a list of lists; a lead of which those
# before it explain more than 0.9 is passed over.
CONDITIONAL_CTES = [
    *cond_ctes(1000 * COND_KB),
    *PANEL_CTES,
    (
        "cl",
        f"select c.*, {D.format(p='c.')} as d, row_number() over (partition by sid order by {csv(VARIANT, 'c.')}) as i,"
        f" row_number() over (partition by sid order by c.pval, {csv(VARIANT, 'c.')}) as o"
        f" from cond c join pv on {VARIANT_SAME.format(a='pv', b='c')} cross join n where n.n * pv.ss - pv.s * pv.s > 0",
    ),
    ("lv", f"select distinct {V} from cl"),
    (
        "wp",
        f"select distinct {csv([f'c.{c} as lead_{c}' for c in VARIANT])}, {csv([f'w.{c} as tag_{c}' for c in VARIANT])} from cl c join w on w.sid = c.sid",
    ),
    (
        "shared",
        f"select {csv([f'a.{c} as lead_{c}' for c in VARIANT])}, {csv([f'b.{c} as tag_{c}' for c in VARIANT])}, sum(a.dosage * b.dosage) as sab"
        f" from (select p.* from panel p join lv on {VARIANT_SAME.format(a='lv', b='p')}) a"
        f" join panel b on b.sample_id = a.sample_id and b.chrom = a.chrom and b.pos between a.pos - {2000 * COND_KB} and a.pos + {2000 * COND_KB} group by all",
    ),
    corr_ctes("wp")[1],
    (
        "rows_of",
        f"select c.sid, c.i, sqrt(c.d) * c.beta as z, list(ld.r order by w.i) as r from cl c join cl w on w.sid = c.sid join ld on {LEAD_IS} and {TAG_IS} group by all",
    ),
    (
        "bordered",
        "select sid, count(*) as k, list(list_append(r, z) order by i) || [list_append(list(z order by i), 0.0)] as m from rows_of group by sid",
    ),
    (
        "swept",
        "select sid, k, 0::bigint as o, m, []::bigint[] as kept from bordered"
        " union all select s.sid, s.k, c.o,"
        " case when s.m[c.i][c.i] < 0.1 then s.m else"
        " [[case when a = c.i and b = c.i then -1 / s.m[a][b] when a = c.i or b = c.i then s.m[a][b] / s.m[c.i][c.i]"
        " else s.m[a][b] - s.m[a][c.i] * s.m[c.i][b] / s.m[c.i][c.i] end for b in range(1, s.k + 2)] for a in range(1, s.k + 2)] end,"
        " case when s.m[c.i][c.i] < 0.1 then s.kept else list_append(s.kept, c.i) end"
        " from swept s join cl c on c.sid = s.sid and c.o = s.o + 1",
    ),
    (
        "var",
        f"select w.sid, quantile_cont({D.format(p='w.')} * se * se + {D.format(p='w.')} * beta * beta / (n_total - 1), 0.5) as vp from w join bordered b on b.sid = w.sid group by w.sid",
    ),
    (
        "rv",
        f"select w.sid, {csv(VARIANT, 'w.')}, list(ld.r order by c.i) as r from (select distinct sid, {V} from w) w join cl c on c.sid = w.sid join ld on {LEAD_IS} and {TAG_IS} group by all",
    ),
    (
        "cj",
        f"select w.*, {D.format(p='w.')} as d, var.vp, len(s.kept) as n_kept, -s.m[k + 1][k + 1] as explained, list_sum([rv.r[a] * s.m[a][k + 1] for a in s.kept]) as ru,"
        " list_sum([list_sum([rv.r[a] * rv.r[b] * -s.m[a][b] for b in s.kept]) for a in s.kept]) as taken"
        f" from rv join w on w.sid = rv.sid and {VARIANT_SAME.format(a='w', b='rv')} join swept s on s.sid = w.sid and s.o = s.k join var on var.sid = w.sid",
    ),
    ("cb", "select *, beta - ru / sqrt(d) as bc from cj where taken <= 0.9"),
    ("cv", "select *, (vp * (n_total - 1) - explained - bc * beta * d) / (n_total - n_kept - 1) * (1 - taken) / d as vc from cb"),
    ("conditional", "select * from cv where vc > 0"),
]
NEAR = "pos between lead_pos - 500000 and lead_pos + 500000"
_STAT = "chrom, pos, ref, alt, n_total, n_cases, eaf, is_cc"
REDUCED_CTE = (
    "red",
    f"select sid, {_STAT}, beta, se from w where sid not in (select sid from cond) and {NEAR}"
    f" union all select sid, {_STAT}, bc, sqrt(vc) from conditional where {NEAR}",
)
COND_NEEDS = ["credset", "sumstats", "top_loci", "panel"]


def conditioning_inputs(t, kb: int = COND_KB):
    """Windowed rows and the leads to condition on, as a run keeps them."""
    """With the ids of ``named_signals``."""
    windowed = t.derived(
        f"windowed_{kb}", lambda: C.by_signal(SS.window_join(named_signals(t), t("sumstats"), kb, 0.01))
    )
    conds = t.derived(
        f"cond_list_{kb}", lambda: SS.cond_list(named_signals(t), windowed, t("top_loci"), kb)
    )
    return windowed, conds


def _conditional(t):
    windowed, conds = conditioning_inputs(t)
    return C.conditional_sumstats(windowed, conds, t("panel"), n_samples(t), keep=materialise)


@query(
    "conditional_sumstats",
    f"select sid, {V}, {r6('bc', 'beta')}, {r6('sqrt(vc)', 'se')}, eaf, n_total from conditional",
    COND_NEEDS,
    CONDITIONAL_CTES,
)
def _(t):
    out = _named(_conditional(t)).select("sid", *VARIANT, "beta", "se", "eaf", "n_total")
    return rounded(out, "beta", "se")


@query(
    "merge_conditional",
    f"select sid, {V}, beta, {r6('bc', 'beta_cond')}, {r6('sqrt(vc)', 'se_cond')} from conditional",
    COND_NEEDS,
    CONDITIONAL_CTES,
)
def _(t):
    # only what is shown: the columns of a row travel together
    windowed = conditioning_inputs(t)[0].select("sid", *VARIANT, "beta")
    merged = C.merge_conditional(windowed, _conditional(t).drop("pval"))
    out = _named(merged).select("sid", *VARIANT, "beta", "beta_cond", "se_cond")
    return rounded(out, "beta_cond", "se_cond")


@query("conditional_sumstats_many")
def _(t):
    # with p-values, which SQL has no function for
    return _named(_conditional(t)).select("sid", *VARIANT, "beta", "se", "pval")


@query(
    "distance_method",
    f"select {csv(_RED_COLS)} from red",
    ["credset", "sumstats"],
    RED_CTES,
)
def _(t):
    rows = C.reduced_sumstats(
        named_signals(t), t("sumstats"), t("top_loci"), t("panel"), method="distance"
    )
    return _named(rows).select(*_RED_COLS)


def reduce_conditioned(t):
    """What a run tests with: conditioned where a signal has other leads around it."""
    return C.reduced_sumstats(
        signals(t), t("sumstats"), t("top_loci"), t("panel"), n_samples=n_samples(t), keep=materialise
    )


def reduced_conditioned(t):
    return t.derived("reduced_conditioned", lambda: reduce_conditioned(t))


@query(
    "reduced_sumstats",
    f"select sid, {V}, {r6('beta')}, {r6('se')}, eaf from red",
    COND_NEEDS,
    [*CONDITIONAL_CTES, REDUCED_CTE],
)
def _(t):
    return rounded(_keyed(t, reduced_conditioned(t)).select(*_RED_COLS), "beta", "se")


# -- ABF --------------------------------------------------------------------

TEST_CTES = [
    *RED_CTES,
    (
        "info",
        "select sid, n_total as n, n_cases, is_cc from (select *, row_number() over (partition by sid order by pos, ref, alt) as rn from red where beta is not null) x where rn = 1",
    ),
    (
        "pairs",
        f"select {key_sql('left_')} as left_sid, {key_sql('right_')} as right_sid from manifest",
    ),
    (
        "j",
        "select p.left_sid as ls, p.right_sid as rs, a.pos, a.beta as left_beta, b.beta as right_beta, a.beta/a.se as zl, b.beta/b.se as zr, a.se*a.se as vl, b.se*b.se as vr, least(a.eaf,1-a.eaf) as ml, least(b.eaf,1-b.eaf) as mr,"
        " il.n as nl, ir.n as nr, il.is_cc as lcc, ir.is_cc as rcc from pairs p join red a on a.sid = p.left_sid join red b on b.sid = p.right_sid and b.chrom = a.chrom and b.pos = a.pos and b.ref = a.ref and b.alt = a.alt"
        " join info il on il.sid = p.left_sid join info ir on ir.sid = p.right_sid where a.se > 0 and b.se > 0 and least(a.eaf,1-a.eaf) > 0 and least(b.eaf,1-b.eaf) > 0",
    ),
]
ABF_CTES = [
    *TEST_CTES,
    ("sd", "select ls, rs, sqrt(sum(2*nl*ml*(1-ml)/vl)/sum(1/(vl*vl))) as sdl, sqrt(sum(2*nr*mr*(1-mr)/vr)/sum(1/(vr*vr))) as sdr from j group by ls, rs"),
    ("pw", "select j.*, case when lcc then 0.2 else 0.15*sdl end as pl, case when rcc then 0.2 else 0.15*sdr end as pr from j join sd on j.ls=sd.ls and j.rs=sd.rs"),
    ("lb", "select ls, rs, 0.5*(ln(vl/(pl*pl+vl)) + (pl*pl/(pl*pl+vl))*zl*zl) as l1, 0.5*(ln(vr/(pr*pr+vr)) + (pr*pr/(pr*pr+vr))*zr*zr) as l2 from pw"),
    ("mx", "select ls, rs, max(l1) as m1, max(l2) as m2, max(l1+l2) as m12 from lb group by ls, rs"),
    (
        "ls3",
        "select lb.ls, lb.rs, count(*) as n, max(m1)+ln(sum(exp(l1-m1))) as s1, max(m2)+ln(sum(exp(l2-m2))) as s2, max(m12)+ln(sum(exp(l1+l2-m12))) as s12 from lb join mx on lb.ls=mx.ls and lb.rs=mx.rs group by lb.ls, lb.rs",
    ),
    (
        "hy",
        "select ls, rs, n, 0.0 as h0, ln(1e-4)+s1 as h1, ln(1e-4)+s2 as h2, case when n > 1 and s1+s2 > s12 then ln(1e-4)+ln(1e-4)+s1+s2+ln(1-exp(s12-s1-s2)) else -1e308 end as h3, ln(1e-5)+s12 as h4 from ls3",
    ),
    ("hm", "select *, greatest(h0,h1,h2,h3,h4) as g from hy"),
    ("ht", "select *, exp(h0-g)+exp(h1-g)+exp(h2-g)+exp(h3-g)+exp(h4-g) as t from hm"),
]
HS = ["coloc_h0", "coloc_h1", "coloc_h2", "coloc_h3", "coloc_h4"]
ABF_SQL = (
    "select ls as left_key, rs as right_key, cast(n as int) as coloc_n_vars, "
    + ", ".join(r6(f"exp(h{i}-g)/t", f"coloc_h{i}") for i in range(5))
    + " from ht"
)


def _keyed_pairs(t, df):
    keys = signals(t).select("sid", S.signal_key().alias("key"))
    return attach_signals(df, keys, ["key"]).drop("left_sid", "right_sid")


@query(
    "harmonise_pair",
    "select ls as left_key, rs as right_key, count(*) as n, cast(sum(pos) as bigint) as pos_sum, max(left_beta) as max_left_beta, min(right_beta) as min_right_beta from j group by ls, rs",
    ["credset", "sumstats"],
    TEST_CTES,
)
def _(t):
    shared = A.harmonise_pair(manifest(t).select(*A.PAIR), reduced(t))
    out = shared.groupBy(*A.PAIR).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("pos").alias("pos_sum"),
        F.max("left_beta").alias("max_left_beta"),
        F.min("right_beta").alias("min_right_beta"),
    )
    return _keyed_pairs(t, out)


@query(
    "study_type_prop",
    "select sid, n, is_cc, round(least(n_cases, n - n_cases) / n, 6) + 0.0 as s from info",
    ["credset", "sumstats"],
    TEST_CTES[:-2],
)
def _(t):
    out = _keyed(t, A.study_type_prop(reduced(t))).select("sid", "n", "is_cc", "s")
    return rounded(out, "s")


@query(
    "sdy_estimate",
    f"select sid, round(sqrt(sum(2*n_total*({MAF})*(1-({MAF}))/(se*se))/sum(1/(se*se*se*se))), 6) + 0.0 as sdy from red group by sid",
    ["credset", "sumstats"],
    RED_CTES,
)
def _(t):
    return rounded(_keyed(t, A.sdy_estimate(reduced(t), ["sid"])), "sdy")


@query("coloc_abf", ABF_SQL, ["credset", "sumstats"], ABF_CTES)
def _(t):
    out = A.coloc_abf(manifest(t).select(*A.PAIR), reduced(t), keep=materialise)
    return rounded(_keyed_pairs(t, out), *HS)


@query(
    "unusable_rows",
    "select sid, count(*) as n_rows, sum(case when eaf > 0.9 then 1 else 0 end)::bigint as n_unusable from red group by sid having sum(case when eaf > 0.9 then 1 else 0 end) > 0",
    ["credset", "sumstats"],
    RED_CTES,
)
def _(t):
    # frequencies above 0.9 recorded as 1: those variants cannot be tested
    broken = reduced(t).withColumn("eaf", F.when(F.col("eaf") > 0.9, 1.0).otherwise(F.col("eaf")))
    return _keyed(t, A.unusable_rows(broken))


@query(
    "coloc_abf_left_window",
    ABF_SQL,
    ["credset", "sumstats"],
    [
        *ABF_CTES[: [n for n, _ in ABF_CTES].index("info")],
        ("red_wide", window_sql(1_000_000, where=f"not ({MAF} < 0.01)")),
        *[
            (n, body.replace("join red b", "join red_wide b").replace("join info ir", "join info_wide ir"))
            for n, body in [
                ABF_CTES[[n for n, _ in ABF_CTES].index("info")],
                (
                    "info_wide",
                    "select sid, n_total as n, n_cases, is_cc from (select *, row_number() over (partition by sid order by pos, ref, alt) as rn from red_wide where beta is not null) x where rn = 1",
                ),
                *ABF_CTES[[n for n, _ in ABF_CTES].index("info") + 1 :],
            ]
        ],
    ],
)
def _(t):
    # both sides within 500 kb of the left lead
    wide = t.derived("reduced_wide", lambda: SS.window_join(signals(t), t("sumstats"), 1000, 0.01))
    out = A.coloc_abf(manifest(t).select(*A.PAIR), reduced(t), right_reduced=wide, keep=materialise)
    return rounded(_keyed_pairs(t, out), *HS)


# The test over conditioned statistics.
CONDITIONED_ABF_CTES = [*CONDITIONAL_CTES, REDUCED_CTE, *ABF_CTES[[n for n, _ in ABF_CTES].index("red") + 1 :]]


def conditioned_posteriors(t):
    return t.derived(
        "posteriors_conditioned",
        lambda: A.coloc_abf(manifest(t).select(*A.PAIR), reduced_conditioned(t), keep=materialise),
    )


@query("coloc_abf_conditioned", ABF_SQL, COND_NEEDS, CONDITIONED_ABF_CTES)
def _(t):
    # overlap, manifest, windows, conditioning and the test
    return rounded(_keyed_pairs(t, conditioned_posteriors(t)), *HS)


BROKEN = "eaf > 0.9"


@query(
    "run_failures",
    "select sid as left_key, cast(null as varchar) as right_key, 'no statistics' as reason, 0::bigint as n_rows from sig where sid not in (select sid from red)"
    f" union all select sid, null, 'unusable rows', count(*) from red where {BROKEN} group by sid"
    " union all select left_sid, right_sid, 'no shared variant', 0 from pairs p where not exists (select 1 from j where ls = p.left_sid and rs = p.right_sid"
    f" and not left_{BROKEN} and not right_{BROKEN})",
    ["credset", "sumstats"],
    [(n, b.replace("a.beta as left_beta", "a.eaf as left_eaf, b.eaf as right_eaf, a.beta as left_beta")) for n, b in TEST_CTES],
)
def _(t):
    # frequencies above 0.9 recorded as 1: those variants cannot be tested
    broken = reduced(t).withColumn("eaf", F.when(F.expr(BROKEN), 1.0).otherwise(F.col("eaf")))
    pairs = manifest(t).select(*A.PAIR)
    failed = run_failures(signals(t), pairs, broken, A.coloc_abf(pairs, broken, keep=materialise))
    keys = signals(t).select("sid", S.signal_key().alias("key"))
    for side in ("left", "right"):
        named = keys.select(F.col("sid").alias(f"{side}_sid"), F.col("key").alias(f"{side}_key"))
        failed = failed.join(named, f"{side}_sid", "left")
    return failed.select("left_key", "right_key", "reason", "n_rows")


@query("coloc_abf_pvalues")
def _(t):
    # as if only p-values were known: needs an inverse normal, checked in the tests
    cases = F.least(F.col("n_cases"), F.col("n_total") - F.col("n_cases"))
    data = A.pvalue_dataset(reduced(t).withColumn("s", F.try_divide(cases, F.col("n_total"))))
    shared = A.harmonise_pair(manifest(t).select(*A.PAIR), data, ("z", "v", "prior_sd"))
    shared = shared.filter("left_z is not null and right_z is not null and left_v is not null and right_v is not null")
    return rounded(_keyed_pairs(t, A.coloc_abf_pvalues(shared, A.PAIR)), *HS)
