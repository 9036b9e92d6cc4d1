import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.functions.stats import two_sided_p, z_from_p
from lociweave.operators import conditional as C
from lociweave.operators import ld as L
from lociweave.operators import sumstats as S
from lociweave.schemas import VARIANT


@pytest.fixture(scope="module")
def panel_data():
    rng = np.random.default_rng(7)
    n, m = 80, 14
    base = rng.integers(0, 3, (n, 4))
    g = np.stack([np.where(rng.random(n) < 0.75, base[:, j % 4], rng.integers(0, 3, n)) for j in range(m)])
    g[13] = 0  # no carriers
    g[12] = 1  # no variation
    return g


@pytest.fixture(scope="module")
def panel(spark, panel_data):
    data = [
        ("1", 1000 * (j + 1), "A", "T", s, int(d))
        for j, row in enumerate(panel_data)
        for s, d in enumerate(row)
        if d
    ]
    return spark.createDataFrame(
        data, "chrom string, pos int, ref string, alt string, sample_id long, dosage int"
    )


def _index(spark, which):
    return spark.createDataFrame(
        [("1", 1000 * (j + 1), "A", "T") for j in which], "chrom string, pos int, ref string, alt string"
    )


@pytest.mark.parametrize("limits", [(250_000, 1000, 16_384), (100, 2, 13)])
def test_ld_equals_numpy(spark, panel, panel_data, monkeypatch, limits):
    for name, value in zip(("TILE_CARRIERS", "TILE_VARIANTS", "SAMPLE_BLOCK"), limits):
        monkeypatch.setattr(L, name, value)
    out = L.ld_pairs(_index(spark, [0, 3, 5, 12]), panel, 4, 0.01, n_samples=80).collect()
    got = {(r.lead_pos // 1000 - 1, r.tag_pos // 1000 - 1): r.r for r in out}
    want = {}
    for i in (0, 3, 5):
        for j in range(12):
            r = np.corrcoef(panel_data[i], panel_data[j])[0, 1]
            if abs(i - j) <= 4 and r * r >= 0.01:
                want[i, j] = r
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert all(got[i, i] == pytest.approx(1.0) for i in (0, 3, 5))


def test_panel_size(spark, panel):
    assert L.panel_size(panel) == 80
    with pytest.raises(ValueError):
        L.ld_pairs(_index(spark, [0]), panel, 4)


def test_only_wanted_tags_are_paired(spark, panel):
    index = _index(spark, [0, 3])
    every = L.ld_pairs(index, panel, 4, 0.0, 80)
    some = L.ld_pairs(index, panel, 4, 0.0, 80, _index(spark, [1, 2]))
    key = lambda r: (r.lead_pos, r.tag_pos, round(r.r, 9))
    wanted = {1000 * (i + 1) for i in (0, 1, 2, 3)}
    assert {key(r) for r in some.collect()} == {key(r) for r in every.collect() if r.tag_pos in wanted}


def test_grch38_windows(spark):
    windows = L.ld_windows(L.grch38_lengths(spark))
    counts = {r.chrom: r["count"] for r in windows.groupBy("chrom").count().collect()}
    assert counts["21"] == 45 and "MT" not in counts and len(counts) == 24
    assert windows.filter("end - start <> 3000000").count() == 0


def test_window_lookup_falls_back_near_the_end(spark):
    windows = spark.createDataFrame([("1", s, s + 3_000_000) for s in (0, 1_000_000)], "chrom string, start int, end int")
    signals = spark.createDataFrame(
        [(b"a", "1", 500_000), (b"b", "1", 2_500_000), (b"c", "1", 4_100_000), (b"d", "1", 9_000_000)],
        "sid binary, lead_chrom string, lead_pos int",
    )
    got = {bytes(r.sid): r.window_start for r in L.signal_window_lookup(signals, windows).collect()}
    assert got == {b"a": 0, b"b": 1_000_000, b"c": 1_000_000, b"d": None}


def test_ld_file_round_trip(spark, panel):
    ld = L.ld_pairs(_index(spark, [0]), panel, 4, 0.0, 80)
    back = L.parse_ld(L.to_ld_file(ld))
    assert sorted((r.lead_pos, r.tag_pos, r.R_EUR) for r in back.collect()) == sorted(
        (r.lead_pos, r.tag_pos, r.r) for r in ld.collect()
    )


def brute_conditional(stats, corr, leads, max_r2=0.9):
    """One signal, straight from the formulas. ``stats``: j -> (beta, se, eaf, n)."""
    d = {j: 2 * f * (1 - f) * n for j, (b, s, f, n) in stats.items()}
    vp = float(
        np.median([d[j] * s * s + d[j] * b * b / (n - 1) for j, (b, s, f, n) in stats.items()])
    )
    kept = []
    for i in sorted(leads, key=lambda i: (leads[i], i)):
        # a lead of which those before it explain more than max_r2 is left out
        own = corr[np.ix_(kept, [i])][:, 0]
        if not kept or own @ np.linalg.solve(corr[np.ix_(kept, kept)], own) <= max_r2:
            kept.append(i)
    kept.sort()
    dz = np.diag([d[i] for i in kept])
    root = np.sqrt(dz)
    b_matrix = root @ corr[np.ix_(kept, kept)] @ root
    marginal = np.array([stats[i][0] for i in kept])
    joint = np.linalg.solve(b_matrix, dz @ marginal)
    out = {}
    for j, (b, s, f, n) in stats.items():
        own = corr[np.ix_(kept, [j])][:, 0]
        if own @ np.linalg.solve(corr[np.ix_(kept, kept)], own) > max_r2:
            continue
        c = math.sqrt(d[j]) * root @ corr[np.ix_(kept, [j])][:, 0]
        bc = b - c @ joint / d[j]
        left = d[j] - c @ np.linalg.solve(b_matrix, c)
        s2 = (vp * (n - 1) - joint @ dz @ marginal - bc * b * d[j]) / (n - len(kept) - 1)
        if s2 * left > 0:
            out[j] = (bc, math.sqrt(s2 * left) / d[j])
    return out


def _conditioning(spark, panel_data, lead_sets):
    rng = np.random.default_rng(8)
    rows, conds, stats = [], [], {}
    for sid, leads in lead_sets.items():
        stats[sid] = {}
        for j in range(12):
            b, s, f, n = float(rng.normal() * 0.1), float(rng.uniform(0.01, 0.03)), float(rng.uniform(0.1, 0.9)), 5000
            stats[sid][j] = (b, s, f, n)
            row = (bytes([sid]), 1, "1", 1000 * (j + 1), "A", "T", b, s, leads.get(j, 0.5), n, 100, f, False)
            rows.append(row)
            if j in leads:
                conds.append(row)
    schema = "sid binary, lead_pos int, chrom string, pos int, ref string, alt string, beta double, se double, pval double, n_total int, n_cases int, eaf double, is_cc boolean"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(conds, schema), stats


LEADS = {1: {0: 1e-9}, 2: {1: 1e-5, 6: 1e-9}, 3: {0: 1e-8, 4: 1e-20, 7: 1e-3, 10: 1e-4}}


@pytest.mark.parametrize(
    ("max_r2", "limits"),
    [(0.9, {}), (0.3, {}), (0.9, {"TILE_BP": 3000, "ROWS_PER_CELL": 5, "TILE_CARRIERS": 100, "SAMPLE_BLOCK": 13}), (0.9, {"LEADS_PER_CELL": 1, "TILE_VARIANTS": 2})],
)
def test_conditioning_equals_brute_force(spark, panel, panel_data, max_r2, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(C, name, value)
    windowed, conds, stats = _conditioning(spark, panel_data, LEADS)
    got = {}
    for r in C.conditional_sumstats(windowed, conds, panel, 80, max_r2).collect():
        got.setdefault(r.sid[0], {})[r.pos // 1000 - 1] = (r.beta, r.se, r.pval)
    corr = np.corrcoef(panel_data[:12])
    for sid, leads in LEADS.items():
        want = brute_conditional(stats[sid], corr, leads, max_r2)
        assert got.get(sid, {}).keys() == want.keys() and want
        for j, (b, s) in want.items():
            assert got[sid][j][:2] == pytest.approx((b, s), rel=1e-7)
            assert got[sid][j][2] == pytest.approx(math.erfc(abs(b / s) / math.sqrt(2)), rel=1e-6)


def test_signal_whose_leads_the_panel_lacks_is_reported(spark, panel, panel_data):
    windowed, conds, _ = _conditioning(spark, panel_data, {1: {2: 1e-9}})
    conds = conds.withColumn("alt", conds["ref"])
    out = C.conditional_sumstats(windowed, conds, panel, 80)
    assert out.count() == 0
    assert C.conditioning_failures(conds, out).collect()[0].n_leads == 1


def test_sweeping_is_inverting():
    rng = np.random.default_rng(1)
    g = rng.normal(size=(50, 6))
    g[:, 5] = g[:, 0] + g[:, 1]  # explained by two others, by neither alone
    r, w = np.corrcoef(g.T), rng.normal(size=6)
    inverse, u, explained, k = C.sweep_leads(r, w, np.arange(6), 0.9)
    want = np.linalg.inv(r[:5, :5])
    assert k == 5 and np.allclose(inverse[:5, :5], want) and not inverse[5].any() and not u[5]
    assert np.allclose(u[:5], want @ w[:5]) and explained == pytest.approx(w[:5] @ want @ w[:5])


def _signals(spark, data):
    return spark.createDataFrame(
        data,
        "sid binary, study_id string, phenotype_id string, bio_feature string, lead_chrom string, lead_pos int, lead_ref string, lead_alt string, has_ld boolean",
    )


def _sumstats(spark):
    data = []
    for study, ph, bf in [("G", None, None), ("Q", "P1", "B1"), ("Q", "P1", "B2"), ("Q", "P2", "B1"), ("H", "P1", None)]:
        for j in range(40):
            eaf = [0.3, 0.005, float("nan"), None][j % 4]
            data.append((study, ph, bf, "1" if j < 30 else "2", 1000 * j, "A", "T", 0.1, 0.02, 0.5, 100, 10, eaf, False))
    return spark.createDataFrame(data, S.SUMSTATS)


def test_window_join_equals_brute_force(spark):
    stats = _sumstats(spark)
    signals = [
        (b"a", "G", None, None, "1", 5000),
        (b"b", "Q", "P1", "B1", "1", 0),
        (b"c", "Q", "P1", None, "1", 20_000),
        (b"d", "Q", None, "B1", "2", 31_000),
        (b"e", "Q", None, None, "1", 29_000),
        (b"f", "H", "P1", "B9", "1", 29_000),
        (b"g", "missing", None, None, "1", 29_000),
    ]
    frame = _signals(spark, [(*s, "A", "T", True) for s in signals])
    got = sorted((bytes(r.sid), r.pos, r.chrom) for r in S.window_join(frame, stats, 6, 0.01, bucket_bp=2500).collect())
    want = []
    for sid, study, ph, bf, chrom, pos in signals:
        for r in stats.collect():
            maf_known_rare = r.eaf is not None and not math.isnan(r.eaf) and min(r.eaf, 1 - r.eaf) < 0.01
            if (
                r.study_id == study
                and (ph is None or r.phenotype_id == ph)
                and (bf is None or r.bio_feature == bf)
                and r.chrom == chrom
                and abs(r.pos - pos) <= 6000
                and not maf_known_rare
            ):
                want.append((sid, r.pos, r.chrom))
    assert got == sorted(want) and want


def test_select_sumstats_keeps_unknown_frequencies(spark):
    one = S.select_sumstats(_sumstats(spark), "Q", "P1", chrom="1", start=1000, end=9000, min_maf=0.01)
    assert sorted({r.pos for r in one.collect()}) == [2000, 3000, 4000, 6000, 7000, 8000]
    assert one.count() == 12 and one.first().variant_id.count(":") == 3


def test_cond_list_leaves_the_own_lead_out(spark):
    signals = _signals(
        spark, [(b"a", "G", None, None, "1", 5000, "A", "T", True), (b"b", "Q", "P1", "B1", "1", 8000, "A", "T", True)]
    )
    loci = spark.createDataFrame(
        [
            ("G", None, None, "1", 5000, "A", "T"),
            ("G", None, None, "1", 7000, "A", "T"),
            ("G", None, None, "1", 28_000, "A", "T"),
            ("Q", "P1", "B1", "1", 8000, "A", "T"),
            ("Q", "P2", "B1", "1", 8000, "A", "T"),
            ("Q", "P1", "B1", "1", 9000, "A", "T"),
            ("G", None, None, "1", 7000, "A", "G"),
        ],
        "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, ref string, alt string",
    )
    windowed = S.window_join(signals, _sumstats(spark), 10)
    got = {(bytes(r.sid), r.pos) for r in S.cond_list(signals, windowed, loci, 10).collect()}
    assert got == {(b"a", 7000), (b"b", 9000)}


def test_reduced_sumstats_without_ld_is_the_plain_window(spark, panel):
    signals = _signals(
        spark, [(b"a", "G", None, None, "1", 15_000, "A", "T", False), (b"b", "G", None, None, "1", 5000, "A", "T", True)]
    )
    loci = spark.createDataFrame(
        [("G", None, None, "1", 7000, "A", "T")],
        "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, ref string, alt string",
    )
    stats = _sumstats(spark).filter("eaf = 0.3 or pos = 7000").fillna({"eaf": 0.4})
    out = C.reduced_sumstats(signals, stats, loci, panel, window_coloc_kb=4, window_cond_kb=8, min_maf=0.01, n_samples=80)
    by = {}
    for r in out.collect():
        by.setdefault(bytes(r.sid), {})[r.pos] = r.beta
    assert set(by[b"a"]) == {12_000, 16_000} and set(by[b"a"].values()) == {0.1}
    # conditioned: the lead at 7000 is gone and the rest have moved
    assert 7000 not in by[b"b"] and all(v != 0.1 for v in by[b"b"].values()) and by[b"b"]


def test_normal_helpers_run_no_loop_per_row(spark):
    # a loop over the series in higher-order functions took 50 microseconds a row and more
    df = spark.range(1).select((F.col("id") / 10 + 0.1).alias("x"))
    for found in (two_sided_p(F.col("x")), z_from_p(F.col("x"))):
        plan = df.select(found.alias("found"))._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and "aggregate(" not in plan


def test_normal_helpers(spark):
    z = [0.0, 1e-9, 0.3, 1.0, -3.5, 4.2, 8.0, 37.0, 60.0, None]
    df = spark.createDataFrame([(v,) for v in z], "z double").select("z", two_sided_p(F.col("z")).alias("p"))
    for r in df.collect():
        want = None if r.z is None else math.erfc(abs(r.z) / math.sqrt(2))
        assert r.p == (want if not want else pytest.approx(want, rel=1e-11))
    ps = [0.05, 1e-200, 0.0, 1.0, 0.999, 0.3, 1e-8, 1e-300, 1.5, None]
    back = spark.createDataFrame([(v,) for v in ps], "p double").select("p", z_from_p(F.col("p")).alias("z"))
    got = {r.p: r.z for r in back.collect()}
    assert got[None] is None and got[1.5] is None and got[1.0] == pytest.approx(0.0, abs=1e-12)
    for p in (0.999, 0.3, 1e-8, 1e-300):
        assert math.erfc(got[p] / math.sqrt(2)) == pytest.approx(p, rel=1e-9)
    assert got[0.05] == pytest.approx(1.959963984540054)
    assert got[0.0] is None or math.isnan(got[0.0])
    assert math.erfc(got[1e-200] / math.sqrt(2)) == pytest.approx(1e-200, rel=1e-6)


def test_cells_are_told_from_stored_spans(spark, panel, panel_data):
    windowed, conds, stats = _conditioning(spark, panel_data, LEADS)
    kept = {}

    def keep(df, name):
        kept[name] = df.localCheckpoint()
        return kept[name]

    assert C.conditional_sumstats(windowed, conds, panel, 80, keep=keep).count() > 0
    assert {(r.sid[0], r.tile): r.n for r in kept["spans"].collect()} == {(s, 0): 12 for s in stats}
    assert [(r.chrom, r.tile, r.subs, r.parts) for r in kept["cells"].collect()] == [("1", 0, 1, 1)]


def test_phenotype_variance_is_a_median(spark):
    rows = [(b"a", 0.1, s, 0.5, 101) for s in (0.3, 0.1, 0.2)] + [(b"b", 0.0, s, 0.5, 101) for s in (0.1, 0.4, None, 0.2, 0.3)]
    df = spark.createDataFrame([*rows, (b"c", None, 0.1, 0.5, 101)], "sid binary, beta double, se double, eaf double, n_total int")
    got = {bytes(r.sid): r.vp for r in C.phenotype_variance(df).collect()}
    d = 0.5 * 101
    assert got[b"a"] == pytest.approx(d * 0.04 + d * 0.01 / 100) and got[b"c"] is None
    assert got[b"b"] == pytest.approx(d * (0.04 + 0.09) / 2)
