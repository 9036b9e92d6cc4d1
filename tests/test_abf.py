import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.operators import abf as A

SCHEMA = "sid binary, chrom string, pos int, ref string, alt string, beta double, se double, pval double, n_total int, n_cases int, eaf double, is_cc boolean"
HS = [f"coloc_h{i}" for i in range(5)]


def _logsum(x):
    m = max(x)
    return m + math.log(sum(math.exp(v - m) for v in x))


def numpy_coloc(left, right, p1=1e-4, p2=1e-4, p12=1e-5):
    """Direct computation for one pair; rows are dicts keyed by position."""
    shared = sorted(set(left) & set(right))

    def labf(rows):
        first = rows[min(rows)]
        v = np.array([rows[p]["se"] ** 2 for p in shared])
        z = np.array([rows[p]["beta"] / rows[p]["se"] for p in shared])
        maf = np.array([min(rows[p]["eaf"], 1 - rows[p]["eaf"]) for p in shared])
        if first["is_cc"]:
            prior = 0.2
        else:
            nvx = 2 * first["n_total"] * maf * (1 - maf)
            prior = 0.15 * math.sqrt(np.sum(nvx / v) / np.sum(1 / v**2))
        r = prior**2 / (prior**2 + v)
        return 0.5 * (np.log(1 - r) + r * z**2)

    l1, l2 = labf(left), labf(right)
    s1, s2, s12 = _logsum(l1), _logsum(l2), _logsum(l1 + l2)
    h = [0.0, math.log(p1) + s1, math.log(p2) + s2, -math.inf, math.log(p12) + s12]
    if len(shared) > 1 and s1 + s2 > s12:
        h[3] = math.log(p1) + math.log(p2) + s1 + s2 + math.log1p(-math.exp(s12 - s1 - s2))
    total = _logsum(h)
    return len(shared), [math.exp(x - total) for x in h]


def _signals(rng, n_signals=5, n=60, cc=(0,), scale=1.0):
    out = {}
    for s in range(n_signals):
        pos = rng.choice(200, n, replace=False)
        out[s] = {
            int(p): {
                "beta": float(rng.normal() * 0.1 * scale),
                "se": float(rng.uniform(0.01, 0.05)),
                "eaf": float(rng.uniform(0.02, 0.98)),
                "n_total": 10_000 + s,
                "is_cc": s in cc,
            }
            for p in pos
        }
    return out


def _frame(spark, signals):
    data = [
        (bytes([s]), "1", p, "A", "T", r["beta"], r["se"], 0.5, r["n_total"], 2000, r["eaf"], r["is_cc"])
        for s, rows in signals.items()
        for p, r in rows.items()
    ]
    return spark.createDataFrame(data, SCHEMA)


def _pairs(spark, pairs):
    return spark.createDataFrame(
        [(bytes([a]), bytes([b])) for a, b in pairs], "left_sid binary, right_sid binary"
    )


def _result(df):
    return {
        (r.left_sid[0], r.right_sid[0]): (r.coloc_n_vars, [r[h] for h in HS]) for r in df.collect()
    }


PAIRS = [(0, 1), (1, 2), (3, 1), (4, 0), (2, 4)]


@pytest.mark.parametrize("scale", [1.0, 30.0])
def test_equals_direct_computation(spark, scale):
    signals = _signals(np.random.default_rng(1), scale=scale)
    got = _result(A.coloc_abf(_pairs(spark, PAIRS), _frame(spark, signals)))
    for a, b in PAIRS:
        n, want = numpy_coloc(signals[a], signals[b])
        assert got[a, b][0] == n
        assert got[a, b][1] == pytest.approx(want, abs=1e-9)
        assert sum(got[a, b][1]) == pytest.approx(1.0)


@pytest.mark.parametrize("rows_per_cell", [1, 60, 130])
def test_cells_do_not_change_a_pair(spark, rows_per_cell):
    signals = _signals(np.random.default_rng(2))
    pairs, frame = _pairs(spark, PAIRS), _frame(spark, signals)
    whole = _result(A.coloc_abf(pairs, frame))
    cut = _result(A.coloc_abf(pairs, frame, rows_per_cell=rows_per_cell))
    assert whole.keys() == cut.keys()
    for k in whole:
        assert whole[k][0] == cut[k][0] and whole[k][1] == pytest.approx(cut[k][1], abs=1e-12)


def test_each_signal_goes_to_a_cell_once(spark):
    """What is shipped does not grow with the pairs."""
    signals = _signals(np.random.default_rng(2), 6)
    frame = _frame(spark, signals)
    info = A.study_type_prop(frame)
    every = [(a, b) for a in range(6) for b in range(6) if a != b]
    for pairs in (PAIRS, every):
        tests = A._in_cells(_pairs(spark, pairs), info, info, 10**6)
        assert tests.select(*A.CELL).distinct().count() == 1
    blocks = A.column_blocks(A.usable_rows(frame), 50).collect()
    assert sum(len(r.key) for r in blocks) == 360 and all(len({p // 50 for p in r.pos}) == 1 for r in blocks)


def test_repeated_variants_meet_in_every_combination(spark):
    rows = {p: {"beta": 0.1 * p, "se": 0.02, "eaf": 0.3, "n_total": 1000, "is_cc": True} for p in (5, 6, 7)}
    frame = _frame(spark, {0: rows, 1: rows})
    frame = frame.union(frame.filter("pos = 6")).union(frame.filter("pos = 6 and sid = X'01'"))
    shared = A.harmonise_pair(_pairs(spark, [(0, 1)]), frame)
    assert _result(A.coloc_abf(_pairs(spark, [(0, 1)]), frame))[0, 1][0] == shared.count() == 2 + 2 * 3


def test_swapping_sides_swaps_h1_and_h2(spark):
    signals = _signals(np.random.default_rng(3))
    frame = _frame(spark, signals)
    ab = _result(A.coloc_abf(_pairs(spark, [(0, 1)]), frame))[0, 1][1]
    ba = _result(A.coloc_abf(_pairs(spark, [(1, 0)]), frame))[1, 0][1]
    assert ab == pytest.approx([ba[0], ba[2], ba[1], ba[3], ba[4]], abs=1e-12)


def test_one_shared_variant_and_none(spark):
    row = {"beta": 0.3, "se": 0.02, "eaf": 0.3, "n_total": 1000, "is_cc": True}
    signals = {0: {5: row, 6: row}, 1: {6: row}, 2: {9: row}}
    got = _result(A.coloc_abf(_pairs(spark, [(0, 1), (0, 2)]), _frame(spark, signals)))
    assert list(got) == [(0, 1)]
    assert got[0, 1][0] == 1 and got[0, 1][1][3] == 0.0 and sum(got[0, 1][1]) == pytest.approx(1)


def test_rows_that_cannot_be_used_are_left_out_and_counted(spark):
    signals = _signals(np.random.default_rng(4), 2)
    frame = _frame(spark, signals)
    bad = frame.withColumn(
        "se", F.when(F.col("pos") % 3 == 0, 0.0).otherwise(F.col("se"))
    ).withColumn("beta", F.when(F.col("pos") % 5 == 1, None).otherwise(F.col("beta")))
    kept = {s: {p: r for p, r in rows.items() if p % 3 and p % 5 != 1} for s, rows in signals.items()}
    n, want = numpy_coloc(kept[0], kept[1])
    got = _result(A.coloc_abf(_pairs(spark, [(0, 1)]), bad))[0, 1]
    assert got[0] == n
    counted = {r.sid[0]: r.n_unusable for r in A.unusable_rows(bad).collect()}
    assert counted[0] == sum(p % 3 == 0 and p % 5 != 1 for p in signals[0])


def test_first_row_decides_type_and_n(spark):
    frame = _frame(spark, _signals(np.random.default_rng(5), 1))
    first = min(r.pos for r in frame.collect())
    mixed = frame.withColumn("is_cc", F.col("pos") == first).withColumn("n_cases", F.lit(9000))
    info = A.study_type_prop(mixed).collect()[0]
    assert info.is_cc and info.n == 10_000 and info.s == pytest.approx(0.1)


def test_log_sums_far_apart(spark):
    data = [(1, -900.0, 5000.0), (1, -20.0, 4000.0), (1, 3.0, -4000.0), (2, -1000.0, 0.0)]
    df = spark.createDataFrame(data, "k int, l1 double, l2 double")
    got = {r.k: r for r in A.log_sums(df, ["k"]).collect()}
    for k in (1, 2):
        l1 = [a for kk, a, _ in data if kk == k]
        l2 = [b for kk, _, b in data if kk == k]
        assert got[k].s1 == pytest.approx(_logsum(l1))
        assert got[k].s2 == pytest.approx(_logsum(l2))
        assert got[k].s12 == pytest.approx(_logsum([a + b for a, b in zip(l1, l2)]))


def test_pvalue_input_goes_by_each_rows_type(spark):
    from statistics import NormalDist

    data = [(p, 0.2, 1000, 0.25, cc) for p in (1e-8, 0.3, 0.04) for cc in (True, False, None)]
    df = spark.createDataFrame(data, "pval double, eaf double, n_total int, s double, is_cc boolean")
    for r in A.pvalue_dataset(df).collect():
        per_sample = 2 * 1000 * 0.2 * 0.8 * (0.25 * 0.75 if r.is_cc else 1)
        assert r.v == pytest.approx(1 / per_sample)
        assert r.z == pytest.approx(-NormalDist().inv_cdf(r.pval / 2))
        assert r.prior_sd == (0.2 if r.is_cc else 0.15)


def test_failures_name_what_was_not_tested(spark):
    from lociweave.operators.audit import run_failures

    signals = _signals(np.random.default_rng(7), 3)
    frame = _frame(spark, signals).filter("sid <> X'02'")
    broken = frame.withColumn("se", F.when((F.col("sid") == F.lit(bytes([1]))), 0.0).otherwise(F.col("se")))
    pairs = _pairs(spark, [(0, 1), (0, 2)])
    ids = spark.createDataFrame([(bytes([i]),) for i in range(3)], "sid binary")
    got = run_failures(ids, pairs, broken, A.coloc_abf(pairs, broken)).collect()
    named = {(bytes(r.left_sid), r.right_sid and bytes(r.right_sid), r.reason): r.n_rows for r in got}
    a, b, c = (bytes([i]) for i in range(3))
    assert named == {
        (c, None, "no statistics"): 0,
        (b, None, "unusable rows"): len(signals[1]),
        (a, b, "no shared variant"): 0,
        (a, c, "no shared variant"): 0,
    }


def test_left_window_uses_the_wider_right_rows(spark):
    signals = _signals(np.random.default_rng(6), 2)
    frame = _frame(spark, signals)
    narrow = frame.filter("pos < 120")
    got = _result(A.coloc_abf(_pairs(spark, [(0, 1)]), narrow, right_reduced=frame))[0, 1]
    left = {p: r for p, r in signals[0].items() if p < 120}
    n, want = numpy_coloc(left, signals[1])
    assert got[0] == n and got[1] == pytest.approx(want, abs=1e-9)


def test_rows_are_counted_and_pairs_placed_once(spark):
    signals = _signals(np.random.default_rng(8), 3)
    frame = _frame(spark, signals).withColumn("beta", F.when(F.col("sid") != F.lit(bytes([2])), F.col("beta")))
    pairs = _pairs(spark, [(0, 1), (0, 2)])
    kept = []

    def keep(df, name):
        kept.append((name, df.count()))
        return df.localCheckpoint()

    tested = A.coloc_abf(pairs, frame, keep=keep)
    assert kept == [("signal_info", 2), ("tests", 1)] and tested.count() == 1
    counts = {bytes(r.sid): (r.n_rows, r.n_unusable) for r in A.usable_counts(frame).collect()}
    assert counts == {bytes([i]): (len(signals[i]) if i < 2 else 0, 0) for i in range(3)}
