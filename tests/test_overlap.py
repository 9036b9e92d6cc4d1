from itertools import product

import pytest
from pyspark.sql import functions as F

from lociweave.operators import overlap as O
from lociweave.operators.skew import broadcast_if_small, grid_join
from lociweave.schemas import CREDSET


def _signal(study, type_="gwas", ph=None, bf=None, lead=100, tags=(100,), n95=None):
    out = []
    for i, pos in enumerate(tags):
        inside = n95 is None or i < n95
        out.append((type_, study, ph, bf, "1", lead, "A", "T", "1", pos, "A", "T", inside, True, "conditional"))
    return out


@pytest.fixture
def credset(spark):
    data = (
        _signal("G1", tags=(100, 110, 120))
        + _signal("G2", lead=110, tags=(110, 120, 130))
        + _signal("Q1", "eqtl", "P1", "B", 120, (120, 140))
        + _signal("Q1", "eqtl", "P1", None, 120, (120,))
        + _signal("Q2", "pqtl", "P1", "B", 140, (120, 140))
        + _signal("G1", lead=2_000_000, tags=(140,))
    )
    return spark.createDataFrame(data, CREDSET)


def _brute(credset, max_dist=None):
    signals = {}
    for r in credset.collect():
        key = tuple(r[:8])
        signals.setdefault(key, []).append(tuple(r[8:12]))
    text = lambda k: "_".join(str(x) for x in k if x is not None)
    out = {}
    for a, b in product(signals, signals):
        shared = sum(x == y for x in signals[a] for y in signals[b])
        if not shared or a[1] == b[1] or "gwas" not in (a[0], b[0]) or not text(a) > text(b):
            continue
        if max_dist and abs(a[5] - b[5]) > max_dist:
            continue
        out[a + b] = (shared, len(signals[a]), len(signals[b]))
    return out


@pytest.mark.parametrize("max_dist", [None, 500_000])
def test_overlap_table_equals_brute_force(credset, max_dist):
    table = O.overlap_table(credset, max_dist=max_dist)
    got = {tuple(r[:16]): tuple(r[16:19]) for r in table.collect()}
    assert got == _brute(credset, max_dist) and got
    assert all(
        r.left_overlap_prop == r.num_overlapping / r.left_num_tags for r in table.collect()
    )


def test_signals_that_differ_in_a_null_stay_apart(credset):
    table = O.overlap_table(credset)
    q1 = table.filter("right_study_id = 'Q1' or left_study_id = 'Q1'").select(
        F.coalesce("right_bio_feature", "left_bio_feature").alias("bf")
    )
    assert {r.bf for r in q1.collect()} == {"B", None}


def test_each_pair_appears_once(credset):
    table = O.overlap_table(credset, with_ids=True)
    pairs = [frozenset((bytes(r.left_sid), bytes(r.right_sid))) for r in table.collect()]
    assert len(pairs) == len(set(pairs))


def test_repeated_rows_count_like_a_plain_join(spark, credset):
    twice = credset.unionAll(credset.filter("study_id = 'G2'"))
    got = {tuple(r[:16]): tuple(r[16:19]) for r in O.overlap_table(twice).collect()}
    assert got == _brute(twice)


def test_credset_and_method_filters(spark):
    data = _signal("G1", tags=(1, 2, 3), n95=1)
    data.append((*data[0][:14], "distance"))
    df = spark.createDataFrame(data, CREDSET)
    assert O.filter_credset(df, "95").count() == 2
    assert O.filter_credset(df, "99").count() == 4
    assert O.filter_method(df, "distance").count() == 1
    assert O.filter_method(df, "all").count() == 4
    with pytest.raises(ValueError):
        O.filter_credset(df, "90")


def test_grid_join_splits_a_hot_key_exactly(spark, rows):
    left = spark.range(300).select(
        F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("a")
    )
    right = spark.range(150).select(
        F.when(F.col("id") < 90, 0).otherwise(F.col("id") % 5).alias("k"), F.col("id").alias("b")
    )
    plain = left.join(right, "k")
    assert rows(grid_join(left, right, ["k"], edge=10), "k", "a", "b") == rows(plain, "k", "a", "b")
    some = F.col("a") > F.col("b")
    assert rows(grid_join(left, right, ["k"], some, edge=10), "a", "b") == rows(
        plain.filter(some), "a", "b"
    )


def test_grid_join_cuts_cells(spark):
    one = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    two = spark.range(500).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    joined = grid_join(one, two, ["k"], edge=50)
    assert joined.count() == 500_000
    # the hot key must not meet in a single task
    parts = joined.groupBy(F.spark_partition_id().alias("p")).count()
    assert parts.count() > 1


def test_broadcast_needs_a_small_table(spark):
    small, large = spark.range(5), spark.range(50)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(broadcast_if_small(small, 10))
    assert not hinted(broadcast_if_small(large, 10))


def test_low_p_matches_null_keys_and_does_not_multiply(spark, credset):
    table = O.overlap_table(credset)
    loci = spark.createDataFrame(
        [
            ("G1", None, None, "1:100:A:T", 0.0),
            ("G1", None, None, "1:100:A:T", 0.0),
            ("Q1", "P1", "None", "1:120:A:T", 0.0),
            ("G2", None, None, "1:110:A:T", 1e-5),
        ],
        "study_id string, phenotype_id string, bio_feature string, variant_id string, pval double",
    )
    kept = O.overlap_low_p(table, loci)
    want = table.filter(
        "(left_study_id = 'G1' and left_lead_pos = 100)"
        " or (right_study_id = 'G1' and right_lead_pos = 100)"
        " or (right_study_id = 'Q1' and right_bio_feature is null)"
    )
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect())) and kept.count()
