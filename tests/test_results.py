import itertools

import pytest
from pyspark.sql import functions as F

from lociweave import fixtures
from lociweave.catalog import QUERIES
from lociweave.config import Config
from lociweave.operators import audit, enrich, merge
from lociweave.operators import process as P
from lociweave.schemas import COLOC_KEYS, COLOC_STATS, MERGE_KEYS, SUMSTATS
from lociweave.sources.writers import range_layout

SCHEMA = (
    "coloc_n_vars int, "
    + ", ".join(f"coloc_h{i} double" for i in range(5))
    + ", "
    + ", ".join(f"{c} {'int' if c.endswith('pos') else 'string'}" for c in COLOC_KEYS)
)


def test_row(left=("gwas", "G1", None, None), right=("eqtl", "Q1", "B", "P1"), lpos=10, rpos=20, h3=0.2, h4=0.6, n=500):
    return (n, 0.05, 0.1, 0.05, h3, h4, *left, "1", lpos, "A", "T", *right, "1", rpos, "A", "T")


row = test_row
del test_row


@pytest.fixture
def lut(spark):
    return spark.createDataFrame([("P1", "ENSG1"), ("P3", "ENSG3")], "phenotype_id string, gene_id string")


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_process_chain(spark, lut):
    raw = frame(
        spark,
        row(),
        row(rpos=21, h4=0.7, h3=0.1),  # better right locus of the same dataset
        row(right=("eqtl", "Q1", "B", "ENSG9"), lpos=11),
        row(right=("eqtl", "Q1", "None", "probe"), lpos=12),
        row(right=("sqtl", "S1", "B", "1^2^3^clu^ENSG7"), lpos=13),
        row(right=("sqtl", "S1", "B", "1^2"), lpos=14),
        row(right=("gwas", "G2", "None", "None"), lpos=15),
        row(lpos=16, n=99),
        row(lpos=17, h3=0.0),
        row(left=("eqtl", "Q1", "B", "P3"), right=("gwas", "G1", None, None), lpos=18),
    )
    out = P.process_results(raw, lut)
    got = {(r.left_pos, r.is_flipped): r for r in out.collect()}
    assert set(got) == {(10, False), (11, False), (12, False), (13, False), (14, False), (15, False), (20, True)}
    assert got[10, False].right_pos == 21 and got[10, False].right_gene_id == "ENSG1"
    assert got[11, False].right_gene_id == "ENSG9"
    assert got[12, False].right_gene_id is None and got[12, False].right_bio_feature is None
    assert got[13, False].right_gene_id == "ENSG7" and got[14, False].right_gene_id is None
    assert got[15, False].right_phenotype is None
    assert "left_phenotype" not in out.columns and "left_gene_id" not in out.columns
    assert got[10, False].coloc_log2_h4_h3 == pytest.approx(2.807354922)


def test_flipping_a_symmetric_table_gives_it_back(spark, rows):
    sym = P.make_symmetric(frame(spark, row(), row(lpos=11, right=("gwas", "G2", None, None))))
    again = P.make_symmetric(sym.drop("is_flipped")).drop("is_flipped").distinct()
    assert rows(again, *COLOC_STATS, *COLOC_KEYS) == rows(sym.distinct(), *COLOC_STATS, *COLOC_KEYS)


def test_flipped_rows_can_swap_h1_and_h2(spark):
    one = frame(spark, row())
    assert P.make_symmetric(one).filter("is_flipped").first().coloc_h1 == 0.1
    swapped = P.make_symmetric(one, swap_h1_h2=True).filter("is_flipped").first()
    assert (swapped.coloc_h1, swapped.coloc_h2) == (0.05, 0.1)


def test_dedup_does_not_depend_on_partitioning(spark, rows):
    data = [row(rpos=r, h4=h) for r, h in itertools.product(range(20, 30), (0.5, 0.6))] + [row(lpos=99)]
    picked = [
        rows(P.dedup_keep_best(frame(spark, *data).repartition(n)), "left_pos", "right_pos", "coloc_h4")
        for n in (1, 3, 7)
    ]
    assert picked[0] == picked[1] == picked[2] == [(10, 20, 0.6), (99, 20, 0.6)]


def test_rank_filter_cuts_groups_before_the_shuffle(spark):
    plan = P.dedup_keep_best(frame(spark, row()))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge(spark, rows):
    new = frame(spark, row(h4=0.9), row(lpos=11, right=("gwas", "G2", None, None)))
    old = frame(
        spark, row(h4=0.1), row(lpos=11, right=("gwas", "G2", None, None), h4=0.2), row(lpos=12)
    ).withColumn("note", F.lit("old"))
    merged = merge.merge_raw(new, old)
    assert {(r.left_pos, r.coloc_h4, r.note) for r in merged.collect()} == {
        (10, 0.9, None),
        (11, 0.6, None),
        (12, 0.6, "old"),
    }
    # null keys match null keys
    assert rows(merge.merge_missing(old, new), "left_pos") == [(12,)]
    assert merge.merge_missing(new, old).count() == 0
    assert rows(merge.merge_present(new, old), "left_pos") == [(10,), (11,)]
    both = merge.merge_overlap_compare(new, old)
    assert rows(both, "left_pos", "prev_coloc_h4", "new_coloc_h4") == [(10, 0.1, 0.9), (11, 0.2, 0.6)]
    again = merge.merge_raw(merged, old)
    assert rows(again, *MERGE_KEYS, "coloc_h4") == rows(merged, *MERGE_KEYS, "coloc_h4")
    drift = {r.column_name: tuple(r)[1:] for r in merge.schema_drift_report(new, old).collect()}
    assert drift["note"] == (True, False, old.count(), None)
    assert drift["coloc_h4"] == (True, True, old.count(), new.count())


def test_join_betas_uses_the_left_variant_in_the_right_study(spark):
    coloc = P.make_symmetric(frame(spark, row(), row(lpos=11, right=("gwas", "G2", None, None)))).drop(
        "left_phenotype", "left_bio_feature"
    )
    stats = spark.createDataFrame(
        [
            ("Q1", "P1", "B", "1", 10, "A", "T", 0.5, 0.1, 0.01, 100, 10, 0.2, False),
            ("G2", None, None, "1", 11, "A", "T", 0.7, 0.1, 0.02, 100, 10, 0.2, True),
            ("Q1", "P2", "B", "1", 10, "A", "T", 9.0, 0.1, 0.01, 100, 10, 0.2, False),
            ("Q1", None, "B", "1", 10, "A", "T", 9.0, 0.1, 0.01, 100, 10, 0.2, False),
        ],
        SUMSTATS,
    )
    out = enrich.join_betas(coloc, stats)
    assert out.count() == coloc.count()
    got = {(r.left_pos, r.right_study): r.left_var_right_study_beta for r in out.collect()}
    assert got[10, "Q1"] == 0.5 and got[11, "G2"] == 0.7 and got[20, "G1"] is None
    assert enrich.rows_added(coloc, out).first().n_added == 0
    doubled = enrich.join_betas(coloc, stats.unionAll(stats))
    best, twins = enrich.enrich(coloc, stats.unionAll(stats))
    assert enrich.rows_added(coloc, doubled).first().n_added == 2
    assert best.count() == coloc.count() and twins.count() == 2


def test_top_loci_match_needs_both_leads_and_is_not_multiplied(spark):
    coloc = frame(spark, row(left=("gwas", "G1", "None", "None")), row(lpos=11))
    loci = spark.createDataFrame(
        [("G1", None, None, "1", 10, "A", "T")] * 2 + [("Q1", "P1", "B", "1", 20, "A", "T")],
        "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, ref string, alt string",
    )
    kept, removed = enrich.filter_top_loci_match(coloc, loci)
    assert [r.left_pos for r in kept.collect()] == [10] and removed.first().n_filtered_out == 1


def test_range_layout_is_sorted_and_spreads_a_hot_position(spark):
    data = [row(rpos=r) for r in range(400)] + [row(lpos=p) for p in range(11, 20)]
    out = range_layout(frame(spark, *data), n=4)
    parts = out.select(F.spark_partition_id().alias("p"), "left_pos").collect()
    hot = {r.p for r in parts if r.left_pos == 10}
    assert len(hot) > 1
    for p in {r.p for r in parts}:
        inside = [r.left_pos for r in parts if r.p == p]
        assert inside == sorted(inside)


def test_row_audit(spark):
    steps = audit.step_audit([("all", spark.range(10)), ("even", spark.range(0, 10, 2))]).collect()
    assert [(r.step, r.n_rows, r.n_removed) for r in sorted(steps)] == [("all", 10, 0), ("even", 5, 5)]


def test_log_time_mean(spark):
    texts = [(f"f{i:03d}", f"start\nTime taken: 0:{i % 60}:1.5\nTime taken: 9:9:9\n") for i in range(95)]
    texts[3] = ("f003", "no time in here")
    logs = spark.createDataFrame(texts, "file string, text string").repartition(5)
    secs = [None if i == 3 else (i % 60) * 60 + 1.5 for i in range(95)]
    got = {r.iteration: r.mean_sec for r in audit.log_time_mean(logs, 10).collect()}
    assert sorted(got) == list(range(10, 95, 10))
    for n, mean in got.items():
        known = [s for s in secs[:n] if s is not None]
        assert mean == pytest.approx(sum(known) / len(known))


def test_config():
    assert Config.from_dict({"p12": 1e-6}).p12 == 1e-6
    with pytest.raises(ValueError):
        Config.from_dict({"nonsense": 1})


def test_results_far_along_a_chromosome(spark, tmp_path):
    # three times such a position is more than 32 bits hold
    rows = [(n, 1_000_000, n, 0, 10.0 + n, 0.05, 0.02) for n in range(8)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    raw = fixtures.table(spark, str(tmp_path), "coloc_raw").collect()
    assert {r["left_pos"] for r in raw} == {1_000_005_000} and len(raw) > 7
    assert {round(r["coloc_h3"], 9) for r in raw} == {round(0.09 * ((1_000_005_000 // 5000 * 4) % 11), 9)}
    assert QUERIES["abs_distance"](spark, str(tmp_path)).count() == len(raw)
