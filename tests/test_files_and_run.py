import gzip
from dataclasses import replace
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave import fixtures
from lociweave.config import Config
from lociweave.operators import features as FE
from lociweave.operators import ml
from lociweave.plans import coloc, release
from lociweave.operators.ld import panel_size
from lociweave.schemas import COLOC_KEYS, CREDSET, MERGE_KEYS, MERGE_KEYS_GWAS_LEFT
from lociweave.sources import readers as R
from lociweave.sources import writers as W

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_credset_without_qtl_columns(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"type":"gwas","study_id":"G","lead_chrom":"X","lead_pos":5,"is95_credset":true}\n'
        '{"type":"eqtl","study_id":"Q","phenotype_id":"None","bio_feature":"B","lead_chrom":"1"}\n'
    )
    out = R.scan_credset(spark, str(tmp_path)).orderBy("study_id").collect()
    assert out[0].phenotype_id is None and out[0].bio_feature is None and out[0].lead_chrom == "X"
    assert out[1].phenotype_id is None and out[1].bio_feature == "B"
    assert list(out[0].asDict()) == CREDSET.names


def test_json_leaves_null_fields_out(spark, tmp_path):
    W.write_json_gz(spark.sql("select 1 as a, cast(null as string) as b"), str(tmp_path / "j"), files=1)
    (part,) = [f for f in os.listdir(tmp_path / "j") if f.endswith(".json.gz")]
    assert gzip.open(tmp_path / "j" / part, "rt").read().strip() == '{"a":1}'


def test_gene_lut_last_entry_wins(spark, tmp_path):
    header = "phenotype_id\tgene_id\n"
    for name, body in [("a.tsv.gz", "P1\tENSG1\nP2\tENSG2\nP1\tENSG3\n"), ("b.tsv.gz", "P2\tENSG4\nP1\tprobe\n")]:
        with gzip.open(tmp_path / name, "wt") as out:
            out.write(header + body)
    got = {r.phenotype_id: r.gene_id for r in R.scan_gene_lut(spark, str(tmp_path / "*.tsv.gz")).collect()}
    assert got == {"P1": "ENSG3", "P2": "ENSG4"}


def test_result_files_are_read_whole_or_not_at_all(spark, tmp_path):
    good = "nsnps,PP.H0.abf,PP.H1.abf,PP.H2.abf,PP.H3.abf,PP.H4.abf," + ",".join(COLOC_KEYS)
    values = "5,0.1,0.2,0.3,0.3,0.1,gwas,G,,,1,10,A,T,eqtl,Q,B,P,1,20,A,T"
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write(f"{good}\n{values}\n")
    (tmp_path / "c.csv").write_text("")
    out = R.scan_coloc_csv(spark, str(tmp_path)).collect()
    assert len(out) == 1 and out[0]["PP.H3.abf"] == 0.3 and out[0].left_phenotype is None
    assert R.malformed_coloc_rows(spark, str(tmp_path)).collect() == []
    (tmp_path / "d.csv").write_text(f"{good}\n{values.replace('0.2', 'x')}\n{values}\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        R.scan_coloc_csv(spark, str(tmp_path)).collect()
    broken = R.malformed_coloc_rows(spark, str(tmp_path)).collect()
    assert [(r.file.rsplit("/", 1)[1], r.line) for r in broken] == [("d.csv", values.replace("0.2", "x"))]
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "b.csv.gz").write_bytes(b"not gzip at all")
    with pytest.raises(Exception, match="(?i)gzip|header|read"):
        R.scan_coloc_csv(spark, str(tmp_path)).collect()


def test_hive_layout_reads_back_nulls_and_prunes(spark, tmp_path):
    df = spark.createDataFrame(
        [("S1", None, None, "1", 5), ("S1", "P", "B", "X", 6), ("S2", None, None, "2", 7)],
        "study_id string, phenotype_id string, bio_feature string, chrom string, pos int",
    )
    W.partition_sumstats(df, str(tmp_path / "s"))
    back = R.scan_sumstats_table(spark, str(tmp_path / "s"))
    got = {(r.study_id, r.phenotype_id, r.chrom, r.pos) for r in back.collect()}
    assert got == {("S1", None, "1", 5), ("S1", "P", "X", 6), ("S2", None, "2", 7)}
    plan = back.filter("study_id = 'S1' and pos > 5").select("pos")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(study_id" in plan and "GreaterThan(pos,5)" in plan


def test_a_repeated_partition_job_replaces_its_directories_only(spark, tmp_path):
    schema = "study_id string, phenotype_id string, bio_feature string, chrom string, pos int"
    out = str(tmp_path / "s")
    W.partition_sumstats(spark.createDataFrame([("S1", None, None, "1", 5), ("S1", "P", "B", "X", 6), ("S2", None, None, "2", 7)], schema), out)
    again = spark.createDataFrame([("S1", None, None, "1", 8), ("S3", None, None, "1", 9)], schema)
    for _ in range(2):
        W.partition_sumstats(again, out)
    got = sorted((r.study_id, r.pos) for r in R.scan_sumstats_table(spark, out).collect())
    assert got == [("S1", 6), ("S1", 8), ("S2", 7), ("S3", 9)]


def test_logs_are_read_whole(spark, tmp_path):
    (tmp_path / "x.txt").write_text("one\nTime taken: 0:0:7\n")
    out = R.scan_logs(spark, str(tmp_path)).collect()
    assert out[0].file == "x.txt" and "one\nTime" in out[0].text


@needs_data
def test_whole_run_and_release(spark):
    t = lambda n: fixtures.table(spark, SF_DIR, n)
    inputs = coloc.Inputs(t("credset"), t("sumstats"), t("top_loci"), t("gene_lut"), t("panel"), n_samples=panel_size(t("panel")))
    out = coloc.run(inputs, Config(min_overlapping_vars=5, window_cond_kb=600))
    raw = out.coloc_raw.collect()
    assert raw and all(abs(sum(r[f"coloc_h{i}"] for i in range(5)) - 1) < 1e-9 for r in raw)
    assert out.coloc_processed.filter("left_type <> 'gwas'").count() == 0
    untested = out.failures.filter("reason = 'no shared variant'").count()
    assert untested == out.manifest.count() - len(raw)
    # a run that is given the reduced statistics has no signal left to reduce
    assert coloc.pending(out.reduced.select("sid").distinct(), out.reduced).count() == 0
    # a second run against the first one's results has nothing left to do
    inputs.previous = out.coloc_raw
    left = coloc.build_manifest(out.overlap, inputs, Config())
    tested = out.coloc_raw.select(*COLOC_KEYS).distinct().count()
    assert left.count() == out.manifest.count() - tested
    twice = (out.coloc_raw, out.coloc_raw, out.coloc_processed, out.coloc_processed, 4)
    merged = release.merge_release(*twice)
    assert merged.raw.count() == out.coloc_raw.select(*MERGE_KEYS).distinct().count()
    assert merged.missing.count() == 0
    assert release.merge_release(*twice, MERGE_KEYS_GWAS_LEFT).raw.count() <= len(raw)
    best, twins, added = release.enrich_release(out.coloc_processed, t("sumstats"), 4)
    assert best.count() == out.coloc_processed.count() and added.first().n_added == 0


@needs_data
def test_run_from_files(spark, tmp_path):
    t = lambda n: fixtures.table(spark, SF_DIR, n)
    p = lambda n: str(tmp_path / n)
    W.partition_credset(t("credset"), p("credset"))
    W.partition_sumstats(t("sumstats").drop("type"), p("sumstats"))
    W.write_json_gz(t("top_loci"), p("top_loci"))
    t("gene_lut").coalesce(1).write.option("header", True).option("sep", "\t").csv(p("lut"))
    config = Config(
        credset=p("credset"), sumstats=p("sumstats"), top_loci=p("top_loci"), gene_lut=p("lut"),
        output=p("out"), min_overlapping_vars=5, method="distance", output_partitions=3,
    )
    result = coloc.run_files(spark, config)
    again = coloc.run_files(spark, replace(config, reduced=p("out/reduced.parquet"), output=p("out2")))
    assert again.reduced.count() == result.reduced.count()
    same = [*COLOC_KEYS, "coloc_n_vars"]
    assert sorted(again.coloc_raw.select(*same).collect(), key=str) == sorted(result.coloc_raw.select(*same).collect(), key=str)
    raw = spark.read.parquet(p("out/coloc_raw.parquet"))
    overlap = R.scan_overlaps(spark, p("out/overlap_table"))
    assert 0 < raw.count() <= overlap.count()
    processed = spark.read.parquet(p("out/coloc_processed.parquet"))
    assert processed.columns.count("right_gene_id") == 1
    # the counts that the writes carried are those of the written tables
    counts = {r.dataset: r.n_rows for r in spark.read.parquet(p("out/row_counts.parquet")).collect()}
    assert counts["coloc_raw"] == raw.count() and counts["overlap_table"] == overlap.count()
    assert counts["coloc_processed"] == processed.count()
    assert {n: spark.read.parquet(p(f"out/{n}.parquet")).count() for n in ("manifest", "reduced", "failures")} == {
        n: counts[n] for n in ("manifest", "reduced", "failures")
    }


@pytest.fixture(scope="module")
def model_rows(spark):
    rng = np.random.default_rng(0)
    data = []
    for i in range(300):
        x = rng.random(len(FE.FEATURE_COLUMNS))
        y = float(2 * x[0] - x[3] + 0.01 * rng.normal())
        data.append((*[str(i) if not c.endswith("pos") else i for c in COLOC_KEYS], *map(float, x), y, y, y))
    names = [*COLOC_KEYS, *FE.FEATURE_COLUMNS, "coloc_h3", "coloc_h4", "coloc_log2_h4_h3"]
    df = spark.createDataFrame(data, names)
    return df.withColumn("right_type", F.when(F.col("right_pos") % 3 == 0, "gwas").otherwise("eqtl")).persist()


def test_cross_validation_bounds(model_rows):
    scores = {
        (r.subset, r.regressor): r.r2_mean
        for r in ml.cv_regress(model_rows, targets=["h4"], subsets=["all", "gwas"], trees=10).collect()
    }
    assert scores["all", "OLS"] > 0.99 and scores["gwas", "OLS"] > 0.95
    assert 0.3 < scores["all", "RandomForest"] < 1


def test_predictions_cover_every_row_once(model_rows):
    out = ml.cv_predictions(model_rows, ["h3"], ["OLS"], ["molecular_trait"])
    assert out.count() == model_rows.filter("right_type <> 'gwas'").count()
    assert out.select(F.max(F.abs(F.col("label") - F.col("prediction")))).first()[0] < 0.2


def test_importance_and_learning_curve(model_rows):
    top = ml.feature_importance(model_rows, "h4", trees=10).orderBy(F.desc("importance_mean")).take(2)
    assert top[0].feature == FE.FEATURE_COLUMNS[0]
    curve = ml.learning_curve(model_rows, "h4", fractions=(0.3, 1.0)).orderBy("fraction").collect()
    assert len(curve) == 2 and all(r.test_r2_mean > 0.9 for r in curve)


def test_folds_do_not_depend_on_partitioning(model_rows):
    one, two = (
        {tuple(r[:16]): r.fold for r in ml.feature_matrix(model_rows.repartition(n), "h4").collect()}
        for n in (1, 5)
    )
    assert one == two and set(one.values()) == set(range(5))
