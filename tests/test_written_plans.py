"""Plans that write their results: the merged release and the feature table."""

import os

import pytest
from pyspark.sql import functions as F

from lociweave import fixtures
from lociweave.config import Config
from lociweave.operators import enrich as E
from lociweave.operators import merge as M
from lociweave.operators.ld import panel_size
from lociweave.operators.process import process_results
from lociweave.plans import prediction, release
from lociweave.schemas import DEDUP_KEYS_ENRICHED, MERGE_KEYS
from lociweave.session import materialise

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def counts(out):
    return {r.dataset: r.n_rows for r in out["row_counts"].collect()}


def table(spark, name):
    return fixtures.table(spark, SF_DIR, name)


@pytest.fixture(scope="module")
def releases(spark):
    """Raw and processed results of a new and an earlier release, and statistics without duplicates."""
    raw = [table(spark, n) for n in ("release_new", "release_old")]
    config = Config(min_overlapping_vars=5)
    processed = [materialise(process_results(df, table(spark, "gene_lut"), config), "processed") for df in raw]
    return *raw, *processed, table(spark, "sumstats").dropDuplicates(E.MATCHED)


def test_release_is_written(spark, tmp_path, releases):
    new, prev = releases[:2]
    out = release.release_files(spark, *releases, str(tmp_path / "r"), 2)
    raw = M.merge_raw(*(M.drop_duplicates_subset(df, MERGE_KEYS) for df in (new, prev)))
    assert out["raw"].count() == raw.count() and out["raw"].exceptAll(raw.select(out["raw"].columns)).count() == 0
    n = counts(out)
    assert n["betas_joined"] == n["processed"] == out["processed"].count()
    assert n["with_betas"] == out["processed"].select(*DEDUP_KEYS_ENRICHED).distinct().count()
    assert all(n[name] == df.count() for name, df in out.items() if name != "row_counts")
    missing = spark.read.option("header", True).csv(str(tmp_path / "r" / "missing.csv"))
    assert missing.count() == n["missing"] == M.merge_missing(M.drop_duplicates_subset(new), prev).count()


def test_release_fails_after_writing_if_betas_add_rows(spark, tmp_path, releases):
    *results, stats = releases
    once = release.merge_release(*results).processed
    matched = E.join_betas(once, stats).filter("left_var_right_study_beta is not null").count()
    assert matched
    with pytest.raises(release.RowsAdded, match=f" {matched} rows"):
        release.release_files(spark, *results, stats.unionAll(stats), str(tmp_path / "r"), 2)
    written = lambda name: spark.read.parquet(str(tmp_path / "r" / f"{name}.parquet"))
    assert written("duplicates").count() >= matched
    assert written("with_betas").select(*DEDUP_KEYS_ENRICHED).distinct().count() == written("with_betas").count()
    assert {r.dataset for r in written("row_counts").collect()} >= {"raw", "processed", "betas_joined", "duplicates"}


def test_features_are_written(spark, tmp_path):
    panel = table(spark, "panel")
    inputs = (table(spark, "coloc_raw"), panel, table(spark, "top_loci"))
    out = prediction.feature_files(spark, *inputs, str(tmp_path / "f"), panel_size(panel), min_vars=50)
    n, match = counts(out), out["matches"].first()
    assert match["both"] == n["features"] == out["features"].count() > 0
    # a test with an H3 or H4 of 0 has no ratio; without features it is in none of the three
    neither = out["features_outer"].filter("total_overlap is null and coloc_log2_h4_h3 is null").count()
    assert sum(match[c] for c in ("ld_only", "coloc_only", "both")) + neither == n["features_outer"]
    assert out["linear_scores"].select("subset", "target").distinct().count() == 9
    empty = prediction.feature_files(spark, inputs[0].filter(F.lit(False)), *inputs[1:], str(tmp_path / "e"), 1)
    assert counts(empty) == {"features_outer": 0, "features": 0, "matches": 1}
