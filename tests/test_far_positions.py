"""Results of leads so far along a chromosome that a few positions add up to more than 32 bits hold."""

import pytest

from lociweave.catalog import QUERIES, predict
from lociweave.catalog.registry import Tables
from lociweave.operators import ml
from lociweave.operators.features import FEATURE_COLUMNS

# Keeps allele, chromosome, block of a credible set and the made-up H3 and H4 of every part key.
SHIFT = 1_006_500
SAME = [
    "feature_matrix", "abs_distance", "dedup_keep_best", "dedup_keep_rank", "dedup_keep_best_dataset", "drop_columns",
    "drop_duplicates_subset", "drop_exact_duplicates", "drop_null_stats", "feature_input_filter", "feature_match_counts",
    "feature_run", "features_outer_coloc",
]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = []
    for shift in (0, SHIFT):
        folder = str(tmp_path_factory.mktemp("far"))
        lines = [
            (8 * j + s, shift + 5 * j, s, 0, 1.0 + (17 * j + 5 * s) % 50, 0.06 if j == s else 0.05, 0.02)
            for j in range(20)
            for s in range(8)
        ]
        schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double"
        spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
        orders = [(i, i * 7 % 30) for i in range(160)]
        spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
        out.append(folder)
    return out


@pytest.mark.parametrize("name", SAME)
def test_far_results_are_the_near_ones_shifted(spark, folders, name):
    near, far = (QUERIES[name](spark, folder).collect() for folder in folders)

    def rows(found, shift):
        return sorted(
            repr([(c, v - shift if c.endswith("_pos") and v is not None else v) for c, v in r.asDict().items()]) for r in found
        )

    assert near and rows(near, 0) == rows(far, 1000 * SHIFT)


@pytest.mark.parametrize("name", ["cv_regress_ols", "learning_curve"])
def test_far_fits(spark, folders, name):
    assert QUERIES[name](spark, folders[1]).count()


@pytest.fixture(scope="module")
def far_input(spark, folders):
    return predict.model_input(Tables(spark, folders[1]))


def test_far_cross_validation(far_input):
    scores = ml.cv_regress(far_input, targets=("h4",), subsets=("all",), folds=2, trees=2).collect()
    assert sorted((r.subset, r.regressor, r.target) for r in scores) == [("all", "OLS", "h4"), ("all", "RandomForest", "h4")]


def test_far_importances(far_input):
    found = ml.feature_importance(far_input, "h4", folds=2, trees=2).collect()
    assert {r.feature for r in found} == set(FEATURE_COLUMNS)
    assert sum(r.importance_mean for r in found) == pytest.approx(1.0)
