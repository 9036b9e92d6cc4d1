"""Results of leads beyond the positions that 32 bits hold are those of near ones, shifted."""

import random

import pytest

from lociweave import fixtures
from lociweave.catalog import QUERIES, predict
from lociweave.catalog.registry import Tables
from lociweave.operators import ml
from lociweave.operators.abf import column_blocks, study_type_prop
from lociweave.operators.features import FEATURE_COLUMNS
from lociweave.schemas import TOP_LOCI, far_schema

# Keeps allele, chromosome, block of a credible set and the made-up H3 and H4 of every part key.
SHIFT = 600 * 16_500
SAME = {
    "F2": "side_tag_counts", "F3": "feature_run", "F6": "features_outer_coloc", "F9": "feature_match_counts",
    "F10": "ld_intersection", "F11": "conditional_sumstats", "F12": "create_features", "F13": "conditional_sumstats_many",
    "F14": "ld_pairs", "F16": "coloc_run", "F17": "reduced_sumstats", "F18": "coloc_abf_conditioned",
    "F19": "prop_overlap_at_r2", "F21": "coloc_abf_left_window", "F22": "feature_matrix", "F24": "run_failures",
    "F25": "distance_method",
}
READ_BACK = ["scan_credset", "scan_coloc_csv", "partition_sumstats", "write_json_gz", "scan_ld_tsv"]
BP = 1000 * SHIFT


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = []
    for shift in (0, SHIFT):
        draw, folder = random.Random(4), str(tmp_path_factory.mktemp("wide"))
        lines = []
        for j in range(24):
            for s in range(8):
                for line in range(4):
                    stats = (1.0 + draw.randrange(50), draw.randrange(11) / 100, draw.randrange(9) / 100)
                    lines.append((len(lines) % 300, shift + 1000 + 25 * j + (j % 3) * 5, s, line, *stats))
        schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double"
        spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
        orders = [(i, draw.randrange(40)) for i in range(300)]
        spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
        out.append(folder)
    return out


def _rows(spark, name, folder, shift):
    def near(column, value):
        if isinstance(value, float):
            return f"{value:.5g}"
        if isinstance(value, int) and (column == "pos" or column.endswith("_pos")):
            return value - shift
        if isinstance(value, str) and column in ("sid", "left_key", "right_key", "variant_id"):
            sep = ":" if column == "variant_id" else "_"
            return sep.join(str(int(p) - shift) if p.isdigit() and int(p) >= 1000 else p for p in value.split(sep))
        return value

    return sorted(repr([(c, near(c, v)) for c, v in r.asDict().items()]) for r in QUERIES[name](spark, folder).collect())


@pytest.mark.parametrize("name", [*SAME.values(), *READ_BACK])
def test_wide_results_are_the_near_ones_shifted(spark, folders, name):
    near = _rows(spark, name, folders[0], 0)
    assert near or name == "run_failures"
    assert near == _rows(spark, name, folders[1], BP)


def test_positions_are_wide_only_where_they_have_to_be(spark, folders):
    kinds = [Tables(spark, f)("sumstats").schema["pos"].dataType.simpleString() for f in folders]
    assert kinds == ["int", "bigint"]
    assert [f.dataType.simpleString() for f in far_schema(TOP_LOCI) if f.name == "pos"] == ["bigint"]
    assert "as int) as pos" in fixtures.spark_sql("panel") and "as int) as pos" not in fixtures.spark_sql("panel", True)


def test_wide_panel_windows(spark, folders):
    # windows start at 0, so a far place has those of a near one and the ones that begin before it
    near, far = (QUERIES["panel_window_assign"](spark, f).collect() for f in folders)
    places = [{(r.chrom, r.pos - s, r.ref, r.alt, r.start - s, r.n_carriers) for r in rows} for rows, s in ((near, 0), (far, BP))]
    assert near and places[0] <= places[1] and all(start < 0 for *_, start, _ in places[1] - places[0])
    assert len(places[1]) == len(far)


@pytest.mark.parametrize("name", ["cv_regress_ols", "learning_curve", "shuffle_sample"])
def test_wide_fits(spark, folders, name):
    # F8, F20, F7: which rows a fold holds is drawn by a digest of the positions
    assert QUERIES[name](spark, folders[0]).count() == QUERIES[name](spark, folders[1]).count() > 0


@pytest.fixture(scope="module")
def wide_input(spark, folders):
    return predict.model_input(Tables(spark, folders[1]))


def test_wide_cross_validation(spark, wide_input):
    # F4, F15
    held_out = ml.cv_predictions(wide_input, targets=("h4",), subsets=("all",), folds=2, trees=2)
    assert held_out.count() == 2 * wide_input.count()
    scores = ml.cv_regress(wide_input, targets=("h4",), subsets=("all",), folds=2, trees=2).collect()
    assert sorted((r.subset, r.regressor, r.target) for r in scores) == [("all", "OLS", "h4"), ("all", "RandomForest", "h4")]


def test_wide_importances(wide_input):
    # F5
    found = ml.feature_importance(wide_input, "h4", folds=2, trees=2).collect()
    assert {r.feature for r in found} == set(FEATURE_COLUMNS)


def test_first_row_and_blocks_of_a_wide_signal(spark):
    columns = "sid string, chrom string, pos long, ref string, alt string, beta double, se double, eaf double, n_total int, n_cases int, is_cc boolean"
    rows = [("s", "1", pos, "A", "C", 0.1, 0.1, 0.3, n, 10, False) for pos, n in ((9_900_000_000, 2), (2_100_000_000, 1))]
    reduced = spark.createDataFrame(rows, columns)
    assert study_type_prop(reduced).first().n == 1
    assert sorted(p for r in column_blocks(reduced).collect() for p in r.pos) == [2_100_000_000, 9_900_000_000]
