"""Linear fits from sums of products against fits on the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.operators import ml
from lociweave.operators.features import FEATURE_COLUMNS
from lociweave.schemas import COLOC_KEYS
from lociweave.session import materialise

N = 600


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(N, len(FEATURE_COLUMNS)))
    x[:, 3] = 2 * x[:, 0] - x[:, 1]  # explained by others
    x[:, 4] = 1.0  # constant
    y = x[:, :6] @ rng.normal(size=6) + rng.normal(size=N)
    text = {c: F.concat(F.lit(c), F.col("i").cast("string")) for c in COLOC_KEYS}
    text["right_type"] = F.when(F.col("i") % 3 == 0, "gwas").otherwise("eqtl")
    rows = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(N)]
    df = spark.createDataFrame(rows, "i int, x array<double>, y double").withColumns(text)
    df = df.withColumns({c: F.col("x")[j] for j, c in enumerate(FEATURE_COLUMNS)})
    known = F.when(F.col("i") % 50 != 0, F.col("y"))  # some outcomes are unknown
    df = df.withColumns({column: known * (k + 1) for k, column in enumerate(ml.TARGETS.values())})
    return materialise(df.repartition(5), "model_rows")


def plain(rows, fraction, fold):
    train = [r for r in rows if r["fold"] != fold and r["u"] < fraction]
    test = [r for r in rows if r["fold"] == fold]
    x, y = (np.array([r[c] for r in train]) for c in ("x", "y"))
    b = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]

    def r2(of):
        x, y = (np.array([r[c] for r in of]) for c in ("x", "y"))
        return 1 - ((y - np.column_stack([np.ones(len(x)), x]) @ b) ** 2).sum() / ((y - y.mean()) ** 2).sum()

    return r2(train), r2(test)


def test_scores_are_those_of_fits_on_the_rows(table):
    drawn = table.withColumns({"fold": ml.row_share(123) % 5, "u": ml.row_share(321) / ml.HASH_RANGE}).filter("i % 50 <> 0").collect()
    assert {r["fold"] for r in drawn} == set(range(5))
    scores = ml.ols_scores(table, fractions=(0.4, 1.0)).collect()
    assert len(scores) == 3 * 3 * 2 * 5
    for r in scores:
        keep = {"all": (True, False), "gwas": (True,), "molecular_trait": (False,)}[r["subset"]]
        rows = [d for d in drawn if (d["right_type"] == "gwas") in keep]
        assert (r["train_r2"], r["test_r2"]) == pytest.approx(plain(rows, r["fraction"], r["fold"]), abs=1e-6)


def test_tasks_hand_on_groups_not_rows(table):
    sums = ml.gram_sums(table)
    assert sums.count() == 3 * 2 * 5 * len(ml.FRACTIONS)
    size = len(FEATURE_COLUMNS) + 2
    assert {len(r["sums"]) for r in sums.collect()} == {size * (size + 1) // 2}


def test_constant_outcomes_have_no_score(table):
    flat = table.withColumns({c: F.lit(2.0) for c in ml.TARGETS.values()})
    assert {(r["train_r2"], r["test_r2"]) for r in ml.ols_scores(flat, fractions=(1.0,)).collect()} == {(None, None)}
    assert ml.ols_scores(table.limit(0)).collect() == []
