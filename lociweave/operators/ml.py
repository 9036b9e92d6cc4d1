"""Cross-validated regressions of test results on LD-overlap features.

Folds come from a hash of the row's keys: every row knows its fold, whatever the
partitioning, and no global shuffle or sort is needed.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators.features import FEATURE_COLUMNS
from lociweave.schemas import COLOC_KEYS
from lociweave.session import materialise

TARGETS = {"h3": "coloc_h3", "h4": "coloc_h4", "log_h4_h3": "coloc_log2_h4_h3"}
SUBSETS = ("all", "gwas", "molecular_trait")
HASH_RANGE = 1 << 20


def regressor(name: str, trees: int = 100):
    if name == "OLS":
        return LinearRegression(labelCol="label", featuresCol="features")
    if name == "RandomForest":
        return RandomForestRegressor(
            labelCol="label", featuresCol="features", numTrees=trees, seed=123
        )
    raise ValueError(f"unknown regressor {name}")


def _hash(salt: int):
    return F.pmod(F.xxhash64(F.lit(salt), *COLOC_KEYS), F.lit(HASH_RANGE))


def shuffle_sample(df: DataFrame, seed: int = 123, keep=materialise) -> DataFrame:
    """All rows with their ``place``, 0 to n - 1, in a random order that depends only on the keys
    and the seed. Rows with equal keys follow each other in the order of their other columns.

    The order is that of a digest of the keys. Rows are dealt by ranges of it and written by
    ``keep``, so that the ranges are fixed; a range's first place is the number of rows before it.
    """
    text = [F.concat(F.lit("|"), F.coalesce(F.col(c).cast("string"), F.lit("~"))) for c in COLOC_KEYS]
    drawn = df.withColumn("_draw", F.md5(F.concat(F.lit(str(seed)), *text)))
    ranges = keep(
        drawn.repartitionByRange("_draw").withColumn("_range", F.spark_partition_id()), "shuffled"
    )
    # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("_range").orderBy("_draw", *[f"`{c}`" for c in df.columns])
    return (
        ranges.join(F.broadcast(first), "_range")
        .withColumn("place", F.col("_first") + F.row_number().over(inside) - 1)
        .drop("_draw", "_range", "_first")
    )


def subset(df: DataFrame, which: str = "all") -> DataFrame:
    if which not in SUBSETS:
        raise ValueError(f"subset must be one of {SUBSETS}")
    if which == "gwas":
        return df.filter(F.col("right_type") == "gwas")
    if which == "molecular_trait":
        return df.filter(F.col("right_type") != "gwas")
    return df


def feature_matrix(df: DataFrame, target: str, which: str = "all", folds: int = 5) -> DataFrame:
    """Keys, fold, feature vector and label of one outcome and subset."""
    plain = {c: c.replace(".", "_") for c in FEATURE_COLUMNS}
    rows = subset(df, which).filter(F.col(TARGETS[target]).isNotNull()).select(
        *COLOC_KEYS,
        F.pmod(_hash(123), F.lit(folds)).cast("int").alias("fold"),
        (_hash(321) / HASH_RANGE).alias("u"),
        F.col(TARGETS[target]).alias("label"),
        *[F.col(f"`{c}`").cast("double").alias(name) for c, name in plain.items()],
    )
    assembler = VectorAssembler(inputCols=list(plain.values()), outputCol="features")
    return assembler.transform(rows).drop(*plain.values())


def _scores(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _fit_folds(matrix: DataFrame, name: str, folds: int, trees: int):
    """(fold, model, held-out predictions) per fold; training itself is distributed."""
    for fold in range(folds):
        model = regressor(name, trees).fit(matrix.filter(F.col("fold") != fold))
        yield fold, model, model.transform(matrix.filter(F.col("fold") == fold))


_R2 = RegressionEvaluator  # evaluated on the executors, one number per fold


def cv_predictions(
    df: DataFrame,
    targets=tuple(TARGETS),
    regressors=("OLS", "RandomForest"),
    subsets=SUBSETS,
    folds: int = 5,
    trees: int = 100,
    keep=lambda df, name: df.persist(),
) -> DataFrame:
    """Held-out (label, prediction) of every row, per subset, regressor and outcome.

    ``keep`` stores the matrix of a subset and outcome, which every fold and regressor reads.
    """
    parts = []
    for which in subsets:
        for target in targets:
            matrix = keep(feature_matrix(df, target, which, folds), "matrix")
            for name in regressors:
                names = {"subset": F.lit(which), "regressor": F.lit(name), "target": F.lit(target)}
                for _, _, held_out in _fit_folds(matrix, name, folds, trees):
                    rows = held_out.select(*COLOC_KEYS, "fold", "label", "prediction")
                    parts.append(rows.withColumns(names))
    return reduce(DataFrame.unionAll, parts)


def cv_scores(predictions: DataFrame) -> DataFrame:
    """Mean and sd over folds of the held-out R2 per subset, regressor and outcome."""
    grid = ["subset", "regressor", "target"]
    wrong = F.sum((F.col("label") - F.col("prediction")) ** 2)
    spread = F.count(F.lit(1)) * F.var_pop("label")
    r2 = (1 - F.try_divide(wrong, spread)).alias("r2")
    return predictions.groupBy(*grid, "fold").agg(r2).groupBy(*grid).agg(
        F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_sd")
    )


def cv_regress(df: DataFrame, **grid) -> DataFrame:
    """Scores of :func:`cv_predictions` with the same arguments."""
    return cv_scores(cv_predictions(df, **grid))


def feature_importance(
    df: DataFrame, target: str, which: str = "all", folds: int = 5, trees: int = 100
) -> DataFrame:
    """Mean and sd over folds of each feature's forest importance."""
    matrix = feature_matrix(df, target, which, folds).persist()
    rows = []
    for fold, model, _ in _fit_folds(matrix, "RandomForest", folds, trees):
        values = model.featureImportances.toArray()
        rows += [(fold, f, float(v)) for f, v in zip(FEATURE_COLUMNS, values, strict=True)]
    matrix.unpersist()
    per_fold = _scores(df.sparkSession, rows, "fold int, feature string, importance double")
    return per_fold.groupBy("feature").agg(
        F.avg("importance").alias("importance_mean"),
        F.stddev_pop("importance").alias("importance_sd"),
    )


def learning_curve(
    df: DataFrame,
    target: str,
    name: str = "OLS",
    which: str = "all",
    folds: int = 5,
    fractions=(0.1, 0.325, 0.55, 0.775, 1.0),
    trees: int = 100,
) -> DataFrame:
    """Train and held-out R2 when only a share of each training fold is used.

    A share is the rows whose hash falls below it, so the shares are nested.
    """
    r2 = _R2(labelCol="label", predictionCol="prediction", metricName="r2")
    matrix = feature_matrix(df, target, which, folds).persist()
    rows = []
    for fraction in fractions:
        for fold in range(folds):
            train = matrix.filter((F.col("fold") != fold) & (F.col("u") < fraction))
            model = regressor(name, trees).fit(train)
            rows.append(
                (
                    float(fraction),
                    fold,
                    float(r2.evaluate(model.transform(train))),
                    float(r2.evaluate(model.transform(matrix.filter(F.col("fold") == fold)))),
                )
            )
    matrix.unpersist()
    scores = _scores(
        df.sparkSession, rows, "fraction double, fold int, train_r2 double, test_r2 double"
    )
    return scores.groupBy("fraction").agg(
        *[
            agg(f"{s}_r2").alias(f"{s}_r2_{label}")
            for s in ("train", "test")
            for agg, label in ((F.avg, "mean"), (F.stddev_pop, "sd"))
        ]
    )


#: A feature is left out of a fit if those before it explain all but this share of its squares.
COLLINEAR = 1e-6
FRACTIONS = (0.1, 0.325, 0.55, 0.775, 1.0)


def row_share(salt: int):
    """A number in [0, HASH_RANGE) that depends on the row's keys and the salt only, from the first
    five digits of a digest, so that other engines can draw the same folds."""
    text = F.concat_ws("|", F.lit(str(salt)), *[F.col(c).cast("string") for c in COLOC_KEYS])
    return F.conv(F.substring(F.md5(text), 1, 5), 16, 10).cast("int")


def gram_sums(df: DataFrame, targets=tuple(TARGETS), folds: int = 5, fractions=FRACTIONS) -> DataFrame:
    """Sums of products of (1, features, outcome): ``target, gwas, fold, step, sums``.

    ``gwas`` tells the subset that a row is in, ``step`` the smallest of the nested shares. ``sums``
    is the upper triangle by rows. A task hands on one row per group, and groups do not grow with
    the table, so everything a linear fit or its score needs comes from one pass over the rows.
    """
    share = row_share(321) / HASH_RANGE
    step = reduce(lambda s, f: F.when(share < f[1], f[0]).otherwise(s), reversed(list(enumerate(fractions))), F.lit(len(fractions)))
    features = [f"x{i}" for i in range(len(FEATURE_COLUMNS))]
    rows = df.select(
        (F.col("right_type") == "gwas").alias("gwas"),
        F.pmod(row_share(123), F.lit(folds)).cast("int").alias("fold"),
        step.cast("int").alias("step"),
        *[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(FEATURE_COLUMNS, features, strict=True)],
        *[F.col(TARGETS[t]).cast("double").alias(t) for t in targets],
    )
    schema = "target string, gwas boolean, fold int, step int, sums array<double>"
    upper = np.triu_indices(len(features) + 2)

    def run(batches):
        found: dict[tuple, np.ndarray] = {}
        for batch in batches:
            x = np.stack([np.ones(batch.num_rows), *(batch.column(f).to_numpy(zero_copy_only=False) for f in features)], axis=1)
            group = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(int) for c in ("gwas", "fold", "step")], axis=1)
            keys, member = np.unique(group, axis=0, return_inverse=True)
            for t in targets:
                y = batch.column(t).to_numpy(zero_copy_only=False).astype(float)
                for i, key in enumerate(keys.tolist()):
                    if key[2] == len(fractions):  # beyond the largest share
                        continue
                    mine = (member.ravel() == i) & ~np.isnan(y)
                    z = np.column_stack([x[mine], y[mine]])
                    own = found.setdefault((t, *key), np.zeros(len(upper[0])))
                    own += (z.T @ z)[upper]
        if found:
            columns = list(zip(*found, strict=True))
            arrays = [pa.array(columns[0]), pa.array([bool(g) for g in columns[1]]), *(pa.array(c, pa.int32()) for c in columns[2:])]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(found.values()), pa.list_(pa.float64()))], names=["target", "gwas", "fold", "step", "sums"])

    keys = ["target", "gwas", "fold", "step"]
    parts = rows.mapInArrow(run, schema).select(*keys, F.posexplode("sums").alias("at", "value"))
    total = parts.groupBy(*keys, "at").agg(F.sum("value").alias("value"))
    return total.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("v")).select(*keys, F.col("v.value").alias("sums"))


def least_squares(gram: np.ndarray) -> np.ndarray:
    """Coefficients of the last variable on the others, by sweeping; 0 for those left out."""
    m, k = gram.copy(), len(gram) - 1
    kept = np.zeros(k, dtype=bool)
    for i in range(k):
        pivot = m[i, i]
        if pivot <= COLLINEAR * gram[i, i]:
            continue
        kept[i] = True
        row, column = m[i].copy(), m[:, i].copy()
        m -= np.outer(column, row) / pivot
        m[i], m[:, i], m[i, i] = row / pivot, column / pivot, -1 / pivot
    return np.where(kept, m[:k, k], 0.0)


def gram_r2(b: np.ndarray, gram: np.ndarray) -> float | None:
    """R2 of the coefficients on the rows behind a Gram matrix, None if the outcome is constant."""
    k = len(b)
    spread = gram[k, k] - gram[0, k] ** 2 / gram[0, 0] if gram[0, 0] else 0.0
    if spread <= 1e-12 * max(gram[k, k], 1e-300):
        return None
    return float(1 - (gram[k, k] - 2 * b @ gram[:k, k] + b @ gram[:k, :k] @ b) / spread)


def ols_scores(df: DataFrame, targets=tuple(TARGETS), subsets=SUBSETS, folds: int = 5, fractions=FRACTIONS) -> DataFrame:
    """``subset, target, fraction, fold, train_r2, test_r2`` of linear fits, each on a share of the
    other folds' rows and scored on them and on the whole fold.

    All fits come from one pass: a training set is the sum of its groups of :func:`gram_sums`, that
    is all folds minus one, up to a share. Only these sums reach the driver; their number depends
    on features, folds and shares, not on rows.
    """
    size = len(FEATURE_COLUMNS) + 2
    upper = np.triu_indices(size)
    sums = {}
    for r in gram_sums(df, targets, folds, fractions).collect():
        gram = np.zeros((size, size))
        gram[upper] = r["sums"]
        sums[r["target"], r["gwas"], r["fold"], r["step"]] = gram + np.triu(gram, 1).T
    scores = []
    for which in subsets:
        sides = {"all": (False, True), "gwas": (True,), "molecular_trait": (False,)}[which]
        for target in targets:
            cell = np.zeros((folds, len(fractions), size, size))
            for (t, gwas, fold, step), gram in sums.items():
                if t == target and gwas in sides:
                    cell[fold, step] += gram
            upto = cell.cumsum(axis=1)  # shares are nested
            for step, fraction in enumerate(fractions):
                for fold in range(folds):
                    train, test = upto[:, step].sum(axis=0) - upto[fold, step], upto[fold, -1]
                    if train[0, 0] and test[0, 0]:
                        b = least_squares(train)
                        scores.append((which, target, float(fraction), fold, gram_r2(b, train), gram_r2(b, test)))
    schema = "subset string, target string, fraction double, fold int, train_r2 double, test_r2 double"
    return df.sparkSession.createDataFrame(scores, schema)


def mean_scores(scores: DataFrame) -> DataFrame:
    """Mean and sd over folds of :func:`ols_scores`."""
    return scores.groupBy("subset", "target", "fraction").agg(
        *[
            agg(f"{s}_r2").alias(f"{s}_r2_{label}")
            for s in ("train", "test")
            for agg, label in ((F.avg, "mean"), (F.stddev_pop, "sd"))
        ]
    )


def matrix_rows(matrix: DataFrame) -> DataFrame:
    """The feature vectors as one row per (pair, feature), for export."""
    named = F.arrays_zip(
        F.array(*[F.lit(c) for c in FEATURE_COLUMNS]).alias("feature"),
        vector_to_array("features").alias("value"),
    )
    return matrix.select(*COLOC_KEYS, "label", F.explode(named).alias("f")).select(
        *COLOC_KEYS, "label", F.col("f.feature").alias("feature"), F.col("f.value").alias("value")
    )
