"""Quality scores by regularised quadratic discriminant analysis.

Each class is a Gaussian over transformed document statistics, with its own covariance shrunk
towards the pooled diagonal. The score is the logistic of the difference of the two log
densities: log prior - log|L| - |L^-1 (x - mean)|^2 / 2, with the Cholesky factor L of each
class computed once. Fitting needs only counts, sums and products per class, which Spark adds
up over all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import text as tx

STATISTICS = [
    "log_words",
    "log_word_length",
    "upper",
    "digits",
    "marks",
    "symbols",
    "bars",
    "exclaims",
    "distinct",
    "repeats",
    "top_word",
    "line_length",
]
#: Shrinkage towards the pooled diagonal, and the least variance of a statistic.
SHRINKAGE, LEAST_VARIANCE = 0.1, 1e-3
THRESHOLD = 0.3
#: Distinct words are counted in blocks of this many, so the share does not fall with length.
BLOCK = 100
#: Ratios of short texts are drawn towards 0 as if so many more characters or words stood there.
PRIOR_CHARS, PRIOR_WORDS = 60, 15
MARKS = b".,;:!?'\"()-"
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"


def _ratio(count: float, total: float, prior: float) -> float:
    return math.log(count / (total + prior) + 0.005)


def statistics(data: bytes) -> list[float]:
    """The transformed statistics of a whole text; defined for the empty text too."""
    by = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = int(by.sum() - by[0x80:0xC0].sum())
    words = data.split()
    n = len(words)
    upper, digits = int(by[65:91].sum()), int(by[48:58].sum())
    # blocks of equal size; a short rest borrows the words before it
    starts = range(0, n, BLOCK)
    distinct = sum(len(set(words[max(0, min(a, n - BLOCK)) : a + BLOCK])) for a in starts)
    counted = sum(len(words[max(0, min(a, n - BLOCK)) : a + BLOCK]) for a in starts)
    repeats = sum(a == b for a, b in zip(words, words[1:]))  # noqa: B905
    top = 0
    for a in starts:
        seen: dict[bytes, int] = {}
        for w in words[a : a + BLOCK]:
            seen[w] = seen.get(w, 0) + 1
        top += max(seen.values())
    return [
        math.log1p(n),
        math.log((sum(map(len, words)) + 5 * PRIOR_WORDS) / (n + PRIOR_WORDS)),
        _ratio(upper, chars, PRIOR_CHARS),
        _ratio(digits, chars, PRIOR_CHARS),
        _ratio(int(by[list(MARKS)].sum()), chars, PRIOR_CHARS),
        _ratio(int(by[list(SYMBOLS)].sum()), chars, PRIOR_CHARS),
        _ratio(int(by[0x7C]), chars, PRIOR_CHARS),
        _ratio(int(by[0x21]), chars, PRIOR_CHARS),
        _ratio(counted - distinct, counted, PRIOR_WORDS),
        _ratio(repeats, n, PRIOR_WORDS),
        _ratio(top, n, PRIOR_WORDS),
        math.log1p(chars / (1 + int(by[0x0A]))),
    ]


def document_statistics(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``statistics``, an array of doubles, of every row."""
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField("statistics", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, "text"):
            values = [statistics(t or b"") for t in batch.column("text").to_pylist()]
            arrays = [batch.column(f"keep_{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(values, pa.list_(pa.float64()))], names=schema.names
            )

    picked = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    return docs.select(*picked, F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


@dataclass
class Gaussian:
    """A class: log prior, mean, inverse Cholesky factor and log of its determinant."""

    log_prior: float
    mean: np.ndarray
    whiten: np.ndarray
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return self.log_prior + self.log_det - 0.5 * (z * z).sum(1)


@dataclass
class Model:
    """``good`` and ``bad`` classes; a class without labelled rows is None."""

    good: Gaussian | None
    bad: Gaussian | None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the good class: one half without labels, else 0 or 1 if only one class
        has labels."""
        if self.good is None or self.bad is None:
            known = 0.5 if self.good is self.bad else float(self.good is not None)
            return np.full(len(x), known)
        gap = np.clip(self.good.log_density(x) - self.bad.log_density(x), -700, 700)
        return 1 / (1 + np.exp(-gap))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Model:
    """Model of rows (``statistics``, ``label``); label 1 is good, 0 bad, others are ignored."""
    size = len(STATISTICS)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    x = [F.col("statistics")[i] for i in range(size)]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]
    rows = labelled.filter("label in (0, 1)").groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products)
    classes = {}
    for r in rows.collect():  # two rows at most
        mean = np.array([r[f"s{i}"] for i in range(size)]) / r["n"]
        second = np.zeros((size, size))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r["n"]
        classes[r["label"]] = (r["n"], mean, second - np.outer(mean, mean))
    total = sum(n for n, _, _ in classes.values())
    if not total:
        return Model(None, None)
    pooled = sum(n * np.diag(cov) for n, _, cov in classes.values()) / total

    def gaussian(label: int) -> Gaussian | None:
        if label not in classes:
            return None
        n, mean, cov = classes[label]
        cov = (1 - shrinkage) * cov + np.diag(shrinkage * pooled + LEAST_VARIANCE)
        factor = np.linalg.cholesky(cov)
        whiten = np.linalg.inv(factor)
        return Gaussian(math.log(n / total), mean, whiten, -float(np.log(np.diag(factor)).sum()))

    return Model(gaussian(1), gaussian(0))


def score(stats: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``score`` of every row of ``stats``."""
    schema = T.StructType([stats.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("statistics").flatten().to_numpy(zero_copy_only=False)
            scores = model.score(flat.reshape(batch.num_rows, -1)) if batch.num_rows else []
            arrays = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(scores, pa.float64())], names=schema.names)

    return stats.select(*keep, "statistics").mapInArrow(run, schema)


def held_out(id_col) -> F.Column:
    """Whether a row is kept from training: crc32 of the id as text, mod 5, is 0. A null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``statistics`` and ``label`` of the rows that may be learned from."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("label")).dropna().distinct()
    return stats.join(known, F.col(id_col) == F.col("_id")).filter(~held_out(id_col)).select("statistics", "label")


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    materialise,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Id, held_out, score and predicted of every row of ``docs``.

    Learns from the labelled rows whose id is not held out; id, language and source are never
    inputs of a score. ``materialise`` writes a table and reads it back: the statistics are made
    once and used to fit and to score. Null text: empty, which has statistics and a score like
    any other. Repeated rows are scored alike and weigh in the fit as often as they appear;
    rows with a null id are scored, not learned from. Without labels every score is 0.5. An
    empty table gives no rows.
    """
    stats = materialise(document_statistics(docs, text_col, [id_col]), "statistics")
    model = fit(training_rows(stats, labels, id_col, label_col))
    return score(stats, model, [id_col]).select(
        id_col,
        held_out(id_col).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` without the rows that score under ``threshold``; all columns stay.

    Fits as :func:`score_documents` does and scores each text where it is read: nothing is
    shuffled but the labelled rows' statistics.
    """
    model = fit(training_rows(document_statistics(docs, text_col, [id_col]), labels, id_col, label_col))
    columns = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, columns, strict=True)])
    text = columns[docs.columns.index(text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches, text):
            values = [statistics((t or "").encode()) for t in batch.column(text).to_pylist()]
            good = model.score(np.array(values)) >= threshold
            yield batch.filter(pa.array(good))

    kept = renamed.mapInArrow(run, renamed.schema)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, columns, strict=True)])
