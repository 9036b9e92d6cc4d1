"""Merging a new release with an earlier one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import null_safe_equal
from lociweave.operators.process import keep_rank
from lociweave.schemas import MERGE_KEYS, MERGE_KEYS_PROCESSED


def _order(df: DataFrame) -> list[Column]:
    """A total order over everything the duplicates can differ in."""
    first = [F.desc(c) for c in ("coloc_h4", "coloc_h3", "coloc_n_vars") if c in df.columns]
    named = ("coloc_h4", "coloc_h3", "coloc_n_vars")
    return first + [F.asc(c) for c in sorted(df.columns) if c not in named]


def drop_duplicates_subset(df: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """One row per key: the one with the highest H4 (ties by the remaining columns)."""
    return keep_rank(df, keys, _order(df.drop(*keys)), 1)


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return null_safe_equal(left, right, [(k, f"_{k}") for k in keys])


def _keys_only(df: DataFrame, keys: list[str], *extra) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys], *extra)


def merge_missing(new: DataFrame, prev: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """Tests of the new release that the earlier one lacks. Null keys match null."""
    done = _keys_only(prev, keys)
    return new.join(done, _on(new, done, keys), "left_anti")


def merge_present(new: DataFrame, prev: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """Tests of the earlier release that the new one repeats."""
    again = _keys_only(new, keys)
    return prev.join(again, _on(prev, again, keys), "left_semi")


def merge_overlap_compare(
    new: DataFrame, prev: DataFrame, keys: list[str] = MERGE_KEYS
) -> DataFrame:
    """Tests in both releases with both H4 values, one row per test."""
    new, prev = (drop_duplicates_subset(df, keys) for df in (new, prev))
    fresh = _keys_only(new, keys, F.col("coloc_h4").alias("new_coloc_h4"))
    old = prev.withColumnRenamed("coloc_h4", "prev_coloc_h4")
    return old.join(fresh, _on(old, fresh, keys)).select(*old.columns, "new_coloc_h4")


def merge_releases(new: DataFrame, prev: DataFrame, keys: list[str]) -> DataFrame:
    """All tests of both releases; where both have one, the new release's row.

    Columns only one release has are null in the other's rows.
    """
    both = new.withColumn("_old", F.lit(0)).unionByName(
        prev.withColumn("_old", F.lit(1)), allowMissingColumns=True
    )
    return keep_rank(both, keys, [F.asc("_old"), *_order(both.drop("_old", *keys))], 1).drop("_old")


def merge_raw(new: DataFrame, prev: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """Merged raw results, by all columns of a test.

    ``MERGE_KEYS_GWAS_LEFT`` leaves the left phenotype and bio-feature out, as earlier releases
    did; tests that differ only in those then become one.
    """
    return merge_releases(new, prev, keys)


def merge_processed(new: DataFrame, prev: DataFrame) -> DataFrame:
    return merge_releases(new, prev, MERGE_KEYS_PROCESSED)


def schema_drift_report(new: DataFrame, prev: DataFrame) -> DataFrame:
    """Per column of either release: whether each has it, and in how many rows it has a value.

    A column that is there but has become empty shows as well as one that has gone. One pass
    over each release.
    """

    def filled(df: DataFrame, name: str) -> DataFrame:
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias(f"{name}_values")) for c in df.columns]
        return counts.select(F.explode(F.array(*pairs)).alias("x")).select("x.*")

    both = filled(prev, "previous").join(filled(new, "new"), "column_name", "full")
    return both.select(
        "column_name",
        F.col("previous_values").isNotNull().alias("in_previous"),
        F.col("new_values").isNotNull().alias("in_new"),
        "previous_values",
        "new_values",
    )
