"""Merging a finished run with the previous release and adding effect sizes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lociweave.operators import enrich as E
from lociweave.operators import merge as M
from lociweave.operators.audit import CountedWrites
from lociweave.schemas import MERGE_KEYS, MERGE_KEYS_PROCESSED
from lociweave.session import Scratch
from lociweave.sources.writers import range_layout, write_csv


@dataclass
class Release:
    raw: DataFrame
    processed: DataFrame
    missing: DataFrame
    present: DataFrame
    compared: DataFrame
    drift: DataFrame


def merge_release(
    raw_new: DataFrame,
    raw_prev: DataFrame,
    processed_new: DataFrame,
    processed_prev: DataFrame,
    partitions: int | None = None,
    raw_keys: list[str] = MERGE_KEYS,
) -> Release:
    """Both tables of the merged release and the reports on what changed."""
    new, prev = (M.drop_duplicates_subset(df, raw_keys) for df in (raw_new, raw_prev))
    p_new, p_prev = (
        M.drop_duplicates_subset(df, MERGE_KEYS_PROCESSED) for df in (processed_new, processed_prev)
    )
    return Release(
        raw=range_layout(M.merge_raw(new, prev, raw_keys), n=partitions),
        processed=range_layout(M.merge_processed(p_new, p_prev), n=partitions),
        missing=M.merge_missing(new, prev, raw_keys),
        present=M.merge_present(new, prev, raw_keys),
        compared=M.merge_overlap_compare(new, prev, raw_keys),
        drift=M.schema_drift_report(new, prev),
    )


def enrich_release(
    processed: DataFrame, sumstats: DataFrame, partitions: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results with effect sizes, audit of duplicates, rows the join added)."""
    merged = E.join_betas(processed, sumstats)
    best = range_layout(E.dedup_keep_rank(merged, 1), n=partitions)
    return best, E.keep_duplicates(merged), E.rows_added(processed, merged)


class RowsAdded(ValueError):
    """Effect sizes matched some tests more than once. All outputs are written by then."""


def release_files(
    spark: SparkSession,
    raw_new: DataFrame,
    raw_prev: DataFrame,
    processed_new: DataFrame,
    processed_prev: DataFrame,
    sumstats: DataFrame,
    output: str,
    partitions: int | None = None,
    raw_keys: list[str] = MERGE_KEYS,
) -> dict[str, DataFrame]:
    """A merged release written below ``output``, which must not hold the tables it is made from.

    ``raw`` and ``processed`` are the merged tables, ``with_betas`` the processed one with effect
    sizes and one row per test, ``duplicates`` the second rows that were left out of it, ``drift``
    what became of the columns; ``missing``, ``present`` and ``compared`` are reports as CSV.
    ``row_counts`` has the rows of each as its own write counted them, with ``betas_joined``: the
    rows of the join before duplicates went. Where those are more than ``processed`` has, everything
    is written and RowsAdded is raised. Empty tables give empty outputs.
    """
    base = output.rstrip("/")
    scratch, writes = Scratch(spark), CountedWrites(spark)

    def parquet(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}.parquet"
        writes.write(name, df, lambda seen: seen.write.mode("overwrite").parquet(path))
        return spark.read.schema(df.schema).parquet(path)

    merged = merge_release(
        *(scratch.keep(df, "input") for df in (raw_new, raw_prev, processed_new, processed_prev)), partitions, raw_keys
    )
    out = {name: parquet(name, getattr(merged, name)) for name in ("raw", "processed", "drift")}
    for name in ("missing", "present", "compared"):
        writes.write(name, getattr(merged, name), lambda seen, name=name: write_csv(seen, f"{base}/{name}.csv"))
    joined = E.join_betas(out["processed"], sumstats)
    path = f"{scratch.path}/betas"
    writes.write("betas_joined", joined, lambda seen: seen.write.parquet(path))
    joined = spark.read.schema(joined.schema).parquet(path)
    out["with_betas"] = parquet("with_betas", range_layout(E.dedup_keep_rank(joined, 1), n=partitions))
    out["duplicates"] = parquet("duplicates", E.keep_duplicates(joined))
    counts = dict(writes.counts)
    report = writes.report().coalesce(1)
    report.write.mode("overwrite").parquet(f"{base}/row_counts.parquet")
    out["row_counts"] = spark.read.schema(report.schema).parquet(f"{base}/row_counts.parquet")
    scratch.clear()
    added = counts["betas_joined"] - counts["processed"]
    if added > 0:
        raise RowsAdded(f"effect sizes added {added} rows to {counts['processed']}")
    return out
