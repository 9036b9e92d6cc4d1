"""Writing results.

Without a requested number of files the writers ask for rebalanced partitions: the
adaptive planner then picks file sizes and splits oversized ones. Asking for
``files=1`` gives a single file and, unavoidably, a single writing task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _files(df: DataFrame, files: int | None, *cols: str) -> DataFrame:
    if files is not None:
        return df.coalesce(files)
    return df.hint("rebalance", *cols)


def write_parquet_snappy(df: DataFrame, path: str, files: int | None = None) -> None:
    _files(df, files).write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_csv_gz(df: DataFrame, path: str, files: int | None = None) -> None:
    _files(df, files).write.mode("overwrite").option("header", True).option(
        "compression", "gzip"
    ).csv(path)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    _files(df, files).write.mode("overwrite").option("header", True).csv(path)


def write_json_gz(df: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines; null fields are left out."""
    _files(df, files).write.mode("overwrite").option("compression", "gzip").json(path)


def concat_json(
    spark: SparkSession, paths: list[str], out: str, files: int | None = None
) -> None:
    """Join several JSON-lines files into one dataset, line by line, unparsed."""
    _files(spark.read.text(paths), files).write.mode("overwrite").option(
        "compression", "gzip"
    ).text(out)


def range_layout(
    df: DataFrame, cols: list[str] | None = None, n: int | None = None
) -> DataFrame:
    """Partition by genomic range and sort within.

    Without ``n`` the session's shuffle partitions apply, which the adaptive planner joins to
    partitions of the advised size.

    Other key columns follow the position in the range key, so a position with very
    many rows spreads over several partitions.
    """
    cols = cols or ["left_chrom", "left_pos"]
    finer = [
        c
        for c in ("right_study", "right_chrom", "right_pos", "tag_pos")
        if c in df.columns and c not in cols
    ]
    keys = [*cols, *finer]
    ranged = df.repartitionByRange(*keys) if n is None else df.repartitionByRange(n, *keys)
    return ranged.sortWithinPartitions(*cols)


def partition_sumstats(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One directory per study, bio-feature, chromosome and phenotype.

    A directory that ``df`` has rows for is replaced and all others stay, so a repeated job does not
    double rows and new studies can be added. ``mode="append"`` adds files to the directories.
    """
    cols = ["study_id", "bio_feature", "chrom", "phenotype_id"]
    writer = _files(df, None, *cols).write.mode(mode).option("compression", "snappy")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def partition_credset(df: DataFrame, path: str) -> None:
    cols = ["study_id", "bio_feature", "lead_chrom"]
    _files(df, None, *cols).write.mode("overwrite").option("compression", "gzip").partitionBy(
        *cols
    ).json(path)


def partition_top_loci(df: DataFrame, path: str) -> None:
    """Top loci by chromosome. The chromosome stays in the records too."""
    _files(df.withColumn("by_chrom", df["chrom"]), None, "by_chrom").write.mode(
        "overwrite"
    ).partitionBy("by_chrom").json(path)
