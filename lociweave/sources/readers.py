"""Reading every input format, always with a declared schema.

A declared schema saves the inference pass over the data and gives absent columns
as typed nulls. The text ``None`` in a dataset key means null everywhere. ``far`` declares
positions in 64 bits, for tables that need them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lociweave import schemas
from lociweave.functions.scalars import none_to_null


def canonical_nulls(df: DataFrame) -> DataFrame:
    """Turn the text ``None`` into null in all phenotype and bio-feature columns."""
    keys = [c for c in df.columns if c.endswith(schemas.NULLABLE_KEYS) and not c.startswith("n_")]
    return df.withColumns({c: none_to_null(F.col(c)) for c in keys}) if keys else df


def _positions(schema: StructType, far: bool) -> StructType:
    return schemas.far_schema(schema) if far else schema


def scan_json_lines(spark: SparkSession, path: str | list[str], schema: StructType, far: bool = False) -> DataFrame:
    """JSON lines, plain or compressed; a directory is read whole."""
    return canonical_nulls(spark.read.schema(_positions(schema, far)).json(path))


def scan_credset(spark: SparkSession, path: str, far: bool = False) -> DataFrame:
    return scan_json_lines(spark, path, schemas.CREDSET, far)


def scan_top_loci(spark: SparkSession, path: str, far: bool = False) -> DataFrame:
    return scan_json_lines(spark, path, schemas.TOP_LOCI, far)


def scan_overlaps(spark: SparkSession, path: str, far: bool = False) -> DataFrame:
    return scan_json_lines(spark, path, schemas.OVERLAP, far)


def scan_manifest(spark: SparkSession, path: str, far: bool = False) -> DataFrame:
    return scan_json_lines(spark, path, schemas.MANIFEST, far)


def scan_parquet_projected(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def scan_sumstats_table(spark: SparkSession, path: str, far: bool = False) -> DataFrame:
    """The whole statistics table; select a dataset with ``select_sumstats``.

    Chromosomes are text whatever the files or directory names hold, which the
    declared schema ensures without touching the rows.
    """
    return spark.read.schema(_positions(schemas.SUMSTATS, far)).parquet(path)


def scan_coloc_csv(spark: SparkSession, path: str, far: bool = False) -> DataFrame:
    """Result files with a header each, below one directory.

    A file that cannot be read, a header with other columns or a row that does not fit the schema
    is an error; :func:`malformed_coloc_rows` lists such rows.
    """
    return (
        spark.read.schema(_positions(schemas.COLOC_FILE, far))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("mode", "FAILFAST")
        .option("basePath", path)
        .csv(path)
    )


def malformed_coloc_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of result files that do not fit the schema: (file, line) and what could be parsed."""
    schema = StructType([*schemas.COLOC_FILE.fields, StructField("line", StringType())])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", "line")
        .csv(path)
    )
    parsed = [f"`{c}`" for c in schemas.COLOC_FILE.names]
    return rows.filter("line is not null").select(F.col("_metadata.file_path").alias("file"), "line", *parsed)


def scan_ld_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LD_FILE).option("header", True).option("sep", "\t").csv(path)


def scan_gene_lut(spark: SparkSession, path: str) -> DataFrame:
    """phenotype_id -> gene_id from tab-separated files, Ensembl genes only.

    A phenotype listed twice takes its last entry in (file, position) order. Files
    are read by column position, so both columns must come in schema order.
    """
    raw = (
        spark.read.schema(schemas.GENE_LUT)
        .option("header", True)
        .option("sep", "\t")
        .csv(path)
        .select(
            "phenotype_id",
            "gene_id",
            F.struct(
                F.col("_metadata.file_path"),
                F.col("_metadata.file_block_start"),
                F.monotonically_increasing_id(),
            ).alias("at"),
        )
    )
    return (
        raw.filter(F.col("gene_id").startswith("ENSG"))
        .groupBy("phenotype_id")
        .agg(F.max_by("gene_id", "at").alias("gene_id"))
    )


def scan_logs(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): one row per log file, with its whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"),
        F.col("value").alias("text"),
    )
