"""Turning raw test results into the released table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.config import Config
from lociweave.functions.scalars import ensembl_only, h4_h3, none_to_null
from lociweave.operators.skew import broadcast_if_small
from lociweave.schemas import DEDUP_KEYS

NONE_COLUMNS = ["left_phenotype", "left_bio_feature", "right_phenotype", "right_bio_feature"]
TIEBREAK = ["right_chrom", "right_pos", "right_ref", "right_alt", "is_flipped"]


def rename_coloc_stats(df: DataFrame) -> DataFrame:
    """Result-file column names to table column names."""
    names = {f"PP.H{h}.abf": f"coloc_h{h}" for h in range(5)}
    return df.withColumnsRenamed({**names, "nsnps": "coloc_n_vars"})


def filter_min_overlap(df: DataFrame, min_vars: int | None = 100) -> DataFrame:
    return df if not min_vars else df.filter(F.col("coloc_n_vars") >= min_vars)


def make_symmetric(df: DataFrame, swap_h1_h2: bool = False) -> DataFrame:
    """Add every test with its sides exchanged, marked ``is_flipped``.

    H1 and H2 mean "left only" and "right only". They keep their values by default;
    ``swap_h1_h2`` exchanges them in flipped rows.
    """
    other = {"left_": "right_", "right_": "left_"}

    def source(name: str) -> str:
        for prefix, opposite in other.items():
            if name.startswith(prefix):
                return opposite + name[len(prefix):]
        if swap_h1_h2 and name in ("coloc_h1", "coloc_h2"):
            return "coloc_h2" if name == "coloc_h1" else "coloc_h1"
        return name

    flipped = df.select(*[F.col(source(c)).alias(c) for c in df.columns])
    return df.withColumn("is_flipped", F.lit(False)).unionByName(
        flipped.withColumn("is_flipped", F.lit(True))
    )


def left_gwas_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("left_type") == "gwas")


def keep_rank(df: DataFrame, keys: list[str], order: list[Column], rank: int = 1) -> DataFrame:
    """The row at position ``rank`` of each key. ``order`` should be total.

    The rank filter lets Spark cut each key to ``rank`` rows before the shuffle, so
    a key with very many rows does not end up whole in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == rank).drop("_rank")


def best_first(df: DataFrame, by: str = "coloc_h4") -> list[Column]:
    """Highest ``by`` first, then the right variant and the original orientation."""
    return [F.desc(by), *[F.asc(c) for c in TIEBREAK if c in df.columns]]


def dedup_keep_best(df: DataFrame, keys: list[str] = DEDUP_KEYS) -> DataFrame:
    """Per left signal and right dataset, the test with the highest H4."""
    return keep_rank(df, keys, best_first(df), 1)


def none_to_null_columns(df: DataFrame, columns=NONE_COLUMNS) -> DataFrame:
    return df.withColumns({c: none_to_null(F.col(c)) for c in columns if c in df.columns})


def gene_id_map(df: DataFrame, lut: DataFrame, sides=("left", "right")) -> DataFrame:
    """``left_gene_id`` and ``right_gene_id``, or that of one side: Ensembl genes only.

    eQTL phenotypes are looked up, and stand for themselves when not listed; sQTL
    phenotypes carry the gene as the fifth ``^``-separated field. Rows of other types need no
    entry; they get keys that no phenotype has, spread over the join's partitions.
    """
    out = df
    for side in sides:
        genes = broadcast_if_small(lut.select(F.col("phenotype_id").alias("_p"), F.col("gene_id").alias("_g")))
        phenotype = F.col(f"{side}_phenotype")
        spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*DEDUP_KEYS), F.lit(4096)).cast("string"))
        gene = F.when(F.col(f"{side}_type") == "eqtl", F.coalesce("_g", phenotype)).when(
            F.col(f"{side}_type") == "sqtl", F.get(F.split(phenotype, "\\^"), F.lit(4))
        )
        out = (
            out.withColumn("_p", F.when(F.col(f"{side}_type") == "eqtl", phenotype).otherwise(spread))
            .join(genes, "_p", "left")
            .withColumn(f"{side}_gene_id", ensembl_only(gene))
            .drop("_g", "_p")
        )
    return out.select(*df.columns, *[f"{side}_gene_id" for side in sides])


def drop_null_stats(df: DataFrame) -> DataFrame:
    return df.dropna(how="any", subset=["coloc_h3", "coloc_h4", "coloc_log2_h4_h3"])


def process_results(raw: DataFrame, lut: DataFrame, config: Config = Config()) -> DataFrame:
    """The whole chain from raw tests to the processed table (without layout)."""
    df = filter_min_overlap(h4_h3(raw), config.min_overlapping_vars)
    if config.make_symmetric:
        df = make_symmetric(df, config.swap_h1_h2)
    if config.left_gwas_only:
        df = left_gwas_only(df)
    if config.deduplicate_right:
        df = dedup_keep_best(df)
    # a GWAS on the left has no gene
    df = gene_id_map(df, lut, ("right",) if config.left_gwas_only else ("left", "right"))
    df = none_to_null_columns(df).drop("left_sumstat", "right_sumstat")
    if config.left_gwas_only:
        df = df.drop("left_bio_feature", "left_phenotype")
    return drop_null_stats(df)
