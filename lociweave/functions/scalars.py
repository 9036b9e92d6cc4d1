"""Scalar column expressions. All of them stay inside Spark's code generation."""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.schemas import SIGNAL

# -log10 of the smallest normal double, used where a p-value underflowed to 0.
MAX_NEG_LOG10 = -math.log10(sys.float_info.min)


def variant_id(chrom="chrom", pos="pos", ref="ref", alt="alt") -> Column:
    """``chrom:pos:ref:alt``."""
    return F.concat_ws(":", F.col(chrom), F.col(pos).cast("string"), F.col(ref), F.col(alt))


def parse_variant_id(col: Column, prefix: str, sep: str = "_", far: bool = False) -> list[Column]:
    """Split a variant id into four columns; malformed parts become null, and so do positions beyond
    32 bits without ``far``."""
    parts = F.split(col, sep)
    return [
        F.get(parts, F.lit(0)).alias(f"{prefix}_chrom"),
        F.get(parts, F.lit(1)).try_cast("bigint" if far else "int").alias(f"{prefix}_pos"),
        F.get(parts, F.lit(2)).alias(f"{prefix}_ref"),
        F.get(parts, F.lit(3)).alias(f"{prefix}_alt"),
    ]


def to_ld_variant_id(col: Column) -> Column:
    return F.translate(col, ":", "_")


def from_ld_variant_id(col: Column) -> Column:
    return F.translate(col, "_", ":")


def signal_key(cols=SIGNAL) -> Column:
    """Readable key used for ordering. It skips nulls, so it is not an identity."""
    return F.concat_ws("_", *[F.col(c).cast("string") for c in cols])


def signal_id(cols=SIGNAL) -> Column:
    """16-byte identity of a signal.

    Built from a named, null-aware encoding of the key columns, so signals that
    differ only in which column is null stay apart. Heavy joins carry these 16
    bytes instead of eight columns per side.
    """
    named = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)])
    return F.unhex(F.md5(F.to_json(named)))


def eaf_to_maf(eaf: Column) -> Column:
    return F.when(eaf <= 0.5, eaf).otherwise(1 - eaf)


def maf_at_least(eaf: Column, min_maf: float) -> Column:
    """Exclude rows *known* to be rarer; an unknown frequency (null, NaN) stays."""
    return F.coalesce(~(eaf_to_maf(eaf) < min_maf), F.lit(True))


def is_number(col: Column) -> Column:
    return col.isNotNull() & ~F.isnan(col)


def none_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit("None"))


def null_to_none(col: Column) -> Column:
    return F.coalesce(col, F.lit("None"))


def in_window(pos: Column, centre: Column, kb: int) -> Column:
    return pos.between(centre - 1000 * kb, centre + 1000 * kb)


def study_class(type_col: Column) -> Column:
    return F.when(type_col == "gwas", "gwas").otherwise("molecular_trait")


def ld_eligible(study_col: Column, prefix: str = "FINNGEN") -> Column:
    return ~study_col.startswith(prefix)


def h4_h3(df: DataFrame) -> DataFrame:
    """Posterior ratio and its log2; null where H3 is zero."""
    ratio = F.try_divide(F.col("coloc_h4"), F.col("coloc_h3"))
    return df.withColumns({"coloc_h4_h3": ratio, "coloc_log2_h4_h3": F.log2(ratio)})


def neg_log10_pval(pval: Column) -> Column:
    return F.coalesce(-F.log10(pval), F.lit(MAX_NEG_LOG10))


def ensembl_only(col: Column) -> Column:
    return F.when(col.startswith("ENSG"), col)


def null_safe_equal(left: DataFrame, right: DataFrame, pairs) -> Column:
    """Conjunction of ``<=>`` over (left column, right column) names."""
    cond = None
    for lc, rc in pairs:
        eq = left[lc].eqNullSafe(right[rc])
        cond = eq if cond is None else cond & eq
    return cond
