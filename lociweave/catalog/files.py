"""Registered queries: every source and sink, as a write and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.common import csv, overlap, r6, rounded
from lociweave.catalog.overlaps import MANIFEST_CTES
from lociweave.catalog.common import manifest as manifest_table
from lociweave.catalog.predict import BOTH_INDEX, FE_CTES, both_ld
from lociweave.catalog.registry import query
from lociweave.operators import ld as L
from lociweave.operators import process as P
from lociweave.schemas import COLOC_KEYS, COLOC_STATS, MANIFEST, SIGNAL, SUMSTATS, TAG, VARIANT
from lociweave.session import scratch_path
from lociweave.sources import readers as R
from lociweave.sources import writers as W

CRED = [*SIGNAL, *TAG, "is95_credset", "is99_credset", "multisignal_method"]
ALL = [*COLOC_STATS, *COLOC_KEYS]
H = ["coloc_h0", "coloc_h1", "coloc_h2", "coloc_h3", "coloc_h4"]
ROUNDED = ", ".join(r6(h) for h in H)
LOCI = ["study_id", "phenotype_id", "bio_feature", *VARIANT, "variant_id"]


def _path(t, name: str) -> str:
    return scratch_path(t.spark, name)


@query("scan_credset", f"select {csv(CRED)} from credset", ["credset"])
def _(t):
    out = _path(t, "credset")
    W.write_json_gz(t("credset"), out)
    return R.scan_credset(t.spark, out, t.far).select(*CRED)


@query("scan_json_lines", "select * from manifest", ["credset"], MANIFEST_CTES)
def _(t):
    out = _path(t, "manifest")
    W.write_json_gz(manifest_table(t).drop("left_sid", "right_sid"), out)
    return R.scan_json_lines(t.spark, out, MANIFEST, t.far)


@query(
    "write_json_gz",
    f"select {csv(LOCI)}, round(pval, 6) + 0.0 as pval from top_loci",
    ["top_loci"],
)
def _(t):
    out = _path(t, "top_loci")
    W.write_json_gz(t("top_loci"), out)
    return rounded(R.scan_top_loci(t.spark, out, t.far).select(*LOCI, "pval"), "pval")


_FILE = {"coloc_n_vars": "nsnps"} | {f"coloc_h{h}": f"PP.H{h}.abf" for h in range(5)}


@query("scan_coloc_csv", f"select coloc_n_vars, {ROUNDED}, {csv(COLOC_KEYS)} from coloc_raw", ["coloc_raw"])
def _(t):
    out = _path(t, "coloc_csv")
    W.write_csv(t("coloc_raw").withColumnsRenamed(_FILE), out)
    return rounded(P.rename_coloc_stats(R.scan_coloc_csv(t.spark, out, t.far)).select(*ALL), *H)


@query("write_csv_gz", f"select coloc_n_vars, {ROUNDED}, {csv(COLOC_KEYS)} from coloc_raw", ["coloc_raw"])
def _(t):
    out = _path(t, "coloc_csv_gz")
    W.write_csv_gz(t("coloc_raw"), out)
    back = t.spark.read.schema(t("coloc_raw").schema).option("header", True).csv(out)
    return rounded(back, *H)


@query("write_csv_single", f"select coloc_n_vars, {ROUNDED}, {csv(COLOC_KEYS)} from coloc_raw", ["coloc_raw"])
def _(t):
    # files=1 is an option of the writer; the query writes in parallel
    out = _path(t, "coloc_csv_plain")
    W.write_csv(t("coloc_raw"), out)
    back = t.spark.read.schema(t("coloc_raw").schema).option("header", True).csv(out)
    return rounded(back, *H)


@query("write_parquet_snappy", f"select coloc_n_vars, {ROUNDED}, {csv(COLOC_KEYS)} from coloc_raw", ["coloc_raw"])
def _(t):
    out = _path(t, "coloc_parquet")
    W.write_parquet_snappy(W.range_layout(t("coloc_raw")), out, files=200)
    return rounded(t.spark.read.parquet(out), *H)


@query(
    "scan_parquet_projected",
    "select distinct left_study, right_study, coloc_n_vars from coloc_raw",
    ["coloc_raw"],
)
def _(t):
    out = _path(t, "coloc_projected")
    W.write_parquet_snappy(t("coloc_raw"), out)
    cols = ["left_study", "right_study", "coloc_n_vars"]
    return R.scan_parquet_projected(t.spark, out, cols).distinct()


_LD_FILE_CTES = [c for c in FE_CTES if c[0] in ("n", "pv", "idx", "vp", "shared", "ld", "ld05")]
_LD_COLS = [f"{s}_{c}" for s in ("lead", "tag") for c in VARIANT]


@query(
    "scan_ld_tsv",
    f"select {csv(_LD_COLS)}, {r6('r', 'R_EUR')}, {r6('r2', 'R2_EUR')} from ld05",
    ["coloc_raw", "panel"],
    _LD_FILE_CTES,
)
def _(t):
    out = _path(t, "ld_tsv")
    L.to_ld_file(both_ld(t)).write.option("header", True).option("sep", "\t").option(
        "compression", "gzip"
    ).csv(out)
    return rounded(L.parse_ld(R.scan_ld_tsv(t.spark, out), t.far), "R_EUR", "R2_EUR")


@query(
    "scan_gene_lut",
    "select phenotype_id, concat('ENSG00', substr(phenotype_id, 5), lpad(cast(max(pos) as varchar(12)), 9, '0')) as gene_id from sumstats where phenotype_id is not null and alt = 'T' group by phenotype_id",
    ["sumstats"],
)
def _(t):
    # every position lists its phenotype once, in position order, some with a gene that
    # is not an Ensembl one: the last Ensembl entry has to win
    genes = (
        t("sumstats")
        .filter("phenotype_id is not null")
        .select(
            "phenotype_id",
            F.concat(
                F.when(F.col("alt") == "T", "ENSG00").otherwise("probe"),
                F.substring("phenotype_id", 5, 10),
                F.lpad(F.col("pos").cast("string"), 9, "0"),
            ).alias("gene_id"),
            "pos",
        )
        .distinct()
        .orderBy("pos", "gene_id")
        .drop("pos")
    )
    out = _path(t, "gene_lut")
    genes.write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(out)
    return R.scan_gene_lut(t.spark, out)


@query("concat_json", f"select {csv(LOCI)} from top_loci", ["top_loci"])
def _(t):
    by_type = t("top_loci").withColumn("part", F.col("phenotype_id").isNull())
    paths = []
    for flag in ("true", "false"):
        paths.append(_path(t, f"loci_{flag}"))
        W.write_json_gz(by_type.filter(f"part = {flag}").drop("part"), paths[-1])
    out = _path(t, "loci_all")
    W.concat_json(t.spark, paths, out)
    return R.scan_top_loci(t.spark, out, t.far).select(*LOCI)


LOG_P = "round(log10(pval), 6) as log_p"


@query(
    "partition_sumstats",
    f"select {csv(SUMSTATS.names[:9])}, n_total, n_cases, eaf, is_cc, {LOG_P} from sumstats",
    ["sumstats"],
)
def _(t):
    # all studies, then one of them again, as a repeated job would
    out = _path(t, "sumstats_by_study")
    rows = t("sumstats").select(*SUMSTATS.names)
    W.partition_sumstats(rows, out)
    W.partition_sumstats(rows.filter("study_id = 'ST1'"), out)
    table = R.scan_sumstats_table(t.spark, out, t.far)
    columns = [*SUMSTATS.names[:9], "n_total", "n_cases", "eaf", "is_cc"]
    return table.select(*columns, F.round(F.log10("pval"), 6).alias("log_p"))


@query("partition_credset", f"select {csv(CRED)} from credset", ["credset"])
def _(t):
    out = _path(t, "credset_by_study")
    W.partition_credset(t("credset"), out)
    return R.scan_credset(t.spark, out, t.far).select(*CRED)


@query("partition_top_loci", f"select {csv(LOCI)} from top_loci", ["top_loci"])
def _(t):
    out = _path(t, "loci_by_chrom")
    W.partition_top_loci(t("top_loci"), out)
    return R.scan_top_loci(t.spark, out, t.far).select(*LOCI)
