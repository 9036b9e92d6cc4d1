"""Input tables of the data model, derived from a general star schema.

Each recipe is one SELECT that reads base tables or earlier recipes and runs
unchanged in any ANSI engine, which is what lets results be checked elsewhere. The
numbers have no biological meaning. Every recipe uses its source tables whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.session import materialise

BASE_TABLES = ("lineitem", "orders", "events")

# Variant columns of a part key.
_VARIANT = """cast(1 + {k} % 5 as varchar(10)) as chrom,
  cast(5000 * (({k} - {k} % 5) / 5) + 5000 as int) as pos,
  case when {k} % 2 = 0 then 'A' else 'C' end as ref, case when {k} % 3 = 0 then 'G' else 'T' end as alt"""

RECIPES: dict[str, str] = {}

RECIPES["sumstats"] = f"""
with base as (
 select case when l_suppkey % 8 < 4 then 'gwas' when l_suppkey % 8 < 6 then 'eqtl' when l_suppkey % 8 = 6 then 'pqtl' else 'sqtl' end as type,
  concat('ST', cast(l_suppkey % 8 as varchar(10))) as study_id,
  case when l_suppkey % 8 < 4 then null else concat('ENSG', cast(l_linenumber % 2 as varchar(10))) end as phenotype_id,
  case when l_suppkey % 8 < 4 then null when l_linenumber % 4 < 2 then 'BLOOD' else 'BRAIN' end as bio_feature,
  {_VARIANT.format(k="l_partkey")},
  l_discount, l_tax, l_quantity from lineitem),
g as (select type, study_id, phenotype_id, bio_feature, chrom, pos, ref, alt, max(l_discount) - 0.03 as beta, 0.01 + min(l_tax) / 8 as se,
  max(l_quantity) / 51.0 as eaf, 50000 as n_total, 10000 as n_cases, study_id in ('ST0','ST1') as is_cc
 from base group by type, study_id, phenotype_id, bio_feature, chrom, pos, ref, alt)
select type, study_id, phenotype_id, bio_feature, chrom, pos, ref, alt, beta, se, exp(-0.5*(beta/se)*(beta/se)) as pval, n_total, n_cases, eaf, is_cc from g
"""

RECIPES["credset"] = """
with z as (select *, abs(beta/se) as z, cast(floor(pos/250000.0) as int) as block from sumstats),
r as (select *, row_number() over (partition by type,study_id,phenotype_id,bio_feature,chrom,block order by z desc, pos, ref, alt) as rn,
 max(z) over (partition by type,study_id,phenotype_id,bio_feature,chrom,block) as mz from z),
l as (select type,study_id,phenotype_id,bio_feature,chrom,block,pos as lead_pos,ref as lead_ref,alt as lead_alt from r where rn=1)
select r.type, r.study_id, r.phenotype_id, r.bio_feature, r.chrom as lead_chrom, l.lead_pos, l.lead_ref, l.lead_alt,
 r.chrom as tag_chrom, r.pos as tag_pos, r.ref as tag_ref, r.alt as tag_alt, r.z >= r.mz - 1.0 as is95_credset, r.z >= r.mz - 2.0 as is99_credset,
 case when r.study_id in ('ST0','ST4') then 'distance' else 'conditional' end as multisignal_method
from r join l on r.type=l.type and r.study_id=l.study_id and r.phenotype_id is not distinct from l.phenotype_id and r.bio_feature is not distinct from l.bio_feature and r.chrom=l.chrom and r.block=l.block
where r.z >= r.mz - 2.0
"""

RECIPES["top_loci"] = """
select s.study_id, s.phenotype_id, s.bio_feature, s.chrom, s.pos, s.ref, s.alt, concat_ws(':', s.chrom, cast(s.pos as varchar(12)), s.ref, s.alt) as variant_id, s.pval
from sumstats s join (select distinct study_id, phenotype_id, bio_feature, lead_chrom, lead_pos, lead_ref, lead_alt from credset) c
on s.study_id=c.study_id and s.phenotype_id is not distinct from c.phenotype_id and s.bio_feature is not distinct from c.bio_feature and s.chrom=c.lead_chrom and s.pos=c.lead_pos and s.ref=c.lead_ref and s.alt=c.lead_alt
"""

# Carriers only: a sample without a row for a variant has no copy of the allele.
# An order for a part also makes its customer a carrier at the next three
# positions, which gives neighbouring variants linkage that decays with distance.
RECIPES["panel"] = f"""
with c as (select l_partkey as k, o_custkey as sample_id, max(l_quantity) as q from lineitem join orders on l_orderkey = o_orderkey group by l_partkey, o_custkey),
s as (select k, sample_id, q from c union all select k + 5, sample_id, q from c union all select k + 10, sample_id, q from c union all select k + 15, sample_id, q from c),
g as (select k, sample_id, max(q) as q from s group by k, sample_id)
select {_VARIANT.format(k="k")}, sample_id, case when q > 25 then 2 else 1 end as dosage from g
"""

RECIPES["coloc_raw"] = """
with c as (select *, concat_ws('_', type, study_id, phenotype_id, bio_feature, lead_chrom, cast(lead_pos as varchar(12)), lead_ref, lead_alt) as k,
  case when type='sqtl' then concat('1^2^3^clu^', phenotype_id) else phenotype_id end as ph from credset where is95_credset),
p as (select a.type as left_type, a.study_id as left_study, coalesce(a.bio_feature,'None') as left_bio_feature, coalesce(a.ph,'None') as left_phenotype, a.lead_chrom as left_chrom, a.lead_pos as left_pos, a.lead_ref as left_ref, a.lead_alt as left_alt,
  b.type as right_type, b.study_id as right_study, coalesce(b.bio_feature,'None') as right_bio_feature, coalesce(b.ph,'None') as right_phenotype, b.lead_chrom as right_chrom, b.lead_pos as right_pos, b.lead_ref as right_ref, b.lead_alt as right_alt
 from c a join c b on a.tag_chrom=b.tag_chrom and a.tag_pos=b.tag_pos and a.tag_ref=b.tag_ref and a.tag_alt=b.tag_alt
 where a.study_id<>b.study_id and (a.type='gwas' or b.type='gwas') and a.k>b.k),
g as (select count(*) as n, cast(left_pos/5000 + 3*right_pos/5000 as int) % 11 as u, left_type, left_study, left_bio_feature, left_phenotype, left_chrom, left_pos, left_ref, left_alt, right_type, right_study, right_bio_feature, right_phenotype, right_chrom, right_pos, right_ref, right_alt
 from p group by left_type, left_study, left_bio_feature, left_phenotype, left_chrom, left_pos, left_ref, left_alt, right_type, right_study, right_bio_feature, right_phenotype, right_chrom, right_pos, right_ref, right_alt)
select cast(n*80 as int) as coloc_n_vars, cast(0.02 as double) as coloc_h0, cast(0.03 as double) as coloc_h1, cast(0.05 as double) as coloc_h2, cast(0.09 as double)*u as coloc_h3, cast(0.09 as double)*(10-u) as coloc_h4,
 left_type, left_study, left_bio_feature, left_phenotype, left_chrom, left_pos, left_ref, left_alt, right_type, right_study, right_bio_feature, right_phenotype, right_chrom, right_pos, right_ref, right_alt from g
"""

RECIPES["gene_lut"] = """
select distinct phenotype_id, concat('ENSG0000', substr(phenotype_id, 5)) as gene_id from sumstats where type='eqtl' and phenotype_id='ENSG0'
"""

# Two releases of the same results that share some tests: the earlier one has its
# own H4, the later one lacks some tests and adds others. Every result is in one of them.
RECIPES["release_old"] = "select * from (select coloc_n_vars, coloc_h0, coloc_h1, coloc_h2, coloc_h3, coloc_h4 * 0.5 as coloc_h4, left_type, left_study, left_bio_feature, left_phenotype, left_chrom, left_pos, left_ref, left_alt, right_type, right_study, right_bio_feature, right_phenotype, right_chrom, right_pos, right_ref, right_alt, 'old' as release_note from coloc_raw) x where left_ref = 'A' or right_alt = 'G'"
RECIPES["release_new"] = "select * from coloc_raw where left_alt = 'T' or right_ref = 'C' or not (left_ref = 'A' or right_alt = 'G')"

# Log lines of finished tests, one file name per event.
RECIPES["logs"] = """
select concat('log_', lpad(cast(event_id as varchar(20)), 12, '0'), '.txt') as file,
 concat('Time taken: ', cast(event_id % 3 as varchar(4)), ':', cast(event_id % 60 as varchar(4)), ':', cast(event_id % 50 as varchar(4)), '.5') as line from events
"""

# Where a recipe computes with positions beyond what 32 bits hold, Spark counts in 64: three times a
# position overflows from 715,827,883 on. The recipe itself stays as it is for other engines.
_WIDE = {"coloc_raw": ("3*right_pos/5000", "3*cast(right_pos as bigint)/5000")}

# Positions themselves are int, as the recipes say, unless part keys reach so far that one of them, or
# a window of this width around it, needs more than 32 bits: then those of all tables are bigint.
_NARROW_POS, _WIDE_POS = " as int) as pos", " as bigint) as pos"
_AROUND = 10_000_000


def spark_sql(name: str, far: bool = False) -> str:
    """A recipe as Spark runs it: the same rows, without overflow. ``far``: with positions in 64 bits."""
    pairs = [_WIDE[name]] if name in _WIDE else []
    if far and name in ("sumstats", "panel"):
        pairs.append((_NARROW_POS, _WIDE_POS))
    sql = RECIPES[name]
    for narrow, wide in pairs:
        if narrow not in sql:
            raise ValueError(f"recipe {name} has changed")
        sql = sql.replace(narrow, wide)
    return sql


_DEPENDS = {
    "sumstats": [],
    "credset": ["sumstats"],
    "top_loci": ["sumstats", "credset"],
    "panel": [],
    "coloc_raw": ["credset"],
    "gene_lut": ["sumstats"],
    "release_old": ["coloc_raw"],
    "release_new": ["coloc_raw"],
    "logs": [],
}


def closure(names) -> list[str]:
    """``names`` and everything they are derived from, in build order."""
    needed: set[str] = set()

    def visit(name: str) -> None:
        for dep in _DEPENDS[name]:
            visit(dep)
        needed.add(name)

    for name in names:
        visit(name)
    return [n for n in _DEPENDS if n in needed]


_tables: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, built once per session and kept in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _tables:
        for dep in _DEPENDS[name]:
            table(spark, sf_dir, dep).createOrReplaceTempView(dep)
        for base in BASE_TABLES:
            if base in RECIPES[name]:
                base_table(spark, sf_dir, base).createOrReplaceTempView(base)
        _tables[key] = materialise(spark.sql(spark_sql(name, is_far(spark, sf_dir))), name)
    return _tables[key]


_far: dict[tuple, bool] = {}


def is_far(spark: SparkSession, sf_dir: str) -> bool:
    """Whether positions need more than 32 bits; told once per session from the part keys."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _far:
        part = F.col("l_partkey").cast("double")
        last = base_table(spark, sf_dir, "lineitem").agg(F.max(F.abs(part))).first()[0]
        # the panel reaches 15 keys beyond the last one
        _far[key] = last is not None and 1000 * (last + 15) + 5000 + _AROUND >= 2**31
    return _far[key]


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table some operators compute for others, built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _tables:
        _tables[key] = materialise(build(), name)
    return _tables[key]
