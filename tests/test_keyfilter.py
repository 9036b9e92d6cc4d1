import pytest
from pyspark.sql import functions as F

from lociweave.operators.keyfilter import STRETCH, KeyFilter
from lociweave.operators.sumstats import window_join
from lociweave.schemas import SUMSTATS
from lociweave.sources.writers import partition_sumstats

LEAST = 64 * STRETCH


def test_every_key_passes_and_most_others_do_not(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("a"), (F.col("id") * 3).alias("b")
    )
    keys = rows.filter("b % 60 = 0")
    wanted = KeyFilter(keys, {"both": ["a", "b"], "b": ["b"]})
    passed = rows.filter(wanted.passes("both", ["a", "b"]) & wanted.passes("b", ["b"]))
    # rows with nulls in the key are found too
    assert keys.exceptAll(passed).count() == 0
    assert passed.count() < 1.05 * keys.count()
    # the sets are apart: a key of one is no key of the other
    assert rows.filter(wanted.passes("b", ["a"])).count() < 100


def test_no_keys_and_more_keys_than_bits(spark):
    rows = spark.range(100_000)
    none = KeyFilter(rows.filter("id < 0"), {"k": ["id"]}, LEAST)
    assert rows.filter(none.passes("k", ["id"])).count() == 0
    full = KeyFilter(rows, {"k": ["id"]}, LEAST)
    assert rows.filter(full.passes("k", ["id"])).count() == 100_000
    with pytest.raises(ValueError):
        KeyFilter(rows, {"k": ["id"]}, LEAST + 1)


def test_window_join_reads_only_directories_of_its_signals(spark, tmp_path):
    stats = [
        (study, ph, None, chrom, 1000 * i, "A", "T", 0.1, 0.1, 0.5, 100, 10, 0.3, False)
        for study, ph in (("S1", None), ("S2", "P1"), ("S2", "P2"), ("S3", None))
        for chrom in ("1", "2")
        for i in range(1, 40)
    ]
    table = spark.createDataFrame(stats, SUMSTATS)
    partition_sumstats(table, str(tmp_path / "s"))
    laid_out = spark.read.schema(SUMSTATS).parquet(str(tmp_path / "s"))
    signals = spark.createDataFrame(
        [(b"a", "S1", None, None, "1", 20_000), (b"b", "S2", "P2", None, "1", 3_000), (b"c", "S2", None, None, "2", 9_000)],
        "sid binary, study_id string, phenotype_id string, bio_feature string, lead_chrom string, lead_pos int",
    )
    found = window_join(signals, laid_out.withColumn("ph", F.col("phenotype_id")), 2, bucket_bp=10_000)
    got = sorted((bytes(r.sid), r.ph or "", r.chrom, r.pos) for r in found.collect())
    near = lambda lead: [1000 * i for i in range(1, 40) if abs(1000 * i - lead) <= 2000]
    # the signal without a phenotype takes all of its study
    want = [(b"a", "", "1", p) for p in near(20_000)] + [(b"b", "P2", "1", p) for p in near(3_000)]
    want += [(b"c", ph, "2", p) for ph in ("P1", "P2") for p in near(9_000)]
    assert got == sorted(want)
    plan = found._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [(getbit(" in plan.toString()


def test_plan_is_made_without_a_job(spark):
    signals = spark.createDataFrame(
        [(b"a", "S1", None, None, "1", 20_000)],
        "sid binary, study_id string, phenotype_id string, bio_feature string, lead_chrom string, lead_pos int",
    )
    spark.sparkContext.setJobGroup("planning", "planning")
    window_join(signals, spark.createDataFrame([], SUMSTATS), 500).explain()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("", "")
    assert not jobs
