import pytest
from pyspark.sql import functions as F

from lociweave.operators import features as FE
from lociweave.operators.ml import shuffle_sample
from lociweave.schemas import COLOC_KEYS, VARIANT


def tags(spark, side, leads, step):
    """Each lead's tags at every ``step`` positions around it; some r2 are unknown."""
    rows = [
        ("1", pos, "A", "T", "1", tag, "A", "T", None if (pos + tag) % 11 == 0 else (tag % 20) / 19.0)
        for pos in leads
        for tag in range(max(1, pos - 600_000), pos + 600_000, step)
    ]
    schema = ", ".join(
        [f"{side}_chrom string, {side}_pos int, {side}_ref string, {side}_alt string"]
        + ["tag_chrom string, tag_pos int, tag_ref string, tag_alt string", f"{side}_R2_EUR double"]
    )
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("limits", [(1_000_000, 50_000, 4_096), (200_000, 40, 7)])
def test_counts_equal_those_of_the_joined_tags(spark, rows, monkeypatch, limits):
    for name, value in zip(("PLACE_BP", "CELL_TAGS", "TAG_BLOCK"), limits):
        monkeypatch.setattr(FE, name, value)
    left = tags(spark, "left", [500_000, 900_000, 5_000_000], 20_011)
    right = tags(spark, "right", [510_000, 1_400_000, 9_000_000], 20_011 * 2)
    # the same grid of positions on both sides
    left = left.withColumn("tag_pos", (F.round(F.col("tag_pos") / 40_000) * 40_000).cast("int")).dropDuplicates([*[f"left_{c}" for c in VARIANT], "tag_pos"])
    right = right.withColumn("tag_pos", (F.round(F.col("tag_pos") / 40_000) * 40_000).cast("int")).dropDuplicates([*[f"right_{c}" for c in VARIANT], "tag_pos"])
    keys = [f"left_{c}" for c in VARIANT] + [f"right_{c}" for c in VARIANT]
    want = FE.prop_overlap_at_r2(FE.ld_intersection(left, right), keys)
    got = FE.shared_tag_props(left, right)
    rounded = lambda df: df.select(*keys, "total_overlap", *[F.round(f"`prop_overlap_{t}`", 9).alias(t.replace(".", "_")) for t in FE.R2_THRESHOLDS])
    assert rows(rounded(got)) == rows(rounded(want)) and got.count() >= 3


def test_no_shared_tags_and_no_tags(spark):
    left, right = tags(spark, "left", [500_000], 50_000), tags(spark, "right", [9_000_000], 50_000)
    assert FE.shared_tag_props(left, right).count() == 0
    assert FE.shared_tag_props(left.limit(0), right).count() == 0


def test_places_of_a_shuffle(spark):
    text = [c for c in COLOC_KEYS if not c.endswith("_pos")]
    df = spark.range(500).select(
        *[F.lit(None if c.endswith("bio_feature") else "x").cast("string").alias(c) for c in text],
        (F.col("id") % 400).cast("int").alias("left_pos"),
        F.lit(1).alias("right_pos"),
        "id",
    )
    once = {r.id: r.place for r in shuffle_sample(df).collect()}
    again = {r.id: r.place for r in shuffle_sample(df.repartition(7)).collect()}
    other = {r.id: r.place for r in shuffle_sample(df, seed=5).collect()}
    assert once == again and once != other
    assert sorted(once.values()) == list(range(500))
    # the order is no longer that of the keys, and equal keys follow each other
    assert sum(once[i] > once[i + 1] for i in range(399)) > 100
    assert all(once[i + 400] == once[i] + 1 for i in range(100))
    assert shuffle_sample(df.limit(0)).count() == 0
