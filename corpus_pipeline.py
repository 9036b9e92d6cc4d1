"""A corpus from raw documents to packed sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm import packing, qda, simhash, superkmer, templates, text, tokenizer
from lociweave.llm.queries import VOCABULARY, digest_pieces, table
from lociweave.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return qda.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, as ``op10_simhash`` links them."""
    return simhash.deduplicate(docs, shingle=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows that an earlier text has. Documents of which no word is left go;
    those that had none stay. ``n_chars`` follows the text."""
    rows, name = text.numbered(docs)
    own = F.col(name["text"])
    empty = F.trim(F.coalesce(own, F.lit(""))) == ""
    cut = superkmer.remove_repeats(rows.withColumn("was_empty", empty), name["doc_id"], name["text"])
    left = cut.filter((F.col("was_empty")) | (own != ""))
    if "n_chars" in name:
        size = F.length(own).cast(docs.schema["n_chars"].dataType)
        left = left.withColumn(name["n_chars"], F.coalesce(size, F.col(name["n_chars"])))
    return text.named_again(left, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no benchmark item away."""
    return templates.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, one row each."""
    return digest_pieces(packing.pack_documents(docs, tokenizer.vocabulary_file(VOCABULARY)))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: No SQL: models, fingerprints and tokenizers cannot be expressed; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
