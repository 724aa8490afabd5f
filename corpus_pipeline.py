"""A corpus from raw documents to token ids, in five stages; each calls one operator of ``quireflow.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the caller writes as Parquet and
reads again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.llm.bpe import encoded
from quireflow.llm.mixing import mixed
from quireflow.llm.quality import apply_policy
from quireflow.llm.similar import without_near_duplicates
from quireflow.llm.substring import repeats
from quireflow.session import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy rejects go."""
    return apply_policy(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in five-word shingles (0.8 or more), one of each group stays."""
    return without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that start elsewhere as well go from the texts; every document stays."""
    out = repeats(docs, keep=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights: a document comes as often as the mix takes it."""
    return mixed(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of each text, with digests of ids and decoded text."""
    return encoded(docs, with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("bpe_codec", bpe_codec),
]

#: Jaccard classes and BPE ids can't be expressed in SQL; tests/llm holds run() against the five stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    to = scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{to}/{name}")
        docs = spark.read.parquet(f"{to}/{name}")
    return docs
