"""Preparing a training corpus: five stages over the documents table.

Toxic documents go, one document of each near-duplicate group stays, documents
contaminated by the benchmark go, personal data is masked, and the sources are mixed to
their target weights. Every stage's result is written to the shared scratch folder and
read back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkledger.llm import decontaminate, mixing, near_dedup, pii, toxicity
from sparkledger.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go; it learns from the labelled ones among them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest doc_id stays."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets."""
    return pii.with_masked_text(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, all columns, and how many words of each the mix takes.

    Rows of one doc_id meet their part of the mix in order of source and size; rows that
    agree in all three are interchangeable."""
    order = [F.col("source").asc_nulls_first(), F.col("size")]
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    own = docs.withColumn("size", mixing.word_count(F.col("text"))) \
        .withColumn("_place", place).drop("size")
    taken = mixing.mix_sources(docs).withColumn("_at", place).drop("source") \
        .withColumnRenamed("doc_id", "_id")
    return own.join(taken, F.col("doc_id").eqNullSafe(F.col("_id"))
                    & (F.col("_place") == F.col("_at"))).drop("_id", "_place", "_at")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("mixing", mix),
]

#: Hash sketches, trained models and transducers have no SQL form; tests/llm holds the whole
#: against a plain version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
