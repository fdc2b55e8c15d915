"""A training corpus from the documents table: five stages, each written as Parquet and read again by the next.

Toxic documents go; of each group of near copies one document stays; documents
contaminated by the benchmark go; personal data is replaced in the texts; the
rest is mixed to the sources' target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tulha.llm import decontaminate, jaccard_join, mixing, personal_data, toxicity
from tulha.llm.tables import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic, by a model of the labels outside the held-out fold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind."""
    return personal_data.without_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with size, source_size, target and taken."""
    return mixing.mix_documents(docs).filter("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

#: The stages train models, which SQL does not express; tests compare the pipeline with a plain version of itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus of the documents in `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
