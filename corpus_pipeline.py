"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; every stage's result is written to the
shared folder and read again.  All but the last return the columns of documents.

Defined cases, for every stage: a null text counts as an empty one, and nulls in other columns stay; equal rows are documents of
their own, of which `near_duplicates` keeps one, as of all it links; ties in doc_id are broken by set and text there; texts are
taken whole, however long; columns beyond those of documents are kept up to the last stage, whatever their names but for the ones
that begin with two underscores; an empty table gives an empty result.  Without any labelled document no language is known, and
`language_id` rejects only texts without a letter.  Without benchmark items nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, language, ngram_join, packing, secrets
from larder.llm.queries import documents, vocabulary
from larder.session import materialize, small_batches


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model tells; learnt from the documents' own labels."""
    small_batches(spark)
    return language.accepted(docs, language.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates."""
    small_batches(spark)
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mask."""
    small_batches(spark)
    return secrets.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    small_batches(spark)
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_redaction", secret_redaction),
    ("sequence_packing", sequence_packing),
]

#: Trained models, tiling and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
