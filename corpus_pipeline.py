"""A training-data pipeline over the table documents: five stages, each over all that the one before has kept.

Toxic documents go; of each class of near duplicates the one with the least id stays; passages that an
earlier document holds are cut out; documents contaminated by the benchmark go; the rest is encoded.
Every stage but the last returns the columns of documents, with n_chars as the length of the text.

Edge cases, in all stages: rows with a null or empty text are kept, as nothing is found in them; rows without an id
are kept and judged by their own text; of repeated rows the second stage keeps all whose id is their class's, since rows
of one id are one document; very long texts are worked on whole; an empty table gives an empty table of the same columns;
further columns, whatever their names, are carried along until the last stage, which returns its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, decontamination, near_dedup, substring_dedup, toxicity
from tideline.llm.tables import made, shared_dir, table

#: What a Python worker's encoder remembers: little, since workers keep it through the other stages.
TABLE_BYTES = 24_000_000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.3 or more, by a model of the labels that aren't held out."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class."""
    return near_dedup.near_duplicates_removed(docs)


def substrings_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words that a document with a smaller id also has."""
    return substring_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which the benchmark's windows cover a twentieth or more."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and digests of them and of the text they decode to."""
    return bpe.encode(docs, table_bytes=TABLE_BYTES).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("substrings", substrings_stage),
    ("decontamination", decontamination_stage),
    ("tokens", tokens_stage),
]

#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's are written to the shared folder and read again as the next one's."""
    docs = table(spark, sf_dir, "documents")
    folder = made(f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
