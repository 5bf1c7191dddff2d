"""A corpus pipeline: language, toxicity, near-duplicates, benchmark passages, encoding.

Every stage is a function of (spark, docs, sf_dir) that works on all rows its predecessor kept;
its result is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm import decontaminate, language, pieces, simhash, toxicity
from twinshelf.llm.queries import table, tokenizer_file
from twinshelf.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, in a language that the labelled ones teach."""
    return language.identified(docs, language.fit(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic by the model of the labelled ones."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link."""
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; mostly copied ones go."""
    clean = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text."""
    model = tokenizer_file("piece_bpe_32k.model")
    coded = pieces.encode(docs, model, lossless_col="lossless")
    return coded.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "lossless")


STAGES = [
    ("language", language_id),
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("sentencepiece", encode),
]

# Models and fingerprints are beyond SQL; the tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
