"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrytab.llm import bpe, jaccard, lines, mixing, toxicity
from ferrytab.llm.common import landed, read, ship
from ferrytab.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go."""
    ship(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels"))).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; every document stays, ``n_chars`` follows its text."""
    ship(spark)
    kept = lines.drop_template_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars").cast("long"))
    return kept.withColumn("n_chars", changed).select(*COLUMNS)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, four fifths in common."""
    ship(spark)
    return jaccard.keep_one_of_each(docs, percent=80, size=5).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a document that is used twice is there twice."""
    ship(spark)
    return mixing.repeat_documents(docs.select(*COLUMNS))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become token ids; the digests show the ids and that they decode to the text."""
    ship(spark)
    return bpe.encode_digests(docs, tokenizer(spark))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", bpe_stage),
]

#: The trained model and the knapsack have no form in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
