"""Full-text search over lineage documents: an inverted index with term statistics, ranked by BM25.

Entries of different records often have one and the same document, so documents are told apart by their text and count
their entries; the index grows with the different texts, not with the records.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How fast a repeated term saturates, and how much a long document is held against it.
SATURATION, LENGTH_WEIGHT = 1.2, 0.75
#: Decimals to which scores are compared; documents with equal scores follow their text.
SCORE_DECIMALS = 9
TERM = "[a-z0-9]+"


class TextIndex(NamedTuple):
    """``postings`` (term, document, weight), and ``documents`` (document, entries)."""

    postings: DataFrame
    documents: DataFrame


def terms(text: Column) -> Column:
    """Runs of letters a-z and digits, lower-cased; an underscore parts them."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"))


def text_index(documents: DataFrame, text: str = "document") -> TextIndex:
    """An index over the different texts of a column.

    A posting's weight is the term's part of the BM25 score, so a search only adds up. Three aggregates: texts, terms of
    a text, texts of a term. Null texts and those without terms are in no posting.
    """
    texts = documents.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("document"))
    texts = texts.agg(F.count(F.lit(1)).alias("entries"))
    sized = texts.select("document", F.size(terms(F.col("document"))).alias("_length"))
    counted = (
        texts.select("document", F.explode(terms(F.col("document"))).alias("term"))
        .groupBy("document", "term")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    whole = sized.agg(F.count(F.lit(1)).alias("_documents"), F.avg("_length").alias("_mean"))
    holding = counted.groupBy("term").agg(F.count(F.lit(1)).alias("_holding"))
    joined = counted.join(sized, "document").join(holding, "term").crossJoin(F.broadcast(whole))  # whole is one row
    rare = F.log(1 + (F.col("_documents") - F.col("_holding") + 0.5) / (F.col("_holding") + 0.5))
    length = 1 - LENGTH_WEIGHT + LENGTH_WEIGHT * F.col("_length") / F.col("_mean")
    often = F.col("_times") * (SATURATION + 1) / (F.col("_times") + SATURATION * length)
    return TextIndex(joined.select("term", "document", (rare * often).alias("weight")), texts)


def search_text(questions: DataFrame, index: TextIndex, keep: int = 5, key: str = "question_id", text: str = "question") -> DataFrame:
    """(``key``, ``rank``, ``document``, ``entries``, ``score``): the ``keep`` best documents of every question.

    A question scores a document by the terms that both have, each once. Questions of one wording are looked up once, and
    each task cuts a wording's documents to the best before the shuffle. Questions without a known term have no rows.
    """
    asked = questions.select(F.col(key).alias("_key"), F.lower(text).alias("_wording"))
    wanted = asked.select("_wording").distinct().select("_wording", F.explode(F.array_distinct(terms(F.col("_wording")))).alias("term"))
    scored = (
        wanted.join(index.postings, "term")
        .groupBy("_wording", "document")
        .agg(F.round(F.sum("weight"), SCORE_DECIMALS).alias("score"))
    )
    best = Window.partitionBy("_wording").orderBy(F.col("score").desc(), "document")
    top = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    found = top.join(index.documents, "document").join(asked, "_wording")
    return found.select(F.col("_key").alias(key), "rank", "document", "entries", "score")
