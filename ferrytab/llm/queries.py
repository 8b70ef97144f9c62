"""Queries of this subpackage over the test tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrytab.llm import (
    alignment,
    ann,
    bpe,
    filter_audit,
    jaccard,
    lines,
    mixing,
    passages,
    pq_dedup,
    topk,
    toxicity,
    urls,
    warc,
)
from ferrytab.llm.common import landed, read, ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Rules of the URL filter. Fixed values.
URL_RULES = [
    urls.UrlRule(urls.ALLOW, "org", "/"),
    urls.UrlRule(urls.BLOCK, "example.org", "/es/"),
    urls.UrlRule(urls.BLOCK, "example.org", "/en/1"),
    urls.UrlRule(urls.ALLOW, "com", "/fr/"),
    urls.UrlRule(urls.BLOCK, "com", "/de/"),
]


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def tokenizer(spark: SparkSession) -> bpe.ByteBpe:
    """The many-language byte-level vocabulary of the installed tokenizer files."""
    import public_tokenizers

    return bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def alignment_tokenizers() -> tuple[str, bytes]:
    """The byte-level tokenizer's JSON and the piece tokenizer's model, from the installed tokenizer files."""
    from pathlib import Path

    import public_tokenizers

    a, b = (Path(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return a.read_text(encoding="utf-8"), b.read_bytes()


@query
def op1_line_dedup(spark, sf):
    kept = lines.drop_template_lines(read(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query
def op2_nearest(spark, sf):
    return ann.nearest(read(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op3_mixing(spark, sf):
    used = mixing.mix(read(spark, sf, "documents"), ["doc_id"])
    return used.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query
def op4_byte_bpe(spark, sf):
    return bpe.encode_digests(read(spark, sf, "documents"), tokenizer(spark))


@query
def op5_top_products(spark, sf):
    return topk.top_products(read(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query
def op6_passages(spark, sf):
    cut = passages.drop_repeats(read(spark, sf, "documents"), ["doc_id"])
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_toxicity(spark, sf):
    docs = read(spark, sf, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, read(spark, sf, "labels")))
    held_out = (toxicity.fold(F.col("doc_id")) == 0).alias("held_out")
    return scores.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_jaccard(spark, sf):
    return jaccard.jaccard_components(read(spark, sf, "documents"))


@query
def op9_url_filters(spark, sf):
    return urls.filter_urls(read(spark, sf, "pages"), URL_RULES)


@query
def op10_warc(spark, sf):
    pages = read(spark, sf, "pages")
    archives = landed(warc.write_archives(pages, warc.train_dictionary(pages), min_bytes=0), "warc")
    return warc.read_archives(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op11_near_vectors(spark, sf):
    return pq_dedup.near_duplicates(read(spark, sf, "embeddings"))


@query
def op12_alignment(spark, sf):
    docs = read(spark, sf, "documents")
    found = alignment.alignment_report(docs, *alignment_tokenizers(), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op13_filter_audit(spark, sf):
    return filter_audit.audit(read(spark, sf, "documents"), read(spark, sf, "labels"))


ORACLE["op5_top_products"] = """
WITH v AS (
    SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op6_passages"] = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS k
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)
), late AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM windows
    ) WHERE r > 1
), gone AS (
    SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM late)
), words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM w
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

ORACLE["op11_near_vectors"] = """
WITH RECURSIVE v AS (
    SELECT DISTINCT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), u AS (
    SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS s FROM v WHERE len([x FOR x IN v IF x <> 0]) > 0
), pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v) / (a.s * b.s) >= 0.9
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), roots AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
    SELECT a, count(*) AS n FROM pairs GROUP BY a
)
SELECT roots.a AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, roots.a = component_id AS kept
FROM roots LEFT JOIN counts ON roots.a = counts.a
"""

ORACLE["op13_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
), l AS (
    SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id
), m AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CAST(len(words) < 50 AS INTEGER)
           + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INTEGER)
           + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INTEGER)
           + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
           + 16 * CAST(coalesce(d.doc_id > first_id, false) AS INTEGER) AS mask
    FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), c AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
    SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
