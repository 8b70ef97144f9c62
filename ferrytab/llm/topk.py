"""Exact top-k search by inner product with norm buckets.

Vectors are grouped by length, longest first. A first bucket gives every query a bound on its k-th
score; in every other bucket that bound over the lengths is a cosine threshold, by which a query
skips the bucket, cuts it by coordinates, or cuts it by length, and then verifies products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import landed
from ferrytab.llm.vectors import BLOCK, QUERY_BLOCK, best_of, blocks, fitted, length, ranked, unpacked, usable

#: From this cosine threshold on a bucket is cut by coordinates, below it by length.
COORDINATE_FROM = 0.75
#: Coordinates, the query's largest, that are compared with the threshold.
FOCUS = 4
#: Blocks of candidates for which one copy of the queries is made: as few as that in a small table, at most ``MOST`` in any.
GROUP, MOST = 8, 64
#: Whole numbers are exact in doubles up to here.
EXACT = float(1 << 53)


def survivors(query: np.ndarray, bucket: np.ndarray, lengths: np.ndarray, cosine: float) -> np.ndarray:
    """Rows of a bucket whose largest-coordinate values allow at least the cosine with ``query``.

    With a unit query and unit vectors a coordinate can differ only so far if the cosine is reached.
    """
    q = query / np.linalg.norm(query)
    alive = np.ones(len(bucket), bool)
    for f in np.argsort(-np.abs(q))[:FOCUS]:
        spread = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - q[f] * q[f]))) + 1e-9
        x = bucket[:, f] / np.maximum(lengths, 1e-300)
        high, low = q[f] * cosine + spread, q[f] * cosine - spread
        # Where a coordinate may lie on the far side of the query itself, the sphere's end is the bound.
        alive &= (x <= (1.0 + 1e-9 if q[f] >= cosine else high)) & (x >= (-1.0 - 1e-9 if -q[f] >= cosine else low))
    return np.flatnonzero(alive)


def products(queries: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered vectors, exact also where doubles are not."""
    bound = np.linalg.norm(queries, axis=1).max(initial=0) * np.linalg.norm(bucket, axis=1).max(initial=0)
    if bound < EXACT / 2:
        return (queries @ bucket.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in bucket]
    rows = [[sum(int(a) * b for a, b in zip(q, row)) for row in whole] for q in queries]
    top = (1 << 63) - 1
    return np.array([[max(-top, min(top, x)) for x in row] for row in rows], np.int64).reshape(len(queries), len(bucket))


def search_bucket(queries, query_ids, bounds, bucket, ids, k: int):
    """(query ids, ids, scores) of products that reach the queries' bounds, at most ``k`` a query."""
    queries, bucket = fitted(queries, bucket)
    lengths, q_lengths = np.linalg.norm(bucket, axis=1), np.linalg.norm(queries, axis=1)
    longest = lengths.max(initial=0)
    reach = q_lengths * longest
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach > 0, bounds / reach, np.where(bounds > 0, np.inf, -np.inf))
    out = []

    def keep(which: np.ndarray, rows: np.ndarray) -> None:
        if not len(which) or not len(rows):
            return
        scores = products(queries[which], bucket[rows])
        good = (scores >= bounds[which][:, None]) & (query_ids[which][:, None] != ids[rows][None, :])
        at = np.nonzero(good)
        out.append((query_ids[which][at[0]], ids[rows][at[1]], scores[at]))

    alive = cosine <= 1 + 1e-9
    by_coordinate = alive & (cosine >= COORDINATE_FROM)
    for i in np.flatnonzero(by_coordinate):
        keep(np.array([i]), survivors(queries[i], bucket, lengths, max(0.0, float(cosine[i]) - 1e-9)))
    by_length = np.flatnonzero(alive & ~by_coordinate)
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(bounds[by_length] > 0, bounds[by_length] / q_lengths[by_length] * (1 - 1e-9), 0.0)
        keep(by_length, np.flatnonzero(lengths >= least.min()))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = tuple(np.concatenate([x[j] for x in out]) for j in range(3))
    best = best_of(found[0], found[1], found[2], k)
    return tuple(x[best] for x in found)


def _first_bounds(pairs: DataFrame, k: int) -> DataFrame:
    """Query blocks beside the first bucket: adds ``bounds``, each query's k-th score there, or less than any."""

    def bound(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids, n = np.frombuffer(row["ids"], np.int64), row["n"]
                queries, bucket = fitted(unpacked(row["data"], n), unpacked(row["c_data"], row["c_n"]))
                others = np.frombuffer(row["c_ids"], np.int64)
                scores = products(queries, bucket).astype(np.float64)
                scores[ids[:, None] == others[None, :]] = -np.inf
                kth = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(n, -np.inf)
                columns = {"q": [row["q"]], "ids": [row["ids"]], "data": [row["data"]], "n": [n], "bounds": [kth.tobytes()]}
                yield pa.RecordBatch.from_pydict(columns)

    return pairs.mapInArrow(bound, "q long, ids binary, data binary, n long, bounds binary")


def top_products(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The ``k`` highest integer inner products of each query: (``query_id``, ``rank``, ``vec_id``, ``score``).

    Components become ``floor(scale * x)``. Queries are the rows for which ``is_query`` (over
    ``vec_id``) holds, candidates all rows with another id; fewer than ``k`` give all. Rows without an
    id, without a vector or with a null or non-finite component take no part; empty vectors are zero.
    Scores beyond a long are cut to its ends. Ties go to the smaller id.

    Blocks of queries meet blocks of candidates. The queries, which are few, are copied once per group
    of candidate blocks; candidates are shuffled once. A group is a task, which holds its candidates and sees
    one block of queries after the other, so neither side is broadcast. Groups grow with the table where the copies
    would else be more than the candidates. Equal lengths are told apart by a hash of the id, so a vector that fills a
    third of the table is spread like any other.
    """
    rows = usable(vectors, key, vector, lambda x: F.floor(x * scale))
    rows = landed(rows.withColumn("length", length()), "topk-vectors")
    spread = F.xxhash64("vec_id")
    by_length = rows.repartitionByRange(F.col("length").desc(), spread).sortWithinPartitions(F.col("length").desc(), spread)
    buckets = landed(blocks(by_length, "bucket", BLOCK), "topk-buckets")
    asked = landed(blocks(rows.where(is_query).repartition(F.pmod(spread, F.lit(64))), "q", QUERY_BLOCK), "topk-queries")
    # The first bucket: one block, so of bounded size.
    first = buckets.orderBy("bucket").limit(1).select(F.col("ids").alias("c_ids"), F.col("data").alias("c_data"), F.col("n").alias("c_n"))
    bounded = landed(_first_bounds(asked.withColumn("one", F.lit(1)).join(F.broadcast(first.withColumn("one", F.lit(1))), "one"), k), "topk-bounds")
    groups = _groups(buckets.count(), bounded.count() * QUERY_BLOCK / BLOCK, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    group = F.pmod(F.xxhash64("bucket"), F.lit(groups)).cast("int").alias("g")
    held = buckets.select(group, F.lit(0).alias("kind"), "ids", "data", "n", F.lit(None).cast("binary").alias("bounds"))
    copies = bounded.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("kind"), "ids", "data", "n", "bounds")
    together = held.unionByName(copies).repartitionById(groups, "g").sortWithinPartitions("g", "kind")
    return ranked(_searched(together, k), k)


def _groups(blocks: int, asked: float, tasks: int) -> int:
    """Groups of ``blocks`` of candidates that meet ``asked`` times a block of queries.

    Of ``GROUP`` blocks each, or larger ones as long as there are ``tasks`` groups and their copies of the queries are no
    less than the candidates.
    """
    enough = max(tasks, int(blocks / asked) if asked else 0)
    return max(1, -(-blocks // MOST), min(-(-blocks // GROUP), enough))


def _searched(together: DataFrame, k: int) -> DataFrame:
    """What the queries of a group find in its candidates, which come before them (``kind`` 0), at most ``k`` a query."""

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["g"] != at:
                    at, held = row["g"], []
                vectors, ids = unpacked(row["data"], row["n"]), np.frombuffer(row["ids"], np.int64)
                if row["kind"] == 0:
                    held.append((vectors, ids))
                    continue
                bounds = np.frombuffer(row["bounds"], np.float64)
                found = [search_bucket(vectors, ids, bounds, bucket, others, k) for bucket, others in held]
                if found:
                    whole = [np.concatenate(x) for x in zip(*found, strict=True)]
                    best = best_of(*whole, k)
                    yield pa.RecordBatch.from_arrays([pa.array(x[best], pa.int64()) for x in whole], ["query_id", "vec_id", "score"])

    return together.mapInArrow(search, "query_id long, vec_id long, score long")
