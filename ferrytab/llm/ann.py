"""Approximate nearest neighbours by low-dimensional stable projections, a kd-tree and a chi-square stopping test.

The nearest vectors by inner product are the nearest ones by distance once every vector is given one
more component that brings all to the same length. Vectors are projected to a few dimensions with a
Gaussian matrix; there a projected distance is the true one times the root of a chi-square variable.
A query takes neighbours in the order of projected distance and verifies them until the test says
that a nearer one is unlikely to be left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import landed
from ferrytab.llm.vectors import QUERY_BLOCK, best_of, fitted, length, matrix, ranked, unpacked, usable

#: Projected dimensions (an even number) and the probability at which the search stops: the share of
#: true neighbours that it finds at least, on average.
DIMENSIONS, CONFIDENCE = 8, 0.97
#: Points of a sample on which the upper tree is built, and about how many rows a cell of it gets.
SAMPLE, CELL_ROWS = 16_384, 4_096
#: Points of a block, and of a leaf of the tree inside a block.
BLOCK, LEAF = 1_024, 64
#: Query blocks of a cell whose best a task holds while it goes through the cell's candidate blocks.
HELD = 256


def chi_square_limit(confidence: float, m: int = DIMENSIONS) -> float:
    """The value that a chi-square variable with ``m`` (even) degrees stays under with probability ``confidence``."""
    low, high = 0.0, 1e4
    for _ in range(200):
        x = (low + high) / 2
        term = total = 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        low, high = (x, high) if 1 - np.exp(-x / 2) * total < confidence else (low, x)
    return low


def projection(dim: int, seed: int, m: int = DIMENSIONS) -> np.ndarray:
    """Gaussian matrix for vectors of ``dim`` components and the added one, the same in every task."""
    return np.random.default_rng(seed).standard_normal((dim + 1, m))


def _projected(vectors: np.ndarray, lift: np.ndarray, matrix_: np.ndarray) -> np.ndarray:
    return vectors @ matrix_[: vectors.shape[1]] + lift[:, None] * matrix_[-1]


def build_tree(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Splits (dimension, value) of a kd-tree of ``depth`` levels in heap order: medians along the widest dimension."""
    splits: list[tuple[int, float]] = []
    parts = [points]
    for _ in range(depth):
        below = []
        for part in parts:
            axis = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            splits.append((axis, value))
            left = part[:, axis] < value if len(part) else np.zeros(0, bool)
            below += [part[left], part[~left]]
        parts = below
    return splits


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    """The leaf of the tree that each point falls in."""
    at = np.zeros(len(points), np.int64)
    axes = np.array([s[0] for s in splits] or [0])
    values = np.array([s[1] for s in splits] or [0.0])
    while len(splits) and at.max(initial=len(splits)) < len(splits):
        at = 2 * at + 1 + (points[np.arange(len(points)), axes[at]] >= values[at])
    return at - len(splits)


def cell_boxes(splits: list[tuple[int, float]], m: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest corner of every leaf; open sides are infinite."""
    low, high = [np.full(m, -np.inf)], [np.full(m, np.inf)]
    for at, (axis, value) in enumerate(splits):
        a, b = low[at], high[at]
        middle_high, middle_low = b.copy(), a.copy()
        middle_high[axis] = min(b[axis], value)
        middle_low[axis] = max(a[axis], value)
        low += [a, middle_low]
        high += [middle_high, b]
    return np.array(low[len(splits) :]), np.array(high[len(splits) :])


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    gap = np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0.0)
    return (gap * gap).sum(axis=2)


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Places of the points by leaf of a kd-tree over them."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) <= size:
            done.append(part)
            continue
        axis = int(np.argmax(np.ptp(points[part], axis=0)))
        half = len(part) // 2
        order = part[np.argsort(points[part, axis], kind="stable")]
        todo += [order[:half], order[half:]]
    return done


def search_block(queries, query_ids, projected, best, bucket, ids, bucket_projected, most: float, limit: float, k: int):
    """Verified neighbours (query ids, ids, scores) of one block.

    ``best`` are the ``k`` highest scores each query has so far, lowest first; ``most`` is the squared
    length that all vectors are brought to, ``limit`` the chi-square value of the stopping test. Leaves
    are taken by falling nearness; a query stops at the first leaf whose projected distance fails the
    test against the distance of its k-th neighbour, which verified products bring down.
    """
    queries, bucket = fitted(queries, bucket)
    squares = (queries * queries).sum(axis=1)
    best = best.copy()
    parts = leaves(bucket_projected)
    low = np.array([bucket_projected[p].min(axis=0) for p in parts])
    high = np.array([bucket_projected[p].max(axis=0) for p in parts])
    gaps = box_distance(projected, low, high)
    out = []
    for leaf in np.argsort(gaps.min(axis=0)):
        reach = np.maximum(squares + most - 2 * best[:, 0], 0.0)
        active = np.flatnonzero(gaps[:, leaf] <= limit * reach + 1e-9)
        if not len(active):
            continue
        rows = parts[leaf]
        scores = queries[active] @ bucket[rows].T
        scores[query_ids[active][:, None] == ids[rows][None, :]] = -np.inf
        slack = 1e-9 * (1 + np.abs(best[active, 0]))
        at = np.nonzero((scores >= np.where(np.isfinite(slack), best[active, 0] - slack, -np.inf)[:, None]) & np.isfinite(scores))
        if len(at[0]):
            out.append((active[at[0]], rows[at[1]]))
        both = np.concatenate([best[active], scores], axis=1)
        best[active] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    which, rows = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
    # Summed row by row, so that equal vectors get equal scores wherever they stand.
    scores = (queries[which] * bucket[rows]).sum(axis=1)
    chosen = best_of(query_ids[which], ids[rows], scores, k)
    return query_ids[which][chosen], ids[rows][chosen], scores[chosen]


def nearest(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
            confidence: float = CONFIDENCE, seed: int = 20) -> DataFrame:
    """About the ``k`` nearest by inner product of each query: (``query_id``, ``rank``, ``vec_id``, ``score``).

    Queries are the rows for which ``is_query`` (over ``vec_id``) holds, candidates all rows with
    another id; fewer than ``k`` give all. A true neighbour is found with probability ``confidence``
    or more, and scores are exact products of the vectors as doubles. Rows without an id, and vectors
    that are null, zero, or hold a null or non-finite component take no part. Ties go to the smaller id.

    The upper tree is built on the ``SAMPLE`` rows that come first by a hash; every row is indexed. A
    cell's rows are packed in blocks of bounded size, so a vector that fills a third of the table makes
    many blocks, not a large one. A query first searches its own cell; the k-th distance found there
    tells which other cells pass the test, and it is sent only to those.
    """
    rows = landed(usable(vectors, key, vector).where(length() > 0), "ann-vectors")
    facts = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.max(F.size("v"))).first()
    total, most, dim = facts[0], float(facts[1] or 0.0), int(facts[2] or 1)
    turn = projection(dim, seed)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    points = matrix([r["v"] for r in sample], dim)
    lift = np.sqrt(np.maximum(most - (points * points).sum(axis=1), 0.0))
    depth = min(max(0, int(np.ceil(np.log2(max(1, total / CELL_ROWS))))), int(np.log2(max(2, len(sample)))) - 1)
    splits = build_tree(_projected(points, lift, turn), max(0, depth))
    low, high = cell_boxes(splits)
    limit = chi_square_limit(confidence)
    cells = len(low)

    candidates = _celled(rows, turn, most, splits, True)
    spread = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(8))
    packed = candidates.repartition("cell", spread).sortWithinPartitions("cell", F.xxhash64("vec_id"))
    index = landed(_packed(packed, BLOCK, turn, most, True), "ann-index")
    asked = _celled(rows.where(is_query), turn, most, splits, False)
    asked = asked.repartition("cell", spread).sortWithinPartitions("cell", F.xxhash64("vec_id"))
    queries = landed(_packed(asked, QUERY_BLOCK, turn, most, False), "ann-queries")

    columns = [F.col(c).alias(f"c_{c}") for c in ("ids", "data", "n", "projected")]
    home = queries.join(index.select("cell", *columns), "cell")
    first = landed(ranked(_verified(home, most, limit, k), k), "ann-home")
    best = first.groupBy("query_id").agg(F.sort_array(F.collect_list("score")).alias("best"))

    # Beside each query its scores so far; then queries go on to the cells that pass the test.
    alone = _unpacked(queries).join(best, F.col("vec_id") == F.col("query_id"), "left")
    alone = alone.select("cell", "vec_id", "v", F.coalesce("best", F.array().cast("array<double>")).alias("best"))
    again = landed(_onward(alone.repartition("cell", spread), low, high, turn, most, limit, k), "ann-onward")
    visits = again.withColumn("cell", F.explode("cells")).drop("cells")
    other = landed(_verified(visits.join(index.select("cell", *columns), "cell"), most, limit, k), "ann-others")
    del cells
    return ranked(first.select("query_id", "vec_id", "score").unionByName(other), k)


def _celled(rows: DataFrame, turn: np.ndarray, most: float, splits, lifted: bool) -> DataFrame:
    def cells(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            points = matrix(batch.column(1).to_pylist(), len(turn) - 1)
            lift = np.sqrt(np.maximum(most - (points * points).sum(axis=1), 0.0)) if lifted else np.zeros(len(points))
            found = cell_of(_projected(points, lift, turn), splits)
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column(0), batch.column(1)], ["cell", "vec_id", "v"])

    return rows.select("vec_id", "v").mapInArrow(cells, "cell long, vec_id long, v array<double>")


def _packed(rows: DataFrame, size: int, turn: np.ndarray, most: float, lifted: bool) -> DataFrame:
    """Blocks of rows (cell, vec_id, v) that stand together by cell, with projections."""

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def block(cell, ids, vectors):
            points = matrix(vectors, len(turn) - 1)
            lift = np.sqrt(np.maximum(most - (points * points).sum(axis=1), 0.0)) if lifted else np.zeros(len(points))
            data = {"ids": [np.array(ids, np.int64).tobytes()], "data": [points.tobytes()], "n": [len(ids)]}
            return pa.RecordBatch.from_pydict({"cell": [cell], **data, "projected": [_projected(points, lift, turn).tobytes()]})

        now, ids, vectors = None, [], []
        for batch in batches:
            for cell, key, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ids and (cell != now or len(ids) == size):
                    yield block(now, ids, vectors)
                    ids, vectors = [], []
                now = cell
                ids.append(key)
                vectors.append(v)
        if ids:
            yield block(now, ids, vectors)

    return rows.select("cell", "vec_id", "v").mapInArrow(pack, "cell long, ids binary, data binary, n long, projected binary")


def _unpacked(blocks: DataFrame) -> DataFrame:
    def unpack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                columns = {"cell": [row["cell"]] * len(ids), "vec_id": ids, "v": unpacked(row["data"], len(ids)).tolist()}
                yield pa.RecordBatch.from_pydict(columns)

    return blocks.select("cell", "ids", "data").mapInArrow(unpack, "cell long, vec_id long, v array<double>")


def _onward(rows: DataFrame, low, high, turn, most: float, limit: float, k: int) -> DataFrame:
    """Blocks of queries that share the cells they still have to search, their own left out."""

    def onward(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            home, ids = np.array(batch.column(0).to_pylist()), np.array(batch.column(1).to_pylist(), np.int64)
            if not len(ids):
                continue
            points = matrix(batch.column(2).to_pylist(), len(turn) - 1)
            found = [[-np.inf] * (k - len(b)) + b for b in batch.column(3).to_pylist()]
            best = np.array(found, float).reshape(len(ids), k)
            flat = _projected(points, np.zeros(len(ids)), turn)
            reach = np.maximum((points * points).sum(axis=1) + most - 2 * best[:, 0], 0.0)
            visit = box_distance(flat, low, high) <= limit * reach[:, None] + 1e-9
            visit[np.arange(len(ids)), home] = False
            order = np.lexsort((ids, home))
            for at in range(0, len(order), QUERY_BLOCK):
                lot = order[at : at + QUERY_BLOCK]
                # Every query of the lot is tested again against each block's own leaves.
                cells = np.flatnonzero(visit[lot].any(axis=0))
                own = home[lot]
                if len(cells):
                    yield pa.RecordBatch.from_pydict({
                        "ids": [ids[lot].tobytes()], "data": [points[lot].tobytes()], "n": [len(lot)],
                        "projected": [flat[lot].tobytes()], "best": [best[lot].tobytes()], "home": [own.tobytes()],
                        "cells": [cells.tolist()],
                    })

    schema = "ids binary, data binary, n long, projected binary, best binary, home binary, cells array<long>"
    return rows.mapInArrow(onward, schema)


def _verified(pairs: DataFrame, most: float, limit: float, k: int) -> DataFrame:
    """What the pairs of a query block and a candidate block give: the ``k`` best of a query once per cell and task.

    Pairs of a cell stand together, so what its blocks find is merged before it leaves the task; beyond ``HELD``
    query blocks of a cell the oldest is let go early.
    """

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[bytes, tuple] = {}
        now = None

        def out(key):
            kinds = (pa.int64(), pa.int64(), pa.float64())
            columns = [pa.array(x, t) for x, t in zip(held.pop(key), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["cell"] != now:
                    yield from [out(key) for key in list(held)]
                    now = row["cell"]
                n, ids = row["n"], np.frombuffer(row["ids"], np.int64)
                queries, flat = unpacked(row["data"], n), unpacked(row["projected"], n)
                best = np.full((n, k), -np.inf)
                if row.get("best") is not None:
                    best = unpacked(row["best"], n)
                    elsewhere = np.frombuffer(row["home"], np.int64) != row["cell"]  # one's own cell has been searched
                    ids, queries, flat, best = ids[elsewhere], queries[elsewhere], flat[elsewhere], best[elsewhere]
                if not len(ids):
                    continue
                found = search_block(
                    queries, ids, flat, best, unpacked(row["c_data"], row["c_n"]), np.frombuffer(row["c_ids"], np.int64),
                    unpacked(row["c_projected"], row["c_n"]), most, limit, k,
                )
                key = row["ids"]
                if key in held:
                    found = tuple(np.concatenate(x) for x in zip(held[key], found))
                    chosen = best_of(*found, k)
                    found = tuple(x[chosen] for x in found)
                elif len(held) >= HELD:
                    yield out(next(iter(held)))
                held[key] = found
        yield from [out(key) for key in list(held)]

    return pairs.mapInArrow(search, "query_id long, vec_id long, score double")
