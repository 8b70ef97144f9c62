"""What both vector searches share: which vectors take part, blocks of vectors, and merging what blocks found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Vectors of one block of candidates, and queries of one block; a pair of blocks is the unit of work.
BLOCK, QUERY_BLOCK = 1_024, 256


def usable(vectors: DataFrame, key: str, vector: str, transform=None) -> DataFrame:
    """(``vec_id``, ``v``) with ``v`` as doubles: rows with an id and a vector without null or non-finite components.

    ``transform`` is applied to every component. Rows repeated in full count once. Vectors shorter
    than others are filled up with zeros where they meet.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    change = transform or (lambda x: x)
    v = F.transform(vector, lambda x: change(x.cast("double")).cast("double"))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(finite)
    return rows.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).distinct()


def length(v: str = "v") -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def matrix(vectors: list[list[float]], dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def unpacked(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(rows, -1) if rows else np.zeros((0, 0))


def fitted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns as the wider one."""
    dim = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == dim else np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in (a, b))


def blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
    """Rows (vec_id, v), in the order in which they stand in their partitions, as blocks of ``size`` vectors.

    A block is (``name``, ``ids``, ``data``, ``n``): its number, and its ids and components as bytes.
    """

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        made, ids, vectors = TaskContext.get().partitionId() << 32, [], []

        def block():
            data = matrix(vectors, max(map(len, vectors)))
            columns = {name: [made], "ids": [np.array(ids, np.int64).tobytes()], "data": [data.tobytes()], "n": [len(ids)]}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            new, at = batch.column(0).to_pylist(), batch.column(1)
            for i, key in enumerate(new):
                ids.append(key)
                vectors.append(at[i].as_py())
                if len(ids) == size:
                    yield block()
                    made, ids, vectors = made + 1, [], []
        if ids:
            yield block()

    return rows.select("vec_id", "v").mapInArrow(pack, f"{name} long, ids binary, data binary, n long")


def best_of(query_ids, ids, scores, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of every query, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query_ids))
    ranked = query_ids[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, int)
    rank = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.append(starts, len(ranked))))
    return order[rank < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of what the blocks found: (``query_id``, ``rank``, ``vec_id``, ``score``)."""
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")
