"""Connected components of a graph given by its edges, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import landed


def components(edges: DataFrame) -> DataFrame:
    """Connected components as (``node``, ``root``), root the smallest node; nodes without edges are left out.

    Alternates two star operations until nothing changes: every node hands its smallest neighbour to
    the larger ones, then to the smaller ones. Rounds grow with the logarithm of the longest chain.
    The minimum per node is a partial aggregate, so a node with a third of all edges costs one row per
    task; the join that follows may split such a node. Each round is written to the shared folder.
    """
    u, v = F.col("u"), F.col("v")
    now = landed(_ordered(edges.select(F.col("node").alias("u"), F.col("alias").alias("v"))), "alias-edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = landed(_ordered(both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v"))), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(v.alias("u"), F.col("m").alias("v"))
        now = landed(_ordered(small.unionByName(least.select("u", F.col("m").alias("v")))), "small")
        last, mark = mark, _mark(now)
        if last == mark:
            break
    return now.select(u.alias("node"), v.alias("root")).unionByName(
        now.select(v.alias("node"), v.alias("root")).distinct()
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end, without loops."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and two order-free digests of them."""
    row = edges.agg(
        F.count("*"),
        F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)"),
        F.expr("coalesce(sum(cast(xxhash64(v, u) as decimal(38, 0))), 0)"),
    ).first()
    return tuple(row)
