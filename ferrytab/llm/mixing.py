"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length. A source's budget is met by whole passes over it,
then by an even share of every length, and what is left by a bounded knapsack over the lengths. Only
then are documents chosen, the first by a seeded hash within each length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrytab.llm.common import landed, packed, unpacked_columns, word_count

#: Weights given to the sources in order, again and again.
WEIGHTS = (1, 2, 3)
#: A document is used at most so often.
MOST_PASSES = 3
#: Words left over that the knapsack fits exactly at first; where that misses the budget it gets more of it, up to all.
KNAPSACK_WORDS = 4_096
#: Bits that the tables of one knapsack may have in memory.
KNAPSACK_BITS = 1 << 31
#: Documents ranked together; longer lists of equal length are cut into parts of about this size.
PART_ROWS = 1_024


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Targets of sources (``source``, ``source_size``): adds ``target`` as double.

    Sources by code point, null last, get the weights in turn. All sizes are shared by weight, no
    target goes over ``most`` times its source's size, and the excess is reshared by weight: the
    water level that fills every source up to its cap. One row per source meets in one task.
    """
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    cap = F.col("source_size").cast("double") * most
    rows = sizes.withColumn("w", weight).withColumn("cap", cap)
    rising = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = rising.rowsBetween(W.unboundedPreceding, -1), rising.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    # The level before a source is capped rises while sources are capped rightly and falls afterwards.
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return rows.select("source", "source_size", F.least("cap", F.col("w") * F.col("level")).alias("target"))


def fit_counts(counts: list[tuple[int, int]], budget: int, limit: int = KNAPSACK_WORDS) -> dict[int, int]:
    """How many documents of each length to take so that their words come as near to ``budget`` as can be, not above.

    ``counts`` are (length, documents), lengths over 0; the budget is under the sum of all. An even
    share of every length comes first, then from the longest on one more of a length each, then what
    fits, and last an exact bounded knapsack over what is left, up to ``limit`` words. If that misses
    the budget, less is shared out and the knapsack runs on four times as many words, until it meets
    the budget or has run on all of it. Only where its tables would have over ``KNAPSACK_BITS`` bits
    does it end before, with the nearest sum found.
    """
    total = sum(size * n for size, n in counts)
    if budget >= total:
        return dict(counts)
    most = max(limit, KNAPSACK_BITS // max(1, sum(n.bit_length() for _, n in counts)))
    words, shared, best, nearest = limit, budget, {}, -1
    while True:
        taken = _fitted(counts, total, budget, shared, words)
        reached = sum(size * k for size, k in taken.items())
        if reached > nearest:
            best, nearest = taken, reached
        if nearest == budget or words >= min(budget, most):
            return best
        words = min(4 * words, budget, most)
        shared = budget - words


def _fitted(counts: list[tuple[int, int]], total: int, budget: int, shared: int, limit: int) -> dict[int, int]:
    """Even shares of ``shared`` words, then from the longest on, then a knapsack over the last ``limit`` words."""
    taken = {size: shared * n // total for size, n in counts}
    left = budget - sum(size * k for size, k in taken.items())
    longest_first = sorted(counts, reverse=True)
    for most in (1, None):
        for size, n in longest_first:
            if left <= limit:
                break
            # Something stays for the knapsack, which fits exactly where a greedy choice may miss.
            more = min(n - taken[size], max(0, left - limit // 2) // size, n if most is None else most)
            taken[size] += more
            left -= more * size
    return _knapsack(taken, [(s, n - taken[s]) for s, n in sorted(counts) if s <= left and n > taken[s]], left, limit)


def _knapsack(taken: dict[int, int], spare: list[tuple[int, int]], left: int, limit: int) -> dict[int, int]:
    """Adds to ``taken`` the documents whose lengths sum to the largest reachable number up to ``left``.

    A bit of an integer stands for a reachable sum; copies are added in lots of doubling size.
    """
    if left > 4 * limit:  # nothing shorter is left: the nearest sum from below is what has been taken
        spare = spare[-4 * limit :]
    full, reached, lots = (1 << left + 1) - 1, 1, []
    for size, n in spare:
        n, lot = min(n, left // size), 1
        while n > 0 and not reached >> left & 1:
            k = min(lot, n)
            lots.append((size, k, reached))
            reached |= reached << size * k & full
            n, lot = n - k, lot * 2
    at = reached.bit_length() - 1
    for size, k, without in reversed(lots):
        if not without >> at & 1:
            taken[size] += k
            at -= size * k
    return taken


def _plan(budgets: DataFrame) -> DataFrame:
    """Rows (source, size, n, source_size, target) to (source, size, n, passes, extra); a group is one source's lengths."""

    def fit(pdf):
        import pandas as pd

        source_size = int(pdf["source_size"].iloc[0])
        budget = int(round(float(pdf["target"].iloc[0])))
        passes = min(MOST_PASSES, budget // source_size) if source_size else 0
        rest = budget - passes * source_size if passes < MOST_PASSES else 0
        counts = [(int(s), int(n)) for s, n in zip(pdf["size"], pdf["n"]) if s > 0]
        extra = fit_counts(counts, rest) if rest > 0 else {}
        return pd.DataFrame(
            {
                "source": pdf["source"],
                "size": pdf["size"],
                "n": pdf["n"],
                "source_size": pdf["source_size"],
                "target": pdf["target"],
                "passes": passes,
                "extra": [extra.get(int(s), 0) for s in pdf["size"]],
            }
        )

    schema = "source string, size long, n long, source_size long, target double, passes long, extra long"
    return budgets.groupBy("source").applyInPandas(fit, schema)


def mix(docs: DataFrame, keep: list[str], seed: int = 7) -> DataFrame:
    """``keep`` columns of every document with ``size``, ``source_size``, ``target`` and ``times``.

    ``times`` says how often the mix uses the document; ``size * times`` is what it takes of it. The
    text and source of ``docs`` are read; a null text has no words and is never used beyond the whole
    passes of its source. Documents are ranked by a hash of seed, doc_id and text, so runs agree;
    rows that repeat in full are interchangeable. The lengths of a source, not its documents, meet in
    one task, and a length with very many documents is cut into parts that are ranked one by one.
    """
    spare = [c for c in ("_size", "_hash", "_part") if c in docs.columns]
    if spare:
        raise ValueError(f"columns {spare} are taken")
    chance = F.xxhash64(F.lit(seed), "doc_id", "text")
    rows = docs.select(*keep, F.col("source").alias("_source"), F.col("doc_id").alias("_id"),
                       word_count(F.col("text")).alias("_size"), chance.alias("_hash"))
    slim = landed(
        docs.select(
            F.col("source").alias("_source"), word_count(F.col("text")).alias("_size"), chance.alias("_hash")
        ),
        "mix-sizes",
    )
    lengths = slim.groupBy("_source", "_size").agg(F.count("*").alias("n"))
    lengths = lengths.select(F.col("_source").alias("source"), F.col("_size").alias("size"), "n")
    totals = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(totals)
    same_source = F.col("l.source").eqNullSafe(F.col("t.source"))
    budgets = lengths.alias("l").join(targets.alias("t"), same_source).select("l.*", "t.source_size", "t.target")
    plan = landed(_plan(budgets), "mix-plan")
    # Parts of one length: documents by hash modulo the number of parts, then what each part gives.
    of_plan = _same(F.col("d._source"), F.col("p.source")) & (F.col("d._size") == F.col("p.size"))
    part = F.pmod(F.col("_hash"), _parts(F.col("n"))).cast("long")
    parts = (
        slim.alias("d").join(plan.alias("p"), of_plan).withColumn("part", part)
        .groupBy("p.source", "p.size", "part", "p.source_size", "p.target", "p.passes", "p.extra", "p.n")
        .agg(F.count("*").alias("here"))
    )
    upto = W.partitionBy("source", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("here").over(upto), F.lit(0))
    quota = F.greatest(F.lit(0), F.least("here", F.col("extra") - before))
    parts = landed(parts.withColumn("quota", quota), "mix-parts")
    counted = lengths.withColumn("_n", F.col("n")).drop("n")
    with_n = rows.alias("d").join(
        counted.alias("c"), _same(F.col("d._source"), F.col("c.source")) & (F.col("d._size") == F.col("c.size"))
    ).select("d.*", F.pmod(F.col("_hash"), _parts(F.col("_n"))).cast("long").alias("_part"))
    of_part = (
        _same(F.col("d._source"), F.col("q.source")) & (F.col("d._size") == F.col("q.size"))
        & (F.col("d._part") == F.col("q.part"))
    )
    order = W.partitionBy("d._source", "d._size", "d._part").orderBy("d._hash", "d._id")
    rank = F.row_number().over(order)
    return with_n.alias("d").join(parts.alias("q"), of_part).select(
        *[F.col(f"d.{c}") for c in keep], F.col("d._size").alias("size"), "q.source_size", "q.target",
        (F.col("q.passes") + (rank <= F.col("q.quota")).cast("long")).alias("times"),
    )


def _parts(n: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / PART_ROWS)).cast("long")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def repeat_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: every document as often as it is used, with the columns of ``docs``."""
    names = ["doc_id", "text", "source"]
    slim = packed(docs, names)
    used = mix(slim, slim.columns, seed).where("times > 0")
    repeated = used.withColumn("_use", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return repeated.select(*unpacked_columns(docs, names))
