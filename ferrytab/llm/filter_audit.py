"""How document filters interact: what each one removes, in every order in which they may be applied.

Which filters a document fails is a mask of five bits; every number of the report is a sum over masks. Four
bits follow from the text alone. The fifth says that the same text stands under a smaller id: texts are dealt to
ranges of their prefixes, and a compressed trie per range holds the smallest id at each text's end.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import landed

#: Letters of the filters; filter i is bit ``1 << i`` of a mask.
FILTERS = "ABCDE"
# What the first four filters ask for.
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DUPLICATE = 1 << FILTERS.index("E")

#: Characters of text for one range, of a prefix that bounds a range, and how many texts are sampled per range.
RANGE_CHARS, PREFIX_CHARS, SAMPLED = 1 << 24, 48, 8
#: Ranges at most, so that their bounds (under 30 MB) may go to every task; a range with more text than that
#: allows is several tries, told apart by a hash of the whole text.
MOST_RANGES = 1 << 16
#: Characters of the texts that a scan task remembers to tell copies before it sends them on.
REMEMBERED_CHARS = 1 << 24


def text_mask(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    data = text.encode()
    words = data.split()  # white space of bytes is 0x20 and 0x09 to 0x0D
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, CAPITALS))) > MOST_CAPITALS_PERCENT * len(text)) << 2
        | (len(data.translate(None, SYMBOLS)) < len(data)) << 3
    )


class TextTrie:
    """A compressed trie: edges hold runs of characters, the end of a text holds the smallest id seen with it."""

    __slots__ = ("edges", "least")

    def __init__(self) -> None:
        self.edges: dict[str, tuple[str, TextTrie]] = {}
        self.least: int | None = None

    def insert(self, text: str, key: int) -> TextTrie:
        """The node of the text's end, after its id is lowered to ``key`` if that is smaller."""
        node, at = self, 0
        while at < len(text):
            first = text[at]
            edge = node.edges.get(first)
            if edge is None:
                leaf = TextTrie()
                node.edges[first] = (text[at:], leaf)
                node, at = leaf, len(text)
                break
            run, below = edge
            if text.startswith(run, at):
                node, at = below, at + len(run)
                continue
            same = _common(run, text, at)
            middle = TextTrie()
            middle.edges[run[same]] = (run[same:], below)
            node.edges[first] = (run[:same], middle)
            node, at = middle, at + same
        if node.least is None or key < node.least:
            node.least = key
        return node


def _common(run: str, text: str, at: int) -> int:
    """Characters that ``run`` and ``text`` from ``at`` on begin with in common, by halving."""
    low, high = 0, min(len(run), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(run[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def range_bounds(texts: DataFrame, text: str) -> tuple[list[str], int]:
    """Prefixes that cut the distinct texts into ranges of about equal numbers, and the tries per range.

    The bounds are every so-many-th of a sample of prefixes, so ranges are narrow where many texts begin alike.
    Texts are sampled by a hash of their own, so copies count once.
    """
    chars, rows = texts.agg(F.sum(F.length(text).cast("long")), F.count("*")).first()
    ranges = 1 + (chars or 0) // RANGE_CHARS
    if ranges == 1 or not rows:
        return [], 1
    kept = min(ranges, MOST_RANGES)
    share = min(1.0, kept * SAMPLED / rows)
    prefix = F.substring(text, 1, PREFIX_CHARS)
    hashed = texts.select(prefix.alias("_prefix"), F.xxhash64(text).alias("_hash"))
    sample = hashed.where(F.pmod("_hash", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).distinct()
    held = sorted(row["_prefix"] for row in sample.select("_prefix").collect())
    return sorted({held[len(held) * i // kept] for i in range(1, kept)} if held else set()), -(-ranges // kept)


def failure_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(``doc_id``, ``part``, ``mask``, ``n``): how many rows with that id and part fail exactly the filters of ``mask``.

    Null texts are empty, null parts too. A null id is smaller than none and has none below it, so such a
    row is no duplicate and makes none. Copies within a scan task are told there, and one row of each text goes on
    with its text; the others are small rows. So a text with a third of all rows is one text per task.
    """
    plain = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    bounds, tries = range_bounds(plain, "text")
    slots = (len(bounds) + 1) * tries
    # One object for all tasks: bounds are at most MOST_RANGES prefixes.
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def spot(batches: Iterator) -> Iterator:
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa

        edges, seen, held = shared.value, {}, 0
        for batch in batches:
            out: Counter = Counter()
            first: dict = {}  # the smallest id of each text of the batch
            masks: dict = {}
            ids, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, t in zip(ids, texts):
                if t not in masks:
                    masks[t] = text_mask(t)
                if i is not None and i < first.get(t, 1 << 63):
                    first[t] = i
            for i, p, t in zip(ids, batch.column(1).to_pylist(), texts):
                if i is None:
                    out[(None, p, masks[t], None)] += 1
                elif i > first[t] or i > seen.get(t, i):
                    out[(i, p, masks[t] | DUPLICATE, None)] += 1
                else:
                    out[(i, p, masks[t], t)] += 1
            for t, i in first.items():
                if i < seen.get(t, 1 << 63):
                    if t not in seen:
                        held += len(t) + 64
                    seen[t] = i
            if held > REMEMBERED_CHARS:
                seen, held = {}, 0

            def slot(i, p, t):
                if t is None:  # goes anywhere
                    return crc32(f"{i},{p}".encode()) % slots
                return bisect_right(edges, t[:PREFIX_CHARS]) * tries + crc32(t.encode()) % tries

            keys = list(out)
            slots_of = [slot(i, p, t) for i, p, _, t in keys]
            columns = [pa.array(slots_of, pa.int64()), *map(pa.array, zip(*keys), kinds(pa)), pa.array(out.values(), pa.int64())]
            if keys:
                yield pa.RecordBatch.from_arrays(columns, ["slot", "doc_id", "part", "mask", "text", "n"])

    def kinds(pa):
        return [pa.int64(), pa.string(), pa.int32(), pa.string()]

    def mark(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tries_, waiting = {}, []
        names = ["doc_id", "part", "mask", "n"]
        for batch in batches:
            rows = batch.to_pydict()
            done = []
            for row in zip(*(rows[c] for c in ("slot", "doc_id", "part", "mask", "text", "n"))):
                where, i, p, m, t, n = row
                if t is None:
                    done.append((i, p, m, n))
                else:
                    waiting.append((tries_.setdefault(where, TextTrie()).insert(t, i), i, p, m, n))
            if done:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done), kinds4(pa))), names)
        for at in range(0, len(waiting), 10_000):
            done = [(i, p, m | DUPLICATE if end.least < i else m, n) for end, i, p, m, n in waiting[at : at + 10_000]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done), kinds4(pa))), names)

    def kinds4(pa):
        return [pa.int64(), pa.string(), pa.int32(), pa.int64()]

    spotted = plain.mapInArrow(spot, "slot long, doc_id long, part string, mask int, text string, n long")
    marked = spotted.repartition(slots, "slot").mapInArrow(mark, "doc_id long, part string, mask int, n long")
    rows = landed(marked, "masks")
    shared.destroy()
    return rows


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(``part``, ``mask``, ``n``, ``good``, ``toxic``): documents per part and mask, and those labelled so.

    A document with several labels is good, or toxic, if any of them says so. Rows without an id have none.
    """
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.where("good = 1 or toxic = 1")
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    told = rows.where("doc_id is not null").join(marks, "doc_id", "left").unionByName(
        rows.where("doc_id is null"), allowMissingColumns=True
    )
    return told.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")],
    )


def interaction_report(counts: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A part has at most 32 masks, so they are one short array and each of its 600 rows sums over it.
    """
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("_m"))
    steps = [
        (
            "".join(FILTERS[i] for i in order),
            step + 1,
            sum(1 << i for i in order[:step]),
            1 << order[step],
        )
        for order in permutations(range(len(FILTERS)))
        for step in range(len(FILTERS))
    ]
    table = F.array(
        *[
            F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("_before"), F.lit(f).alias("_bit"))
            for o, s, b, f in steps
        ]
    )
    rows = parts.select("part", "_m", F.explode(table).alias("_s")).select("part", "_m", "_s.*")

    def total(what, which):
        return F.aggregate(F.filter("_m", which), F.lit(0).cast("long"), lambda s, x: s + what(x))

    def n(x):
        return x["n"]

    before, bit = F.col("_before"), F.col("_bit")

    def hit(x, bits):
        return x["mask"].bitwiseAND(bits) != 0

    def removed(x):
        return hit(x, bit) & ~hit(x, before)

    def share(x):  # of all orders, those in which this filter comes first of the ones that the document fails
        return x["n"] * (F.lit(len(steps) // len(FILTERS)) / F.bit_count(x["mask"])).cast("long")

    return rows.select(
        "part",
        "filter_order",
        "step",
        total(n, lambda x: ~hit(x, before.bitwiseOR(bit))).alias("kept"),
        total(n, removed).alias("removed"),
        total(n, lambda x: hit(x, bit) & hit(x, before)).alias("redundant"),
        total(n, lambda x: x["mask"] == bit).alias("unique_fails"),
        total(lambda x: x["good"], removed).alias("good_lost"),
        total(lambda x: x["toxic"], removed).alias("toxic_lost"),
        total(share, lambda x: hit(x, bit)).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of all rows of ``docs`` (doc_id, text, source) under ``labels`` (doc_id, quality, toxic).

    No documents, no parts: then it is empty.
    """
    return interaction_report(mask_counts(failure_masks(docs), labels))
