"""N-gram Jaccard join in a metric space with pivots.

Jaccard distance is a metric, but two unrelated texts are at distance 1, so a few far pivots tell
nothing apart. Pivots are therefore drawn where texts are close: a document's shingles fall into so
many buckets that linked documents agree on the whole content of at least one. All documents with one
bucket content have a pivot among them, and a document is copied to the region of every pivot that
leads one of its buckets: two linked documents meet in at least one region. In a region distances to
the pivot are computed; documents within reach of it are one component; the others become pivots in
turn and are compared, by the triangle inequality, only with those whose distance to the first pivot
differs by no more than the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrytab.llm.common import WORD, forget, grams, landed, mixed, packed, unpacked_columns, word_hashes
from ferrytab.llm.graph import components

#: Words of a shingle; documents link if ``PERCENT`` of the union of their sets is common.
SHINGLE, PERCENT = 4, 85
#: Ratio of the sizes at which the number of buckets changes.
STEP = 1.6
#: Buckets beyond those needed, as a share of them: the more, the more chance matches of contents can be left out.
EXTRA = 0.25
#: Bits of the filter that tells bucket contents which may repeat. Its size is fixed; when full it lets more pass, no less.
FILTER_BITS = 1 << 28
#: Members and shingles of a region that one task joins; larger regions are cut into cells.
REGION_ROWS, REGION_SHINGLES = 4_000, 2_000_000


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the distinct hashes of ``size`` consecutive words, A-Z lower-cased, in order; of fewer words one for all of them.

    The sets stand in one array, one after the other; the second array has their sizes.
    """
    words, counts = word_hashes(texts)
    if not len(words):
        return words, counts
    ends = np.cumsum(counts)
    # A gram of the whole row of words is a text's own if it ends before the text does; short texts have theirs put in its place.
    every = np.zeros(len(words), np.uint64)
    every[: max(0, len(words) - size + 1)] = grams(words, size)
    own = np.maximum(counts - size + 1, np.minimum(counts, 1))
    for n in range(1, size):
        at = (ends - counts)[counts == n]
        if len(at):
            every[at] = grams(words, n)[at]
    found = every[np.repeat(ends - counts, own) + _ordinals(own)]
    ends = np.cumsum(own)
    for start, end in zip((ends - own).tolist(), ends.tolist()):
        found[start:end].sort()
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    new[(ends - own)[own > 0]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    return found[new], before[ends] - before[ends - own]


def _ordinals(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... ``n - 1`` for each ``n`` of ``counts``."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _parts(flat: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []


def _lots(texts) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """First and last place, and values, of up to 1,000 texts or about 2 MB of an Arrow column."""
    sizes = np.cumsum([0, *(n or 0 for n in pc.binary_length(texts).to_pylist())])
    at = 0
    while at < len(texts):
        last = min(at + 1000, max(at + 1, int(np.searchsorted(sizes, sizes[at] + (2 << 20)))), len(texts))
        yield at, last, texts.slice(at, last - at).to_pylist()
        at = last


def set_hash(shingle_set: np.ndarray) -> int:
    from hashlib import blake2b

    return int.from_bytes(blake2b(shingle_set.tobytes(), digest_size=8).digest(), "little", signed=True)


def equal_only(percent: int) -> int:
    """Sets up to this size link only with their like: one shingle more or less is too much."""
    return -(-100 // (100 - percent)) - 2


def _bounds(percent: int) -> list[int]:
    """Sizes at which classes end."""
    ends, end = [], equal_only(percent) + 1.0
    while end < 1e12:
        end *= max(STEP, 110 / percent)
        ends.append(int(end))
    return ends


def bucket_contents(shingle_set: np.ndarray, ends: list[int], percent: int) -> tuple[np.ndarray, int]:
    """What :func:`contents_of` gives for one set."""
    contents, _, spare = contents_of(shingle_set, np.array([len(shingle_set)]), ends, percent)
    return contents, int(spare[0])


def contents_of(flat: np.ndarray, sizes: np.ndarray, ends: list[int], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the contents of each set's buckets, in its size class and, if partners may be in it, in the next.

    The sets stand in ``flat`` one after the other, and so do the contents; the other arrays tell how many are each set's.

    Two linked sets of sizes below ``end`` differ in at most ``most`` shingles, so of more than
    ``most`` buckets they share the content of one. There are ``EXTRA`` more, so that shared ones are not
    empty unless a set has very many empty buckets; then its empty ones count too.

    The last array says how many of its contents a set may leave out: a linked set shares more than twice
    as many with it, so when both leave out theirs a shared one is left.
    """
    sizes = np.asarray(sizes, np.int64)
    limits = np.array(ends, np.int64)
    most_in = (100 - percent) * 2 * (limits - 1) // (100 + percent)
    count_in = most_in + 1 + 4 + (most_in * EXTRA).astype(np.int64)
    some = np.flatnonzero(sizes > equal_only(percent))
    own = np.searchsorted(limits, sizes[some], side="right")
    both = sizes[some] * 100 // percent >= limits[own]
    # One row per set and class, those of a set next to each other.
    which = np.repeat(some, 1 + both)
    k = np.repeat(own, 1 + both) + _ordinals(1 + both)
    n, count, most = sizes[which], count_in[k], most_in[k]
    firsts = np.cumsum(count) - count
    members = np.repeat((np.cumsum(sizes) - sizes)[which], n) + _ordinals(n)
    names = flat[members]
    spread = mixed(names ^ np.uint64(0x5851F42D4C957F2D)) % np.repeat(count.astype(np.uint64), n)
    bucket = np.repeat(firsts, n) + spread.astype(np.int64)
    content, full = np.zeros(count.sum(), np.uint64), np.zeros(count.sum(), bool)
    np.add.at(content, bucket, mixed(names + np.uint64(0x14057B7EF767814F)))
    full[bucket] = True
    filled = np.add.reduceat(full, firsts, dtype=np.int64) if len(firsts) else count
    common = np.maximum(filled - most, 1)
    full |= np.repeat(filled <= most, count)
    at = np.flatnonzero(full)
    place = _ordinals(count)[at].astype(np.uint64) * np.uint64(64) + np.repeat(k, count)[at].astype(np.uint64)
    counts, spare = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    np.add.at(counts, which, np.where(filled <= most, count, filled))
    if len(some):
        spare[some] = (np.minimum.reduceat(common, np.cumsum(1 + both) - (1 + both)) - 1) // 2
    return mixed(content[at] + mixed(place)), counts, spare


def _repeating(docs: DataFrame, percent: int, size: int) -> np.ndarray:
    """The filter of bucket contents that occur in more than one document, as 64-bit words.

    Counted over all documents within tasks and by partial aggregates; the driver gets the filter only.
    """
    ends = _bounds(percent)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        forget()
        for batch in batches:
            for _, _, texts in _lots(batch.column(0)):
                flat, sizes = shingle_sets(texts, size)
                alone = {set_hash(found): found for found in _parts(flat, sizes)}  # copies count once
                sizes = np.fromiter(map(len, alone.values()), np.int64, len(alone))
                found, _, _ = contents_of(np.concatenate([*alone.values()]), sizes, ends, percent)
                contents, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(contents.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], ["content", "n"]
                )

    slim = docs.select(F.col("text").cast("binary"))
    counted = slim.mapInArrow(count, "content long, n byte").groupBy("content").agg(F.sum("n").alias("n"))
    bit = F.col("content").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = counted.where("n > 1").select(
        F.shiftright(bit, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(content & 63 as int))").alias("bit")
    )
    bits = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return table


def _sets(docs: DataFrame, shared, percent: int, size: int) -> DataFrame:
    """Per document (``doc_id``, ``tag``, ``node``, ``n``, ``contents``, ``spare``, ``words``): hash and size of its set, and what may meet others.

    ``words`` is the text of documents with such contents, once per set and lot.
    """
    ends = _bounds(percent)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        forget()
        for batch in batches:
            ids, tags = batch.column(1), batch.column(2)
            for at, last, texts in _lots(batch.column(0)):
                flat, sizes = shingle_sets(texts, size)
                own, counts, spare = contents_of(flat, sizes, ends, percent)
                bit = own & np.uint64(FILTER_BITS - 1)
                word = shared.value[(bit >> np.uint64(6)).astype(np.int64)]
                may = (word >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
                seen: set[int] = set()
                nodes, contents, kept = [], [], []
                for i, (found, part, left) in enumerate(zip(_parts(flat, sizes), _parts(own, counts), _parts(may, counts))):
                    key = set_hash(found)
                    part = part[left] if key not in seen else part[:0]
                    seen.add(key)
                    nodes.append(key if len(found) else None)
                    contents.append(part.view(np.int64))
                    kept.append(texts[i] if len(part) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, last - at), tags.slice(at, last - at), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(contents, pa.list_(pa.int64())), pa.array(spare, pa.int32()), pa.array(kept, pa.binary())],
                    ["doc_id", "tag", "node", "n", "contents", "spare", "words"],
                )

    slim = docs.select(F.col("text").cast("binary"), F.col("doc_id").cast("long"), F.xxhash64("text").alias("tag"))
    return slim.mapInArrow(scan, "doc_id long, tag long, node long, n long, contents array<long>, spare int, words binary")


class Members:
    """Sets of a region's members in dense numbers, with exact distances of one to all."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        names, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(names), bool)

    def common(self, pivot: int) -> np.ndarray:
        """Shingles that every member has in common with the pivot."""
        own = self.flat[self.starts[pivot] : self.starts[pivot] + self.sizes[pivot]]
        self.mark[own] = True
        counts = np.add.reduceat(self.mark[self.flat], self.starts, dtype=np.int64)
        self.mark[own] = False
        return counts


def region_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect the members (their places) as all their links do; the first member is the pivot.

    After the pivot has been compared with all, members outside the largest component are pivots in
    turn: every pair of two components has one of them. By the triangle inequality a pivot meets only
    members whose distance to the first one differs from its own by no more than the threshold.
    """
    members, n = Members(sets), len(sets)
    sizes, reach = members.sizes, (100 - percent) / 100
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links: list[tuple[int, int]] = []
    first = None
    done = np.zeros(n, bool)
    label = np.arange(n)
    while True:
        if first is None:
            pivot = 0
        else:
            label = np.array([root(i) for i in range(n)]) if changed else label
            counts = np.bincount(label, minlength=n)
            outside = np.flatnonzero(~done & (label != counts.argmax()))
            if not len(outside):
                return links
            pivot = int(outside[0])
        other = ~done & (label != label[pivot])
        other[pivot] = False
        if first is not None:
            other &= np.abs(first - first[pivot]) <= reach + 1e-9
            other &= (sizes * 100 >= sizes[pivot] * percent) & (sizes[pivot] * 100 >= sizes * percent)
        done[pivot], changed = True, False
        if first is not None and not other.any():
            continue
        common = members.common(pivot)
        union = sizes + sizes[pivot] - common
        if first is None:
            first = 1 - common / union
        linked = np.flatnonzero(other & (common * 100 >= union * percent))
        for i in linked.tolist():
            if root(i) != root(pivot):
                links.append((pivot, i))
                parent[root(i)] = root(pivot)
                changed = True


def _region_rows(sets: DataFrame) -> DataFrame:
    """(``pivot``, ``node``): which regions a node is copied to.

    The pivot of a bucket content is the node most of whose contents may repeat, the smallest of
    equals. Contents in a third of all documents cost one row per task here; the join may split them.
    A node leaves out the pivots that lead fewest of its contents, as many contents as it may.
    """
    # Copies of one set have the same contents.
    each = sets.where("size(contents) > 0").groupBy("node").agg(F.first("contents").alias("contents"), F.first("spare").alias("spare"))
    uses = each.select("node", "spare", F.size("contents").alias("w"), F.explode("contents").alias("content"))
    lead = (
        uses.groupBy("content")
        .agg(F.min(F.struct(-F.col("w"), "node")).alias("lead"), F.min("node").alias("a"), F.max("node").alias("b"))
        .where("a <> b")
        .select("content", F.col("lead.node").alias("pivot"))
    )
    shared = uses.join(lead, "content").groupBy("pivot", "node").agg(F.count("*").alias("shared"), F.first("spare").alias("spare"))
    fewest = Window.partitionBy("node").orderBy("shared", "pivot").rowsBetween(Window.unboundedPreceding, 0)
    return shared.withColumn("upto", F.sum("shared").over(fewest)).where("upto > spare").select("pivot", "node")


def _cells(regions: DataFrame, nodes: DataFrame) -> DataFrame:
    """Regions cut into cells that one task can join: (``pivot``, ``a``, ``b``, ``node``, ``chunk``).

    A small region is one cell. A large one is divided into chunks by a hash, and every two chunks
    make a cell, so that any two members still meet; each cell has members of bounded number and size.
    """
    weighed = regions.join(nodes, "node")
    load = F.greatest(F.count("*") / F.lit(REGION_ROWS), F.sum("n") / F.lit(REGION_SHINGLES))
    chunks = weighed.groupBy("pivot").agg(F.count("*").alias("size"), F.when(load <= 1, 1).otherwise(F.ceil(load * 2)).cast("int").alias("k"))
    chunks = chunks.where("size > 1").drop("size")
    placed = weighed.join(chunks, "pivot").withColumn("chunk", F.pmod(F.xxhash64("node", "pivot"), F.col("k")).cast("int"))
    pairs = F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("k") - 1))
    out = placed.select("pivot", "node", "chunk", F.explode(pairs).alias("j"))
    return out.select("pivot", F.least("chunk", "j").alias("a"), F.greatest("chunk", "j").alias("b"), "node", "chunk")


def _joined(cells: DataFrame, percent: int, size: int) -> DataFrame:
    """Links (``node``, ``alias``) of rows (pivot, a, b, node, words) that stand together by cell."""

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        forget()
        def links(pivot, nodes, sets):
            if len(nodes) < 2:
                return None
            order = sorted(range(len(nodes)), key=lambda i: (nodes[i] != pivot, nodes[i]))
            found = region_links([sets[i] for i in order], percent)
            if not found:
                return None
            named = [[nodes[order[i]] for i in side] for side in zip(*found)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in named], ["node", "alias"])

        now, nodes, sets = None, [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for at, last, texts in _lots(batch.column(4)):
                found = _parts(*shingle_sets(texts, size))
                for (pivot, a, b, node), one in zip(zip(*(c[at:last] for c in columns)), found):
                    if (pivot, a, b) != now:
                        if now and (out := links(now[0], nodes, sets)):
                            yield out
                        now, nodes, sets = (pivot, a, b), [], []
                    nodes.append(node)
                    sets.append(one)
        if now and (out := links(now[0], nodes, sets)):
            yield out

    keys = ["pivot", "a", "b"]
    together = cells.select(*keys, "node", "words").repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(join, "node long, alias long")


def _alone(doc_id: Column, tag: Column) -> Column:
    return F.xxhash64(doc_id, tag, F.lit("no words"))


def placed_documents(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """(``doc_id``, ``tag``, ``n``, ``root``) of every row of ``docs``; ``tag`` is a hash of its text, ``root`` its component."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_repeating(docs, percent, size))
    sets = landed(_sets(docs, shared, percent, size), "jaccard-sets")
    nodes = sets.where("words is not null").groupBy("node").agg(F.max("n").alias("n"))
    regions = landed(_region_rows(sets), "jaccard-regions")
    cells = _cells(regions, nodes)
    # One text per set; copies within a lot have been left out already.
    texts = sets.where("words is not null").select("node", "words").dropDuplicates(["node"])
    links = landed(_joined(cells.join(texts, "node"), percent, size), "jaccard-links")
    roots = components(links)
    # Documents without words have no node; a hash of their own keeps them apart in the join.
    alone = _alone(F.col("doc_id"), F.col("tag"))
    named = sets.select("doc_id", "tag", "n", F.coalesce("node", alone).alias("node"))
    return named.join(roots, "node", "left").select("doc_id", "tag", "n", F.coalesce("root", "node").alias("root"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``) of every row of ``docs``.

    Two documents link if ``percent`` of the union of their sets of distinct ``size``-word shingles is
    common; a component is named by its smallest doc_id. Documents with fewer words are one shingle;
    those without words, or with null text, have none, link with nothing and keep their own id.
    Documents with equal sets are one node from the start, however many there are. Rows that repeat an
    id are nodes of their own texts; null ids name a component only if no other id is in it.
    Sets, shingles and words are named by 64-bit hashes of their content.
    """
    placed = placed_documents(docs, percent, size)
    names = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("name"))
    own = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id"))
    return placed.join(names, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that come first in their component, by doc_id (null last) and a hash of the text.

    Documents without words stay. Of rows that repeat an id and a text one stays, the first by its other
    columns. Of rows with one text only the first can stay, so they are cut to it in every task before
    texts are shuffled: a group of copies sends one row per task.
    """
    whole, docs = docs, packed(docs, ["doc_id", "text"])
    last = F.lit((1 << 63) - 1)
    key, tag = F.coalesce(F.col("doc_id").cast("long"), last), F.xxhash64("text")
    placed = placed_documents(docs, percent, size)
    first = placed.groupBy("root").agg(F.min(F.struct(key.alias("key"), "tag", "n")).alias("first")).select("first.*")
    first = first.select(F.when(F.col("n") > 0, F.col("tag")).otherwise(_alone(F.col("key"), F.col("tag"))).alias("_own"))
    own = F.when(F.col("text").rlike(WORD), tag).otherwise(_alone(key, tag))
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    order = F.struct(key, F.to_json(F.struct(*others)) if others else F.lit(""))
    rows = docs.select(own.alias("_own"), order.alias("_order"), F.struct(*docs.columns).alias("_row"))
    one = rows.groupBy("_own").agg(F.min_by("_row", "_order").alias("_row"))
    kept = one.join(first, "_own", "left_semi").select("_row.*")
    return kept.select(*unpacked_columns(whole, ["doc_id", "text"]))
