"""Substring dedup by seed and extend.

Seeds are winnowed anchors: the smallest hash of ``SEED`` words among those that a window of words
holds. Equal windows choose equal seeds, so documents that share a passage meet on its seeds. Seeds
that occur once are left out; every other one is extended both ways to the windows that chose it,
windows meet on their hash, and all but the earliest are repeats. Adjoining windows make maximal
repeats, whose words go.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import WordHashes, grams

#: Words of a window, the shortest passage that counts, and of a seed.
WINDOW, SEED = 20, 8
#: Bits of the filter that tells seeds which may repeat. Its size is fixed; when it is full it lets more pass, no less.
FILTER_BITS = 1 << 28
#: Words that are worked on together.
LOT = 200_000
#: Stands for a null doc_id, which comes after all others.
LAST = (1 << 63) - 1


class Windows(NamedTuple):
    """Windows of a lot of documents: document, first word, place of the first word in the lot, seed, hash."""

    doc: np.ndarray
    start: np.ndarray
    at: np.ndarray
    seed: np.ndarray
    place: np.ndarray
    words: np.ndarray


def windows(texts: list[list[bytes]], hashes: WordHashes, size: int = WINDOW) -> Windows:
    """All windows of the texts' words, each with the hash and place of its seed; texts that are shorter have none."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    words = hashes.of([w for t in texts for w in t])
    doc = np.repeat(np.arange(len(texts)), lengths)
    n, reach = len(words) - size + 1, size - SEED + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Windows(none, none, none, np.zeros(0, np.uint64), none, words)
    seeds = grams(words, SEED)
    least, width = seeds, 1
    while width < reach:  # the minimum over ``reach`` seeds, by doubling
        step = min(width, reach - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    place = np.zeros(n, np.int64)
    for k in range(reach):  # the last of equal minima
        np.copyto(place, np.arange(k, k + n), where=seeds[k : k + n] == least)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Windows(doc[at], at - starts[doc[at]], at, least[at], place[at], words)


def _lots(batch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Documents of a batch (text first) in lots of bounded size: first row, words of each."""
    texts, first, lot, size = batch.column(0), 0, [], 0
    for i in range(batch.num_rows):
        lot.append((texts[i].as_py() or b"").split())
        size += len(lot[-1])
        if size >= LOT:
            yield first, lot
            first, lot, size = i + 1, [], 0
    if lot:
        yield first, lot


def _slim(docs: DataFrame) -> DataFrame:
    """text as bytes, id, and 31 bits of the text that tell rows of one id apart."""
    tag = F.shiftleft(F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)), 32)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select(F.col("text").cast("binary").alias("_bytes"), key.alias("_key"), tag.alias("_tag"))


def repeated_seeds(docs: DataFrame, size: int = WINDOW) -> np.ndarray:
    """The filter of seeds that occur more than once, as 64-bit words.

    Seeds are counted over all documents: first within tasks, then by partial aggregates. What comes
    to the driver is the filter, whose size does not depend on the data.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            for _, lot in _lots(batch):
                found = windows(lot, hashes, size)
                _, first = np.unique(found.place, return_index=True)
                seeds, n = np.unique(found.seed[first], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], ["seed", "n"]
                )

    seeds = _slim(docs).mapInArrow(count, "seed long, n byte").groupBy("seed").agg(F.sum("n").alias("n"))
    bit = F.col("seed").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = seeds.where("n > 1").select(
        F.shiftright(bit, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(seed & {63} as int))").alias("bit")
    )
    bits = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return table


def _may_repeat(table: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    bit = seeds & np.uint64(FILTER_BITS - 1)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def first_windows(docs: DataFrame, shared, size: int = WINDOW) -> DataFrame:
    """(``_key``, ``_tag``, ``_first``): starts of each document's windows that occur there first, of those a repeated seed extends to."""

    def extend(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            keys, tags = (batch.column(i).to_numpy() for i in (1, 2))
            for row, lot in _lots(batch):
                found = windows(lot, hashes, size)
                pick = _may_repeat(shared.value, found.seed)
                if not pick.any():
                    continue
                window = grams(found.words, size)[found.at[pick]]
                key, spot = keys[row + found.doc[pick]], tags[row + found.doc[pick]] + found.start[pick]
                order = np.lexsort((spot, key, window))
                new = np.concatenate([[True], window[order][1:] != window[order][:-1]])
                order = order[new]  # the earliest of a lot
                yield pa.RecordBatch.from_arrays(
                    [pa.array(window[order].view(np.int64)), pa.array(key[order]), pa.array(spot[order])], ["window", "key", "spot"]
                )

    found = _slim(docs).mapInArrow(extend, "window long, key long, spot long")
    first = found.groupBy("window").agg(F.min(F.struct("key", "spot")).alias("first"))
    spots = first.select(
        F.col("first.key").alias("_key"), F.col("first.spot").bitwiseAND(F.lit(0x7FFFFFFF << 32)).alias("_tag"),
        F.col("first.spot").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("spot"),
    )
    return spots.groupBy("_key", "_tag").agg(F.collect_list("spot").alias("_first"))


def drop_repeats(docs: DataFrame, keep: list[str], size: int = WINDOW) -> DataFrame:
    """``keep`` columns of every document with ``kept`` (text), ``n_words``, ``n_removed`` and ``spans``.

    A word goes if a window of ``size`` consecutive words covers it whose words also start earlier: in
    a document with a smaller doc_id (null last), or earlier in the same one. Windows are judged on the
    texts as they come. ``spans`` are the maximal repeats as [first word, word after the last).
    ``kept`` are the other words joined by one space. Null text has no words. Rows that repeat an id and
    a text are one document and lose the same words; other rows of one id are ordered by a hash of their text.

    Nothing grows with the square of a group: seeds are counted, and windows are cut to the earliest
    one within tasks, by partial aggregates, and once more after the shuffle. Each document gets the
    starts of its own first windows, which are no more than its words.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(repeated_seeds(docs, size))
    firsts = first_windows(docs, shared, size)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    own_ = [F.col(f"`{c}`").alias(f"_kept{i}") for i, c in enumerate(keep)]

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            starts = batch.column(1)
            for row, lot in _lots(batch):
                found = windows(lot, hashes, size)
                pick = np.flatnonzero(_may_repeat(shared.value, found.seed))
                first = np.zeros(len(found.words), bool)
                lengths = np.fromiter(map(len, lot), np.int64, len(lot))
                begins = np.cumsum(lengths) - lengths
                for i in range(len(lot)):
                    own = starts[row + i]
                    if own.is_valid:
                        first[begins[i] + own.values.to_numpy()] = True
                late = found.at[pick][~first[found.at[pick]]]
                edge = np.zeros(len(found.words) + 1, np.int64)
                np.add.at(edge, late, 1)
                np.add.at(edge, late + size, -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept, removed, spans = [], [], []
                for i, words in enumerate(lot):
                    mask = gone[begins[i] : begins[i] + lengths[i]]
                    lost = int(mask.sum())
                    removed.append(lost)
                    if lost:
                        words = [w for w, g in zip(words, mask.tolist()) if not g]
                        turns = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                        spans.append(turns.reshape(-1, 2).tolist())
                    else:
                        spans.append([])
                    kept.append(b" ".join(words).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(j).slice(row, len(lot)) for j in range(2, 2 + len(keep))), pa.array(kept, pa.string()),
                     pa.array(lengths), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                    [*keep, "kept", "n_words", "n_removed", "spans"],
                )

    tag = F.shiftleft(F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)), 32)
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) == F.col("_key")) & (tag == F.col("_tag"))
    slim = docs.select("doc_id", "text", *own_)
    rows = slim.join(firsts, same, "left").select(
        F.col("text").cast("binary").alias("_bytes"), "_first", *[f"_kept{i}" for i in range(len(keep))]
    )
    columns = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return rows.mapInArrow(cut, f"{columns}, kept string, n_words long, n_removed long, spans array<array<long>>")
