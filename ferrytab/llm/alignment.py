"""Alignment of two tokenizers over the same texts, by byte offsets, in Arrow columns.

Both tokenizers cut the bytes of a space and the text. Where a token of each ends at one offset, the text falls
into groups, and the two tokens are linked. Token ids of many documents are one flat column with the index
of their document; offsets are cumulative sums within a document; links are a hash join on
(document, end); counts per id pair are grouped within tasks and summed by Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import landed

#: Characters that are tokenized together, and of the documents that look up their pairs' counts together.
PART_CHARS, LOT_CHARS = 1 << 19, 1 << 22
#: What a document without text counts as when documents are put together.
LEAST_CHARS = 64

_BITS = 32
_LOW = (1 << _BITS) - 1


def byte_level_bytes(entry: str) -> bytes:
    """The bytes that an entry of a byte-level vocabulary stands for: one character per byte."""
    return bytes(map(_BYTE_OF.__getitem__, entry))


def _byte_alphabet() -> dict[str, int]:
    """Printable Latin-1 bytes are their own characters, the others follow in order from U+0100."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


_BYTE_OF = _byte_alphabet()


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    """The bytes of a piece: its UTF-8 with U+2581 as space, or the one byte that ``<0xHH>`` names."""
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


class _Pair:
    """Both tokenizers in a worker, with the bytes of every id, and the texts that digests are made of."""

    def __init__(self, a: str, b: bytes) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import pyarrow as pa
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(a), SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        entries = {i: byte_level_bytes(e) for e, i in self.a.get_vocab(with_added_tokens=True).items()}
        sizes = (max(entries) + 1, self.b.get_piece_size())
        pieces = [piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(sizes[1])]
        self.bytes = pa.array([entries.get(i, b"") for i in range(sizes[0])], pa.large_binary()), pa.array(pieces, pa.large_binary())
        # Every id as text, twice: followed by a comma, and by the sign that ends its side of a group.
        self.spelled = pa.array(
            [f"{i}{sign}" for n, signs in zip(sizes, (",|", ",;")) for i in range(n) for sign in signs], pa.large_string()
        )
        self.shift = 2 * sizes[0]
        self.quick = _quick_form(json.loads(a), entries)

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a space and the text, of each text."""
        if self.quick is not None:
            return [self.quick.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        return [np.array(e.ids) for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
        return self.encode_a(texts), self.b.encode(texts, num_threads=1)


def _quick_form(a: dict, entries: dict[int, bytes]):
    """The same byte-level tokenizer in the library that merges ranks, several times as fast; ``None`` if it is none of that form.

    It must split text by the common pattern, change nothing before, and number its merges in their order, so that a
    merge's rank is the id of what it makes.
    """
    import public_tokenizers
    import tiktoken

    model, split = a["model"], a.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if model["type"] != "BPE" or not plain or a.get("normalizer") or any(
        model.get(c) for c in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
    ):
        return None
    vocab = model["vocab"]
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if made != list(range(256, 256 + len(made))) or len(vocab) != 256 + len(made):
        return None
    ranks = {entries[i]: i for i in vocab.values()}
    return tiktoken.Encoding("quick", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_LOADED: dict = {}


def _loaded(name: str, shared) -> _Pair:
    """The tokenizers of a broadcast, made once per worker process; ``name`` tells them from others."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = _Pair(*shared.value)
    return _LOADED[name]


class _Side:
    """Tokens of one tokenizer over several texts: ids in a row, their text's index, and where they end in it."""

    def __init__(self, lists: list, table) -> None:
        import pyarrow as pa
        import pyarrow.compute as pc

        stops = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        if lists and isinstance(lists[0], np.ndarray):
            flat = np.concatenate(lists).astype(np.int32)
        else:
            flat = np.fromiter(chain.from_iterable(lists), np.int32, stops[-1] if len(stops) else 0)
        column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(flat))
        self.ids, self.doc = column.flatten(), pc.list_parent_indices(column).to_numpy()
        self.taken = table.take(self.ids)
        running = pc.cumulative_sum(pc.binary_length(self.taken)).to_numpy() if len(self.ids) else np.zeros(0, np.int64)
        self.totals = np.concatenate([[0], running])[stops]  # bytes up to the end of each text
        self.end = running - np.concatenate([[0], self.totals[:-1]])[self.doc] if len(self.ids) else running
        self.ids = self.ids.to_numpy()

    def joined(self) -> memoryview:
        """All token bytes in a row: the values of the taken entries."""
        return _view(self.taken.buffers()[2])

    def kept(self, right: np.ndarray) -> None:
        stays = right[self.doc]
        self.ids, self.doc, self.end = self.ids[stays], self.doc[stays], self.end[stays]


def _view(buffer) -> memoryview:
    """Bytes of an Arrow buffer, which are signed there."""
    return memoryview(buffer).cast("B") if buffer is not None and buffer.size else memoryview(b"")


def _equals(side: _Side, wanted: list[bytes]) -> np.ndarray:
    """Which texts the tokens' joined bytes give back."""
    data, starts = side.joined(), np.concatenate([[0], side.totals[:-1]])
    return np.array([data[s:e] == w for s, e, w in zip(starts.tolist(), side.totals.tolist(), wanted)], bool)


def _groups(ends: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token, and the ends at which groups are cut; ``ends`` rise, ``linked`` are places of linked tokens."""
    cut = np.zeros(len(ends), bool)
    cut[linked] = True
    first = cut.copy()
    first[1:] &= ends[1:] != ends[:-1]
    return np.cumsum(first) - cut, ends[first]


def align_texts(pair: _Pair, texts: list[str]) -> dict:
    """Of several texts: links (``link_doc``, ``link_pair``), and per text the token, group and link counts and its groups' bytes."""
    import pyarrow as pa

    n = len(texts)
    some = [i for i, t in enumerate(texts) if t]
    wanted = [(" " + texts[i]).encode() for i in some]
    a, b = (_Side(lists, table) for lists, table in zip(pair.encode([texts[i] for i in some]), pair.bytes))
    right = _equals(a, wanted) & _equals(b, wanted)
    place = np.array(some, np.int64)
    for side in (a, b):
        side.kept(right)
        side.doc = place[side.doc]
    sides = [
        pa.table({"doc": s.doc, "end": s.end, name: np.arange(len(s.ids))}) for s, name in ((a, "at_a"), (b, "at_b"))
    ]
    found = sides[0].join(sides[1], ["doc", "end"], join_type="inner", use_threads=False)
    at_a, at_b = found.column("at_a").to_numpy(), found.column("at_b").to_numpy()
    link_doc = a.doc[at_a]

    # Ends of all texts on one scale: groups are cut at the ends that both sides have.
    width = np.int64(1) + max(a.end.max(initial=0), b.end.max(initial=0))
    group_a, cuts = _groups(a.doc * width + a.end, at_a)
    group_b, _ = _groups(b.doc * width + b.end, at_b)
    a_before, b_before = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(cuts)))]) for g in (group_a, group_b))

    def last(group: np.ndarray) -> np.ndarray:
        return np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)

    codes = np.empty(len(a.ids) + len(b.ids), np.int64)
    codes[np.arange(len(a.ids)) + b_before[group_a]] = 2 * a.ids.astype(np.int64) + last(group_a)
    codes[np.arange(len(b.ids)) + a_before[group_b + 1]] = pair.shift + 2 * b.ids.astype(np.int64) + last(group_b)
    spelled = pair.spelled.take(pa.array(codes))
    offsets = np.frombuffer(spelled.buffers()[1], np.int64, len(codes) + 1)
    n_a, n_b = np.bincount(a.doc, minlength=n), np.bincount(b.doc, minlength=n)
    stops = offsets[np.cumsum(n_a + n_b)]
    starts = np.concatenate([[0], stops[:-1]])
    written = _view(spelled.buffers()[2])
    return {
        "link_doc": link_doc,
        "link_pair": a.ids[at_a].astype(np.int64) << _BITS | b.ids[at_b].astype(np.int64),
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.bincount(cuts // width, minlength=n),
        "n_links": np.bincount(link_doc, minlength=n),
        # Without the sign that ends the last group; of a text without tokens nothing.
        "groups": [written[s : max(s, e - 1)] for s, e in zip(starts.tolist(), stops.tolist())],
    }


def _pairs_by_text(found: dict, n: int):
    """(``pairs``, ``times``) per text: each id pair linked in it, and how often."""
    import pyarrow as pa

    links = pa.table({"doc": found["link_doc"], "pair": found["link_pair"]})
    counted = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    doc = counted.column("doc").to_numpy()
    order = np.argsort(doc, kind="stable")
    offsets = pa.array(np.searchsorted(doc[order], np.arange(n + 1)), pa.int32())
    pairs = counted.column("pair").combine_chunks().take(pa.array(order))
    times = counted.column("count_all").combine_chunks().take(pa.array(order))
    return pa.ListArray.from_arrays(offsets, pairs), pa.ListArray.from_arrays(offsets, times)


def _parts(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``most`` characters."""
    start = size = 0
    for i, length in enumerate(lengths):
        size += max(length, LEAST_CHARS)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def aligned(docs: DataFrame, a: str, b: bytes, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Every row's alignment: (``key``, ``lot``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``pairs``, ``times``).

    ``a`` is the JSON of a byte-level tokenizer, ``b`` the model of a piece tokenizer. ``groups`` is
    ``a1,a2|b1;a3|b2,b3``, decimal ids in order, or with ``digest`` the hex SHA-256 of that. ``pairs`` are the id
    pairs linked in the text (A's id in the upper half) and ``times`` how often. Null and empty texts, and
    those that the joined tokens of either side do not give back, have no tokens: zeros, an empty ``groups``. Rows
    with a null key or one that repeats are rows as all others. The result is written once and read again.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((a, b))
    name = sha256(a.encode() + b).hexdigest()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        pair = _loaded(name, shared)
        lot, filled = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, stop in _parts(list(map(len, texts)), PART_CHARS):
                found = align_texts(pair, texts[start:stop])
                n = stop - start
                groups = found["groups"]
                if digest:
                    groups = [sha256(g).hexdigest() if len(g) else "" for g in groups]
                else:
                    groups = [bytes(g).decode() for g in groups]
                counts = [pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                pairs, times = _pairs_by_text(found, n)
                columns = [batch.column(0).slice(start, n), pa.repeat(pa.scalar(lot, pa.int64()), n), *counts]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(groups, pa.string()), pairs, times], names)
                filled += sum(max(len(t), LEAST_CHARS) for t in texts[start:stop])
                if filled >= LOT_CHARS:
                    lot, filled = lot + 1, 0

    names = [key, "lot", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, lot long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
    rows = landed(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema), "aligned")
    shared.destroy()
    return rows


def pairs_by_lot(rows: DataFrame) -> DataFrame:
    """(``lot``, ``pair``, ``n``): partial counts of :func:`aligned` rows, grouped within tasks."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def summed(lot, parts):
            whole = pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            lots = pa.repeat(pa.scalar(lot, pa.int64()), len(whole))
            yield from pa.table([lots, whole.column("pair"), whole.column("n_sum")], ["lot", "pair", "n"]).to_batches()

        now, held = None, []
        for batch in batches:
            lots = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.append(True, lots[1:] != lots[:-1])).tolist() if len(lots) else []
            for start, stop in zip(edges, [*edges[1:], len(lots)]):
                if held and now != lots[start]:
                    yield from summed(now, held)
                    held = []
                now = int(lots[start])
                flat = [batch.column(c).slice(start, stop - start).flatten() for c in (1, 2)]
                held.append(pa.table(flat, ["pair", "n"]))
        if held:
            yield from summed(now, held)

    return rows.select("lot", "pairs", "times").mapInArrow(count, "lot long, pair long, n long")


def pair_counts(asked: DataFrame) -> DataFrame:
    """(``pair``, ``n``, ``best``): links of every id pair in the whole corpus, and whether that is the highest of its B id."""
    counts = asked.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("_b", F.col("pair").bitwiseAND(F.lit(_LOW)))
    highest = counts.groupBy("_b").agg(F.max("n").alias("_most"))
    return counts.join(highest, "_b").select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def alignment_report(docs: DataFrame, a: str, b: bytes, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Every row's counts and groups with ``n_best`` and ``count_sum`` over its links, one row per row of ``docs``.

    Texts are tokenized once. Documents of one task are put in lots of bounded size; a lot looks up each of
    its pairs once, so a pair that every document holds is one row per lot, and no task holds counts of
    more pairs than its lot has.
    """
    rows = aligned(docs, a, b, key, text, digest)
    asked = landed(pairs_by_lot(rows), "asked-pairs")
    found = asked.select("lot", "pair").distinct().join(pair_counts(asked), "pair")
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def rated(table, entries):
        import pyarrow as pa

        known = entries.column("pair").to_numpy()
        order = np.argsort(known)
        n, best = entries.column("n").to_numpy()[order], entries.column("best").to_numpy()[order]
        pairs = table.column("pairs").combine_chunks()
        times = table.column("times").combine_chunks().flatten().to_numpy()
        at = np.searchsorted(known[order], pairs.flatten().to_numpy())
        stops = np.cumsum(pairs.value_lengths().to_numpy())

        def by_row(values):
            return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], stops])])

        sums = [by_row(times * x[at] if len(at) else np.zeros(0, np.int64)) for x in (best.astype(np.int64), n)]
        columns = [table.column(c) for c in (key, *numbers)]
        return pa.table([*columns, *(pa.array(s, pa.int64()) for s in sums), table.column("groups")], out)

    out = [key, *numbers, "n_best", "count_sum", "groups"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {', '.join(f'{c} long' for c in out[1:-1])}, groups string"
    return rows.groupBy("lot").cogroup(found.groupBy("lot")).applyInArrow(rated, schema)
