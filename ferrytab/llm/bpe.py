"""Byte-level BPE encoding and decoding by a two-tier lookup.

A text is split by the tokenizer's pattern. Tier one: a minimal perfect hash over the vocabulary
finds pre-tokens that are tokens as a whole. Tier two, for the rest: the pre-token's bytes form a
linked list, a heap holds the ranks of neighbouring pairs, and the lowest rank is merged first.
The vocabulary is read once on the driver and broadcast; its size is that of the rank file.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from ferrytab.llm.common import kept

#: Code points with the Unicode property White_Space. Fixed values.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Letters, and punctuation without the apostrophe, in character classes: they are so in every Unicode version.
LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af"
MARKS = r"!-&(-/:-@\[-`{-~"

#: Chunks of text that a task process remembers, twice over: those of the last round and those of this one.
CACHED = 1 << 19


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens in order of their ids, from a file of base64 tokens and ranks.

    The file lies on the driver's machine beside the tokenizer package.
    """
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"the ranks in {path} are not 0 to n - 1")
    return [tokens[i] for i in range(len(tokens))]


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys in n slots, no empty slot.

    Keys fall into about n / 4 buckets; buckets are placed by falling size, each with the first
    displacement that puts all of its keys in free slots. Buckets of one key take any free slot,
    which is stored as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.n_buckets = max(1, n // 4)
        self.displace = [0] * self.n_buckets
        self.value = [0] * n
        buckets: list[list[tuple[int, int, int]]] = [[] for _ in range(self.n_buckets)]
        for i, key in enumerate(keys):
            a, b, c = self._hashes(key)
            buckets[a].append((b, c, i))
        used = bytearray(n)
        order = sorted(range(self.n_buckets), key=lambda k: -len(buckets[k]))
        free = None
        for k in order:
            members = buckets[k]
            if not members:
                break
            if len(members) == 1:
                free = free or iter([s for s in range(n) if not used[s]])
                slot = next(free)
                self.displace[k], self.value[slot] = -slot - 1, members[0][2]
                continue
            d = 0
            while True:
                slots = {self._place(b, c, d) for b, c, _ in members}
                if len(slots) == len(members) and not any(used[s] for s in slots):
                    break
                d += 1
                if d > 50 * n:
                    raise ValueError("keys repeat")
            self.displace[k] = d
            for b, c, i in members:
                slot = self._place(b, c, d)
                used[slot], self.value[slot] = 1, i

    def _hashes(self, key: bytes) -> tuple[int, int, int]:
        h = xxh3_128_intdigest(key)
        return (h & 0xFFFFFFFF) % self.n_buckets, h >> 32 & 0xFFFFFFFF, h >> 64

    def _place(self, b: int, c: int, d: int) -> int:
        return ((b + d * c) * 0x9E3779B97F4A7C15 >> 32 & 0xFFFFFFFF) % self.n

    def slot(self, key: bytes) -> int:
        """Place of a key; of a stranger, the place of some key."""
        a, b, c = self._hashes(key)
        d = self.displace[a]
        return -d - 1 if d < 0 else self._place(b, c, d)


def newer_letters() -> dict[int, str]:
    """Code points that are letters or numbers for ``regex`` but not yet for the tokenizer library.

    The two carry different Unicode versions. Where a text is split these code points stand for a
    private one, which is neither letter, number nor space in either. Asked once, on the driver.
    """
    import regex
    import tiktoken

    point = regex.compile(r"[\p{L}\p{N}]")
    known = [chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000 and point.match(chr(c))]
    single = {bytes([b]): b for b in range(256)}
    library = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=single, special_tokens={})
    theirs = set(bytes(library.encode_ordinary("".join(known))).decode())
    return {ord(c): "\ue000" for c in known if c not in theirs}


class Encoder:
    """Token ids of texts, in one task process."""

    def __init__(self, tokens: list[bytes], index: PerfectHash, newer: dict[int, str], pattern: str):
        import re

        import regex

        self.tokens, self.index, self.newer = tokens, index, newer
        self.fine = regex.compile(pattern)
        # White space is divided as by the tokenizer's pattern. Latin letters up to a space or to punctuation other than
        # an apostrophe are one pre-token; any other chunk between white space is divided by that pattern later.
        self.plain = re.compile(rf" ?[{LATIN}]+|[{MARKS}]+")
        self.coarse = re.compile(
            rf" ?[{LATIN}]++(?=[{MARKS}{SPACES}]|\Z)| ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
        )
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.single = [self._rank(bytes([b])) for b in range(256)]
        self.pairs = self._pairs()

    def _rank(self, key: bytes) -> int:
        """Id of a token, or -1: the hash's place is right only if it holds that token."""
        i = self.index.value[self.index.slot(key)]
        return i if self.tokens[i] == key else -1

    def _pairs(self) -> list[dict[int, int]]:
        """For each id the ids that can follow it with what the two make together: every way to cut a token in two."""
        ids = {token: i for i, token in enumerate(self.tokens)}
        pairs: list[dict[int, int]] = [{} for _ in self.tokens]
        for token, i in ids.items():
            for k in range(1, len(token)):
                a, b = ids.get(token[:k]), ids.get(token[k:])
                if a is not None and b is not None:
                    pairs[a][b] = i
        return pairs

    def _merged(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost among equals, over a linked list of parts.

        Part ``i`` begins at byte ``i`` and holds the id ``part[i]``, or -1 once it has been merged into
        its left neighbour; ``after`` and ``before`` link the parts, and ``makes[i]`` is the id that part ``i``
        makes with the next, or -1. A heap entry packs such an id with its place, and is stale if that place
        makes another id by now.
        """
        n, pairs, pop, push = len(piece), self.pairs, heappop, heappush
        part = [self.single[b] for b in piece]
        makes = [pairs[a].get(b, -1) for a, b in zip(part, part[1:])]
        shift = n.bit_length()
        low = (1 << shift) - 1
        heap = [r << shift | i for i, r in enumerate(makes) if r >= 0]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        makes.append(-1)
        while heap:
            entry = pop(heap)
            i, made = entry & low, entry >> shift
            if makes[i] != made:
                continue
            right = after[i]
            after[i] = stop = after[right]
            part[i], part[right], makes[right] = made, -1, -1
            if stop < n:
                before[stop] = i
                makes[i] = r = pairs[made].get(part[stop], -1)
                if r >= 0:
                    push(heap, r << shift | i)
            else:
                makes[i] = -1
            left = before[i]
            if left >= 0:
                makes[left] = r = pairs[part[left]].get(made, -1)
                if r >= 0:
                    push(heap, r << shift | left)
        return [i for i in part if i >= 0]

    def _piece(self, piece: bytes) -> bytes:
        whole = self._rank(piece)
        return array("i", (whole,) if whole >= 0 else self._merged(piece)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if self.plain.fullmatch(chunk):
            return self._piece(chunk.encode())
        seen = chunk if chunk.isascii() else chunk.translate(self.newer)
        return b"".join([self._piece(chunk[m.start() : m.end()].encode()) for m in self.fine.finditer(seen)])

    def _remembered(self, chunk: str) -> bytes:
        ids = self.known.get(chunk)
        if ids is not None:
            return ids
        ids = self.before.get(chunk)
        if ids is None:
            ids = self._chunk(chunk)
        if len(chunk) <= 64:  # longer ones hardly ever come again
            if len(self.known) >= CACHED:
                self.before, self.known = self.known, {}
            self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        chunks = self.coarse.findall(text)
        found = list(map(self.known.get, chunks))
        if None in found:
            found = [self._remembered(c) if ids is None else ids for c, ids in zip(chunks, found)]
        return np.frombuffer(b"".join(found), np.int32)


class ByteBpe:
    """Encoding and decoding as column expressions over one vocabulary.

    Null text is encoded like the empty text, to no ids; null ids are decoded to no bytes. Texts of
    any length are taken whole: merging is n log n in the length of a pre-token.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        tokens = read_ranks(spark, path)
        if not {bytes([b]) for b in range(256)} <= set(tokens):
            raise ValueError("every single byte must be a token")
        self._shared = spark.sparkContext.broadcast((tokens, PerfectHash(tokens), newer_letters()))
        self._pattern = pattern

    def encode(self, text: Column) -> Column:
        """Ids of a text as ``array<int>``."""
        return _encoding(self._shared, self._pattern)(text)

    def round_trip(self, text: Column) -> Column:
        """``ids`` of a text and the bytes ``decoded`` from them, in one pass through Python."""
        return _round_trip(self._shared, self._pattern)(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for."""
        return _decoding(self._shared)(ids)


def _encoder(shared, pattern: str) -> Encoder:
    """Of a broadcast vocabulary; kept with the broadcast, whose ``id`` is then no other's."""
    return kept(("bpe", id(shared)), lambda: (shared, Encoder(*shared.value, pattern)))[1]


def _ids(texts, shared, pattern: str):
    """Arrow list array of the ids of an Arrow array of texts."""
    import pyarrow as pa

    encoder = _encoder(shared, pattern)
    each = [encoder.encode(x.as_py() or "") for x in texts]
    ends = np.cumsum([0, *map(len, each)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(each or [np.empty(0, np.int32)])))


def _bytes(ids, shared):
    """Arrow binary array of the bytes that an Arrow list array of ids stands for."""
    import pyarrow as pa

    tokens = shared.value[0]
    if ids.null_count:
        return pa.array([b"".join([tokens[i] for i in x.as_py() or ()]) for x in ids], pa.binary())
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum([0, *ids.value_lengths().to_numpy(zero_copy_only=False)])
    parts = [b"".join(map(tokens.__getitem__, flat[a:b].tolist())) for a, b in zip(ends, ends[1:])]
    return pa.array(parts, pa.binary())


def _encoding(shared, pattern: str) -> Callable[[Column], Column]:
    @F.arrow_udf("array<int>")
    def encode(texts):
        return _ids(texts, shared, pattern)

    return encode


def _decoding(shared) -> Callable[[Column], Column]:
    @F.arrow_udf("binary")
    def decode(ids):
        return _bytes(ids, shared)

    return decode


def _round_trip(shared, pattern: str) -> Callable[[Column], Column]:
    @F.arrow_udf("ids array<int>, decoded binary")
    def round_trip(texts):
        import pyarrow as pa

        ids = _ids(texts, shared, pattern)
        return pa.StructArray.from_arrays([ids, _bytes(ids, shared)], names=["ids", "decoded"])

    return round_trip


def encode_digests(docs: DataFrame, bpe: ByteBpe) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes decoded from them."""
    both = docs.select("doc_id", bpe.round_trip(F.col("text")).alias("both")).select("doc_id", "both.*")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
