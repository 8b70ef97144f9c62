"""What several operators share: reading tables, words, 64-bit hashes, and cutting lineage."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Hashable
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrytab.session import scratch_path

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MASK = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that a lost executor costs a read and no recomputation.

    The files stay as long as the folder named by ``spark.checkpoint.dir``: results still read them
    when the function that wrote them has returned.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The column in which :func:`packed` puts what an operator does not look at.
EXTRA = "_ferrytab_extra"


def packed(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names``, and all others in one struct, so that an operator's own columns clash with none of them."""
    others = [c for c in docs.columns if c not in names]
    extra = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]) if others else F.lit(None).cast("int")
    return docs.select(*[F.col(f"`{c}`") for c in names], extra.alias(EXTRA))


def unpacked_columns(docs: DataFrame, names: list[str]) -> list[Column]:
    """The columns of ``docs`` in their order, from rows of :func:`packed`."""
    places = {c: i for i, c in enumerate(c for c in docs.columns if c not in names)}
    return [F.col(f"{EXTRA}.c{places[c]}").alias(c) if c in places else F.col(f"`{c}`") for c in docs.columns]


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, where it is not installed on their machines."""
    context = spark.sparkContext
    if getattr(context, "_ferrytab_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    package = Path(tempfile.mkdtemp(prefix="ferrytab-")) / "ferrytab-modules.zip"
    with zipfile.ZipFile(package, "w") as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, module.relative_to(root.parent))
    context.addPyFile(str(package))
    context._ferrytab_shipped = True


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes, by doubling: log(n) vector operations."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    done, have = words[: len(words) - n + 1].copy(), 0
    done[:] = np.uint64(n)
    power, width = words, 1
    rest = n
    while rest:
        if rest & 1:
            done = mixed(done * np.uint64(0x9E3779B97F4A7C15) + power[have : have + len(done)])
            have += width
        rest >>= 1
        if rest:
            power = mixed(power[:-width] * np.uint64(0xD6E8FEB86659FD93) + power[width:])
            width *= 2
    return done


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``limit`` words; then it starts anew."""

    def __init__(self, limit: int = 1 << 17):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        from hashlib import blake2b

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: Bytes hashed at a time: the arrays of a piece stay in the processor's cache.
PIECE = 1 << 17
#: Places in a word whose byte values are looked up.
PLACES = 64
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _value(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    return mixed((place.astype(np.uint64) * np.uint64(256) + code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


VALUES = _value(np.arange(PLACES).repeat(256), np.tile(np.arange(256, dtype=np.uint64), PLACES))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in a row, A-Z lower-cased, and how many are each text's.

    A word's hash is made of the sum of values of its bytes and their places, so that it takes no Python step per word.
    """
    whole = b" ".join([text or b"" for text in texts]).lower() + b" "
    space = re.compile(rb"[\x20\x09-\x0D]")
    hashes, begins, at = [], [], 0
    while at < len(whole):
        cut = space.search(whole, min(at + PIECE, len(whole) - 1)).end()
        codes = np.frombuffer(whole, np.uint8, cut - at, at)
        inside = ~SPACE[codes]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
        starts, lengths = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lengths -= starts
        if len(starts):
            codes = codes[inside]
            first = np.cumsum(lengths) - lengths
            place = np.arange(len(codes)) - np.repeat(first, lengths)
            values = VALUES[np.minimum(place, PLACES - 1) * 256 + codes]
            if lengths.max() > PLACES:
                far = np.flatnonzero(place >= PLACES)
                values[far] = _value(place[far], codes[far].astype(np.uint64))
            sums = np.add.reduceat(values, first)
            hashes.append(mixed(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            begins.append(starts + at)
        at = cut
    ends = np.cumsum([len(text or b"") + 1 for text in texts])
    begins = np.concatenate(begins or [np.zeros(0, np.int64)])
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.diff(np.searchsorted(begins, ends), prepend=0)


#: What tasks of one operator keep in this process for its next ones.
_KEPT: dict = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The tool that ``make`` makes, the same for all tasks that ask for ``key`` in a row; there is one at a time."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Free what another operator's tasks have kept: a worker process serves one after the other."""
    _KEPT.clear()
