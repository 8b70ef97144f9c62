"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, one of toxic and one of ordinary documents, share the counts of their
lowest orders. A word's score is the difference of its log-likelihoods over its length; a document
that holds expressions likelier in the toxic class scores high, however rare each of them is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import forget, landed, mixed

#: Characters of the longest context plus the one that follows.
ORDER = 5
#: Orders up to this one are counted over both classes together.
SHARED = 2
DISCOUNT = 0.75
#: Characters of the texts, and different words, whose words are numbered together; words that are scored together.
CHUNK_CHARS, CHUNK_WORDS, LOT_WORDS = 1 << 23, 1 << 16, 1 << 15
#: Tells the hash of a context from that of a gram of the same characters.
CONTEXT = np.uint64(0x5851F42D4C957F2D)
#: Entries of a model that goes whole to every task (48 bytes each), and labelled ids that do; beyond that both are dealt.
MODEL_ROWS, LABEL_ROWS = 1 << 20, 1 << 20
#: Labelled documents on which the weights of the final score are fitted.
FIT_ROWS = 8_192
#: What a word's score must pass to count as evidence.
EVIDENCE = 0.3
FOLDS = 5

START, END = "\x02", "\x03"

#: Counts, shares and weights by class: of the model without fold 4, on which weights are fitted, and of the one that scores.
COLUMNS = ("toxic_fit", "ordinary_fit", "toxic", "ordinary")
_PAIRS = (COLUMNS[:2], COLUMNS[2:])

Arrays = tuple[np.ndarray, np.ndarray, np.ndarray]


class ToxicModel(NamedTuple):
    """Written rows (``key`` and ``COLUMNS``) of all grams and contexts, floors, and the weights of the document score.

    ``small`` is a broadcast of the entries in order of their keys, of a model with up to ``MODEL_ROWS`` of them.
    """

    entries: DataFrame
    floors: tuple[float, float]
    weights: np.ndarray
    small: Broadcast | None


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text modulo five; null ids belong to the held-out fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0))


def word_bags(docs: DataFrame) -> DataFrame:
    """Written rows of the texts' words, in the order in which tasks read them.

    A document is (``chunk``, ``doc_id``, ``text_hash``, ``wide``, ``ids``, ``times``): the numbers of its different words in
    the chunk, and how often it has each. A chunk is (``chunk``, ``words``): its words, lower-cased, letters and digits only; the
    first one is empty and stands for all that have none. Numbers take two bytes, or four where ``wide``. A chunk
    ends at ``CHUNK_CHARS`` characters or ``CHUNK_WORDS`` words, after the document that reaches them.
    """

    def bag(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa
        from pyspark import TaskContext

        names = ["chunk", "doc_id", "text_hash", "wide", "ids", "times", "words"]
        clean, chunk = _cleaner(), TaskContext.get().partitionId() << 33
        words, raw, chars = {"": 0}, {}, 0

        def number(token: str) -> int:
            return raw.setdefault(token, words.setdefault(clean("", token), len(words)))

        def vocabulary():
            nothing = [pa.nulls(1, k) for k in (kind, pa.int64(), pa.bool_(), pa.binary(), pa.binary())]
            listed = pa.array([list(words)], pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *nothing, listed], names)

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            start, chunks, bags = 0, [], []

            def made(stop):
                columns = [batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start)]
                wide, ids, times = zip(*bags)
                arrays = [pa.array(wide, pa.bool_()), pa.array(ids, pa.binary()), pa.array(times, pa.binary())]
                nothing = pa.nulls(stop - start, pa.list_(pa.string()))
                return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), *columns, *arrays, nothing], names)

            for i, text in enumerate(batch.column(2)):
                text = text.as_py() or ""
                counts: Counter = Counter()
                for token, n in Counter(text.lower().split()).items():
                    at = raw.get(token)
                    counts[number(token) if at is None else at] += n
                wide = len(words) > 1 << 16 or max(counts.values(), default=0) >= 1 << 16
                form = np.uint32 if wide else np.uint16
                bags.append((wide, *(np.fromiter(x, form, len(counts)).tobytes() for x in (counts.keys(), counts.values()))))
                chunks.append(chunk)
                chars += len(text)
                if chars >= CHUNK_CHARS or len(words) >= CHUNK_WORDS or len(bags) >= 1_024:
                    yield made(i + 1)
                    start, chunks, bags = i + 1, [], []
                if chars >= CHUNK_CHARS or len(words) >= CHUNK_WORDS:
                    yield vocabulary()
                    chunk, words, raw, chars = chunk + 1, {"": 0}, {}, 0
            if bags:
                yield made(batch.num_rows)
        if len(words) > 1 or chars or raw:
            yield vocabulary()

    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"chunk long, doc_id {kind}, text_hash long, wide boolean, ids binary, times binary, words array<string>"
    return landed(slim.mapInArrow(bag, schema), "bags")


def _numbers(wide: bool, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if wide else np.uint16).astype(np.int64)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(``text``, ``toxic``, ``last``) of documents outside the held-out fold; ``last`` marks fold 4.

    A repeated id is toxic if any of its labels says so. Up to ``LABEL_ROWS`` ids go to every task, so that texts
    stay where they are; more are joined by a shuffle.
    """
    marks = labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) > 0)
    marks = marks.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = landed(marks.withColumn("last", (fold(F.col("doc_id")) == FOLDS - 1).cast("int")), "labels")
    few = marks.count() <= LABEL_ROWS
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(marks) if few else marks, "doc_id")


def word_counts(rows: DataFrame) -> DataFrame:
    """(``word`` and ``COLUMNS``): occurrences in rows (text, toxic, last) of each class, without and with fold 4."""

    def count(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        forget()
        clean = _cleaner()

        def out():
            words: dict[str, list[int]] = {}
            for (toxic, last), counts in raw.items():
                for token, n in counts.items():
                    if word := clean("", token):
                        sums = words.setdefault(word, [0, 0, 0, 0])
                        sums[3 - toxic] += n
                        if not last:
                            sums[1 - toxic] += n
            columns = zip(*words.values()) if words else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array(c, pa.int64()) for c in columns)], ["word", *COLUMNS])

        raw = {(y, z): Counter() for y in (0, 1) for z in (0, 1)}
        for batch in batches:
            for text, toxic, last in zip(*(batch.column(i) for i in range(3))):
                raw[toxic.as_py(), last.as_py()].update(text.as_py().lower().split())
                if sum(map(len, raw.values())) > 200_000:
                    yield out()
                    raw = {key: Counter() for key in raw}
        yield out()

    schema = "word string, " + ", ".join(f"{c} long" for c in COLUMNS)
    parts = rows.select("text", "toxic", "last").mapInArrow(count, schema)
    return parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in COLUMNS])


def _vocabularies(bags: DataFrame) -> DataFrame:
    return bags.where("words is not null").select("chunk", "words")


def _cleaner():
    import re

    return re.compile(r"[\W_]+").sub


def gram_tables(words: DataFrame) -> tuple[DataFrame, DataFrame, tuple[int, int]]:
    """Of word counts: (``gram`` and ``COLUMNS``), the same of contexts, and the number of characters of either model.

    The first table holds a gram's discounted share of its context, the second the weight of the next
    lower order. The longest grams, and those at a word's start, count occurrences; lower orders count
    the different characters before them, as Kneser and Ney do: the grams one longer that end like them, since every
    gram but a starting one has some. So all orders and both models come from one table of all grams.
    """
    word = F.concat(F.lit(START), F.col("word"), F.lit(END))
    spots = F.sequence(F.lit(2), F.length("padded"))
    ending = F.transform(
        spots,
        lambda i: F.transform(
            F.sequence(F.lit(2), F.least(i, F.lit(ORDER))), lambda size: F.substring("padded", i - size + 1, size)
        ),
    )
    grams = (
        words.select(word.alias("padded"), *COLUMNS)
        .select(F.explode(F.flatten(ending)).alias("gram"), *COLUMNS)
        .groupBy("gram")
        .agg(*[F.sum(c).alias(c) for c in COLUMNS])
    )
    grams = landed(grams, "toxic-grams")
    size = F.length("gram")
    met = {c: (F.col(c) > 0).cast("long") for c in COLUMNS}
    both = {c: ((F.col(a) + F.col(b)) > 0).cast("long") for a, b in _PAIRS for c in (a, b)}
    shorter = grams.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(
        *[F.sum(F.when(size - 1 <= SHARED, both[c]).otherwise(met[c])).alias(c) for c in COLUMNS]
    )
    summed = {c: F.col(a) + F.col(b) for a, b in _PAIRS for c in (a, b)}
    starts = grams.where(F.col("gram").startswith(START) & (size < ORDER)).select(
        "gram", *[F.when(size <= SHARED, summed[c]).otherwise(F.col(c)).alias(c) for c in COLUMNS]
    )
    level = shorter.unionByName(starts).unionByName(grams.where(size == ORDER))
    level = landed(level.withColumn("context", F.expr("substring(gram, 1, length(gram) - 1)")), "toxic-orders")
    by_context = level.groupBy("context").agg(
        *[F.sum(c).alias(f"{c}_all") for c in COLUMNS],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds") for c in COLUMNS],
    )

    def whole(c):
        return F.col(f"{c}_all")

    share = [
        F.when(whole(c) > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / whole(c)).otherwise(0.0).alias(c) for c in COLUMNS
    ]
    weight = [F.when(whole(c) > 0, DISCOUNT * F.col(f"{c}_kinds") / whole(c)).otherwise(1.0).alias(c) for c in COLUMNS]
    single = [F.count_if((size == 1) & ((F.col(a) + F.col(b)) > 0)) for a, b in _PAIRS]
    return (
        level.join(by_context, "context").select("gram", *share),
        by_context.select(F.concat((F.length("context") + 1).cast("string"), "context").alias("gram"), *weight),
        tuple(level.agg(*single).first()),
    )


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text ends."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), ends


def _hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` code points that end at each position from ``size - 1`` on."""
    h = np.full(max(0, len(codes) - size + 1), size, np.uint64)
    for k in range(size):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(h)])
    return h


def _keyed(rows: DataFrame, lead: bool) -> DataFrame:
    """``rows`` (gram and ``COLUMNS``) under the 64-bit hash ``key``. ``lead``: contexts, whose first character tells the order."""

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column(0).to_pylist()
            h = np.zeros(len(grams), np.uint64)
            sizes = np.array([int(g[0]) - 1 if lead else len(g) for g in grams])
            texts = np.array([g[1:] if lead else g for g in grams], object)
            for size in set(sizes.tolist()):
                which = sizes == size
                codes, _ = _codes(texts[which].tolist())
                h[which] = _hashes(codes, size)[::size][: which.sum()] if size else mixed(np.zeros(1, np.uint64))[0]
            if lead:
                h ^= CONTEXT
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *batch.columns[1:]], ["key", *COLUMNS])

    return rows.mapInArrow(place, "key long, " + ", ".join(f"{c} double" for c in COLUMNS))


def _spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the padded words in a row, where each word ends, its length, and the characters before each one in its word."""
    clean = _cleaner()
    codes, ends = _codes([START + c + END if (c := clean("", w)) else "" for w in words])
    lengths = np.diff(ends, prepend=0)
    return codes, ends, lengths, np.arange(len(codes)) - np.repeat(ends - lengths, lengths)


def _keys(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size the keys of the grams that end at each position, and of their contexts."""
    n, empty = len(codes), mixed(np.zeros(1, np.uint64))[0]
    shorter = np.full(n, empty, np.uint64)  # of the grams one shorter, by their ends
    for size in range(1, ORDER + 1):
        h = np.zeros(n, np.uint64)
        h[size - 1 :] = _hashes(codes, size)
        contexts = np.full(n, empty, np.uint64)
        if size > 1:
            contexts[size - 1 :] = shorter[size - 2 : n - 1]
        yield size, h, contexts ^ CONTEXT
        shorter = h


def needed_keys(words: list[str]) -> np.ndarray:
    """Keys of all grams and contexts that scoring the words asks for, each once."""
    codes, _, _, before = _spelled(words)
    found = [np.unique(k[before >= size - 1]) for size, *both in _keys(codes) for k in both]
    return np.unique(np.concatenate(found))


def _looked_up(table: Arrays, keys: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table[0], keys)
    at[at == len(table[0])] = 0
    found = table[0][at] == keys if len(table[0]) else np.zeros(len(keys), bool)
    if not found.any():
        return np.full(len(keys), missing), np.full(len(keys), missing)
    return np.where(found, table[1][at], missing), np.where(found, table[2][at], missing)


def word_scores(table: Arrays, floor: float, words: list[str]) -> np.ndarray:
    """Toxic minus ordinary log-likelihood of each word, over its length; 0 for one without letters or digits.

    ``table`` holds the model's entries for the words' keys in order: (key, toxic, ordinary).
    """
    codes, ends, lengths, before = _spelled(words)
    n = len(codes)
    scores = np.zeros(len(words))
    if not n:
        return scores
    by_size = list(_keys(codes))
    longest = by_size[0][1].copy()
    for size, h, _ in by_size[1:]:
        np.copyto(longest, h, where=before >= size - 1)
    # A character's likelihoods depend on its longest gram alone, so each such gram is looked up once.
    _, first, which = np.unique(longest, return_index=True, return_inverse=True)
    toxic, ordinary = np.full(len(first), floor), np.full(len(first), floor)
    for size, h, contexts in by_size:
        share, weight = _looked_up(table, h[first], 0.0), _looked_up(table, contexts[first], 1.0)
        whole = before[first] >= size - 1
        toxic = np.where(whole, share[0] + weight[0] * toxic, toxic)
        ordinary = np.where(whole, share[1] + weight[1] * ordinary, ordinary)
    ratio = np.log(np.maximum(toxic, 1e-30)) - np.log(np.maximum(ordinary, 1e-30))
    parts = np.where(before > 0, ratio[which], 0.0)
    sums = np.concatenate([[0.0], np.cumsum(parts)])
    some = lengths > 1
    scores[some] = (sums[ends] - sums[ends - lengths])[some] / (lengths[some] - 1)
    return scores


def document_features(scores: np.ndarray, times: np.ndarray | None = None) -> tuple[float, float, float]:
    """Of word scores and how often each word occurs: their mean, the highest, and the evidence over the root of the length."""
    if not len(scores):
        return 0.0, 0.0, 0.0
    times = np.ones(len(scores), np.int64) if times is None else times
    n = times.sum()
    evidence = (np.maximum(scores - EVIDENCE, 0.0) * times).sum()
    return float((scores * times).sum() / n), float(scores.max()), float(np.log1p(evidence / np.sqrt(n)))


def fit_weights(features: np.ndarray, toxic: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps on scaled features; (intercept, weights..., means..., scales...)."""
    rows = len(toxic)
    mean = features.mean(axis=0) if rows else np.zeros(3)
    scale = np.maximum(features.std(axis=0), 1e-6) if rows else np.ones(3)
    x = np.column_stack([np.ones(rows), (features - mean) / scale])
    start = np.log((toxic.sum() + 0.5) / (rows - toxic.sum() + 1.5))
    w = np.array([start, 0.0, 0.0, 0.0])
    if 0 < toxic.sum() < rows:
        penalty = np.diag([1e-3, ridge, ridge, ridge])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (toxic - p) - penalty @ (w * [0, 1, 1, 1]))
            w = w + np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
    return np.concatenate([w, mean, scale])


def probability(weights: np.ndarray, features) -> float:
    z = weights[0] + float(np.dot(weights[1:4], (np.asarray(features) - weights[4:7]) / weights[7:10]))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicModel:
    """The model of ``docs`` (doc_id, text) under ``labels`` (doc_id, toxic).

    The four numbers that turn a document's features into a score are fitted on labelled rows of fold 4
    with counts of all labelled rows of folds 1 to 3, which have not seen them: the ``fit_rows`` that
    come first by a hash. The model that scores counts folds 1 to 4. Both are columns of one table. Fold 0 is held out of
    both. Without labels of both classes every document gets one low score.
    """
    shares, backoffs, single = gram_tables(landed(word_counts(labelled(docs, labels)), "toxic-words"))
    entries = landed(_keyed(shares, False).unionByName(_keyed(backoffs, True)), "toxic-model")
    small = None
    if entries.count() <= MODEL_ROWS:
        table = entries.toArrow()
        key = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        arrays = (key[order], *(table.column(c).to_numpy()[order] for c in COLUMNS))
        small = docs.sparkSession.sparkContext.broadcast(arrays)
    model = ToxicModel(entries, tuple(1 / (n + 1) for n in single), np.zeros(10), small)
    chosen = labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) == FOLDS - 1)
    chosen = chosen.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("mark"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # At most ``fit_rows`` ids and labels, so the broadcast is bounded.
    sample = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = _document_features(sample.select(F.col("mark").cast("long").alias("doc_id"), "text"), model, 0).collect()
    features = np.array([row["features"] for row in found] or np.zeros((0, 3)))
    toxic = np.array([row["doc_id"] for row in found], float)
    return model._replace(weights=fit_weights(features, toxic))


class _Reader:
    """Features of texts by a model that is at hand; words are scored in lots and remembered up to a limit."""

    def __init__(self, arrays: tuple, which: int, floor: float, limit: int = 1 << 18) -> None:
        self.table, self.floor = (arrays[0], *arrays[1 + 2 * which : 3 + 2 * which]), floor
        self.limit, self.known = limit, {}

    def features(self, texts: list[str]) -> list[tuple[float, float, float]]:
        """Of several texts; their new words are scored together."""
        from collections import Counter

        counted = [Counter(text.lower().split()) for text in texts]
        new = [w for w in set().union(*counted) if w not in self.known]
        if len(self.known) + len(new) > self.limit:
            self.known, new = {}, list(set().union(*counted))
        for at in range(0, len(new), LOT_WORDS):
            lot = new[at : at + LOT_WORDS]
            self.known.update(zip(lot, word_scores(self.table, self.floor, lot).tolist()))
        known = self.known.__getitem__
        return [
            document_features(np.fromiter(map(known, c), np.float64, len(c)), np.fromiter(c.values(), np.int64, len(c)))
            for c in counted
        ]

    def of(self, column) -> list[tuple[float, float, float]]:
        """Of a column of texts, about 2 million characters or one text at a time; null is an empty text."""
        out, lot, chars = [], [], 0
        for text in column:
            lot.append(text.as_py() or "")
            chars += len(lot[-1])
            if chars >= 2_000_000:
                out += self.features(lot)
                lot, chars = [], 0
        return out + (self.features(lot) if lot else [])


def _document_features(docs: DataFrame, model: ToxicModel, which: int) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``features``) of documents (doc_id, text) by the model that fits (0) or scores (1)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model.small is None:
        bags = word_bags(docs)
        return _features(bags, _word_scores(bags, model, which), kind)
    small, floor = model.small, model.floors[which]

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        forget()
        reader = _Reader(small.value, which, floor)
        for batch in batches:
            features = pa.array([list(f) for f in reader.of(batch.column(2))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), features], ["doc_id", "text_hash", "features"])

    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return slim.mapInArrow(read, f"doc_id {kind}, text_hash long, features array<double>")


def _word_scores(bags: DataFrame, model: ToxicModel, which: int) -> DataFrame:
    """Written rows (``chunk``, ``scores``): scores of a chunk's words in their order, as bytes.

    Every word of the corpus is scored once. Words are dealt to lots; a lot asks for the model's entries of its grams by
    a shuffled join, so no task holds more of the model than its words need. The scores go to the chunks by
    a join on the word.
    """
    places = _vocabularies(bags).select("chunk", F.posexplode("words").alias("place", "word"))
    words = landed(places.groupBy("word").agg(F.lit(0).alias("_")).select("word"), "words")
    lots = 1 + words.count() // LOT_WORDS
    dealt = words.withColumn("lot", F.pmod(F.xxhash64("word"), F.lit(lots)))
    floor, pair = model.floors[which], _PAIRS[which]

    def spell(table):
        import pyarrow as pa

        keys = needed_keys(table.column("word").to_pylist())
        return pa.table([pa.repeat(table.column("lot")[0], len(keys)), pa.array(keys.view(np.int64))], ["lot", "key"])

    def rate(table, entries):
        import pyarrow as pa

        key = entries.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        values = [entries.column(c).to_numpy()[order] for c in pair]
        rated = word_scores((key[order], *values), floor, table.column("word").to_pylist())
        return pa.table([table.column("word"), pa.array(rated)], ["word", "score"])

    asked = dealt.groupBy("lot").applyInArrow(spell, "lot long, key long")
    found = asked.join(model.entries, "key").select("lot", "key", *pair)
    scored = dealt.groupBy("lot").cogroup(found.groupBy("lot")).applyInArrow(rate, "word string, score double")

    def gather(table):
        import pyarrow as pa

        order = np.argsort(table.column("place").to_numpy())
        rated = table.column("score").to_numpy()[order].tobytes()
        return pa.table([table.column("chunk").slice(0, 1), pa.array([rated], pa.binary())], ["chunk", "scores"])

    joined = places.join(scored, "word").select("chunk", "place", "score")
    return landed(joined.groupBy("chunk").applyInArrow(gather, "chunk long, scores binary"), "word-scores")


def _features(bags: DataFrame, scores: DataFrame, kind: str) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``features``) of the documents of :func:`word_bags`."""

    def read(table, chunk):
        import pyarrow as pa

        rated = np.frombuffer(chunk.column("scores")[0].as_py(), np.float64) if chunk.num_rows else np.zeros(1)
        found = []
        for wide, ids, times in zip(*(table.column(c).to_pylist() for c in ("wide", "ids", "times"))):
            found.append(list(document_features(rated[_numbers(wide, ids)], _numbers(wide, times))))
        features = pa.array(found, pa.list_(pa.float64()))
        return pa.table([table.column("doc_id"), table.column("text_hash"), features], ["doc_id", "text_hash", "features"])

    rows = bags.where("ids is not null").select("chunk", "wide", "ids", "times", "text_hash", "doc_id")
    dealt = rows.groupBy("chunk").cogroup(scores.groupBy("chunk"))
    return dealt.applyInArrow(read, f"doc_id {kind}, text_hash long, features array<double>")


def _scored(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``score``) of every row of ``docs``."""
    w = [float(x) for x in model.weights]
    z = F.lit(w[0])
    for i in range(3):
        z = z + (F.col("features")[i] - w[4 + i]) / w[7 + i] * w[1 + i]
    bounded = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))
    return _document_features(docs, model, 1).select("doc_id", "text_hash", (1 / (1 + F.exp(-bounded))).alias("score"))


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """(``doc_id``, ``score``) of every row of ``docs``: 0 to 1, higher if toxic is likelier.

    Texts are read whole, where they lie: with the whole model at hand if it has up to ``MODEL_ROWS`` entries, else as word
    numbers that are dealt to the scores of their words. Both give the same scores. Null and empty texts have no words and
    get the score of none.
    """
    return _scored(docs, model).select("doc_id", "score")


def drop_toxic(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` without those that score 0.5 or more; columns, of any names, and texts of the others stay as they are.

    A model at hand filters rows where they lie. Otherwise the rejected ones are told by id and a hash of the text, and texts
    are moved where Spark finds the rejected too many to send to all tasks.
    """
    if model.small is not None:
        small, floor, weights = model.small, model.floors[1], model.weights
        at = docs.columns.index("text")

        def keep(batches: Iterator) -> Iterator:
            import pyarrow as pa

            forget()
            reader = _Reader(small.value, 1, floor)
            for batch in batches:
                kept = batch.filter(pa.array([probability(weights, f) < 0.5 for f in reader.of(batch.column(at))], pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, columns)

        columns = docs.columns
        return docs.toDF(*[f"c{i}" for i in range(len(columns))]).mapInArrow(keep, docs.schema)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rejected = landed(_scored(docs, model).where("score >= 0.5").select("doc_id", "text_hash").distinct(), "rejected")
    gone = rejected.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("_row.text")) == F.col("_hash"))
    return packed.join(gone, same, "left_anti").select("_row.*")
