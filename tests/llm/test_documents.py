"""Line dedup, mixing, toxicity and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrytab.llm import lines, mixing, toxicity
from ferrytab.llm.common import read
from ferrytab.llm.queries import QUERIES


def cleaned(rows, least=5):
    """(doc_id, lines, dropped lines, text) by brute force."""

    def templates(line):
        tokens = re.findall(rb"[^\x20\x09-\x0d]+", line)
        n = len(tokens)
        if n == 0:
            return set()
        wild = [b"<*>" if re.search(rb"[0-9]", t) else t for t in tokens]
        made = [wild]
        if n >= 9:  # one third at a time of what follows the leading three
            for a, b in ((0, 1), (1, 2), (2, 3)):
                low, high = 3 + (n - 3) * a // 3, 3 + (n - 3) * b // 3
                made.append([b"<*>" if low <= i < high else t for i, t in enumerate(wild)])
        # The line as it stands always counts, a generalised one if half of its tokens are constant.
        return {tuple(tokens)} | {tuple(t) for t in made if 2 * t.count(b"<*>") <= n}

    order = lambda key: (key is None, key or 0)
    docs = defaultdict(list)
    for key, text in rows:
        for template in {t for line in (text or "").encode().split(b"\n") for t in templates(line)}:
            docs[template].append(order(key))
    out = []
    for key, text in rows:
        kept = [
            line
            for line in (text or "").split("\n")
            if not any(len(docs[t]) >= least and min(docs[t]) < order(key) for t in templates(line.encode()))
        ]
        n = len(text.split("\n")) if text else 0
        out.append((key, n, n - len(kept) if text else 0, "\n".join(kept) if text else text))
    return sorted(out, key=str)


def dropped(docs):
    rows = lines.drop_template_lines(docs).select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted(map(tuple, rows), key=str)


def test_recurring_templates_go(frame):
    chance = random.Random(4)
    rows = []
    for key in range(40):
        body = [" ".join(chance.choices("alpha beta gamma delta eps zeta".split(), k=chance.randrange(12))) for _ in range(4)]
        body += [f"Page {key} of {chance.randrange(90)} pages", "Posted by the user " + chance.choice("xyzuvw") * 4 + " on a sunny day in May"]
        chance.shuffle(body)
        rows.append((key, "\n".join(body)))
    rows += [(None, "Page 1 of 2 pages\nown line of text"), (50, None), (51, ""), (52, "\n\n"), (3, rows[3][1])]
    found = dropped(frame(rows))
    assert found == cleaned(rows)
    assert sum(r[2] for r in found) > 60
    assert dropped(frame([])) == []


def test_short_lines_and_lines_of_numbers_go(frame):
    rows = [(k, f"Read more\n2024-01-05 10:30 +44 20 7946 0000\nLogin\n\u8bf7\u767b\u5f55\n{k}.5 {k}7 {k}9\nown{chr(97 + k)}") for k in range(6)]
    found = {r["doc_id"]: r["text"] for r in lines.drop_template_lines(frame(rows)).collect()}
    assert found[0] == rows[0][1]
    for k in range(1, 6):
        assert found[k] == f"{k}.5 {k}7 {k}9\nown{chr(97 + k)}"


def test_line_query(session, sf_dir):
    rows = [tuple(r) for r in read(session, sf_dir, "documents").select("doc_id", "text").collect()]
    got = sorted((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in QUERIES["op1_line_dedup"](session, sf_dir).collect())
    assert got == sorted(r[:3] for r in cleaned(rows))


def targets_of(sizes, weights=(1, 2, 3)):
    """Targets by sharing and resharing until none is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def mixed(docs):
    return mixing.mix(docs, ["doc_id", "source"]).collect()


def test_targets_and_taken_words(frame):
    chance = random.Random(2)
    rows = [(i, " ".join(["w"] * chance.randrange(1, 60)), chance.choice(["a", "B", "ü", None, "tiny"][: 4 + (i == 0)])) for i in range(400)]
    rows += [(900, None, "a"), (901, "", "nothing"), (902, "only", "tiny"), (5, rows[5][1], rows[5][2])]
    got = mixed(frame(rows))
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = targets_of(sizes)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["times"] <= 3
        taken[r["source"]] += r["size"] * r["times"]
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 1
    again = mixed(frame(rows[::-1]).repartition(5))
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixed(frame([])) == []


def test_a_hot_length_is_cut_in_parts(frame, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 16)
    rows = [(i, "five words are in here", "a") for i in range(500)] + [(1_000 + i, "x y z", "b") for i in range(300)]
    taken = Counter()
    for r in mixed(frame(rows)):
        taken[r["source"]] += r["size"] * r["times"]
    assert abs(taken["a"] - 3_400 / 3) <= 5 and abs(taken["b"] - 3_400 * 2 / 3) <= 3


@pytest.mark.parametrize("seed", range(5))
def test_knapsack_reaches_the_best_sum(seed):
    chance = random.Random(seed)
    counts = [(size, chance.randrange(1, 4)) for size in chance.sample(range(3, 30), 4)]
    total = sum(s * n for s, n in counts)
    sums = {0}
    for size, n in counts:
        sums = {a + size * k for a in sums for k in range(n + 1)}
    for budget in range(0, total, 7):
        taken = mixing._knapsack({s: 0 for s, _ in counts}, counts, budget, 4_096)
        assert all(taken[s] <= n for s, n in counts)
        assert sum(s * k for s, k in taken.items()) == max(x for x in sums if x <= budget)
    assert combinations_with_replacement  # keeps the budget's sums readable above


def test_few_long_documents_meet_their_budget():
    assert mixing.fit_counts([(7_000, 1), (6_500, 1), (5_500, 1)], 12_000) == {7_000: 0, 6_500: 1, 5_500: 1}
    chance = random.Random(3)
    for _ in range(20):
        counts = [(size, chance.randrange(1, 4)) for size in chance.sample(range(3_000, 20_000), 4)]
        sums = {0}
        for size, n in counts:
            sums = {a + size * k for a in sums for k in range(n + 1)}
        budget = chance.randrange(1, max(sums))
        taken = mixing.fit_counts(counts, budget)
        assert all(0 <= taken[s] <= n for s, n in counts)
        assert sum(s * k for s, k in taken.items()) == max(x for x in sums if x <= budget)


@pytest.mark.parametrize("dealt", [False, True])
def test_toxicity_on_held_out_documents(session, frame, monkeypatch, dealt):
    if dealt:  # as with a model and labels too large for every task
        for name, value in (("MODEL_ROWS", 0), ("LABEL_ROWS", 0), ("CHUNK_CHARS", 4_000), ("LOT_WORDS", 20)):
            monkeypatch.setattr(toxicity, name, value)
    chance = random.Random(6)
    usual, bad = [f"plain{i}" for i in range(60)], ["vilewretch", "foulmouthed", "scumbagger"]
    rows, marks = [], []
    for key in range(900):
        words, toxic = chance.choices(usual, k=chance.randrange(5, 60)), int(key % 4 == 0)
        if toxic:
            words[chance.randrange(len(words))] = chance.choice(bad).upper()
        rows.append((key, " ".join(words)))
        marks.append((key, 1, toxic))
    marks += [(None, 1, 1), (2, 1, None)]
    labels = session.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = frame([*rows, (5_000, ""), (5_001, None), (None, "plain1 plain2")])
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs.withColumn("features", F.lit(0)), model).collect()
    assert len(found) == 903 and all(0 <= r["score"] <= 1 for r in found)
    truth = {k: t for k, _, t in marks if t is not None}
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] in truth]
    assert np.mean([(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in held]) > 0.99
    assert all(r["score"] < 0.5 for r in found if r["doc_id"] in (5_000, 5_001, None))
    clashing = docs
    for name in ("_id", "_hash", "_row", "_chunk", "chunk", "features", "a.b"):
        clashing = clashing.withColumn(name, F.lit(1))
    kept = toxicity.drop_toxic(clashing, model)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found if r["score"] < 0.5}
    assert kept.count() == sum(r["score"] < 0.5 for r in found)
    assert toxicity.score(frame([]), model).count() == toxicity.drop_toxic(frame([]), model).count() == 0
    long = frame([(1, "plain1 " * 60_000 + "x" * 90_000), (1, "plain1"), (1, "plain1")])
    assert toxicity.score(long, model).count() == 3


def test_toxicity_without_labels(session, frame):
    model = toxicity.train(frame([(1, "one")]), session.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] < 0.5 for r in toxicity.score(frame([(1, "one"), (2, None)]), model).collect()] == [True, True]


def test_scores_are_probabilities_of_characters():
    """With everything in one table, the shares of a context and its backoff sum to one."""
    h = toxicity._hashes(np.array([97, 98, 97, 98], np.uint64), 2)
    assert h[0] == h[2] != h[1]


def kneser_ney(docs):
    """The share of every gram and the weight of every context by class, and the floor, in plain Python over (text, toxic)."""
    top = defaultdict(lambda: [0, 0])
    for text, toxic in docs:
        for word in text.lower().split():
            if word := re.sub(r"[\W_]+", "", word):
                padded = "\x02" + word + "\x03"
                for i in range(2, len(padded) + 1):
                    top[padded[max(0, i - 5) : i]][1 - toxic] += 1
    level, shares, weights = {g: n for g, n in top.items() if len(g) == 5}, {}, {}
    for size in range(5, 0, -1):
        if size < 5:
            lower = defaultdict(lambda: [0, 0])
            for g, n in level.items():
                for y in (0, 1):
                    lower[g[1:]][y] += 1 if size <= 2 else n[y] > 0
            for g, n in top.items():
                if len(g) == size:
                    for y in (0, 1):
                        lower[g][y] += sum(n) if size == 2 else n[y]
            level = dict(lower)
        whole, kinds = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for g, n in level.items():
            for y in (0, 1):
                whole[g[:-1]][y] += n[y]
                kinds[g[:-1]][y] += n[y] > 0
        for g, n in level.items():
            shares[g] = [max(n[y] - 0.75, 0) / whole[g[:-1]][y] if whole[g[:-1]][y] else 0 for y in (0, 1)]
        for c in whole:
            weights[size, c] = [0.75 * kinds[c][y] / whole[c][y] if whole[c][y] else 1 for y in (0, 1)]
    return shares, weights, 1 / (len(level) + 1)


def features_by_hand(model, text):
    shares, weights, floor = model
    scores = []
    for word in text.lower().split():
        padded, total = "\x02" + re.sub(r"[\W_]+", "", word) + "\x03", 0.0
        for i in range(1, len(padded)):
            p = [floor, floor]
            for size in range(1, min(i + 1, 5) + 1):
                gram = padded[i + 1 - size : i + 1]
                p = [shares.get(gram, (0, 0))[y] + weights.get((size, gram[:-1]), (1, 1))[y] * p[y] for y in (0, 1)]
            total += np.log(max(p[0], 1e-30)) - np.log(max(p[1], 1e-30))
        scores.append(total / (len(padded) - 1) if len(padded) > 2 else 0.0)
    return toxicity.document_features(np.array(scores))


def test_no_gram_is_lost(session, frame, monkeypatch):
    """Scores follow the whole model, with far more grams than can lie in two million slots without a clash."""
    monkeypatch.setattr(toxicity, "fit_weights", lambda *_: np.array([0.0, 0.1, 0.1, 0.1, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0]))
    chance = random.Random(8)
    rows = [(key, " ".join("".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(20))) for key in range(700)]
    learnt = [(k, t) for k, t in rows if zlib.crc32(str(k).encode()) % 5 in (1, 2, 3)]
    labels = session.createDataFrame([(k, k % 2) for k, _ in learnt], "doc_id long, toxic int")
    model = toxicity.train(frame(rows), labels)
    by_hand = kneser_ney([(t, k % 2) for k, t in learnt])
    assert len(by_hand[0]) > 80_000
    found = dict(toxicity.score(frame(rows), model).collect())
    for key, text in rows:
        assert abs(found[key] - toxicity.probability(model.weights, features_by_hand(by_hand, text))) < 1e-9


def test_the_last_fold_counts_too(session, frame, monkeypatch):
    """Expressions of documents in fold 4 alone are in the model that scores, and fold 0 is in neither."""
    monkeypatch.setattr(toxicity, "fit_weights", lambda *_: np.array([0.0, 0.1, 0.1, 0.1, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0]))
    folds = {k: zlib.crc32(str(k).encode()) % 5 for k in range(100)}
    rows = [(k, ["heldword", "plain usual", "plain tale", "usual tale", "vilewretch" if k % 2 else "plain"][n]) for k, n in folds.items()]
    labels = session.createDataFrame([(k, k % 2) for k in folds], "doc_id long, toxic int")
    model = toxicity.train(frame(rows), labels)
    by_hand = kneser_ney([(t, k % 2) for k, t in rows if folds[k]])
    found = dict(toxicity.score(frame(rows), model).collect())
    for key, text in rows:
        assert abs(found[key] - toxicity.probability(model.weights, features_by_hand(by_hand, text))) < 1e-9


def test_pipeline(session, sf_dir):
    docs, columns = read(session, sf_dir, "documents"), corpus_pipeline.COLUMNS
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(session, docs, sf_dir).cache()
        counts.append(docs.count())
        if name == "line dedup":
            assert counts[-1] == counts[-2]
        if name.startswith(("toxicity", "n-gram")):
            assert docs.select(columns).exceptAll(before.select(columns)).count() == 0
        if not name.startswith("byte"):
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < counts[3] <= counts[1] <= counts[0]


def test_new_words_are_scored_in_lots(monkeypatch):
    """However many new words a lot of texts has, few are scored at once, and each gram is hashed once for its two uses."""
    words = [f"{chr(97 + i % 26)}word{i}" for i in range(500)]
    keys = toxicity.needed_keys(words)
    chance = np.random.default_rng(3)
    arrays = (keys, *chance.random((4, len(keys))))
    want = toxicity._Reader(arrays, 1, 1e-3).features([" ".join(words), words[7]])
    seen, hashed, score, hashes = [], [], toxicity.word_scores, toxicity._hashes
    monkeypatch.setattr(toxicity, "LOT_WORDS", 100)
    monkeypatch.setattr(toxicity, "word_scores", lambda table, floor, lot: seen.append(len(lot)) or score(table, floor, lot))
    monkeypatch.setattr(toxicity, "_hashes", lambda codes, size: hashed.append(size) or hashes(codes, size))
    got = toxicity._Reader(arrays, 1, 1e-3).features([" ".join(words), words[7]])
    assert np.allclose(got, want, rtol=0, atol=1e-9)
    assert seen == [100] * 5 and sorted(hashed) == [size for size in range(1, toxicity.ORDER + 1) for _ in range(5)]
