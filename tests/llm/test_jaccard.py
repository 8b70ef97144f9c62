import random
import time
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrytab.llm import common, jaccard
from ferrytab.llm.queries import QUERIES


def sets_of(rows, size):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return out


def brute(rows, percent=85, size=4):
    """(doc_id, set size, component_id) of every row."""
    sets = sets_of(rows, size)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    names = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            names[root(i)] = min(names.get(root(i), key), key)
    return sorted(((k, len(sets[i]), names.get(root(i))) for i, (k, _) in enumerate(rows)), key=str)


def found(docs, **options):
    return sorted(map(tuple, jaccard.jaccard_components(docs, **options).collect()), key=str)


def noisy(chance, words, rate):
    return [chance.choice("abcdefgh") * 3 if chance.random() < rate else w for w in words]


@pytest.mark.parametrize("percent, size", [(85, 4), (80, 5)])
def test_near_copies(frame, percent, size):
    chance = random.Random(percent)
    rows = []
    for _ in range(12):
        base = [f"w{chance.randrange(3_000)}" for _ in range(chance.choice([3, 9, 14, 40, 120, 300]))]
        rows += [(len(rows) + i, " ".join(noisy(chance, base, chance.choice([0, 0.01, 0.03, 0.06])))) for i in range(12)]
    assert found(frame(rows), percent=percent, size=size) == brute(rows, percent, size)


def test_small_sets_at_the_border(frame):
    rows = [(n * 10 + k, " ".join(f"s{i}" for i in range(k, n + k))) for n in range(1, 30) for k in (0, 1)]
    assert found(frame(rows)) == brute(rows)
    assert found(frame(rows), percent=80, size=5) == brute(rows, 80, 5)


def test_region_recursion_is_exact():
    chance = np.random.default_rng(5)
    base = np.arange(60, dtype=np.uint64)
    for _ in range(30):
        sets = []
        for _ in range(25):
            swapped = chance.random(60) < chance.choice([0.02, 0.05, 0.09])
            sets.append(np.unique(np.where(swapped, chance.integers(100, 10_000, 60).astype(np.uint64), base)))
        rows = [set(s.tolist()) for s in sets]
        want = {(a, b) for a, b in combinations(range(25), 2) if 100 * len(rows[a] & rows[b]) >= 85 * len(rows[a] | rows[b])}
        links = {tuple(sorted(x)) for x in jaccard.region_links(sets)}
        assert links <= want and parts(links) == parts(want)


def parts(links, n=25):
    parent = list(range(n))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in links:
        parent[root(a)] = root(b)
    return [[root(a) == root(b) for b in range(n)] for a in range(n)]


def test_large_regions_in_cells(frame, monkeypatch):
    chance = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(noisy(chance, base, 0.03))) for i in range(60)]
    monkeypatch.setattr(jaccard, "REGION_ROWS", 10)
    assert found(frame(rows)) == brute(rows)


def test_left_out_contents_never_part_linked_sets():
    chance = np.random.default_rng(3)
    for percent in (80, 85):
        ends = jaccard._bounds(percent)
        for n in (12, 40, 90, 300, 2_000):
            for _ in range(20):
                common = chance.integers(1, 1 << 62, n).astype(np.uint64)
                more = n * 100 // percent - n  # so many may be in one of the sets only
                cut = chance.integers(0, more + 1)
                sides = np.split(chance.integers(1, 1 << 62, more).astype(np.uint64), [cut])
                a, b = (jaccard.bucket_contents(np.unique(np.append(common, x)), ends, percent) for x in sides)
                assert len(np.intersect1d(a[0], b[0])) > a[1] + b[1]


def test_nulls_ties_and_repeated_rows(frame):
    text = "one two three four five six seven"
    rows = [(5, text), (3, text.upper()), (3, text), (9, None), (8, ""), (2, "one"), (4, "One"), (None, "nobody knows"), (None, None)]
    assert found(frame(rows)) == brute(rows)
    assert found(frame([])) == []


def test_one_of_each_group_stays(frame):
    text = " ".join(f"k{i}" for i in range(50))
    near = text.replace("k49", "other")
    rows = [(4, near), (2, text), (2, text), (7, "something else"), (9, None), (9, None), (9, ""), (10, " \n"), (None, text)]
    rows += [(100 + i, text) for i in range(300)] + [(50, "Something else"), (6, near.upper())]
    kept = jaccard.keep_one_of_each(frame(rows), percent=80, size=5)
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([(2, text), (7, "something else"), (9, None), (9, ""), (10, " \n")], key=str)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_extra_columns_of_any_type_and_name_stay(frame):
    docs = frame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)])
    wide = docs.withColumns({c: F.create_map(F.lit("x"), "doc_id") for c in ("_own", "_row", "_order", "n", "root")})
    kept = jaccard.keep_one_of_each(wide, percent=80, size=5)
    assert kept.columns == wide.columns
    assert sorted((r["doc_id"], r["root"]["x"]) for r in kept.collect()) == [(1, 1), (3, 3)]


def test_query(session, sf_dir):
    rows = [tuple(r) for r in session.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op8_jaccard"](session, sf_dir).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("piece", [16, 1 << 17])
@pytest.mark.parametrize("size", [1, 4, 5])
def test_shingles_of_a_lot_are_those_of_each_text(monkeypatch, piece, size):
    monkeypatch.setattr(common, "PIECE", piece)
    chance = random.Random(size)
    texts = [None, "", " \n", "A", "a b", "a  B\tc", "x" * 300 + " " + "x" * 299 + " y\x0bz", "\xa0 \x1c a\x85b", "ab ba a b", "ba ab b a"]
    texts += [" ".join(chance.choice(["a", "bb", "C", "ccc dd"]) for _ in range(chance.randrange(12))) for _ in range(200)]
    coded = [None if t is None else t.encode() for t in texts]
    flat, sizes = jaccard.shingle_sets(coded, size)
    want = sets_of(enumerate(texts), size)
    assert sizes.tolist() == [len(s) for s in want]
    got = [set(x.tolist()) for x in jaccard._parts(flat, sizes)]
    assert [a == b for a, b in combinations(got, 2)] == [a == b for a, b in combinations(want, 2)]
    for percent in (80, 85):  # contents of a lot are those of each set
        ends = jaccard._bounds(percent)
        found, counts, spare = jaccard.contents_of(flat, sizes, ends, percent)
        for i, (one, part) in enumerate(zip(jaccard._parts(flat, sizes), jaccard._parts(found, counts))):
            alone, few = jaccard.bucket_contents(one, ends, percent)
            assert part.tolist() == alone.tolist() and spare[i] == few


def test_shingles_take_no_python_step_per_word():
    chance = random.Random(2)
    texts = [" ".join(f"{chance.randrange(1 << 40):x}" for _ in range(400)).encode() for _ in range(500)]
    jaccard.shingle_sets(texts)
    start = time.process_time()
    jaccard.shingle_sets(texts)
    took = time.process_time() - start
    start = time.process_time()
    for text in texts:
        for word in text.split():
            blake2b(word, digest_size=8).digest()
    assert took < time.process_time() - start
