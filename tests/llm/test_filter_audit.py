from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from ferrytab.llm import filter_audit
from ferrytab.llm.filter_audit import TextTrie

LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    """Letters of the filters A to D that a text fails, by a character loop."""
    words = []
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words.append("")
        else:
            words[-1:] = [words[-1] + c] if words else [c]
    words = [w for w in words if w]
    out = "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
    return out + ("D" if any(c in "#$%&*|" for c in text) else "")


def brute(rows, labels):
    """Filters applied one after the other, for every order."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = defaultdict(list)
    for i, text, part in rows:
        marks = [(q, t) for j, q, t in labels if j == i and i is not None]
        bad = fails(text or "") + ("E" if i is not None and least[text or ""] < i else "")
        docs[part or ""].append((bad, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out, shapley = [], defaultdict(int)
    for part, have in docs.items():
        for order in map("".join, permutations("ABCDE")):
            left = have
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                failing = [d for d in have if letter in d[0]]
                shapley[part, letter] += len(gone)
                out.append((part, order, step, len(left), len(gone), len(failing) - len(gone),
                            sum(d[0] == letter for d in have), sum(d[1] for d in gone), sum(d[2] for d in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def texts():
    good = " ".join(f"word{i}" for i in range(60))
    same = " ".join(["same"] * 30 + [f"w{i}" for i in range(30)])
    return [good, same, good + " 100%", "Short AND LOUD", same.upper(), "", None, good + " tail", good[:100], "#"]


ROWS = [(i, t, s) for i, (t, s) in enumerate([(t, s) for s in ("a", "b", None, "") for t in texts()] * 3)]
ROWS += [(None, texts()[0], "a"), (None, None, None), (3, texts()[3], "a"), (7, texts()[0], "b"), (7, texts()[0], "b")]
MARKS = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 100, 3)] + [(0, 0, 0), (None, 1, 1), (6, None, None), (5_000, 1, 1)]


@pytest.mark.parametrize("chars", [1 << 24, 500])
def test_against_every_order(session, monkeypatch, chars):
    monkeypatch.setattr(filter_audit, "RANGE_CHARS", chars)
    monkeypatch.setattr(filter_audit, "MOST_RANGES", 3)
    docs = session.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(5)
    for name in ("part", "mask", "n", "slot", "good"):
        docs = docs.withColumn(name, F.lit(1))
    labels = session.createDataFrame(MARKS, LABELS).withColumn("mask", F.lit(1))
    got = filter_audit.audit(docs, labels)
    assert sorted(map(tuple, got.collect())) == brute(ROWS, MARKS)


def test_hot_text_and_long_texts(session):
    long = "x" * 300_000
    rows = [(i, "one text for a third of all rows", "a") for i in range(700)]
    rows += [(1_000 + i, long + str(i % 3), "a") for i in range(9)]
    docs = session.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = filter_audit.audit(docs, session.createDataFrame([], LABELS))
    assert sorted(map(tuple, got.collect())) == brute(rows, [])


def test_empty_table(session):
    none = session.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(none, session.createDataFrame([], LABELS)).count() == 0


def test_trie_holds_the_least_id_of_every_text():
    trie = TextTrie()
    texts_ = ["", "a", "ab", "abc", "abd", "b", "abcdef", "abcxef", "ab"]
    ends = [trie.insert(t, 10 - i) for i, t in enumerate(texts_)]
    assert [e.least for e in ends] == [10, 9, 2, 7, 6, 5, 4, 3, 2]
    assert ends[2] is ends[8] and len({id(e) for e in ends}) == 8
    assert all(len(run) > 0 for run, _ in trie.edges.values())
