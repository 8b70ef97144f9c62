import random

import pytest
from pyspark.sql import functions as F

from ferrytab.llm.passages import drop_repeats
from ferrytab.llm.queries import QUERIES


def brute(rows, size=20):
    """Words, removed words and kept text by doc_id, null last."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out[key] = (len(words), sum(gone), kept)
    return out


def found(docs):
    rows = drop_repeats(docs, ["doc_id"]).collect()
    assert all(r["n_removed"] == sum(b - a for a, b in r["spans"]) for r in rows)
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_shared_passages(frame, seed):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(6 if seed == 2 else 400)]
    passages = [chance.choices(words, k=chance.randrange(15, 60)) for _ in range(8)]
    rows = []
    for key in range(60):
        text = []
        for _ in range(chance.randrange(5)):
            text += chance.choice(passages) if chance.random() < 0.6 else chance.choices(words, k=chance.randrange(30))
        rows.append((key, " ".join(text)))
    assert found(frame(rows)) == brute(rows)


def test_repeats_within_a_document_and_odd_white_space(frame):
    text = "\t".join(f"v{i}" for i in range(25)) + " x\n" + " ".join(f"v{i}" for i in range(25))
    rows = [(1, text), (2, text.replace("\t", "  ")), (None, text), (3, None), (4, ""), (5, "few words")]
    assert found(frame(rows)) == brute(rows)


def test_many_copies_and_a_long_text(frame):
    long = " ".join(f"t{i % 5_000}" for i in range(40_000))
    rows = [(i, " ".join(f"c{j}" for j in range(30))) for i in range(300)] + [(1_000, long)]
    assert found(frame(rows)) == brute(rows)


def test_repeated_rows_clashing_columns_and_no_rows(frame):
    text = " ".join(f"r{i}" for i in range(30))
    docs = frame([(7, text), (7, text), (8, text)]).withColumn("n_words", F.lit(1)).withColumn("window", F.lit(1))
    rows = sorted((r["doc_id"], r["n_removed"]) for r in drop_repeats(docs, ["doc_id"]).collect())
    assert rows == [(7, 0), (7, 0), (8, 30)]
    assert found(frame([])) == {}


def test_query(session, sf_dir):
    texts = [tuple(r) for r in session.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = {k: v[:2] for k, v in brute(texts).items()}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in QUERIES["op6_passages"](session, sf_dir).collect()}
    assert got == want
