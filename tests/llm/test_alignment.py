from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ferrytab.llm import alignment
from ferrytab.llm.queries import QUERIES, alignment_tokenizers

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def loaded():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = alignment_tokenizers()
    first = Tokenizer.from_str(a)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_proto=b)


def spelled(entry):
    """Bytes of a byte-level entry, one character at a time."""
    out = []
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    for c in entry:
        out.append(hidden[ord(c) - 256] if ord(c) >= 256 else ord(c))
    return bytes(out)


def report(loaded, rows):
    """The whole result by plain loops over one document at a time."""
    first, second = loaded
    docs, counts = [], Counter()
    for key, text in rows:
        a = b = []
        if text:
            a = [(i, spelled(first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
            b = [
                (i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode())
                for i in second.encode(text)
                for p in [second.id_to_piece(i)]
            ]
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a = b = []
        ends = []
        for side in (a, b):
            at, found = 0, []
            for i, data in side:
                at += len(data)
                found.append((at, i))
            ends.append(found)
        common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        links = [(x, y) for e in common for f, x in ends[0] if f == e for g, y in ends[1] if g == e]
        counts.update(links)
        groups, last = [], 0
        for e in common:
            groups.append("|".join(",".join(str(i) for f, i in side if last < f <= e) for side in ends))
            last = e
        docs.append((key, len(a), len(b), len(common), links, ";".join(groups)))
    highest = Counter()
    for (x, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (key, n_a, n_b, n, len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), g)
        for key, n_a, n_b, n, links, g in docs
    ]


TEXTS = [
    (1, "A plain line of text, twice: plain line."), (2, None), (3, ""), (4, "<|endoftext|> and <s> </s> <unk> <0x41>"),
    (5, "  two  spaces \n\n\ttabs and 　wide"), (6, "holds ▁ itself"), (7, "naïve 你好 \U0001f600\U0001f468‍\U0001f469 café ก"),
    (8, "x"), (9, " "), (None, "A plain line of text, twice: plain line."), (1, "A plain line of text, twice: plain line."),
    (10, "nul \x00 and \x01 \x7f"), (11, "word " * 3_000),
]


@pytest.mark.parametrize("part, lot", [(1 << 19, 1 << 22), (40, 90)])
def test_against_loops(session, frame, loaded, monkeypatch, part, lot):
    monkeypatch.setattr(alignment, "PART_CHARS", part)
    monkeypatch.setattr(alignment, "LOT_CHARS", lot)
    docs = frame(TEXTS)
    for name in ("lot", "pair", "n", "groups", "_b"):
        docs = docs.withColumn(name, F.lit(1))
    got = alignment.alignment_report(docs, *alignment_tokenizers())
    assert got.columns == NAMES
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted(report(loaded, TEXTS), key=str)
    zeros = {r[0] for r in rows if r[1:] == (0, 0, 0, 0, 0, 0, "")}
    assert {2, 3, 6} <= zeros and not {1, 4, 5, 7} & zeros


def test_both_libraries_give_the_same_ids(loaded, sf_dir):
    import json

    import pyarrow.parquet as pq

    a, b = alignment_tokenizers()
    pair = alignment._Pair(a, b)
    assert pair.quick is not None
    texts = [t for t in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].to_pylist() if t]
    lots = [range(start, start + 64) for start in range(0, 0x110000, 64 * 7)]
    texts += ["".join(f"a{chr(c)}b1{chr(c)} " for c in lot if not 0xD800 <= c < 0xE000) for lot in lots]
    texts += ["x" * 50_000, " " * 5_000 + "\n" * 500 + "y", "ab" * 20_000, "<|endoftext|>" * 50]
    for text, ids in zip(texts, pair.encode_a(texts)):
        assert ids.tolist() == loaded[0].encode(" " + text, add_special_tokens=False).ids
    other = json.loads(a)
    other["pre_tokenizer"]["add_prefix_space"] = True
    assert alignment._quick_form(other, {}) is None
    other = json.loads(a)
    other["model"]["merges"][:2] = other["model"]["merges"][1::-1]
    assert alignment._quick_form(other, {}) is None


def test_empty_table(session, frame):
    assert alignment.alignment_report(frame([]), *alignment_tokenizers()).count() == 0
    only = alignment.alignment_report(frame([(1, None), (2, "")]), *alignment_tokenizers()).collect()
    assert sorted(map(tuple, only)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query(session, sf_dir, loaded):
    rows = [tuple(r) for r in session.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:-1], sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in report(loaded, rows)]
    got = QUERIES["op12_alignment"](session, sf_dir)
    assert got.columns == [*NAMES[:-1], "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
