import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ferrytab.llm import bpe
from ferrytab.llm.queries import QUERIES, tokenizer

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokens(session):
    return bpe.read_ranks(session, PATH)


@pytest.fixture(scope="module")
def encoder(tokens):
    return bpe.Encoder(tokens, bpe.PerfectHash(tokens), bpe.newer_letters(), public_tokenizers.PATTERN)


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5_000)]
    index = bpe.PerfectHash(keys)
    assert sorted(index.slot(k) for k in keys) == list(range(len(keys)))
    assert all(keys[index.value[index.slot(k)]] == k for k in keys)


@pytest.mark.parametrize("keys", [[], [b"one"], [b"a", b"b"]])
def test_perfect_hash_of_few_keys(keys):
    index = bpe.PerfectHash(keys)
    assert [keys[index.value[index.slot(k)]] for k in keys] == keys


def test_encodes_like_the_library(encoder, library):
    chance = random.Random(3)
    pool = "aAé  \n\t\x1c\x85 'sdll10²½.,!?日本اกि\U0001f600" + chr(0x558) + chr(0x11DE1) + chr(0x3000) + chr(0x301)
    for _ in range(2_000):
        text = "".join(chance.choice(pool) for _ in range(chance.randrange(60)))
        ids = encoder.encode(text).tolist()
        assert ids == library.encode_ordinary(text), text
        assert b"".join(encoder.tokens[i] for i in ids) == text.encode()


def test_very_long_pre_tokens(encoder, library):
    text = "a" * 50_000 + " " * 3_000 + "é" * 2_000
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_query_over_all_documents(session, sf_dir, library):
    texts = dict(session.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op4_byte_bpe"](session, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_empty_and_repeated_rows(session, frame):
    docs = frame([(None, None), (1, ""), (2, "two words"), (2, "two words")]).withColumn("ids", F.lit("clash"))
    rows = bpe.encode_digests(docs, tokenizer(session)).collect()
    assert sorted(r["n_tokens"] for r in rows)[:2] == [0, 0]
    assert len(rows) == 4 and len({r["ids_sha256"] for r in rows}) == 2
    assert bpe.encode_digests(frame([]), tokenizer(session)).count() == 0
