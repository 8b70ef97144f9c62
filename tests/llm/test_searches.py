import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrytab.llm import ann, topk
from ferrytab.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def table(session, vectors):
    return session.createDataFrame([(i, v) for i, v in vectors], SCHEMA)


def exact(vectors, is_query, k, change):
    """{query: [(rank, id, score)]} by comparing all, of the vectors that take part."""
    ids = np.array([i for i, _ in vectors])
    x = change(np.array([v for _, v in vectors], np.float32).astype(np.float64))
    out = {}
    for q in np.flatnonzero([is_query(i) for i in ids]):
        scores = x @ x[q]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(r + 1, int(ids[i]), scores[i]) for r, i in enumerate(order)]
    return out


def gathered(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def vectors(n, dim=12, hot=0, scale=1.0, seed=0):
    chance = np.random.default_rng(seed)
    x = chance.standard_normal((n, dim)) * chance.uniform(0.1, scale, (n, 1))
    x[:hot] = x[0]
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("hot, scale", [(0, 1.0), (600, 1.0), (0, 50.0)])
def test_exact_search(session, monkeypatch, hot, scale):
    monkeypatch.setattr(topk, "BLOCK", 128)
    rows = vectors(1_500, hot=hot, scale=scale)
    got = topk.top_products(table(session, rows), F.col("vec_id") % 50 == 0, 5).collect()
    want = exact(rows, lambda i: i % 50 == 0, 5, lambda x: np.floor(256 * x))
    assert gathered(got) == {q: [(r, i, int(s)) for r, i, s in found] for q, found in want.items()}


def test_coordinate_pruning_keeps_what_reaches_the_cosine():
    chance = np.random.default_rng(1)
    for _ in range(200):
        x = chance.standard_normal((200, 4))
        q = x[0] + 0.1 * chance.standard_normal(4)
        lengths = np.linalg.norm(x, axis=1)
        cosines = x @ q / lengths / np.linalg.norm(q)
        for t in (0.75, 0.9, 0.99):
            assert set(np.flatnonzero(cosines >= t)) <= set(topk.survivors(q, x, lengths, t))


def test_products_beyond_doubles_are_exact():
    a = np.array([[float(1 << 30), 1.0, 3.0]])
    assert topk.products(a, a)[0, 0] == (1 << 60) + 10


def test_odd_vectors_take_no_part_in_either_search(session):
    odd = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (None, [1.0, 1.0]),
           (6, [2.0]), (20, [0.0, 0.0]), (0, [1.0, 2.0])]
    rows = table(session, odd).withColumn("length", F.lit(1))
    found = gathered(topk.top_products(rows, F.col("vec_id") % 50 == 0, 5).collect())
    assert found == {0: [(1, 6, 2 * 256 * 256), (2, 5, 0), (3, 20, 0)]}
    found = gathered(ann.nearest(rows, F.col("vec_id") % 20 == 0, 20).collect())
    assert found == {0: [(1, 6, 2.0)]}
    none = table(session, [])
    assert topk.top_products(none, F.col("vec_id") >= 0, 5).count() == 0
    assert ann.nearest(none, F.col("vec_id") >= 0, 20).count() == 0


def test_chi_square_limit():
    assert abs(ann.chi_square_limit(0.95) - 15.507) < 1e-3


@pytest.mark.parametrize("hot", [0, 700])
def test_recall(session, monkeypatch, hot):
    monkeypatch.setattr(ann, "CELL_ROWS", 200)
    monkeypatch.setattr(ann, "BLOCK", 128)
    rows = vectors(2_000, dim=24, hot=hot, scale=2.0)
    got = gathered(ann.nearest(table(session, rows), F.col("vec_id") % 20 == 0, 20).collect())
    want = exact(rows, lambda i: i % 20 == 0, 20, lambda x: x)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    scores = {(q, i): s for q in want for _, i, s in want[q]}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - scores.get((q, i), s)) < 1e-9 for _, i, s in found)


def test_queries(session, sf_dir):
    rows = [tuple(r) for r in session.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = exact(rows, lambda i: i % 50 == 0, 5, lambda x: np.floor(256 * x))
    got = gathered(QUERIES["op5_top_products"](session, sf_dir).collect())
    assert got == {q: [(r, i, int(s)) for r, i, s in found] for q, found in want.items()}
    want = exact(rows, lambda i: i % 20 == 0, 20, lambda x: x)
    got = gathered(QUERIES["op2_nearest"](session, sf_dir).collect())
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_blocks_of_a_cell_are_merged_in_the_task(session):
    """A query leaves a task with ``k`` rows per cell, however many candidate blocks the cell has."""
    chance, turn = np.random.default_rng(4), ann.projection(6, 20)
    x = chance.standard_normal((640, 6))
    most = float((x * x).sum(axis=1).max())

    def block(ids, lifted):
        lift = np.sqrt(np.maximum(most - (x[ids] ** 2).sum(axis=1), 0.0)) if lifted else np.zeros(len(ids))
        return (np.array(ids, np.int64).tobytes(), x[ids].tobytes(), len(ids), ann._projected(x[ids], lift, turn).tobytes())

    queries = [block(range(0, 20), False), block(range(20, 30), False)]
    candidates = [block(range(at, at + 64), True) for at in range(0, 640, 64)]
    rows = [(cell, *q, *(bytearray(v) if isinstance(v, bytes) else v for v in c)) for cell in (0, 1) for c in candidates for q in queries]
    schema = "cell long, ids binary, data binary, n long, projected binary, c_ids binary, c_data binary, c_n long, c_projected binary"
    rows = [tuple(bytearray(v) if isinstance(v, bytes) else v for v in row) for row in rows]
    pairs = session.createDataFrame(rows, schema).coalesce(1)
    found = ann._verified(pairs, most, 1e9, 5).collect()
    assert len(found) == 2 * 30 * 5
    scores = x[:30] @ x.T
    scores[np.arange(30), np.arange(30)] = -np.inf
    want = {(q, int(v)) for q in range(30) for v in np.argsort(-scores[q])[:5]}
    assert {(r["query_id"], r["vec_id"]) for r in found} == want


def test_no_side_of_the_search_is_broadcast(session, monkeypatch):
    """Copies of the queries are many times the table they are made of, by whose size a join would choose."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "GROUP", 1)
    monkeypatch.setattr(topk, "_groups", lambda blocks, asked, tasks: blocks)
    plans, real = [], topk._searched
    monkeypatch.setattr(topk, "_searched", lambda pairs, k: plans.append(pairs) or real(pairs, k))
    rows = vectors(300)
    got = topk.top_products(table(session, rows), F.col("vec_id") % 10 == 0, 5).collect()
    want = exact(rows, lambda i: i % 10 == 0, 5, lambda x: np.floor(256 * x))
    assert gathered(got) == {q: [(r, i, int(s)) for r, i, s in found] for q, found in want.items()}
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan


def test_copies_of_the_queries_grow_with_the_table():
    groups = [topk._groups(n, n / 50, 32) for n in (1, 8, 400, 600, 2_400)]
    assert groups == [1, 1, 50, 50, 50] and topk._groups(0, 0, 32) == 1
    assert topk._groups(64_000, 1_280, 32) == 1_000  # no task holds more than a bounded number of blocks
    assert topk._groups(600, 600, 32) == 32
