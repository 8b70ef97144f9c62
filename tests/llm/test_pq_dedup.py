import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrytab.llm import pq_dedup

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, cosine=0.9):
    """{id: (links, component, kept)} by comparing all pairs of float vectors."""
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    near = (x @ x.T) / np.outer(norm, norm) >= cosine
    np.fill_diagonal(near, False)
    root = np.array(ids)
    while True:
        least = np.minimum(root, np.where(near, root[None], root.max()).min(axis=1))
        if (least == root).all():
            break
        root = least
    return {i: (int(n), int(r), i == r) for i, n, r in zip(ids, near.sum(axis=1), root)}


def got(session, rows, **extra):
    found = pq_dedup.near_duplicates(session.createDataFrame(rows, SCHEMA), **extra)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return {r[0]: tuple(r)[1:] for r in found.collect()}


def planted(n, dim, seed, hot=0):
    """Random vectors, chains and clusters about some of them, and ``hot`` different near copies of one."""
    chance = np.random.default_rng(seed)
    x = chance.standard_normal((n, dim))
    for i in range(0, n // 3):
        x[i] = x[n - 1 - i % 40] + chance.uniform(0.1, 0.6) * chance.standard_normal(dim)
    x[: n // 10] = x[n // 10 : 2 * (n // 10)]
    if hot:
        x[-hot:] = x[-1] + 0.15 * chance.standard_normal((hot, dim))
    order = chance.permutation(n)
    return [(int(i), v.tolist()) for i, v in zip(order, x * chance.uniform(0.5, 3, (n, 1)))]


@pytest.mark.parametrize("hot", [0, 600])
def test_against_all_pairs(session, monkeypatch, hot):
    for name, value in (("LIST_ROWS", 100), ("CELL_ROWS", 128), ("TOGETHER", 32)):
        monkeypatch.setattr(pq_dedup, name, value)
    rows = planted(1_800, 24, 3, hot)
    want, found = brute(rows), got(session, rows)
    assert found.keys() == want.keys()
    assert all(found[i][0] <= want[i][0] for i in want)  # none below the cosine
    links = sum(w[0] for w in want.values())
    assert sum(f[0] for f in found.values()) >= 0.98 * links > 0
    assert sum(found[i][1] == want[i][1] for i in want) >= 0.98 * len(want)
    for i, (_, component, kept) in found.items():
        assert kept == (i == component) and found[component][2]


def test_codes_leave_out_nothing_within_reach():
    chance = np.random.default_rng(5)
    x = chance.standard_normal((500, 10))
    x /= np.linalg.norm(x, axis=1)[:, None]
    fit = pq_dedup.Quantiser.fitted(x[:200], 4, 0.8)
    where = pq_dedup.nearest(x, fit.centres)
    for number in range(4):
        members = x[where == number]
        codes, error = fit.encode(members, np.full(len(members), number))
        reach = ((np.sqrt(0.4) + error) ** 2 + 1e-5).astype(np.float32)
        q, m = pq_dedup.candidates(fit.tables(x, number), codes, reach)
        assert set(zip(*np.nonzero(x @ members.T >= 0.8))) <= set(zip(q.tolist(), m.tolist()))
        assert len(q) < len(x) * len(members)


def test_hot_vector_and_copies(session):
    chance = np.random.default_rng(1)
    v, w = chance.standard_normal((2, 8)).tolist()
    rows = [(i, v) for i in range(900)] + [(i, w) for i in range(900, 910)] + [(5, v)]
    found = got(session, rows)
    assert all(found[i] == (899, 0, i == 0) for i in range(900))
    assert all(found[i] == (9, 900, i == 900) for i in range(900, 910))


def test_odd_vectors(session):
    odd = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []),
           (6, [0.0, 0.0]), (7, [2.0, 4.0]), (8, [1.0, 2.0, 0.1]), (None, [1.0, 2.0]), (9, [-1.0, -2.0])]
    rows = session.createDataFrame(odd, SCHEMA)
    for name in ("uid", "node", "v", "copies", "list", "cell", "root"):
        rows = rows.withColumn(name, F.lit(1))
    found = {r[0]: tuple(r)[1:] for r in pq_dedup.near_duplicates(rows).collect()}
    assert found == {
        0: (2, 0, True), 7: (2, 0, False), 8: (2, 0, False), 9: (0, 9, True), None: (0, None, False),
        **{i: (0, i, True) for i in (1, 2, 3, 4, 5, 6)},
    }
    assert pq_dedup.near_duplicates(session.createDataFrame([], SCHEMA)).count() == 0


def test_one_id_with_two_vectors_is_one_node(session):
    found = got(session, [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [0.1, 1.0])])
    assert found == {1: (2, 1, True), 2: (1, 1, False), 3: (1, 1, False)}
