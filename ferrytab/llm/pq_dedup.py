"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table lookups, exact rerank.

A vector lies in the list of its nearest coarse centroid; what the centroid leaves over is cut into short pieces, each
written as the number of its nearest code. A query visits the lists that a vector near it may lie in, sums
squared distances from small tables by these numbers, and compares exactly where the sum allows a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import landed
from ferrytab.llm.graph import components
from ferrytab.llm.vectors import blocks, length, matrix, unpacked, usable

#: Two vectors are linked from this cosine on.
COSINE = 0.9
#: Vectors on which centroids and codes are fitted (about; drawn by a hash), and rounds of that.
SAMPLE, ROUNDS = 8_192, 12
#: Vectors that a list should hold, most lists, components of a piece, and codes of a piece.
LIST_ROWS, MOST_LISTS, PIECE, CODES = 2_048, 1_024, 4, 256
#: A query visits a list if a partner in it needs a turn towards it of at most so many standard deviations.
PROBE = 3.0
#: Members and queries of one cell, queries looked up together, and pieces summed before rows are left out.
CELL_ROWS, TOGETHER, DENSE = 4_096, 256, 6


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """At most ``k`` centroids of the points; a centroid that loses all its points stays where it was."""
    chance = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[chance.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        some = counts > 0
        centres[some] = sums[some] / counts[some, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1)[None] - 2 * points @ centres.T, axis=1)


class Quantiser:
    """Coarse centroids and the codes of every piece of a residual."""

    def __init__(self, centres: np.ndarray, codes: list[np.ndarray], limit: float) -> None:
        self.centres, self.codes, self.dim = centres, codes, centres.shape[1]
        self.cuts = [min(i * PIECE, self.dim) for i in range(len(codes) + 1)]
        gaps = centres[:, None] - centres[None]
        self.apart = np.sqrt((gaps * gaps).sum(axis=2))
        # Of a partner at the cosine ``limit``, the part across the query over the part along it, in one direction.
        self.turn = np.sqrt(max(0.0, 1 - limit * limit)) / limit / np.sqrt(max(1, self.dim))

    @classmethod
    def fitted(cls, sample: np.ndarray, lists: int, limit: float) -> Quantiser:
        if not len(sample):
            sample = np.zeros((1, max(1, sample.shape[1])))
        centres = kmeans(sample, lists)
        rest = sample - centres[nearest(sample, centres)]
        cuts = list(range(0, sample.shape[1], PIECE)) + [sample.shape[1]]
        pieces = [kmeans(rest[:, a:b], CODES, seed=i + 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        return cls(centres, pieces, limit)

    def encode(self, unit: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distance between each vector and what its codes stand for."""
        rest = unit - self.centres[lists]
        codes = np.empty((len(unit), len(self.codes)), np.uint8)
        error = np.zeros(len(unit))
        for i, table in enumerate(self.codes):
            part = rest[:, self.cuts[i] : self.cuts[i + 1]]
            codes[:, i] = at = nearest(part, table)
            error += ((part - table[at]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)

    def visits(self, unit: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Which lists below its own each vector visits.

        The plane between two centroids parts their lists. A partner is the query's own direction and a turn across
        it; a turn of random direction has about a normal part across the plane, and ``PROBE`` of
        its standard deviations are allowed for.
        """
        squares = (self.centres * self.centres).sum(axis=1)
        far = squares[None] - 2 * unit @ self.centres.T
        margin = far - far[np.arange(len(unit)), lists][:, None]  # twice the distance to the plane times the gap
        reach = 2 * PROBE * self.turn * self.apart[lists]
        return (margin <= reach) & (np.arange(len(self.centres))[None] < lists[:, None])

    def tables(self, unit: np.ndarray, number: int) -> list[np.ndarray]:
        """Squared distances of each query's residual to every code, piece by piece."""
        rest = unit - self.centres[number]
        out = []
        for i, table in enumerate(self.codes):
            part = rest[:, self.cuts[i] : self.cuts[i + 1]]
            squares = (part * part).sum(axis=1)[:, None] + (table * table).sum(axis=1)[None] - 2 * part @ table.T
            out.append(np.maximum(squares, 0.0).astype(np.float32))
        return out


def candidates(tables: list[np.ndarray], codes: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, member) whose summed table entries are within the member's ``reach`` (squared)."""
    dense = min(DENSE, len(tables))
    total = tables[0][:, codes[:, 0]]
    for i in range(1, dense):
        total += tables[i][:, codes[:, i]]
    q, m = np.nonzero(total <= reach[None])
    total = total[q, m]
    for i in range(dense, len(tables)):
        total = total + tables[i][q, codes[m, i]]
        stays = total <= reach[m]
        if not stays.all():
            q, m, total = q[stays], m[stays], total[stays]
    return q, m


def join_sets(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (every node's root) after the sets of each pair of nodes are one; a root is its set's smallest node."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]


class _Rows:
    """Packed vectors put together: row numbers, nodes, copies, vectors, and for members codes and errors."""

    def __init__(self, table, dim: int, pieces: int) -> None:
        def column(name, kind):
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        self.uid, self.node, self.copies = (column(c, np.int64) for c in ("uid", "node", "copies"))
        self.v = column("data", np.float64).reshape(len(self.uid), dim)
        self.codes = column("codes", np.uint8).reshape(len(self.uid), pieces) if pieces else None
        self.error = column("error", np.float64)
        self.norm = np.sqrt((self.v * self.v).sum(axis=1))
        self.unit = self.v / self.norm[:, None]


def search_cell(fit: Quantiser, number: int, members: _Rows, queries: _Rows, own: bool, cosine: float):
    """(``uid``, ``links``, ``node``, ``root``) of the rows of a cell that have a link in it.

    ``own``: queries and members are the same rows, so a pair counts from the row with the larger number only.
    ``root`` is a node of the links' connected part of the cell, so a cell gives no more rows than it holds.
    """
    uids, first, place = np.unique(np.concatenate([members.uid, queries.uid]), return_index=True, return_inverse=True)
    nodes = np.concatenate([members.node, queries.node])[first]
    at_m, at_q = place[: len(members.uid)], place[len(members.uid) :]
    links, parent = np.zeros(len(uids), np.int64), np.arange(len(uids))
    # A vector is no farther from what its partner's codes stand for than from the partner plus the partner's error.
    reach = ((np.sqrt(2 - 2 * cosine) + members.error) ** 2 * 1.0001 + 1e-5).astype(np.float32)
    for start in range(0, len(queries.uid), TOGETHER):
        part = slice(start, start + TOGETHER)
        q, m = candidates(fit.tables(queries.unit[part], number), members.codes, reach)
        q = q + start
        if own:
            once = queries.uid[q] > members.uid[m]
            q, m = q[once], m[once]
        for at in range(0, len(q), 1 << 18):
            some = slice(at, at + (1 << 18))
            a, b = q[some], m[some]
            exact = np.einsum("ij,ij->i", queries.v[a], members.v[b]) / (queries.norm[a] * members.norm[b])
            a, b = a[exact >= cosine], b[exact >= cosine]
            np.add.at(links, at_q[a], members.copies[b])
            np.add.at(links, at_m[b], queries.copies[a])
            parent = join_sets(parent, at_q[a], at_m[b])
    found = np.flatnonzero(links)
    return uids[found], links[found], nodes[found], nodes[parent[found]]


_PACKED = "list int, task long, uid binary, node binary, copies binary, data binary, codes binary, error binary, n long"


def _packed(which: np.ndarray, number: int, task: int, rows: _Rows | dict):
    get = rows.__getitem__ if isinstance(rows, dict) else rows.__getattribute__
    names = ("uid", "node", "copies", "v", "codes", "error")
    return (number, task, *(np.ascontiguousarray(get(c)[which]).tobytes() for c in names), len(which))


def _batch(packed: list[tuple], names: list[str]):
    import pyarrow as pa

    kinds = {"list": pa.int32(), "task": pa.int64(), "n": pa.int64(), "cell": pa.string(), "role": pa.int32(), "visits": pa.list_(pa.int64())}
    columns = [pa.array(column, kinds.get(name, pa.binary())) for column, name in zip(zip(*packed), names)]
    return pa.RecordBatch.from_arrays(columns, names)


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (vec_id, v): the distinct vectors (``uid``, ``node``, ``copies``, ``v``) and every row's (``vec_id``, ``uid``).

    Equal vectors are one unit, ``node`` its smallest id. A task puts its own copies together first, so a
    vector with a third of all rows costs one row per task, here and on the way back.
    """

    def collapse(batches: Iterator) -> Iterator:
        from hashlib import blake2b

        import pyarrow as pa
        from pyspark import TaskContext

        base, groups = TaskContext.get().partitionId() << 33, {}
        names = ["vec_id", "rep", "digest", "n", "v"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.float64())]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            out, lists = [], batch.column(1)
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, key in enumerate(batch.column(0).to_pylist()):
                v = values[offsets[i] : offsets[i + 1]]
                digest = blake2b(v.tobytes(), digest_size=16).digest()
                if (known := groups.get(digest)) is None:
                    known = groups[digest] = [base + len(groups), key, 0, v.copy()]
                known[1], known[2] = min(known[1], key), known[2] + 1
                out.append((key, known[0], None, None, None))
            if out:
                yield made(out)
        held = [(least, rep, digest, n, v) for digest, (rep, least, n, v) in groups.items()]
        for at in range(0, len(held), 1_024):
            yield made(held[at : at + 1_024])

    local = landed(rows.mapInArrow(collapse, "vec_id long, rep long, digest binary, n long, v array<double>"), "vectors")
    heads = local.where("digest is not null")
    units = heads.groupBy("digest").agg(F.min("vec_id").alias("node"), F.sum("n").alias("copies"), F.first("v").alias("v"))
    units = landed(units.withColumn("uid", F.monotonically_increasing_id()), "units")
    reps = heads.select("rep", "digest").join(units.select("digest", "uid"), "digest").select("rep", "uid")
    members = local.where("digest is null").select("vec_id", "rep").join(reps, "rep").select("vec_id", "uid")
    return units.select("uid", "node", "copies", "v"), members


def _coded(units: DataFrame, shared, dim: int) -> DataFrame:
    """Units as packed members of their lists, with the number of them that visit each list."""

    def code(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        fit, task = shared.value, TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in _PACKED.split(", ")] + ["visits"]
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(3)
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            v = matrix([values[a:b] for a, b in zip(offsets, offsets[1:])], dim)
            unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
            where = nearest(unit, fit.centres)
            codes, error = fit.encode(unit, where)
            rows = {c: batch.column(i).to_numpy() for i, c in enumerate(("uid", "node", "copies"))}
            rows |= {"v": v, "codes": codes, "error": error}
            visits = fit.visits(unit, where)
            out = []
            for number in np.unique(where).tolist():
                which = np.flatnonzero(where == number)
                for at in range(0, len(which), CELL_ROWS):
                    some = which[at : at + CELL_ROWS]
                    out.append((*_packed(some, number, task, rows), visits[some].sum(axis=0).tolist()))
                    task += 1
            yield _batch(out, names)

    return landed(units.select("uid", "node", "copies", "v").mapInArrow(code, _PACKED + ", visits array<long>"), "coded")


def _slices(coded: DataFrame) -> dict[int, tuple[int, int]]:
    """Per list, the slices its members are cut into and those of its visitors. A number per list, at most ``MOST_LISTS``."""
    members = {r["list"]: r["n"] for r in coded.groupBy("list").agg(F.sum("n").alias("n")).collect()}
    counts = coded.select(F.posexplode("visits").alias("list", "n")).groupBy("list").agg(F.sum("n").alias("n"))
    visitors = {r["list"]: r["n"] for r in counts.collect()}
    return {i: (-(-n // CELL_ROWS), -(-visitors.get(i, 0) // CELL_ROWS)) for i, n in members.items()}


def _cells(coded: DataFrame, shared, slices: dict, dim: int) -> DataFrame:
    """Packed rows under every cell that needs them: (``cell``, ``role``: member 0, query 1).

    In the cells of a list a slice of its members meets itself (``s``), every other slice of them once (``x``), and
    every slice of its visitors (``v``). A cell holds about ``CELL_ROWS`` rows of either side, however large its list.
    """

    def deal(batches: Iterator) -> Iterator:
        fit = shared.value
        names = ["cell", "role", "list", "uid", "node", "copies", "data", "codes", "error"]
        for batch in batches:
            for row in batch.to_pylist():
                packed = {c: row[c] for c in names[3:]}
                number, (inner, outer) = row["list"], slices[row["list"]]
                mine = _mixed(row["task"]) % inner

                def under(cell, role, which=number, values=packed):
                    return (cell, role, which, *(values[c] for c in names[3:]))

                out = [under(f"{number}x{max(mine, j)}.{min(mine, j)}", int(j < mine)) for j in range(inner) if j != mine]
                out += [under(f"{number}s{mine}", role) for role in (0, 1)]
                out += [under(f"{number}v{mine}.{j}", 0) for j in range(outer)]
                yield _batch(out, names)
                v = np.frombuffer(row["data"], np.float64).reshape(-1, dim)
                unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
                visits = fit.visits(unit, np.full(len(v), number))
                arrays = {c: np.frombuffer(row[c], np.int64) for c in names[3:6]}
                for other in np.flatnonzero(visits.any(axis=0)).tolist():
                    if other not in slices:
                        continue  # no vector lies in it
                    which = np.flatnonzero(visits[:, other])
                    part = {c: a[which].tobytes() for c, a in arrays.items()}
                    part |= {"data": v[which].tobytes(), "codes": b"", "error": b""}
                    inner_o, outer_o = slices[other]
                    at = _mixed(row["task"] * MOST_LISTS + other) % outer_o
                    yield _batch([under(f"{other}v{i}.{at}", 1, other, part) for i in range(inner_o)], names)

    columns = "cell string, role int, list int, uid binary, node binary, copies binary, data binary, codes binary, error binary"
    return coded.drop("visits", "n").mapInArrow(deal, columns)


def _mixed(x: int) -> int:
    from ferrytab.llm.common import MASK

    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    return x ^ (x >> 31)


def linked_parts(units: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(``uid``, ``links``, ``node``, ``root``) from every cell: a unit's links in it, and a node that these connect it with."""
    spark = units.sparkSession
    count, dim = units.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = dim or 1
    share = int(min(1.0, SAMPLE / max(1, count)) * (1 << 20)) + 1
    drawn = units.where(F.pmod(F.xxhash64("uid", "node"), F.lit(1 << 20)) < share).select(F.col("uid").alias("vec_id"), "v")
    sample = [unpacked(bytes(r["data"]), r["n"]) for r in blocks(drawn, "block", 1_024).collect()]
    points = np.concatenate([np.pad(s, ((0, 0), (0, dim - s.shape[1]))) for s in sample] or [np.zeros((0, dim))])
    points = points / np.maximum(np.sqrt((points * points).sum(axis=1)), 1e-300)[:, None]
    fit = Quantiser.fitted(points, min(MOST_LISTS, 1 + count // LIST_ROWS), cosine)
    pieces = len(fit.codes)
    # At most MOST_LISTS centroids and CODES codes per piece, whatever the number of vectors.
    shared = spark.sparkContext.broadcast(fit)
    coded = _coded(units, shared, dim)
    slices = _slices(coded)

    def search(table):
        import pyarrow as pa

        role = table.column("role").to_numpy()
        members, queries = (_Rows(table.filter(pa.array(role == r)), dim, pieces if r == 0 else 0) for r in (0, 1))
        own = "s" in table.column("cell")[0].as_py()
        found = search_cell(shared.value, table.column("list")[0].as_py(), members, queries, own, cosine)
        return pa.table([pa.array(c, pa.int64()) for c in found], ["uid", "links", "node", "root"])

    cells = _cells(coded, shared, slices, dim)
    found = cells.groupBy("cell").applyInArrow(search, "uid long, links long, node long, root long")
    found = landed(found, "links")
    shared.destroy()
    return found


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per id of ``vectors``: (``vec_id``, ``n_links``, ``component_id``, ``kept``).

    Linked are other vectors with a cosine of ``cosine`` or more, in double precision. Vectors that are null or zero, or hold
    null or non-finite components, are linked with nothing; shorter vectors are filled up with zeros. Rows
    repeated in full count once; different vectors of one id are one node with the links of all of them. A null id
    is one row without links and without a component. Every link given is exact; which are found depends on
    the visited lists alone, as codes leave out only what their error rules out.
    """
    rows = usable(vectors, key, vector).where(length() > 0)
    units, members = distinct_vectors(rows)
    parts = linked_parts(units, cosine)
    roots = components(parts.where("node <> root").select("node", F.col("root").alias("alias")))
    links = parts.groupBy("uid").agg(F.sum("links").alias("links"))
    found = units.select("uid", "node", "copies").join(links, "uid", "left").join(roots, "node", "left")
    found = found.select(
        "uid",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    told = members.join(found, "uid").select("vec_id", "n_links", "component_id")
    ids = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"))
    every = ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = every.unionByName(told).groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return whole.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
