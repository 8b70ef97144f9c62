"""Key ranges, and what differs found down a tree of checksums."""

import random

import pytest
from pyspark.sql import functions as F

from ferrytab.operators.drilldown import checksum_tree, differing_leaves, drill_down, range_checksums
from ferrytab.operators.reconcile import Comparison, findings, reconcile
from ferrytab.session import scratch_path
from ferrytab.sources.ranges import KeyRange, Sketch, bounds_of, key_ranges, range_number, ranges_of


def test_ranges_are_disjoint_and_cover_everything(spark):
    ranges = ranges_of(["m", "d", "m", "é"])
    assert ranges == [KeyRange(None, "d"), KeyRange("d", "m"), KeyRange("m", "é"), KeyRange("é", None)]
    keys = [None, "", "a", "d", "d ", "dz", "m", "z", "é", "éa", "\U0001f600", "D", "o'brien"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string")
    hits = rows.select("k", *[r.predicate(F.col("k")).cast("int").alias(f"r{i}") for i, r in enumerate(ranges)], range_number(F.col("k"), ranges).alias("n"))
    for row in hits.collect():
        assert [row[f"r{i}"] for i in range(4)] == [int(i == row["n"]) for i in range(4)]
    assert ranges_of([]) == [KeyRange(None, None)]
    assert rows.where(KeyRange(None, None).predicate(F.col("k"))).count() == len(keys)


def test_predicates_as_sql():
    import duckdb

    ranges = ranges_of(["d", "o'brien"])
    assert ranges[1].sql("k") == "(k >= 'd' AND k < 'o''brien')"
    rows = "SELECT * FROM (VALUES (NULL), ('a'), ('d'), ('o''brien'), ('o''b'), ('z')) AS t(k)"
    counts = [duckdb.connect().sql(f"SELECT count(*) FROM ({rows}) WHERE {r.sql('k')}").fetchall()[0][0] for r in ranges]
    assert counts == [2, 2, 2] and KeyRange(None, None).sql("k") == "1 = 1"


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_ranges_are_balanced(spark, parts):
    chance = random.Random(parts)
    keys = [f"K-{chance.random():.9f}" for _ in range(30_000)]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    ranges = key_ranges(rows, "k", parts)
    assert len(ranges) == parts
    counts = [r["count"] for r in rows.select(range_number(F.col("k"), ranges).alias("n")).groupBy("n").count().collect()]
    assert sum(counts) == len(keys) and max(counts) <= 1.35 * len(keys) / parts


def test_a_hot_key_and_nulls(spark):
    rows = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 == 1, None).otherwise(F.format_string("%05d", "id")).alias("k"))
    ranges = key_ranges(rows, "k", 12)
    assert 8 <= len(ranges) <= 12 and sum(r.low == "hot" for r in ranges) == 1
    assert key_ranges(rows.limit(0), "k", 12) == [KeyRange(None, None)]
    assert key_ranges(rows.where("k = 'hot'"), "k", 12) == [KeyRange(None, None)]


def test_many_sketches_are_merged_by_tasks(spark):
    rows = spark.range(0, 40_000, 1, 150).select(F.format_string("%06d", "id").alias("k"))
    ranges = key_ranges(rows, "k", 10, size=128)
    found = [int(r.high) for r in ranges[:-1]]
    assert all(abs(b - 4_000 * (i + 1)) < 1_600 for i, b in enumerate(found)) and len(found) == 9


def test_sketch_keeps_its_weight():
    made = Sketch(16)
    for i in range(1_000):
        made.add(f"{i:04d}")
    assert sum(1 << level for _, level in made.items()) == 1_000 and len(made.items()) < 16 * 8
    assert bounds_of([], 5) == [] and bounds_of([("a", 3)], 4) == []


COLUMNS = "k string, a int, b string"


def pair(spark, n=4_000):
    rows = spark.range(n).select(F.format_string("K%05d", "id").alias("k"), (F.col("id") % 91).cast("int").alias("a"), F.lit("same").alias("b"))
    key = F.col("k")
    other = rows.where("k <> 'K00777'").withColumn("a", F.when(key == "K01500", -1).otherwise(F.col("a")))
    other = other.unionByName(rows.where("k = 'K03333'")).unionByName(spark.createDataFrame([(None, 1, "x")], COLUMNS))
    return rows, other


def test_exactly_the_damaged_ranges(spark):
    source, target = pair(spark)
    ranges = ranges_of([f"K{i:05d}" for i in range(100, 4_000, 100)])
    found = drill_down(source, target, "k", ranges)
    got = sorted(map(tuple, found.ranges.collect()))
    assert got == [
        (0, None, "K00100", 100, 101), (7, "K00700", "K00800", 100, 99), (15, "K01500", "K01600", 100, 100),
        (33, "K03300", "K03400", 100, 101),
    ]
    assert (found.source.count(), found.target.count()) == (400, 401)
    status = {r["source_id"] or r["target_id"]: r["status"] for r in findings(reconcile(found.source, found.target, Comparison(["k"]))).collect()}
    assert status == {"K00777": "missing_in_target", "K01500": "mismatched", "None": "missing_in_source"}


def test_equal_tables_differ_nowhere(spark):
    source, _ = pair(spark)
    found = drill_down(source, source.repartition(7), "k", ranges_of(["K01000", "K02000"]))
    assert found.ranges.count() == found.source.count() == 0
    alone = drill_down(source, source.limit(0), "k", [KeyRange(None, None)])
    assert [tuple(r) for r in alone.ranges.collect()] == [(0, None, None, 4_000, 0)]


def test_only_differing_ranges_are_read(spark):
    source, target = pair(spark)
    paths = [scratch_path(spark, "side") for _ in range(2)]
    for df, path in zip((source, target), paths):
        df.orderBy("k").write.parquet(path)
    sides = [spark.read.parquet(p) for p in paths]
    found = drill_down(*sides, "k", ranges_of([f"K{i:05d}" for i in range(100, 4_000, 100)]))
    plan = found.source._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "K00700" in plan
    many = drill_down(source, target.withColumn("b", F.lit("other")).where("a % 2 = 0"), "k", ranges_of([f"K{i:05d}" for i in range(4_000)]))
    assert many.source.count() == 4_000


def test_tree_is_compared_from_the_root(spark):
    source, target = pair(spark)
    ranges = ranges_of([f"K{i:05d}" for i in range(10, 4_000, 10)])
    trees = [checksum_tree(range_checksums(side, "k", ranges, ["k", "a", "b"]), len(ranges), 8) for side in (source, target)]
    assert [level.count() for level in trees[0]] == [400, 50, 7, 1]
    assert sorted(r["node"] for r in differing_leaves(*trees, 8).collect()) == [0, 77, 150, 333]
