"""Row numbers, pages and checksums under repeated keys, equal rows and other partitionings."""

import random

import pytest
from pyspark.sql import functions as F

from ferrytab.operators.questions import trim_history
from ferrytab.sources import extract as ex


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(1)
    data = [("hot", 1, "same")] * 700 + [("hot", random.randint(0, 5), "x") for _ in range(300)]
    data += [(f"k{random.randint(0, 400)}", random.randint(0, 9), None) for _ in range(1000)]
    random.shuffle(data)
    return data


@pytest.fixture(autouse=True)
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


FIELDS = "k STRING, n INT, t STRING"


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or ""))


def test_row_numbers(spark, rows):
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    landed = ex.land_ordered(df, ["k"])
    parts = landed.groupBy(ex.part_of(F.col(ex.ROW_ID)).alias("p")).count().collect()
    # Equal rows make up a third of the table and still spread over the parts.
    assert len(parts) == 4 and max(p["count"] for p in parts) < 900
    numbered = ex.with_batches(ex.number_rows(landed), 300).orderBy("row_index").collect()
    assert [r["row_index"] for r in numbered] == list(range(2000))
    assert [(r["k"], r["n"], r["t"]) for r in numbered] == ordered(rows)
    assert [r["batch_number"] for r in numbered] == [i // 300 for i in range(2000)]


def test_batches_and_headers(spark, rows):
    df = spark.createDataFrame(rows, FIELDS)
    batches = ex.extract_batches(df, "k", ["k", "n"], "n > 0", 256)
    kept = sorted(r[0] for r in rows if r[1] > 0)
    headers = sorted(ex.batch_headers(batches, "k").collect())
    assert [h["record_count"] for h in headers[:-1]] == [256] * (len(headers) - 1)
    assert [(h["min_key"], h["max_key"]) for h in headers] == [
        (kept[i], kept[min(i + 255, len(kept) - 1)]) for i in range(0, len(kept), 256)
    ]
    total = ex.extraction_totals(ex.batch_headers(batches, "k")).first()
    assert (total["batches"], total["total_records"]) == (len(headers), len(kept))


@pytest.mark.parametrize("number", [0, 3, 6, 7])
def test_pages(spark, rows, number):
    df = spark.createDataFrame(rows, FIELDS)
    expected = ordered(rows)[number * 300 : (number + 1) * 300]
    page = ex.extract_page(df, "k", number, batch_size=300).collect()
    assert ordered([tuple(r) for r in page]) == expected


def test_empty_table(spark):
    empty = spark.createDataFrame([], FIELDS)
    assert ex.extract_batches(empty, "k").count() == 0
    assert ex.page_of(ex.land_ordered(empty, ["k"]), 0).count() == 0
    assert ex.extraction_totals(ex.batch_headers(ex.extract_batches(empty, "k"), "k")).first()["total_records"] == 0


@pytest.mark.parametrize("algorithm", ["md5", "xxhash64"])
def test_checksum_does_not_depend_on_order(spark, rows, algorithm):
    df = spark.createDataFrame(rows, FIELDS)
    one = ex.table_checksum(df, algorithm=algorithm).first()
    two = ex.table_checksum(df.orderBy(F.rand(4)).repartition(3).select("t", "n", "k"), algorithm=algorithm).first()
    assert one == two
    changed = spark.createDataFrame([*rows[1:], (rows[0][0], rows[0][1], "other")], FIELDS)
    assert ex.table_checksum(changed, algorithm=algorithm).first()["checksum"] != one["checksum"]


def test_checksum_tells_splits_and_nulls_apart(spark):
    fields = "a STRING, b STRING"
    tables = [[("x", "yz")], [("xy", "z")], [("x", None)], [(None, "x")], [("x", "")], [("x", "-")]]
    sums = {ex.table_checksum(spark.createDataFrame(t, fields)).first()["checksum"] for t in tables}
    assert len(sums) == len(tables)
    # Two equal rows cancel in the exclusive or, but not in the sum.
    twice = ex.table_checksum(spark.createDataFrame([("x", "y")] * 2, fields)).first()
    assert twice["digest_xor"] == 0 and twice["digest_sum"] != "0"


def test_missing_batches_and_comparison(spark):
    arrived = spark.createDataFrame([(0,), (2,)], "batch_number BIGINT")
    assert [r[0] for r in ex.missing_batches(arrived, 31, 10).orderBy("batch_number").collect()] == [1, 3]
    one = spark.createDataFrame([(0, "a"), (1, "b")], "batch_number BIGINT, checksum STRING")
    two = spark.createDataFrame([(0, "a"), (2, "c")], "batch_number BIGINT, checksum STRING")
    found = ex.compare_checksums(one, two).orderBy("batch_number").collect()
    assert [r["is_equal"] for r in found] == [True, False, False]


def test_combined_checksum_depends_on_batch_order(spark):
    def combined(pairs):
        return ex.combined_checksum(spark.createDataFrame(pairs, "batch_number BIGINT, checksum STRING")).first()[0]

    assert combined([(0, "a"), (1, "b")]) == combined([(1, "b"), (0, "a")])
    assert combined([(0, "a"), (1, "b")]) != combined([(0, "b"), (1, "a")])
    many = [(i, str(i)) for i in range(2500)]
    assert combined(many) != combined([*many[:-1], (2499, "x")])


def test_synthetic_policies_repeat(spark):
    make = lambda: ex.synthetic_policies(spark.range(50), "id", 1).collect()
    assert make() == make() != ex.synthetic_policies(spark.range(50), "id", 2).collect()
    assert all(50 <= r["premium_amount"] <= 5000 for r in make())


def test_history_of_a_busy_session(spark):
    rows = [("busy", i) for i in range(500)] + [("quiet", 1)]
    kept = trim_history(spark.createDataFrame(rows, "session STRING, turn INT"), "session", ["turn"])
    assert {(r[0], r[1]) for r in kept.collect()} == {("busy", i) for i in range(480, 500)} | {("quiet", 1)}
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
