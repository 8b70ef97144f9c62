"""Reconciliation: records, values, keys, duplicates, reports, against brute force in Python."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ferrytab.operators import reconcile as rc

PEOPLE = "policy_id STRING, name STRING, premium DOUBLE, status STRING"
ROWS = [("POL-1", "Doe", 1250.5, "active"), ("POL-2", "Smith", 850.0, "active"), ("POL-3", "Johnson", 3200.75, "lapsed")]


def results(spark, source, target, fields, how):
    one, two = (spark.createDataFrame(rows, fields) for rows in (source, target))
    return rc.reconcile(one, two, how)


def report(spark, source, target, fields, how):
    return rc.reconciliation_report(results(spark, source, target, fields, how)).first()


def details(spark, source, target, fields, how):
    found = rc.mismatch_details(results(spark, source, target, fields, how)).collect()
    return {(r["source_id"], r["field_name"], r["mismatch_type"]) for r in found}


BY_ID = rc.Comparison(["policy_id"])


def test_equal_tables(spark):
    found = report(spark, ROWS, ROWS, PEOPLE, BY_ID)
    assert (found["matched"], found["match_rate"], found["acceptable"]) == (3, 100.0, True)


def test_changed_fields(spark):
    target = [ROWS[0], ("POL-2", "Smith", 999.99, "cancelled"), ROWS[2]]
    assert details(spark, ROWS, target, PEOPLE, BY_ID) == {("POL-2", "premium", "value"), ("POL-2", "status", "value")}
    found = report(spark, ROWS, target, PEOPLE, BY_ID)
    assert (found["matched"], found["mismatched"], found["acceptable"]) == (2, 1, False)


def test_missing_both_ways(spark):
    found = results(spark, ROWS[:2], ROWS[1:], PEOPLE, BY_ID).where("status <> 'matched'").collect()
    assert {(r["source_id"], r["target_id"], r["status"], r["severity"]) for r in found} == {
        ("POL-1", None, "missing_in_target", "critical"),
        ("", "POL-3", "missing_in_source", "warning"),
    }


@pytest.mark.parametrize(
    ("left", "right", "tolerance", "equal"),
    [
        (100.0, 100.0001, 0.001, True), (100.0, 100.0001, 0.00001, False), (0.0, 0.001, 0.001, True),
        (1e12, 1e12 + 900, 0.001, True), (1e12, 1e12 + 1100, 0.001, False), (1.0, math.inf, 0.001, False),
        (math.inf, math.inf, 0.001, True), (math.inf, -math.inf, 0.001, False), (math.nan, math.nan, 0.001, True),
    ],
)
def test_tolerance(spark, left, right, tolerance, equal):
    how = rc.Comparison(["id"], tolerance=tolerance)
    found = report(spark, [("a", left)], [("a", right)], "id STRING, amount DOUBLE", how)
    assert found["matched"] == int(equal)


def python_mismatch(left, right, tolerance=0.001):
    def null(v):
        return v is None or (isinstance(v, float) and math.isnan(v))

    def number(v):
        try:
            return float(v)
        except (TypeError, ValueError):
            return None

    if null(left) and null(right):
        return None
    if null(left) != null(right):
        return "missing" if null(right) else "extra"
    if number(left) is not None and number(right) is not None:
        return None if math.isclose(number(left), number(right), abs_tol=tolerance) else "value"
    return None if str(left).strip().lower() == str(right).strip().lower() else "value"


GRID = {
    "STRING": [None, "nan", "NaN", "", " ", "1", "1.0", "001", "1e3", "1d", "1_000", "inf", "-inf", "Abc", " abc\t",
               "True", "2026-01-15", "1000"],
    "DOUBLE": [None, math.nan, math.inf, -math.inf, 1.0, 1000.0, 1.0005, 12345678.5],
    "BIGINT": [None, 1, 1000, -5],
    "BOOLEAN": [None, True, False],
    "DATE": [None, date(2026, 1, 15)],
}


@pytest.mark.parametrize("right_type", GRID)
@pytest.mark.parametrize("left_type", GRID)
def test_value_grid(spark, left_type, right_type):
    pairs = [(a, b) for a in GRID[left_type] for b in GRID[right_type]]
    source = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], f"id INT, v {left_type}")
    target = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(pairs)], f"id INT, v {right_type}")
    found = rc.mismatch_details(rc.reconcile(source, target, rc.Comparison(["id"], ["v"]))).collect()
    got = {int(r["source_id"]): r["mismatch_type"] for r in found}
    expected = {i: m for i, (a, b) in enumerate(pairs) if (m := python_mismatch(a, b))}
    assert got == expected


def test_composite_keys_do_not_collide(spark):
    fields = "a STRING, b STRING, v INT"
    how = rc.Comparison(["a", "b"])
    found = report(spark, [("x|y", "z", 1)], [("x", "y|z", 1)], fields, how)
    assert (found["matched"], found["missing_in_target"], found["missing_in_source"]) == (0, 1, 1)
    same = results(spark, [("E", "1", 1), ("W", None, 2)], [("E", "1", 1), ("W", None, 3)], fields, how).collect()
    assert {(r["source_id"], r["status"]) for r in same} == {("E|1", "matched"), ("W|None", "mismatched")}


def test_key_with_other_value_is_critical(spark):
    found = results(spark, [("nan", 1)], [("nan", 1)], "id STRING, v INT", rc.Comparison(["id"])).first()
    assert (found["status"], found["severity"]) == ("mismatched", "critical")
    null_key = results(spark, [(None, 1)], [("None", 1)], "id STRING, v INT", rc.Comparison(["id"])).first()
    assert (null_key["severity"], null_key["mismatches"][0]["mismatch_type"]) == ("warning", "extra")


def test_ignored_listed_and_missing_columns(spark):
    fields = "id STRING, data STRING, audit_ts STRING"
    source, target = [("1", "x", "a")], [("1", "x", "b")]
    assert report(spark, source, target, fields, rc.Comparison(["id"], ignore=["audit_ts"]))["matched"] == 1
    assert report(spark, source, target, fields, rc.Comparison(["id"], columns=["data"]))["matched"] == 1
    one = spark.createDataFrame(source, fields)
    gone = rc.reconcile(one, one.drop("data"), rc.Comparison(["id"], columns=["data", "nowhere"])).first()
    assert [(m["field_name"], m["mismatch_type"]) for m in gone["mismatches"]] == [("data", "missing")]


def test_case_and_empty(spark):
    how = rc.Comparison(["id"])
    assert report(spark, [("1", " John")], [("1", "JOHN ")], "id STRING, name STRING", how)["matched"] == 1
    empty = report(spark, [], [], "id STRING, name STRING", how)
    assert (empty["match_rate"], empty["acceptable"], empty["total_source"]) == (0.0, False, 0)


@pytest.mark.parametrize(
    ("matched", "mismatched", "lost", "extra", "acceptable"),
    [(9999, 1, 0, 0, True), (9998, 2, 0, 0, False), (99999, 0, 1, 0, False), (99999, 0, 0, 1, True), (0, 0, 0, 0, False)],
)
def test_gate(spark, matched, mismatched, lost, extra, acceptable):
    counts = spark.createDataFrame(
        [(matched, mismatched, lost, extra)],
        "matched BIGINT, mismatched BIGINT, missing_in_target BIGINT, missing_in_source BIGINT",
    )
    assert rc.report_gate(counts).first()["acceptable"] is acceptable


def test_hot_key_and_row_order(spark):
    # A third of all rows has one key; what is compared does not depend on row order or partitions.
    random.seed(3)
    rows = [("hot", random.randint(0, 50), f"v{random.randint(0, 9)}") for _ in range(3000)]
    rows += [(f"k{i}", i % 7, "v") for i in range(6000)]
    fields = "id STRING, n INT, v STRING"
    source, target = spark.createDataFrame(rows, fields), spark.createDataFrame(rows, fields)
    how = rc.Comparison(["id"])
    outcomes = set()
    for parts, seed in ((1, 1), (7, 2)):
        shuffled = target.orderBy(F.rand(seed)).repartition(parts)
        found = rc.reconciliation_report(rc.reconcile(source, shuffled, how)).first()
        assert (found["matched"], found["total_source"], found["total_target"]) == (6001, 9000, 9000)
        outcomes.add(tuple(found))
    assert len(outcomes) == 1
    first = {r["_k0"]: r for r in rc.first_per_key(source, ["id"], ["n", "v"]).collect()}
    low = min((n, v) for k, n, v in rows if k == "hot")
    assert (first["hot"]["_row"]["v0"], first["hot"]["_row"]["v1"], first["hot"]["_rows"]) == (*low, 3000)


def test_counts_add_up(spark):
    random.seed(5)
    fields = "id INT, v INT"
    source = [(random.randint(0, 200), random.randint(0, 3)) for _ in range(400)]
    target = [(random.randint(100, 300), random.randint(0, 3)) for _ in range(400)]
    found = report(spark, source, target, fields, rc.Comparison(["id"]))
    keys = {k for k, _ in source} | {k for k, _ in target}
    parts = ("matched", "mismatched", "missing_in_target", "missing_in_source")
    assert sum(found[p] for p in parts) == len(keys)
    one, two = spark.createDataFrame(source, fields), spark.createDataFrame(target, fields)
    sets = {r["key_set"]: r["keys"] for r in rc.key_set_counts(one, two, ["id"]).collect()}
    assert sets["common"] == found["matched"] + found["mismatched"]
    assert (sets["source_only"], sets["target_only"]) == (found["missing_in_target"], found["missing_in_source"])


def test_result_rows_as_json(spark):
    target = [("POL-1", "Doe", 1250.5, None)]
    row = rc.result_rows(results(spark, ROWS[:1], target, PEOPLE, BY_ID), "J", "policies").first()
    assert row["mismatched_fields"] == '{"status":"missing"}'
    assert row["source_values"] == '{"status":"active"}' and row["resolved"] is False


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_plan_has_one_shuffle_per_side(spark):
    one = spark.createDataFrame(ROWS, PEOPLE)
    plan = rc.reconciliation_report(rc.reconcile(one, one.limit(2), BY_ID))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert shuffles(plan) == 2 and "FullOuter" in text
    assert "Python" not in text and "Window" not in text and "Cartesian" not in text
