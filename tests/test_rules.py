"""Validation rules on single values, the report and its gate, and rules over groups of rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ferrytab.operators import rules as rl

FIELDS = (
    "policy_id STRING, premium_amount STRING, coverage_amount STRING, effective_date STRING, status STRING, "
    "product_type STRING"
)
GOOD = ("POL-123456", "1500.0", "500000", "2025-06-15", "active", "whole_life")
RULES = rl.standard_rules("2026-01-01")


def report(spark, rows, rules=RULES, fields=FIELDS):
    return rl.validation_report(spark.createDataFrame(rows, fields), rules).first()


def failed(spark, rows, rules=RULES, fields=FIELDS):
    return rl.validation_failures(spark.createDataFrame(rows, fields), rules).collect()


def test_good_record(spark):
    found = report(spark, [GOOD])
    assert (found["total_checks"], found["passed"], found["failed"], found["acceptable"]) == (7, 7, 0, True)


@pytest.mark.parametrize(
    ("place", "value", "broken"),
    [
        (0, "INVALID", {"policy_id_format"}),
        (0, "POL-12345", {"policy_id_format"}),
        (0, "POL-12345678901", {"policy_id_format"}),
        (0, "pol-123456", {"policy_id_format"}),
        (0, "POL-123456\n", set()),
        (0, None, {"policy_id_format"}),
        (1, "-5", {"premium_positive", "premium_within_range"}),
        (1, "0", {"premium_positive", "premium_within_range"}),
        (1, "text", {"premium_positive", "premium_within_range"}),
        (1, None, {"premium_positive", "premium_within_range"}),
        (1, "nan", {"premium_positive", "premium_within_range"}),
        (1, "20000.01", {"premium_within_range"}),
        (1, "20000", set()),
        (2, "999.99", {"coverage_exceeds_minimum"}),
        (2, "inf", set()),
        (2, None, {"coverage_exceeds_minimum"}),
        (3, "2026-01-02", {"effective_date_valid"}),
        (3, "2026-01-01", set()),
        (3, "2025-6-5", set()),
        (3, "2025-06-15T10:00", set()),
        (3, "2025-02-30", {"effective_date_valid"}),
        (3, "20250615", {"effective_date_valid"}),
        (3, None, {"effective_date_valid"}),
        (4, "UNKNOWN", {"status_valid"}),
        (4, " ACTIVE", {"status_valid"}),
        (4, None, {"status_valid"}),
        (5, "universal_life", {"product_type_valid"}),
        (5, None, {"product_type_valid"}),
    ],
)
def test_one_bad_value(spark, place, value, broken):
    row = list(GOOD)
    row[place] = value
    assert {f["rule_name"] for f in failed(spark, [tuple(row)])} == broken


def test_typed_columns(spark):
    rows = [(1.5e3, date(2025, 1, 1), datetime(2025, 1, 1, 8)), (float("nan"), date(2027, 1, 1), None)]
    df = spark.createDataFrame(rows, "premium_amount DOUBLE, effective_date DATE, at TIMESTAMP")
    assert {f["rule_name"] for f in rl.validation_failures(df, RULES).collect()} == {
        "premium_positive", "premium_within_range", "effective_date_valid"
    }
    stamped = df.select(F.col("at").alias("effective_date"))
    assert rl.validation_report(stamped, RULES).first()["failed"] == 1


def test_failure_details(spark):
    row = ("BAD", "12345678.5", "500", "2025-06-15", "ACTIVE", "ANNUITY")
    df = spark.createDataFrame([row], FIELDS).withColumn("premium_amount", F.lit(12345678.5))
    found = {f["rule_name"]: f for f in rl.validation_failures(df, RULES).collect()}
    assert found["policy_id_format"]["message"] == "Invalid policy ID format: BAD"
    assert found["policy_id_format"]["severity"] == "critical"
    assert found["premium_within_range"]["actual"] == "12345678.5"
    assert found["coverage_exceeds_minimum"]["expected"] == ">= 1000.00"
    assert all(f["record_id"] == "BAD" for f in found.values())


def test_thresholds(spark):
    # One warning in 1,000 records of 7 checks is acceptable, one critical failure is not.
    warning = (GOOD[0], "1500", "1", *GOOD[3:])
    critical = (GOOD[0], "1500", "5000", GOOD[3], "?", GOOD[5])
    assert report(spark, [GOOD] * 999 + [warning])["acceptable"]
    assert not report(spark, [GOOD] * 999 + [critical])["acceptable"]
    many = report(spark, [GOOD] * 100 + [warning] * 2)
    assert not many["acceptable"] and many["pass_rate"] == pytest.approx(100 * 712 / 714)


def test_empty_batch(spark):
    found = report(spark, [])
    assert (found["total_checks"], found["pass_rate"], found["acceptable"]) == (0, 0.0, False)


def test_absent_columns_are_skipped(spark):
    found = report(spark, [("ACTIVE",)], fields="STATUS STRING")
    assert (found["total_checks"], found["passed"]) == (1, 1)
    assert failed(spark, [("?",)], fields="status STRING")[0]["record_id"] == "UNKNOWN"


def test_python_rule(spark):
    rule = rl.python_rule("even", "n", lambda value, row: value % row["by"] == 0, ["by"], message="Odd: {}")
    df = spark.createDataFrame([(2, 2), (3, 2), (4, 0), (None, 2)], "n INT, by INT")
    found = rl.validation_failures(df, [rule], "n").collect()
    assert [(f["record_id"], f["severity"]) for f in found] == [("3", "warning"), ("4", "critical"), ("None", "critical")]
    assert found[0]["message"] == "Odd: 3" and found[1]["message"].startswith("Rule execution error")
    counts = rl.validation_report(df, [rule]).first()
    assert (counts["passed"], counts["failed"], counts["critical_failures"]) == (1, 3, 2)
    by_rule = {(r["severity"], r["failures"]) for r in rl.failures_by_rule(df, [rule]).collect()}
    assert by_rule == {("critical", 2), ("warning", 1)}


def test_group_sums(spark):
    df = spark.createDataFrame(
        [("a", 33.33), ("a", 33.33), ("a", 33.34), ("b", 50.0), ("b", 49.0), ("c", None)], "k STRING, share DOUBLE"
    )
    found = {r["k"]: r["total"] for r in rl.group_sum_violations(df, "k", "share").collect()}
    assert set(found) == {"b", "c"} and float(found["b"]) == 99.0


def test_transitions_of_one_long_history(spark):
    # One key holds nearly all rows, so that its history crosses the parts of the written table.
    cycle = ["ACTIVE", "LAPSED", "ACTIVE", "PAID_UP", "MATURED"]
    rows = [("hot", i, cycle[i % 5]) for i in range(4000)] + [("cold", 1, "ACTIVE"), ("cold", 2, "LAPSED")]
    rows += [(None, 1, "LAPSED"), (None, 2, "ACTIVE"), ("null", 1, "ACTIVE"), ("null", 2, None), ("null", 3, "LAPSED")]
    df = spark.createDataFrame(rows, "k STRING, at INT, status STRING").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rl.transition_violations(df, "k", ["at"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    allowed = set(rl.ALLOWED_TRANSITIONS)
    expected = {
        ("hot", i, cycle[(i - 1) % 5], cycle[i % 5])
        for i in range(1, 4000)
        if (cycle[(i - 1) % 5], cycle[i % 5]) not in allowed
    }
    expected |= {(None, 2, "LAPSED", "ACTIVE"), ("null", 2, "ACTIVE", None), ("null", 3, None, "LAPSED")}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
