"""Value functions against Python's own str and float, and the standard transforms on edge values."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.text import as_text, parse_number
from ferrytab.functions.transforms import TransformRegistry
from ferrytab.operators.mapping import (
    POLICY_MAPPING,
    EntityMapping,
    FieldMapping,
    change_statistics,
    map_entity,
    mapping_rows,
    read_mapping,
    transform_columns,
)


def run(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r["r"] for r in rows.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def transform(spark, name, values, kind="string"):
    dtype = T.DataType.fromDDL(kind)
    return run(spark, values, lambda c: TransformRegistry().apply(name, c, dtype), kind)


def python_number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def same(left, right):
    return str(left) == str(right)


def test_numbers_follow_python(spark):
    texts = ["1", " 1.0 ", "1_000", "1__0", "_1", "1_", "1d", "1f", "0x1p3", "inf", "-Infinity", "nan", "+nan",
             "-nan", "", " ", ".", ".5", "5.", "1e3", "1E+2", "e5", "1e", "abc", None, "\xa07　", "+-1", "1 2",
             "infinit", "1.2.3", "--1", "1e400", "-0"]
    for text, value in zip(texts, run(spark, texts, parse_number)):
        assert same(value, python_number(text)), text


def test_texts_of_doubles_follow_python(spark):
    numbers = [0.0, -0.0, 1.0, 10.0, 12345678.5, 1e7, 1e15, 1e16, 1.5e16, 1e22, 1e100, 1e-3, 1e-4, 1.234e-4, 1e-5,
               -2.5e-7, 123456789012345.67, float("inf"), float("-inf"), float("nan"), 0.1, 999999.999]
    texts = run(spark, numbers, lambda c: as_text(c, T.DoubleType()), "double")
    assert texts == [str(n) for n in numbers]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aBzÉßñ中 '-#.9_\t", max_size=12), min_size=40, max_size=60))
def test_text_transforms_follow_python(spark, texts):
    assert transform(spark, "name_title_case", texts) == [t.strip().title() for t in texts]
    assert transform(spark, "trim_string", texts) == [t.strip() or None for t in texts]


def test_title_case_of_whole_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    titled = rows.select("text", TransformRegistry().apply("name_title_case", F.col("text")).alias("r")).collect()
    assert all(row["r"] == row["text"].strip().title() for row in titled)


@pytest.mark.parametrize(
    ("name", "values", "expected"),
    [
        ("trim_string", ["  a b ", "", "  ", None, "\t\nx"], ["a b", None, None, None, "x"]),
        (
            "db2_date_to_iso",
            ["20260115", "2026-01-15", "2026/01/15", "01/15/2026", "2026-1-5", "00000000", "0", "", "20260230", None,
             " 20260115 ", "not a date", "00000101", "2024-02-29", "2023-02-29"],
            ["2026-01-15", "2026-01-15", "2026-01-15", None, "2026-1-5", None, None, None, None, None,
             "2026-01-15", "not a date", None, "2024-02-29", None],
        ),
        ("packed_decimal_to_float", ["12.34567", "x", None, "1e2", "-0.5"], [12.3457, None, None, 100.0, -0.5]),
        ("status_code_map", ["A", "2", " l ", "I", None, "active", ""],
         ["ACTIVE", "LAPSED", "LAPSED", "I", None, "ACTIVE", ""]),
        ("phone_normalize", ["5551234567", "(555) 987-6543", "15554567890", "25554567890", "abc", "", None, "12"],
         ["+15551234567", "+15559876543", "+15554567890", "25554567890", None, None, None, "12"]),
        ("ssn_mask", ["123-45-6789", "1234", "123", "", None], ["***-**-6789", "***-**-1234", None, None, None]),
        ("null_coalesce", [None, " ", "x "], ["", "", "x "]),
        ("currency_to_cents", ["12.34", "0.005", "0.015", "x", None, "inf", "nan", "1e30"],
         [1234, 0, 2, None, None, None, None, None]),
        ("boolean_from_flag", ["Y", "yes ", "1", "t", "N", "no", "0", "FALSE", "maybe", None, ""],
         [True, True, True, True, False, False, False, False, None, None, None]),
    ],
)
def test_transform(spark, name, values, expected):
    assert transform(spark, name, values) == expected


def test_transforms_take_other_types(spark):
    assert transform(spark, "db2_date_to_iso", [date(2026, 1, 15)], "date") == ["2026-01-15"]
    assert transform(spark, "db2_date_to_iso", [20260115, 0], "bigint") == ["2026-01-15", None]
    assert transform(spark, "status_code_map", [1, 9], "int") == ["ACTIVE", "9"]
    assert transform(spark, "currency_to_cents", [10.01, None], "double") == [1001, None]
    assert transform(spark, "boolean_from_flag", [True, False], "boolean") == [True, False]


def test_default_option_and_description(spark):
    registry = TransformRegistry()
    assert run(spark, [None, "a"], lambda c: registry.apply("null_coalesce", c, default="-")) == ["-", "a"]
    texts = run(spark, ["A", "x" * 80, None], lambda c: registry.describe("trim_string", c))
    assert texts[0] == "trim_string('A') → 'A'"
    assert texts[1] == f"trim_string('{'x' * 49}) → '{'x' * 49}"
    assert texts[2] == "trim_string(None) → None"


def test_unknown_transform():
    with pytest.raises(ValueError, match="Unknown transform: nope"):
        TransformRegistry().get("nope")


def test_chain_and_statistics(spark):
    rows = spark.createDataFrame([(" jo ", "1.5"), ("Al", "2"), (None, None), ("", "x")], "name STRING, amt STRING")
    chains = {"NAME": ["trim_string", "name_title_case"], "amt": ["packed_decimal_to_float"], "gone": ["trim_string"]}
    done = transform_columns(rows, chains)
    assert done.columns == ["name", "amt"]
    assert [tuple(r) for r in done.collect()] == [("Jo", 1.5), ("Al", 2.0), (None, None), (None, None)]
    stats = {(r[0], r[1]): (r[2], r[3]) for r in change_statistics(rows, chains).collect()}
    assert stats == {
        ("name", "trim_string"): (2, 4),
        ("name", "name_title_case"): (1, 4),
        ("amt", "packed_decimal_to_float"): (3, 4),
    }
    assert change_statistics(rows, {"gone": ["trim_string"]}).count() == 0


def test_python_transform(spark):
    registry = TransformRegistry()
    registry.register_python("twice", lambda v: None if v is None else v * 2, "int")
    rows = spark.createDataFrame([(2,), (None,)], "n INT")
    assert [r["n"] for r in transform_columns(rows, {"n": ["twice"]}, registry).collect()] == [4, None]


def test_mapping_as_rows(spark):
    again = read_mapping(mapping_rows(spark, POLICY_MAPPING), "policies", "fast_policies")
    assert again == POLICY_MAPPING


def test_defaults_take_the_column_type(spark):
    mapping = EntityMapping(
        "e", "s", "t",
        (
            FieldMapping("AMT", "amount", "packed_decimal_to_float", default="1.5"),
            FieldMapping("NAME", "name", default="-"),
            FieldMapping("N", "n", default="7"),
        ),
    )
    rows = spark.createDataFrame([("2", "a", 1), (None, None, None), ("x", "b", None)], "amt STRING, name STRING, n INT")
    mapped = map_entity(rows, mapping)
    assert mapped.dtypes == [("amount", "double"), ("name", "string"), ("n", "int")]
    assert [tuple(r) for r in mapped.collect()] == [(2.0, "a", 1), (1.5, "-", 7), (1.5, "b", 7)]


def test_python_functions_see_the_values_spark_holds(spark):
    from ferrytab.operators.rules import python_rule, validation_failures

    registry = TransformRegistry()
    registry.register_python("shown", lambda v: repr(v))
    rows = spark.sql(
        "SELECT * FROM VALUES (1, 9007199254740993L, 1.10BD, DATE'2026-01-02', true), (2, NULL, NULL, NULL, NULL) "
        "AS t(k, n, d, day, flag)"
    )
    for parts in (1, 2):
        got = rows.repartition(parts).select("k", *[registry.apply("shown", F.col(c)).alias(c) for c in ("n", "d", "day", "flag")])
        assert {r["k"]: tuple(r)[1:] for r in got.collect()} == {
            1: ("9007199254740993", "Decimal('1.10')", "datetime.date(2026, 1, 2)", "True"),
            2: ("None",) * 4,
        }
    rule = python_rule("exact", "n", lambda v, row: v in (None, 9007199254740993), ["d"])
    assert validation_failures(rows, [rule]).count() == 0
