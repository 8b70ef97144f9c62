"""Lineage of records, its queries, and the questions that are answered from it."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ferrytab.operators import lineage as ln
from ferrytab.operators import questions as qs
from ferrytab.operators.mapping import POLICY_MAPPING, EntityMapping, FieldMapping

MAPPING = EntityMapping(
    "policies",
    "db2_policies",
    "fast_policies",
    (
        FieldMapping("POLICY_ID", "policy_id", "trim_string", is_key=True),
        FieldMapping("PREM_AMT", "premium_amount", "packed_decimal_to_float"),
        FieldMapping("STATUS_CD", "status"),
        FieldMapping("NOT_THERE", "nothing"),
    ),
)
FIELDS = "policy_id STRING, prem_amt STRING, status_cd STRING"
ROWS = [("POL-000001 ", "12345678.50", "A"), ("POL-000002", "x", None)]


@pytest.fixture(scope="module")
def lineage(spark):
    return ln.build_lineage(spark.createDataFrame(ROWS, FIELDS), MAPPING, "J1", "abc", "2026-01-01 00:00:00").cache()


def test_entries(lineage):
    found = {(r["record_id"], r["target_column"]): r for r in lineage.collect()}
    assert len(found) == 6
    premium = found["POL-000001", "premium_amount"]
    assert (premium["source_value"], premium["target_value"]) == ("12345678.50", "12345678.5")
    assert (premium["transformation"], premium["etl_commit_id"]) == ("packed_decimal_to_float", "abc")
    assert found["POL-000002", "premium_amount"]["target_value"] == "None"
    assert found["POL-000002", "status"]["source_value"] == "None"
    assert found["POL-000001", "status"]["transformation"] == "direct_copy"
    assert len({r["lineage_id"] for r in found.values()}) == 6


def test_same_job_gives_same_ids(spark, lineage):
    again = ln.build_lineage(spark.createDataFrame(ROWS[::-1], FIELDS), MAPPING, "J1")
    assert again.select("lineage_id").exceptAll(lineage.select("lineage_id")).count() == 0
    other = ln.build_lineage(spark.createDataFrame(ROWS, FIELDS), MAPPING, "J2")
    assert other.join(lineage, "lineage_id", "left_semi").count() == 0


def test_ids_are_the_digests_of_the_stored_texts(lineage):
    for r in lineage.collect():
        parts = [r[name] for name in ln._ID_PARTS]
        assert r["lineage_id"] == hashlib.md5("|".join(parts).encode()).hexdigest()


def test_the_jvm_compiles_the_lineage_of_policies(spark, tmp_path, capsys):
    """The JVM interprets methods of 8,000 bytes and more, for every row."""
    rows = spark.createDataFrame([("x",) * len(POLICY_MAPPING.fields)], [f.source_column for f in POLICY_MAPPING.fields])
    wide = ln.wide_rows(rows, POLICY_MAPPING)
    wide.write.parquet(f"{tmp_path}/wide")
    landed = spark.read.schema(wide.schema).parquet(f"{tmp_path}/wide")
    ln.lineage_of(landed, POLICY_MAPPING, ln.present_fields(rows, POLICY_MAPPING), "J1").explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_queries(lineage):
    assert ln.forward(lineage, "db2_policies", "PREM_AMT").count() == 2
    assert ln.forward(lineage, "db2_policies", "PREM_AMT", "other job").count() == 0
    assert ln.backward(lineage, "fast_policies", "status", "J1").count() == 2
    assert ln.of_record(lineage, "POL-000001").count() == 3
    assert ln.search(lineage, entity_type="policies", field_name="status", record_id="POL-000002").count() == 1
    assert ln.search(lineage, entity_type="claims").count() == 0
    assert [tuple(r) for r in ln.statistics(lineage).collect()] == [("J1", 6)]


def test_impact(lineage):
    more = lineage.withColumn("target_table", F.lit("fast_claims")).unionByName(lineage)
    found = ln.impact_of(more, "db2_policies", "PREM_AMT").first()
    assert (found["source"], found["affected_tables"], found["affected_columns"]) == ("db2_policies.PREM_AMT", 2, 2)
    assert found["details"] == {"fast_claims": ["premium_amount"], "fast_policies": ["premium_amount"]}
    none = ln.impact_of(lineage, "db2_policies", "NOPE").first()
    assert (none["affected_tables"], none["affected_columns"], none["details"]) == (0, 0, {})


def test_documents(lineage):
    texts = {r["document"] for r in ln.documents(lineage).collect()}
    assert (
        "Source: db2_policies.PREM_AMT → Target: fast_policies.premium_amount Transform: packed_decimal_to_float Job: J1"
        in texts
    )


def test_data_map_of_a_repeated_record(spark):
    rows = spark.createDataFrame(ROWS + [("POL-000001", "7", "B")] * 500, FIELDS)
    lineage = ln.build_lineage(rows, MAPPING, "J1")
    failures = spark.createDataFrame([("POL-000001", "status")] * 3, "record_id STRING, field_name STRING")
    maps = {r["record_id"]: r for r in ln.data_map(lineage, failures, "J1").collect()}
    busy = maps["POL-000001"]
    assert (busy["total_fields"], busy["entries"]) == (3, 1503)
    assert busy["validation_pass_rate"] == pytest.approx(200 / 3)
    assert [(f["field_name"], f["validation_passed"]) for f in busy["fields"]] == [
        ("policy_id", True), ("premium_amount", True), ("status", False)
    ]
    assert maps["POL-000002"]["validation_pass_rate"] == 100.0


def test_data_map_keeps_jobs_apart(spark):
    rows = spark.createDataFrame(ROWS, FIELDS)
    lineage = ln.build_lineage(rows, MAPPING, "A").unionByName(ln.build_lineage(rows, MAPPING, "B"))
    fields = "job_id STRING, record_id STRING, field_name STRING"
    failures = spark.createDataFrame(
        [("A", "POL-000001", "status"), ("B", "POL-000002", "status"), ("C", "POL-000001", "status"),
         ("A", "unknown", "status"), ("A", None, None)], fields
    )
    maps = ln.data_map(lineage, failures)
    rates = {(r["job_id"], r["record_id"]): r["validation_pass_rate"] for r in maps.collect()}
    assert set(rates) == {(job, row[0].strip()) for job in "AB" for row in ROWS}
    assert {k for k, v in rates.items() if v < 100} == {("A", "POL-000001"), ("B", "POL-000002")}
    plan = ln.data_map(lineage, failures)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
    with pytest.raises(ValueError):
        ln.data_map(lineage, failures.drop("job_id"))


def test_values_are_not_computed_when_not_read(lineage, spark):
    plan = ln.statistics(ln.build_lineage(spark.createDataFrame(ROWS, FIELDS), MAPPING, "J1"))
    assert "RLIKE" not in plan._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("question", "intent"),
    [
        ("Where does premium_amount come from?", "lineage_backward"),
        ("What is the SOURCE OF this?", "lineage_backward"),
        ("Which reports are used by claims, downstream?", "lineage_forward"),
        ("Did the data match?", "reconciliation"),
        ("What transformation was applied?", "transformation"),
        ("How was it changed?", "transformation"),
        ("How many records?", "status"),
        ("What breaks if I change it?", "impact"),
        ("Hello", "general"),
        ("", "general"),
        (None, "general"),
    ],
)
def test_intents(spark, question, intent):
    row = spark.createDataFrame([(question,)], "q STRING").select(qs.intent(F.col("q")).alias("i")).first()
    assert row["i"] == intent


@pytest.mark.parametrize(
    ("question", "expected"),
    [
        ("show pol-123456 now", ("pol-123456", None, None, None, None)),
        ("db2_x.COL and premium_amount in claims", (None, "db2_x", "COL", "fast_claims", "premium_amount")),
        ("status of coverage_amount", (None, "db2_coverage", "coverage_amount", "fast_coverage", "coverage_amount")),
        ("agents and policies", (None, "db2_policies", None, "fast_policies", None)),
        ("nothing", (None, None, None, None, None)),
    ],
)
def test_entities(spark, question, expected):
    row = qs.with_entities(spark.createDataFrame([(question,)], "question STRING")).first()
    names = ("record_id", "source_table", "source_column", "target_table", "target_column")
    assert tuple(row[n] for n in names) == expected


def test_context(spark):
    rows = [(f"POL-{i:06d}", str(i), "A") for i in range(40)] + [("POL-000007", "1", "A")] * 30
    lineage = ln.build_lineage(spark.createDataFrame(rows, FIELDS), MAPPING, "J1")
    asked = [
        (1, "Where did premium_amount in policies come from?"),
        (2, "What is downstream of db2_policies.STATUS_CD?"),
        (3, "Show POL-000007"),
        (4, "What breaks if I change db2_policies.PREM_AMT?"),
        (5, "What breaks if I change claim_amount in claims?"),
        (6, "Did it match?"),
        (7, "Where did POL-000003 come from?"),
    ] + [(100 + i, "Where did premium_amount in policies come from?") for i in range(200)]
    questions = spark.createDataFrame(asked, "question_id INT, question STRING")
    found = qs.question_context(questions, lineage).collect()
    of = lambda n: sorted((r for r in found if r["question_id"] == n), key=lambda r: r["rank"])
    assert [r["rank"] for r in of(1)] == list(range(1, 11))
    assert {r["target_column"] for r in of(1)} == {"premium_amount"}
    # The repeated record has 31 copies of its entry, but ties are ordered by their content.
    assert [r["record_id"] for r in of(2)][:8] == [f"POL-{i:06d}" for i in range(8)]
    assert len(of(3)) == 20 and {r["record_id"] for r in of(3)} == {"POL-000007"}
    assert [(r["affected_tables"], r["affected_columns"]) for r in of(4)] == [(1, 1)]
    assert [(r["affected_tables"], r["affected_columns"]) for r in of(5)] == [(0, 0)]
    assert of(6) == [] and len(of(7)) == 3 and len(of(299)) == 10
    fewer = qs.question_context(questions, lineage, by_column=3, by_record=5).collect()
    limits = {"backward": 3, "forward": 3, "record": 5}
    expected = [r for r in found if r["rank"] <= limits.get(r["lookup"], 1)]
    assert sorted(map(str, fewer)) == sorted(map(str, expected))


def test_context_moves_only_the_first_entries(spark, monkeypatch):
    """With keys too large for an automatic broadcast, and bounds in force, lookups still sort no entries for a join."""
    rows = [(f"POL-{i // 2:06d}", str(i), "B") for i in range(400)]
    lineage = ln.build_lineage(spark.createDataFrame(rows, FIELDS), MAPPING, "J1").localCheckpoint()
    asked = [(1, "Where did premium_amount in policies come from?"), (2, "Show POL-000150"), (3, "Show POL-999999")]
    questions = spark.createDataFrame(asked, "question_id INT, question STRING")
    plans, write = {}, qs._written
    monkeypatch.setattr(qs, "BOUND_SHARE", 0.2)
    monkeypatch.setattr(qs, "_written", lambda df, label: plans.setdefault(label, df) and write(df, label))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = qs.question_context(questions, lineage).collect()
        plan = plans["chosen"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    by_column = sorted((r["rank"], r["record_id"]) for r in found if r["question_id"] == 1)
    assert by_column == [(i + 1, f"POL-{i // 2:06d}") for i in range(10)]
    by_record = {(r["record_id"], r["source_column"], r["source_value"]) for r in found if r["question_id"] == 2}
    assert len(by_record) == 4 and {r for r, *_ in by_record} == {"POL-000150"}
    assert {r["question_id"] for r in found} == {1, 2}


def test_data_map_packs_a_record(spark):
    """Entries of a record reach the shuffle as one row per batch, copies of a field once; null and empty ids count as one field."""
    rows = spark.createDataFrame([("POL-000001", str(9 - i % 3), "B") for i in range(50)] + ROWS[1:], FIELDS).coalesce(1)
    lineage = ln.build_lineage(rows, MAPPING, "J1").withColumn("_failed", F.lit(False))
    names = [*ln._ID_PARTS, "source_value", "target_value", "transformation", "etl_commit_id", "_failed"]
    packed = {r["_record"]: r["_packed"] for r in ln._packed(lineage.select(*names)).collect()}
    assert {k: len(v) for k, v in packed.items()} == {"POL-000001": 3, "POL-000002": 3}
    assert [(e["source_value"], e["_n"]) for e in packed["POL-000001"] if e["source_column"] == "PREM_AMT"] == [("7", 50)]

    entries = lineage.drop("_failed").where("record_id = 'POL-000002'")
    mixed = entries.withColumn("record_id", F.lit("")).unionByName(
        entries.where("target_column = 'status'").withColumn("record_id", F.lit(None).cast("string"))
    )
    none = spark.createDataFrame([], "record_id STRING, field_name STRING")
    maps = {r["record_id"]: (r["total_fields"], r["entries"]) for r in ln.data_map(mixed, none, "J1").collect()}
    assert maps == {None: (1, 2), "": (2, 2)}


def _by_hand(entries, failures):
    """{(job, record): (fields, entries)} as a data map has them; rows are in the order of ``NAMES``."""
    least, times = {}, {}
    for failed, rows in ((False, entries), (True, [(j, r, None, None, None, t, *[None] * 4) for j, r, t in failures])):
        for row in rows:
            key = (failed, *[v or "" for v in row[:6]])
            rank = tuple((v is not None, v or "") for v in row)
            times[key] = times.get(key, 0) + 1
            least[key] = min(least.get(key, (rank, row)), (rank, row), key=lambda pair: pair[0])
    records, broken = {}, {}
    for (failed, *_), (_, row) in sorted(least.items()):
        if failed and row[5] is not None:
            broken.setdefault(row[:2], set()).add(row[5])
    for key, (_, row) in least.items():
        if not key[0]:
            fields, n = records.get(row[:2], ([], 0))
            fields.append((row[5], row[2], row[3], row[6], row[7], row[8], row[5] not in broken.get(row[:2], ()) if row[5] is not None else True, row[9]))
            records[row[:2]] = (fields, n + times[key])
    return {k: (sorted(map(repr, fields)), n) for k, (fields, n) in records.items()}


NAMES = [*ln._ID_PARTS, "source_value", "target_value", "transformation", "etl_commit_id"]


@pytest.mark.parametrize("lot", [7, 1 << 18])
def test_data_map_merges_odd_entries(spark, monkeypatch, lot):
    """Null and empty ids, columns and values, copies in many tasks and lots, and failures of records without lineage."""
    monkeypatch.setattr(ln, "LOT", lot)
    chance = random.Random(5)

    def some(*values):
        return chance.choice(values)

    entries = [
        (some("A", "B", "", None), some("r1", "r2", "ü3", "", None), some("s", None), some("c", "", None), "t", some("x", "y", "", None),
         some("1", "2", "", None), some("1", None), some("copy", None), some("k", None))
        for _ in range(600)
    ]
    failures = [(some("A", "B", "", None), some("r1", "", None, "nobody"), some("x", "", None)) for _ in range(25)]
    lineage = spark.createDataFrame(entries, ", ".join(f"{n} STRING" for n in NAMES)).repartition(5)
    broken = spark.createDataFrame(failures, "job_id STRING, record_id STRING, field_name STRING")
    maps = ln.data_map(lineage, broken).collect()
    got = {(r["job_id"], r["record_id"]): (sorted(repr(tuple(f)) for f in r["fields"]), r["entries"]) for r in maps}
    assert len(got) == len(maps) and got == _by_hand(entries, failures)


def test_entries_are_sealed_for_the_shuffle(spark):
    """What a record's entries share is not there once an entry; every record is in one bucket."""
    rows = spark.createDataFrame([(f"POL-{i:06d}", str(i * 7919 % 6007), "A") for i in range(6_000)], FIELDS).coalesce(2)
    lineage = ln.build_lineage(rows, MAPPING, "J1").withColumn("_failed", F.lit(False))
    sealed = ln._sealed(ln._packed(lineage.select(*NAMES, "_failed")), 4).collect()
    assert len(sealed) == 8 and {r["_bucket"] for r in sealed} == {0, 1, 2, 3}
    assert sum(len(r["_sealed"]) for r in sealed) < 12 * 18_000
    none = spark.createDataFrame([], "record_id STRING, field_name STRING")
    plan = ln.data_map(lineage, none, "J1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_bucket") == 2 and "Aggregate" not in plan
    assert ln.data_map(lineage.limit(0), none, "J1").count() == 0


def test_more_lineage_has_more_buckets(spark):
    rows = spark.range(1_000)
    assert ln._buckets(rows, 32) == 128
    assert ln._buckets(spark.range(1 << 32), 32) == 8 * (1 << 32) // ln.BUCKET_BYTES
    assert ln._buckets(spark.range(1 << 50), 32) == ln.MOST_BUCKETS
