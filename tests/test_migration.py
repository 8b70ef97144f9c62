"""Staging, slots, rollback, metadata tables and whole migrations."""

import pytest
from pyspark.sql import functions as F

from ferrytab.operators.mapping import POLICY_MAPPING
from ferrytab.operators.progress import job_progress
from ferrytab.plans.fixtures import view
from ferrytab.plans.migration import run_migration
from ferrytab.sources.staging import BLUE, GREEN, TargetField, Workspace


@pytest.fixture
def space(spark):
    return Workspace.temporary(spark)


def numbers(spark, low, high):
    return spark.range(low, high).withColumn("batch_number", F.expr("id div 10"))


def test_staging(spark, space):
    space.stage(numbers(spark, 0, 25), "J1", "things")
    space.stage(numbers(spark, 25, 30), "J1", "things")
    space.stage(numbers(spark, 0, 5), "J2", "things")
    assert space.staged("J1", "things").count() == 30
    batches = {r["batch_number"]: r["record_count"] for r in space.staged_batches("J1", "things").collect()}
    assert batches == {0: 10, 1: 10, 2: 10}
    plan = space.staged_batches("J1", "things")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(job_id" in plan and "ReadSchema: struct<batch_number:bigint>" in plan


def test_discarding_a_job_keeps_the_others(spark, space):
    space.stage(numbers(spark, 0, 25), "J1", "things")
    space.stage(numbers(spark, 0, 5), "J2", "things")
    space.stage(numbers(spark, 0, 3), "J1", "things", "transform")
    removed = {tuple(r) for r in space.discard_staged("J1").collect()}
    assert removed == {("staged__things__extract", 25, 25), ("staged__things__transform", 3, 3)}
    assert space.staged("J1", "things").count() == 0 and space.staged("J2", "things").count() == 5
    assert space.table("archive__things__extract").count() == 25
    assert space.discard_staged("J1").count() == 0
    assert space.discard_staged("J2", archive=False).first()["rows_archived"] == 0
    space.stage(numbers(spark, 0, 5), "it's", "things")
    assert space.discard_staged("it's").first()["rows_removed"] == 5
    assert space.staged("it's", "things").count() == 0


def test_slots(spark, space):
    space.load(numbers(spark, 0, 3), "things", BLUE)
    assert space.live_slot("things") is None and space.can_rollback("things", GREEN)
    space.promote("things", BLUE)
    space.load(numbers(spark, 0, 7), "things", GREEN)
    assert (space.live_slot("things"), space.live("things").count()) == (BLUE, 3)
    space.promote("things", GREEN)
    assert (space.live_slot("things"), space.live("things").count()) == (GREEN, 7)
    with pytest.raises(ValueError, match="is live"):
        space.discard("things", GREEN)
    with pytest.raises(ValueError, match="is live"):
        space.load(numbers(spark, 0, 1), "things", GREEN)
    assert space.emergency_swap("things").first()["success"] and space.live("things").count() == 3
    space.discard("things", GREEN)
    assert not space.exists("things__green") and not space.can_rollback("things", BLUE)
    with pytest.raises(ValueError, match="holds nothing"):
        space.promote("things", GREEN)
    assert not space.emergency_swap("other").first()["success"]
    with pytest.raises(ValueError, match="Unknown slot"):
        space.discard("things", "red")


def test_load_errors_and_dry_run(spark, space):
    rows = spark.createDataFrame([("a", "1", "2026-01-01"), ("b", "x", None), (None, "3", "bad")], "k STRING, n STRING, d STRING")
    target = [TargetField("k", "string", required=True), TargetField("n", "int"), TargetField("d", "date")]
    dry = space.load(rows, "things", dry_run=True, target=target).first()
    assert (dry["total_loaded"], dry["total_errors"]) == (1, 2) and not space.exists("things__green")
    done = space.load(rows, "things", target=target).first()
    assert (done["total_loaded"], done["total_errors"]) == (1, 2)
    assert space.loaded("things").dtypes == [("k", "string"), ("n", "int"), ("d", "date")]
    assert {r["k"] for r in space.load_errors("things").collect()} == {"b", None}


def test_rollback_reports_failed_steps(spark, space):
    space.load(numbers(spark, 0, 3), "things", GREEN)
    space.promote("things", GREEN)
    space.stage(numbers(spark, 0, 5), "J1", "things")
    report = space.rollback("J1", "things", "why").first()
    assert not report["success"] and "is live" in report["errors"][0]
    assert (report["staged_rows_removed"], space.live("things").count()) == (5, 3)
    assert space.table("audit_events").where("event_type = 'rollback'").first()["details"] == "why"


def test_metadata_states(spark, space):
    rows = spark.createDataFrame([("J1", 1, "loaded")], "job_id STRING, batch_number INT, status STRING")
    space.record(rows, "migration_batches")
    space.record(rows.withColumn("batch_number", F.lit(2)), "migration_batches")
    assert space.table("migration_batches").count() == 2
    with pytest.raises(Exception, match="not allowed: lost"):
        space.record(rows.withColumn("status", F.lit("lost")), "migration_batches")


def test_progress(spark):
    jobs = spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("b", None)], "job_id STRING, started_at STRING")
    batches = spark.createDataFrame(
        [("a", "completed", 10), ("a", "loading", 5), ("a", "failed", None), ("a", "completed", 10)],
        "job_id STRING, status STRING, record_count INT",
    )
    found = {r["job_id"]: r for r in job_progress(jobs, batches, "2026-01-01 00:01:00").collect()}
    assert (found["a"]["progress_pct"], found["a"]["elapsed_seconds"]) == (50.0, 60)
    assert found["a"]["estimated_remaining_seconds"] == 60.0
    assert (found["b"]["progress_pct"], found["b"]["batches_total"]) == (0.0, 0)


@pytest.fixture(scope="module")
def policies(spark, sf_dir):
    return view(spark, sf_dir, "policy_clean").cache()


def migrate(space, policies, **options):
    return run_migration(space, policies, POLICY_MAPPING, 500, as_of="2026-01-01", **options)


def outcomes(report):
    return {s.name: s.outcome for s in report.stages}


def test_two_migrations_take_turns(space, policies):
    first = migrate(space, policies, auto_promote=True)
    assert first.status == "completed" and outcomes(first)["promote"] == "promoted"
    assert space.live_slot("policies") == GREEN
    second = migrate(space, policies.limit(100), auto_promote=True)
    assert second.status == "completed" and space.live_slot("policies") == BLUE
    assert space.live("policies").count() == 100
    space.promote("policies", GREEN)
    assert space.live("policies").count() == 1500
    assert space.table("migration_jobs").where("status = 'completed'").count() == 2
    assert space.table("lineage_records").where(F.col("job_id") == first.job_id).count() == 15000


def test_manual_promotion_and_dry_run(space, policies):
    dry = migrate(space, policies, dry_run=True)
    assert outcomes(dry)["load"] == "skipped" and not space.exists("policies__green")
    manual = migrate(space, policies)
    assert outcomes(manual)["promote"] == "awaiting_manual_promotion" and space.live_slot("policies") is None


def test_failures(space, policies):
    bad = policies.withColumn("status_cd", F.lit("?"))
    gated = migrate(space, bad)
    assert gated.status == "failed" and "load" not in outcomes(gated) and "Validation failed" in gated.error
    misfit = migrate(space, policies, target=[TargetField("premium_amount", "decimal(5,2)")])
    assert outcomes(misfit)["load"] == "errors" and outcomes(misfit)["rollback"] == "success"
    assert not space.exists("policies__green")
    states = {r["job_id"]: r["status"] for r in space.table("migration_jobs").collect()}
    assert states == {gated.job_id: "failed", misfit.job_id: "rolled_back"}


def test_missing_key_is_a_failed_job(space, policies):
    report = migrate(space, policies.drop("policy_id"))
    assert report.status == "failed" and report.stages == []


def test_a_job_may_run_again(space, policies):
    first = migrate(space, policies, dry_run=True, job_id="AGAIN")
    again = migrate(space, policies, auto_promote=True, job_id="AGAIN")
    assert first.error is None and again.error is None
    n = policies.count()
    assert [s.records for s in again.stages if s.name in ("extract", "load")] == [n, n]
    assert space.live("policies").count() == n
    batches = space.table("migration_batches").where("job_id = 'AGAIN'").collect()
    assert {b["status"] for b in batches} == {"completed"}
    assert all(b["extract_duration_ms"] is not None for b in batches)
    assert sum(b["record_count"] for b in batches) == n


def test_append_widens_and_refuses_other_types(spark, space):
    space.append(spark.sql("SELECT 1 AS a, 'x' AS job_id"), "wide")
    space.append(spark.sql("SELECT 2 AS a, 'w' AS b, 'y' AS job_id"), "wide")
    space.append(spark.sql("SELECT 'only' AS b, 'z' AS job_id"), "wide")
    rows = {r["job_id"]: (r["a"], r["b"]) for r in space.table("wide").collect()}
    assert rows == {"x": (1, None), "y": (2, "w"), "z": (None, "only")}
    with pytest.raises(ValueError, match="two types"):
        space.append(spark.sql("SELECT 'text' AS a, 'x' AS job_id"), "wide")


def test_emergency_swap_goes_both_ways(spark, space):
    space.load(spark.range(3).toDF("k"), "swap", BLUE)
    space.promote("swap", BLUE)
    space.load(spark.range(5).toDF("k"), "swap", GREEN)
    space.promote("swap", GREEN)
    assert space.emergency_swap("swap").first()["slot"] == BLUE and space.live("swap").count() == 3
    assert space.emergency_swap("swap").first()["slot"] == GREEN and space.live("swap").count() == 5


def test_an_earlier_loads_errors_are_gone(spark, space):
    rows = spark.sql("SELECT * FROM VALUES ('a', '1'), ('b', 'x') AS t(k, v)")
    space.load(rows, "stale", GREEN, target=[TargetField("v", "int")])
    assert space.load_errors("stale").count() == 1
    space.load(rows, "stale", GREEN)
    assert space.load_errors("stale").count() == 0


def test_every_core_has_several_tasks_of_a_stage(spark, space, policies):
    small = {
        "spark.sql.shuffle.partitions": "64", "spark.sql.files.openCostInBytes": "1",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    }
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        assert migrate(space, policies, job_id="EVEN").error is None
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # A task writes a file: one per core, or a few more, would leave most cores waiting for the last.
    assert len(space.records("lineage_records", "EVEN", "policies").inputFiles()) >= 3 * spark.sparkContext.defaultParallelism
