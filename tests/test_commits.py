"""The commit log, runs that stop at any write, and the proof of a load."""

import pytest
from pyspark.sql import functions as F

from ferrytab.operators.lineage import data_map, data_map_of, build_lineage, present_fields, wide_rows
from ferrytab.operators.mapping import CLAIM_MAPPING, POLICY_MAPPING
from ferrytab.operators.progress import stage_durations
from ferrytab.functions.transforms import TransformRegistry
from ferrytab.operators.rules import not_null_rule, standard_rules, validation_failures
from ferrytab.plans.fixtures import view
from ferrytab.plans.migration import run_migration
from ferrytab.sources.commits import Change, CommitLog
from ferrytab.sources.staging import GREEN, SLOT_BATCH, TargetField, Workspace
from ferrytab.session import scratch_path


class Killed(BaseException):
    """Stops a run as the loss of its process would."""


@pytest.fixture
def log(spark):
    return CommitLog(spark, scratch_path(spark, "log"))


@pytest.fixture
def space(spark):
    return Workspace.temporary(spark)


@pytest.fixture(scope="module")
def policies(spark, sf_dir):
    return view(spark, sf_dir, "policy_clean").limit(400).cache()


def held(log, table="t", **owner):
    rows = log.read(table, log.spark.range(1).schema, **owner)
    return sorted(r["id"] for r in rows.collect())


def put(log, part, low, high, job="J", entity="e"):
    return Change("t", job, entity, part, log.stage(log.spark.range(low, high), "t"))


def test_rows_are_seen_after_their_commit_and_once(spark, log):
    assert held(log) == []
    first = put(log, "a", 0, 3)
    assert held(log) == []
    assert log.commit([first]) == 0 and held(log) == [0, 1, 2]
    assert log.commit([first]) == 1 and held(log) == [0, 1, 2]
    log.commit([put(log, "a", 5, 6), put(log, "b", 7, 8)])
    assert held(log) == [5, 7]
    log.commit([put(log, "a", 8, 9, entity="f"), put(log, "a", 9, 10, job="K")])
    assert held(log, job_id="J", entity="e") == [5, 7] and held(log) == [5, 7, 8, 9]
    log.commit([Change("t", "J", "e", "b")])
    assert held(log, job_id="J", entity="e") == [5]
    log.commit([Change("t", "J", "e", None), put(log, "z", 1, 2)])
    assert held(CommitLog(spark, log.folder)) == [1, 8, 9]


def test_two_writers_get_two_numbers(spark, log):
    other = CommitLog(spark, log.folder)
    number = log.next_number()
    assert other.commit([put(other, "a", 0, 1)], number) == number
    assert log.commit([put(log, "b", 1, 2)], number) is None and held(log) == [0]
    assert log.commit([put(log, "b", 1, 2)]) == number + 1 and held(other) == [0, 1]


def test_vacuum_and_compaction(log):
    for i in range(4):
        log.commit([put(log, f"p{i}", i, i + 1)])
    log.stage(log.spark.range(9), "t")
    assert log.vacuum() == [] and log.compact("t") == 4 and held(log) == [0, 1, 2, 3]
    assert len(log.parts()) == 1 and log.compact("t") == 0
    assert len(log.vacuum(0.0)) == 5 and held(log) == [0, 1, 2, 3]


def state(space):
    """What readers see of a job: everything but times and moments."""
    lineage = space.table("lineage_records").drop("created_at")
    batches = space.table("migration_batches").select("job_id", "batch_number", "status", "record_count", "checksum_source", "checksum_target")
    jobs = space.table("migration_jobs").select("job_id", "entity_type", "status", "total_records", "processed_records")
    live = space.live("policies")
    return [sorted(map(str, df.collect())) for df in (lineage, batches, jobs, live, space.staged("J", "policies").drop("_row_id"))]


def run(space, source, mapping=POLICY_MAPPING, **options):
    return run_migration(space, source, mapping, 150, as_of="2026-01-01", auto_promote=True, job_id="J", **options)


def test_a_run_killed_at_any_write_is_repeated_without_loss_or_doubles(spark, space, policies, monkeypatch):
    assert run(space, policies).error is None
    want = state(space)
    assert len(want[0]) == 4_000 and len(want[3]) == len(want[4]) == 400
    writes = {"n": 0, "stop": None}

    def counting(name):
        real = getattr(CommitLog, name)

        def call(self, *args, **kwargs):
            writes["n"] += 1
            if writes["n"] == writes["stop"]:
                raise Killed
            return real(self, *args, **kwargs)

        monkeypatch.setattr(CommitLog, name, call)

    for name in ("commit", "new_path"):
        counting(name)
    run(Workspace.temporary(spark), policies)
    total = writes["n"]
    assert total >= 12
    for stop in (1, 4, 7, total - 1):
        target = Workspace.temporary(spark)
        writes.update(n=0, stop=stop)
        with pytest.raises(Killed):
            run(target, policies)
        writes.update(n=0, stop=None)
        run(target, policies)
        assert state(target) == want, stop


def test_a_second_entity_under_one_job_keeps_the_first_ones_records(spark, sf_dir, space, policies):
    claims = view(spark, sf_dir, "claims_master").limit(300)
    run(space, policies)
    lines = space.records("lineage_records", "J", "policies").count()
    second = run(space, claims, CLAIM_MAPPING, rules=[not_null_rule("claim_id")])
    assert second.error is None
    assert space.records("lineage_records", "J", "policies").count() == lines == 4_000
    assert space.records("lineage_records", "J", "claims").count() == 300 * 6
    assert {r["entity_type"] for r in space.table("migration_jobs").collect()} == {"policies", "claims"}
    assert space.table("migration_batches").agg(F.sum("record_count")).first()[0] == 700
    space.forget("J", "claims")
    assert space.records("lineage_records", "J", "claims").count() == 0
    assert space.records("lineage_records", "J", "policies").count() == lines
    assert space.staged("J", "policies").count() == 400


def test_a_failed_job_leaves_no_lineage_of_rows_that_are_not_there(space, policies):
    failed = run(space, policies, target=[TargetField("premium_amount", "decimal(5,2)")])
    assert failed.status == "failed" and failed.stage("transform").records == 4_000
    assert space.table("lineage_records").count() == 0
    assert {r["status"] for r in space.table("migration_batches").collect()} == {"failed"}


def altered(monkeypatch, change):
    """Every load is followed by a change of what the slot holds."""
    real = Workspace.load

    def load(self, df, entity, slot=GREEN, **options):
        report = real(self, df, entity, slot, **options).collect()
        rows = self.loaded(entity, slot, batches=True)
        path = self.log.stage(change(rows), "altered")
        self._place(f"{entity}__{slot}", rows.schema, path)
        return self.spark.createDataFrame(report)

    monkeypatch.setattr(Workspace, "load", load)


CHANGES = {
    "doubled row": lambda df: df.unionByName(df.limit(1)),
    "lost row": lambda df: df.offset(1),
    "changed value": lambda df: df.withColumn("status", F.when(F.col(SLOT_BATCH) == 1, "other").otherwise(F.col("status"))),
    "foreign row": lambda df: df.unionByName(df.limit(1).withColumn("policy_id", F.lit("Z")).withColumn(SLOT_BATCH, F.lit(None).cast("bigint"))),
}


@pytest.mark.parametrize("name", CHANGES)
def test_a_slot_that_is_not_what_was_sent_is_blocked(space, policies, monkeypatch, name):
    altered(monkeypatch, CHANGES[name])
    report = run(space, policies)
    assert (report.stage("reconcile").outcome, report.stage("promote").outcome) == ("not acceptable", "blocked")
    assert space.live_slot("policies") is None


def test_a_whole_run(spark, space, policies, monkeypatch):
    asked, runs = [], spark.sparkContext.accumulator(0)
    real = Workspace.table
    monkeypatch.setattr(Workspace, "table", lambda self, name: asked.append(name) or real(self, name))

    def counted(text):
        runs.add(1)
        return text

    registry = TransformRegistry()
    registry.register_python("phone_normalize", counted)
    report = run(space, policies, registry=registry)
    assert report.error is None and runs.value == 400  # transforms run once
    # Counts come from the writes: what is read again is the staged table for the transforms, and the slot for the proof
    # and for the columns of its view.
    assert [report.stage(s).records for s in ("extract", "transform", "validate", "load")] == [400, 4_000, 400, 400]
    assert "lineage_records" not in asked and "migration_batches" not in asked
    assert asked.count("staged__policies__extract") <= 2 and asked.count("policies__green") <= 2
    # Nothing is left of the tables that only the run itself reads.
    names = space.log.files.names(f"{space.log.folder}/files")
    assert not [n for n in names if n.startswith(("mapped", "proof", "checksums"))]
    batches = space.table("migration_batches").collect()
    assert len(batches) == 3 and all(b["checksum_target"] and b["checksum_source"] for b in batches)
    fields = [f.target_field for f in POLICY_MAPPING.fields]
    assert space.loaded("policies").columns == fields == space.live("policies").columns
    times = {r["stage"]: r for r in stage_durations(space.table("migration_batches")).collect()}
    for stage in ("extract", "transform", "load"):
        assert (times[stage]["batches"], times[stage]["total_ms"]) == (3, report.stage(stage).duration_ms)


def test_empty_source(space, policies):
    report = run(space, policies.limit(0))
    assert report.stage("extract").records == 0


def test_load_errors_say_why(spark, space):
    rows = spark.createDataFrame(
        [("a", "1", "2026-01-01"), ("b", "x", None), (None, "3", "bad"), (None, "y", "2026-02-30")], "k STRING, n STRING, d STRING"
    )
    target = [TargetField("k", "string", True), TargetField("n", "int"), TargetField("d", "date"), TargetField("m", "int", True)]
    report = space.load(rows, "things", target=target[:3]).first()
    assert (report["total_loaded"], report["total_errors"]) == (1, 3)
    found = {(r["k"], r["n"]): [tuple(p) for p in r["problems"]] for r in space.load_errors("things").collect()}
    assert found == {
        ("b", "x"): [("n", "x", "does not fit int")],
        (None, "3"): [("k", None, "required value is null"), ("d", "bad", "does not fit date")],
        (None, "y"): [("k", None, "required value is null"), ("n", "y", "does not fit int"), ("d", "2026-02-30", "does not fit date")],
    }
    assert space.load_errors("things").dtypes[:3] == [("k", "string"), ("n", "string"), ("d", "string")]
    none = space.load(rows, "things", target=target).first()
    assert (none["total_loaded"], none["total_errors"]) == (0, 4) and space.loaded("things").count() == 0
    assert space.load_errors("things", shown=2).count() == 2 and space.load_errors("things", shown=None).count() == 4


def test_a_load_reads_its_rows_once(spark, space):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = spark.range(50).selectExpr("cast(id as string) AS k", "if(id % 5 = 0, 'x', '1') AS n")
    rows = rows.mapInArrow(count, rows.schema)
    report = space.load(rows, "things", target=[TargetField("n", "int")]).first()
    assert (report["total_loaded"], report["total_errors"], runs.value) == (40, 10, 50)


def test_data_map_from_rows_is_that_of_the_lineage(spark, sf_dir):
    source = view(spark, sf_dir, "policy_master").limit(300)
    source = source.unionByName(source.limit(40)).unionByName(source.limit(5).withColumn("status_cd", F.lit("?")))
    rules = standard_rules("1998-06-30")
    wide, present = wide_rows(source, POLICY_MAPPING), present_fields(source, POLICY_MAPPING)
    fields = [F.col(f.target_field) for f in POLICY_MAPPING.fields]
    lineage = build_lineage(source, POLICY_MAPPING, "J", "c", "2000-01-01")
    want = data_map(lineage, validation_failures(wide.select(*fields), rules), "J")
    got = data_map_of(wide, POLICY_MAPPING, present, rules, "J", "c")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_repeated_run_does_not_keep_what_it_replaces(spark, space, policies):
    """Staged rows and lineage of the run before are gone before those of this one are written; others' stay."""
    assert space.staged_folder("J", "policies") is None
    others = policies.selectExpr("policy_id AS claim_id", "policy_id", "cov_amt AS claim_amt", "eff_dt AS claim_dt", "status_cd", "prod_typ AS diag_cd")
    for _ in range(2):
        assert run(space, others, CLAIM_MAPPING, rules=[not_null_rule("claim_id")]).error is None
        assert run(space, policies.where("policy_id is not null")).error is None
    names = space.log.files.names(f"{space.log.folder}/files")
    assert sum(n.startswith("lineage_records") for n in names) == sum(n.startswith("staged") for n in names) == 2
    assert space.table("lineage_records").count() == 400 * (len(POLICY_MAPPING.fields) + len(CLAIM_MAPPING.fields))
    assert space.staged("J", "policies").count() == space.staged("J", "claims").count() == 400
    written = [n for folder in names for n in space.log.files.names(f"{space.log.folder}/files/{folder}") if n.endswith(".parquet")]
    assert written and all(".zstd." in n for n in written)


def test_a_run_that_stops_keeps_what_the_one_before_left(spark, space, policies, monkeypatch):
    """Until the new staged rows are proven and the commit is made, those of the run before can be read."""
    assert run(space, policies).error is None
    kept, lines = space.staged_folder("J", "policies"), space.table("lineage_records").count()

    def stop(self, *args):
        raise Killed

    monkeypatch.setattr(CommitLog, "commit", stop)
    with pytest.raises(Killed):
        run(space, policies)
    assert space.log.files.exists(kept) and space.staged_folder("J", "policies") != kept
    assert space.table("lineage_records").count() == lines == 4_000
