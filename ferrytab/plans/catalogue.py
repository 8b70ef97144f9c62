"""The queries over the test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.transforms import TransformRegistry
from ferrytab.operators import drilldown as dd
from ferrytab.operators import lineage as ln
from ferrytab.operators import progress as pg
from ferrytab.operators import questions as qs
from ferrytab.operators import reconcile as rc
from ferrytab.operators import rules as rl
from ferrytab.operators import search as sr
from ferrytab.operators.mapping import (
    CLAIM_MAPPING,
    POLICY_MAPPING,
    EntityMapping,
    FieldMapping,
    change_statistics,
    map_entity,
    mapping_rows,
    read_mapping,
    transform_columns,
)
from ferrytab.plans.fixtures import table, view
from ferrytab.plans.migration import run_migration
from ferrytab.sources import extract as ex
from ferrytab.sources import ranges as rg
from ferrytab.sources.staging import BLUE, GREEN, SLOT_BATCH, TargetField, Workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The day that dates may not lie after, and the moment progress is measured at, in all queries.
AS_OF = "1998-06-30"
NOW = "2000-01-01 00:00:00"
JOB = "JOB-1"
BATCH_SIZE = 1_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- extraction --------------------------------------------------------------------------------


@query
def source_count(spark, sf):
    return ex.source_count(table(spark, sf, "orders"), "o_totalprice > 100000")


@query
def extract_page(spark, sf):
    return ex.extract_page(view(spark, sf, "order_rows"), "o_orderkey", 1, batch_size=500)


@query
def extract_page_deep(spark, sf):
    return ex.extract_page(view(spark, sf, "claims_master"), "claim_id", 3, batch_size=BATCH_SIZE)


@query
def extract_batches(spark, sf):
    return ex.extract_batches(view(spark, sf, "claims_master"), "claim_id", batch_size=BATCH_SIZE)


@query
def extract_summary(spark, sf):
    batches = ex.extract_batches(
        view(spark, sf, "claims_master"), "claim_id", ["claim_id", "claim_amt"], "status_cd <> 'N'", BATCH_SIZE
    )
    return ex.batch_headers(batches, "claim_id")


@query
def extract_totals(spark, sf):
    batches = ex.extract_batches(view(spark, sf, "claims_master"), "claim_id", ["claim_id"], batch_size=BATCH_SIZE)
    return ex.extraction_totals(ex.batch_headers(batches, "claim_id"))


@query
def missing_batches(spark, sf):
    events = table(spark, sf, "events")
    batches = ex.extract_batches(events, "event_id", ["event_id", "event_type"], batch_size=10, unique_key=True)
    arrived = ex.batch_headers(batches.where("event_type = 'purchase'"), "event_id")
    return ex.missing_batches(arrived, events.count(), 10)


@query
def synthetic_policies(spark, sf):
    return ex.synthetic_policies(table(spark, sf, "orders"), "o_orderkey", seed=7)


def _order_checksums(spark, sf, name="order_rows", algorithm="md5"):
    rows = ex.extract_batches(view(spark, sf, name), "o_orderkey", batch_size=BATCH_SIZE, unique_key=True)
    return ex.batch_checksums(rows, algorithm=algorithm)


@query
def batch_checksum(spark, sf):
    return _order_checksums(spark, sf)


@query
def combined_checksum(spark, sf):
    return ex.combined_checksum(_order_checksums(spark, sf))


@query
def table_checksum(spark, sf):
    return ex.table_checksum(view(spark, sf, "claims_master"), algorithm="md5")  # as any engine computes it


@query
def checksum_compare(spark, sf):
    return ex.compare_checksums(_order_checksums(spark, sf), _order_checksums(spark, sf, "order_rows_changed"))


@query
def key_ranges(spark, sf):
    """Rows by the number of ranges of a text key that hold them, some keys being null; ranges are far from uneven."""
    claims = view(spark, sf, "claims_master")
    keyed = claims.select(F.when(F.col("status_cd") != "N", F.col("claim_id")).alias("key"))
    ranges = rg.key_ranges(keyed, "key", 16)
    hits = [r.predicate(F.col("key")).cast("int") for r in ranges]
    counted = keyed.select(sum(hits, F.lit(0)).alias("ranges"), rg.range_number(F.col("key"), ranges).alias("_n"))
    parts = counted.where("_n > 0").groupBy("ranges", "_n").agg(F.count(F.lit(1)).alias("rows"))
    whole = counted.groupBy("ranges").agg(F.count(F.lit(1)).alias("rows"))
    return whole.join(parts.groupBy("ranges").agg((F.max("rows") < 2 * F.avg("rows")).alias("even")), "ranges")


@query
def checksum_drilldown(spark, sf):
    """Ranges of policy ids in which a damaged copy differs, with the rows of both sides."""
    source, target = view(spark, sf, "recon_source"), view(spark, sf, "recon_target")
    bounds = [f"POL-{i:06d}" for i in range(50, 6_000, 50)] + ["POL-", "POM"]
    found = dd.drill_down(source, target, "policy_id", rg.ranges_of(bounds))
    return found.ranges.select("low", "high", "source_rows", "target_rows")


# -- staging and publishing --------------------------------------------------------------------


def _staged(spark, sf) -> Workspace:
    space = Workspace.temporary(spark)
    rows = ex.extract_batches(
        view(spark, sf, "policy_master"), "policy_id", ["policy_id", "prem_amt"], batch_size=BATCH_SIZE
    )
    space.stage(rows, JOB, "policies")
    return space


@query
def stage_roundtrip(spark, sf):
    return _staged(spark, sf).staged(JOB, "policies").select("policy_id", "prem_amt", "batch_number")


@query
def stage_list(spark, sf):
    return _staged(spark, sf).staged_batches(JOB, "policies")


@query
def stage_discard(spark, sf):
    return _staged(spark, sf).discard_staged(JOB, archive=True)


_POLICY_TARGET = [
    TargetField("policy_id", "string", required=True),
    TargetField("premium_amount", "decimal(12,2)"),
    TargetField("effective_date", "date", required=True),
]


@query
def load_slot(spark, sf):
    space = Workspace.temporary(spark)
    return space.load(map_entity(view(spark, sf, "policy_master"), POLICY_MAPPING), "policies", target=_POLICY_TARGET)


@query
def load_dry_run(spark, sf):
    space = Workspace.temporary(spark)
    mapped = map_entity(view(spark, sf, "policy_master"), POLICY_MAPPING)
    return space.load(mapped, "policies", dry_run=True, target=_POLICY_TARGET)


@query
def loaded_rows(spark, sf):
    space = Workspace.temporary(spark)
    space.load(map_entity(view(spark, sf, "policy_master"), POLICY_MAPPING), "policies", target=_POLICY_TARGET)
    return space.loaded("policies").select(
        "policy_id", F.col("effective_date").cast("string").alias("effective_date"), "premium_amount", "status"
    )


@query
def load_errors(spark, sf):
    """Every refused value with its field and the reason."""
    space = Workspace.temporary(spark)
    space.load(map_entity(view(spark, sf, "policy_master"), POLICY_MAPPING), "policies", target=_POLICY_TARGET)
    return space.load_errors("policies", shown=None).select("policy_id", F.inline("problems"))


def _two_slots(spark, sf) -> Workspace:
    space = Workspace.temporary(spark)
    space.load(view(spark, sf, "recon_source"), "policies", BLUE)
    space.load(view(spark, sf, "recon_target"), "policies", GREEN)
    space.promote("policies", BLUE)
    return space


@query
def publish_slot(spark, sf):
    space = _two_slots(spark, sf)

    def live(step):
        return (
            space.live("policies")
            .agg(F.count(F.lit(1)).alias("live_rows"), F.count("status").alias("with_status"))
            .withColumns({"step": F.lit(step), "slot": F.lit(space.live_slot("policies"))})
        )

    steps = [live("first")]
    space.promote("policies", GREEN)
    steps.append(live("promoted"))
    space.emergency_swap("policies")
    steps.append(live("swapped back"))
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@query
def discard_slot(spark, sf):
    space = _two_slots(spark, sf)
    space.discard("policies", GREEN)
    return (
        space.live("policies")
        .agg(F.count(F.lit(1)).alias("live_rows"))
        .withColumn("green_exists", F.lit(space.exists("policies__green")))
    )


@query
def rollback_report(spark, sf):
    space = _staged(spark, sf)
    space.load(space.staged(JOB, "policies"), "policies", GREEN)
    could = space.can_rollback("policies", GREEN)
    report = space.rollback(JOB, "policies", "test", GREEN)
    return report.select(
        "job_id", "reason", "deployment_rolled_back", "success", F.size("errors").cast("bigint").alias("errors"),
        "staged_rows_removed", "staged_rows_archived", F.lit(could).alias("could_roll_back"),
    )


@query
def audit_events(spark, sf):
    space = Workspace.temporary(spark)
    space.record(view(spark, sf, "event_log"), "audit_events")
    counts = pg.audit_counts(space.table("audit_events"))
    return counts.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_at", "last_at")}
    )


# -- mapping and transforms --------------------------------------------------------------------


@query
def map_policies(spark, sf):
    return map_entity(view(spark, sf, "policy_master"), POLICY_MAPPING)


@query
def map_claims(spark, sf):
    return map_entity(view(spark, sf, "claims_master"), CLAIM_MAPPING)


_DEFAULTS = EntityMapping(
    "probes",
    "probes",
    "mapped_probes",
    (
        FieldMapping("id", "id", is_key=True),
        FieldMapping("padded", "priority", "trim_string", default="none"),
        FieldMapping("code", "status", "status_code_map", is_required=True, default="UNKNOWN"),
        FieldMapping("day", "day", "db2_date_to_iso", is_required=True),
        FieldMapping("absent", "absent", "trim_string"),
    ),
)


@query
def map_defaults(spark, sf):
    return map_entity(view(spark, sf, "probes"), _DEFAULTS)


#: A mapping whose transforms and rules are texts, as they stand in the mapping table.
STORED_MAPPING = EntityMapping(
    "policies",
    "db2_policies",
    "fast_policies",
    (
        FieldMapping("POLICY_ID", "policy_id", "trim_string", is_key=True, rule="matches(value, '^POL-[0-9]{6}$')"),
        FieldMapping("PREM_AMT", "premium_cents", "round(float(value) * 100)", target_type="bigint", rule="0 < value <= 500000"),
        FieldMapping("STATUS_CD", "status", "upper(strip(value))", source_type="string", rule="value in ['A', 'L', '3']"),
        FieldMapping("PROD_TYP", "product", "concat(strip(prod_typ), '-', status_cd)", rule="len(value) > 8 or status == 'A'"),
        FieldMapping("EFF_DT", "effective_date", "db2_date_to_iso", target_type="date", rule="value is not None"),
    ),
)


def _read_back(spark):
    space = Workspace.temporary(spark)
    space.record(mapping_rows(spark, STORED_MAPPING), "entity_mappings")
    return read_mapping(space.table("entity_mappings"), "policies", "fast_policies")


@query
def mapping_roundtrip(spark, sf):
    return map_entity(view(spark, sf, "policy_master"), _read_back(spark))


@query
def validate_from_mapping(spark, sf):
    mapping = _read_back(spark)
    return rl.failures_by_rule(map_entity(view(spark, sf, "policy_master"), mapping), mapping.stored_rules())


@query
def map_required(spark, sf):
    mapped = map_entity(view(spark, sf, "probes"), _DEFAULTS)
    return rl.failures_by_rule(mapped, _DEFAULTS.required_rules())


_CHAINS = {
    "first_nm": ["trim_string", "name_title_case"],
    "last_nm": ["trim_string", "name_title_case", "null_coalesce"],
    "prem_amt": ["packed_decimal_to_float", "currency_to_cents"],
    "status_cd": ["trim_string", "status_code_map"],
    "prod_typ": ["trim_string"],
    "eff_dt": ["db2_date_to_iso"],
    "no_such_column": ["trim_string"],
}


@query
def transform_chain(spark, sf):
    return transform_columns(view(spark, sf, "policy_master"), _CHAINS)


@query
def transform_stats(spark, sf):
    return change_statistics(view(spark, sf, "policy_master"), _CHAINS)


@query
def transform_custom_udf(spark, sf):
    def mark_priority(value):
        """A user's own transform: the number before the dash, doubled."""
        return None if value is None else f"P{int(value.split('-')[0]) * 2}"

    registry = TransformRegistry()
    registry.register_python("mark_priority", mark_priority)
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return transform_columns(rows, {"o_orderpriority": ["mark_priority"]}, registry)


@query
def transform_describe(spark, sf):
    rows = view(spark, sf, "probes")
    registry = TransformRegistry()
    return rows.select("id", registry.describe("status_code_map", F.col("code")).alias("description"))


def _transform(name, column, source, key, spark, sf):
    rows = view(spark, sf, source) if source == "probes" else table(spark, sf, source)
    result = TransformRegistry().apply(name, F.col(column), T.StringType())
    return rows.select(key, column, result.alias("result"))


for _key, _name, _column, _source, _id in (
    ("tf_trim_string", "trim_string", "padded", "probes", "id"),
    ("tf_date_to_iso", "db2_date_to_iso", "day", "probes", "id"),
    ("tf_decimal", "packed_decimal_to_float", "amount", "probes", "id"),
    ("tf_status_map", "status_code_map", "code", "probes", "id"),
    ("tf_title_case", "name_title_case", "text", "documents", "doc_id"),
    ("tf_phone", "phone_normalize", "phone", "probes", "id"),
    ("tf_ssn_mask", "ssn_mask", "ssn", "probes", "id"),
    ("tf_null_coalesce", "null_coalesce", "padded", "probes", "id"),
    ("tf_cents", "currency_to_cents", "amount", "probes", "id"),
    ("tf_bool_flag", "boolean_from_flag", "flag", "probes", "id"),
):
    QUERIES[_key] = partial(_transform, _name, _column, _source, _id)


# -- rules -------------------------------------------------------------------------------------


def _mapped(spark, sf):
    return map_entity(view(spark, sf, "policy_master"), POLICY_MAPPING)


def _rule(name, spark, sf):
    rule = next(r for r in rl.standard_rules(AS_OF) if r.name == name)
    return rl.check_rule(_mapped(spark, sf), rule, "policy_id")


def _rule_on_claims(spark, sf):
    """Claim ids are no policy ids, policy ids are."""
    rule = next(r for r in rl.standard_rules(AS_OF) if r.name == "policy_id_format")
    claims = view(spark, sf, "claims_master")
    both = claims.select("claim_id", F.col("policy_id").alias("other"), F.col("claim_id").alias("policy_id")).unionByName(
        claims.select("claim_id", F.col("policy_id").alias("other"), "policy_id")
    )
    return rl.check_rule(both, rule, "policy_id")


QUERIES["rule_policy_id"] = _rule_on_claims
for _key, _name in (
    ("rule_premium_positive", "premium_positive"),
    ("rule_coverage_min", "coverage_exceeds_minimum"),
    ("rule_effective_date", "effective_date_valid"),
    ("rule_status", "status_valid"),
    ("rule_product_type", "product_type_valid"),
    ("rule_premium_range", "premium_within_range"),
):
    QUERIES[_key] = partial(_rule, _name)


@query
def rule_custom(spark, sf):
    def covers_premium(value, row):
        return float(value) >= float(row["premium_amount"])

    def recent(value, row):
        return int(value[:4]) >= 1993

    rules = [
        rl.python_rule("coverage_covers_premium", "coverage_amount", covers_premium, ["premium_amount"]),
        rl.python_rule("recent", "effective_date", recent, []),
    ]
    return rl.failures_by_rule(_mapped(spark, sf), rules)


@query
def validate_report(spark, sf):
    return rl.validation_report(_mapped(spark, sf), rl.standard_rules(AS_OF))


@query
def validate_failures(spark, sf):
    return rl.validation_failures(_mapped(spark, sf), rl.standard_rules(AS_OF))


@query
def validate_by_rule(spark, sf):
    return rl.failures_by_rule(_mapped(spark, sf), rl.standard_rules(AS_OF))


@query
def rule_group_sum(spark, sf):
    found = rl.group_sum_violations(view(spark, sf, "beneficiary"), "policy_key", "share_pct")
    return found.select("policy_key", F.col("total").cast("string").alias("total"))


@query
def rule_transitions(spark, sf):
    found = rl.transition_violations(view(spark, sf, "status_history"), "policy_key", ["changed_at", "event_id"])
    return found.select("policy_key", "event_id", "previous_status", "status")


# -- reconciliation ----------------------------------------------------------------------------

_BY_POLICY = rc.Comparison(["policy_id"], order_by=["premium"])


def _results(spark, sf, how=_BY_POLICY, sides="recon"):
    return rc.reconcile(view(spark, sf, f"{sides}_source"), view(spark, sf, f"{sides}_target"), how)


@query
def recon_report(spark, sf):
    return rc.reconciliation_report(_results(spark, sf))


@query
def recon_results(spark, sf):
    return _results(spark, sf).select(
        "source_id", "target_id", "status", "severity", F.size("mismatches").cast("bigint").alias("differing"),
        "source_rows", "target_rows",
    )


@query
def recon_mismatch_detail(spark, sf):
    return rc.mismatch_details(_results(spark, sf))


@query
def recon_missing_target(spark, sf):
    return _results(spark, sf).where(F.col("status") == rc.MISSING_IN_TARGET).select("source_id", "severity")


@query
def recon_missing_source(spark, sf):
    found = _results(spark, sf).where(F.col("status") == rc.MISSING_IN_SOURCE)
    return found.select("source_id", "target_id", "severity")


@query
def recon_key_setops(spark, sf):
    return rc.key_set_counts(view(spark, sf, "recon_source"), view(spark, sf, "recon_target"), ["policy_id"])


@query
def recon_composite(spark, sf):
    how = rc.Comparison(["order_key", "line_no"])
    return _results(spark, sf, how, "lines").select("source_id", "target_id", "status", "severity")


@query
def recon_ignore_cols(spark, sf):
    how = rc.Comparison(["policy_id"], ignore=["status"], order_by=["premium"])
    return rc.mismatches_by_field(_results(spark, sf, how))


@query
def recon_listed_cols(spark, sf):
    how = rc.Comparison(["policy_id"], columns=["premium", "status", "no_such_column"], order_by=["premium"])
    return rc.mismatches_by_field(_results(spark, sf, how))


@query
def recon_dedup(spark, sf):
    rows = view(spark, sf, "claims_master")
    first = rc.first_per_key(rows, ["claim_id"], ["claim_amt", "claim_dt"], ["claim_dt"])
    return first.select(
        F.col("_k0").alias("claim_id"), F.col("_row.v0").alias("claim_amt"), F.col("_row.v1").alias("claim_dt"),
        F.col("_rows").alias("copies"),
    )


def _details(keys, sides, spark, sf):
    found = rc.mismatch_details(_results(spark, sf, rc.Comparison(keys), sides))
    return found.select("source_id", "field_name", "mismatch_type")


QUERIES["recon_nulls"] = partial(_details, ["id"], "nulls")
QUERIES["recon_numeric_text"] = partial(_details, ["id"], "spelled")
QUERIES["recon_tolerance"] = partial(_details, ["id"], "near")
QUERIES["recon_text"] = partial(_details, ["id"], "text")


@query
def recon_mismatch_json(spark, sf):
    rows = rc.result_rows(_results(spark, sf), JOB, "policies")
    return rows.select("source_record_id", "target_record_id", "status", "severity", "mismatched_fields", "resolved")


@query
def recon_summary(spark, sf):
    return rc.reconciliation_summary(_results(spark, sf), JOB)


@query
def recon_by_field(spark, sf):
    return rc.mismatches_by_field(_results(spark, sf))


@query
def recon_schema_diff(spark, sf):
    source = view(spark, sf, "probes").select("id", "amount", "day", "flag")
    target = source.select(
        F.col("id").cast("string").alias("id"),
        F.col("amount").try_cast("double").alias("amount"),
        F.col("day").try_cast("date").alias("day"),
        "flag",
    )
    return rc.schema_differences(source, target)


# -- lineage -----------------------------------------------------------------------------------

_COMMIT = "c0ffee"


def _lineage(spark, sf, records=None, name="policy_master", mapping=POLICY_MAPPING, job=JOB):
    rows = view(spark, sf, name)
    if records is not None:
        rows = ln.rows_of_records(rows, mapping, records)
    return ln.build_lineage(rows, mapping, job, _COMMIT, NOW)


def _claim_lineage(spark, sf, records=None):
    return _lineage(spark, sf, records, "claims_master", CLAIM_MAPPING, "JOB-2")


def _plain(lineage):
    return lineage.drop("created_at")


@query
def lineage_build(spark, sf):
    return _plain(_lineage(spark, sf))


@query
def lineage_roundtrip(spark, sf):
    space = Workspace.temporary(spark)
    space.record(_lineage(spark, sf), "lineage_records")
    stored = space.table("lineage_records").where(F.col("job_id") == JOB)
    return stored.groupBy("target_column").agg(
        F.count(F.lit(1)).alias("entries"), F.countDistinct("target_value").alias("target_values")
    )


@query
def lineage_forward(spark, sf):
    return _plain(ln.forward(_lineage(spark, sf), "db2_policies", "STATUS_CD", JOB))


@query
def lineage_backward(spark, sf):
    return _plain(ln.backward(_lineage(spark, sf), "fast_policies", "premium_amount"))


@query
def lineage_record(spark, sf):
    return _plain(ln.of_record(_lineage(spark, sf), "POL-000042"))


@query
def lineage_impact(spark, sf):
    both = _lineage(spark, sf).unionByName(_claim_lineage(spark, sf))
    return ln.impacts(both).select(
        "source_table", "source_column", "affected_tables", F.col("affected_columns").cast("bigint"),
        F.to_json("details").alias("details"),
    )


@query
def lineage_stats(spark, sf):
    return ln.statistics(_lineage(spark, sf).unionByName(_claim_lineage(spark, sf)))


@query
def lineage_filter(spark, sf):
    both = _lineage(spark, sf).unionByName(_claim_lineage(spark, sf))
    found = ln.search(both, entity_type="claims", field_name="status", etl_commit_id=_COMMIT, job_id="JOB-2")
    return found.select("record_id", "source_column", "source_value", "target_value")


def _shown_map(maps):
    failed = F.filter("fields", lambda f: ~f["validation_passed"])
    return maps.select(
        "job_id", "record_id", "total_fields", "entries", "validation_pass_rate",
        F.array_join(F.transform(failed, lambda f: f["field_name"]), ",").alias("failed_fields"),
        F.array_join(
            F.transform("fields", lambda f: F.concat_ws("=", f["field_name"], f["transformed_value"])), ";"
        ).alias("transformed"),
    )


@query
def lineage_map(spark, sf):
    source = view(spark, sf, "policy_master")
    wide, present = ln.wide_rows(source, POLICY_MAPPING), ln.present_fields(source, POLICY_MAPPING)
    return _shown_map(ln.data_map_of(wide, POLICY_MAPPING, present, rl.standard_rules(AS_OF), JOB, _COMMIT))


@query
def lineage_map_jobs(spark, sf):
    """Data maps of two jobs from stored lineage, with the failures of both."""
    space = Workspace.temporary(spark)
    space.record(_lineage(spark, sf).unionByName(_claim_lineage(spark, sf)), "lineage_records")
    claims = map_entity(view(spark, sf, "claims_master"), CLAIM_MAPPING)
    failures = rl.validation_failures(_mapped(spark, sf), rl.standard_rules(AS_OF)).withColumn("job_id", F.lit(JOB))
    others = rl.validation_failures(claims, rl.standard_rules(AS_OF), "claim_id").withColumn("job_id", F.lit("JOB-2"))
    maps = _shown_map(ln.data_map(space.table("lineage_records"), failures.unionByName(others)))
    return maps.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("total_fields").alias("fields"), F.sum("entries").alias("entries"),
        F.count_if(F.col("failed_fields") != "").alias("failing_records"),
    )


@query
def lineage_docs(spark, sf):
    return ln.documents(_lineage(spark, sf))


@query
def lineage_search(spark, sf):
    """The five lineage documents that fit each question best."""
    index = sr.text_index(ln.documents(_lineage(spark, sf).unionByName(_claim_lineage(spark, sf))))
    return sr.search_text(view(spark, sf, "question_log"), index)


# -- questions ---------------------------------------------------------------------------------


@query
def question_intent(spark, sf):
    return qs.intent_counts(view(spark, sf, "question_log"))


@query
def text_intent(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", qs.intent(F.col("text")).alias("intent"))


@query
def question_entities(spark, sf):
    return qs.with_entities(view(spark, sf, "question_log")).drop("asked_at", "session_id")


@query
def question_context(spark, sf):
    both = _lineage(spark, sf).unionByName(_claim_lineage(spark, sf))

    def fetch(records):
        return _lineage(spark, sf, records).unionByName(_claim_lineage(spark, sf, records))

    found = qs.question_context(view(spark, sf, "question_log"), both, fetch=fetch)
    return found.withColumn("details", F.to_json("details"))


@query
def history_trim(spark, sf):
    kept = qs.trim_history(view(spark, sf, "question_log"), "session_id", ["asked_at", "question_id"])
    return kept.select("session_id", "question_id", "question")


@query
def history_trim_short(spark, sf):
    return qs.trim_history(table(spark, sf, "conversations"), "conv_id", ["turn"], keep=3)


# -- pipeline ----------------------------------------------------------------------------------


def _migration(name, spark, sf, **options):
    report = run_migration(
        Workspace.temporary(spark), view(spark, sf, name), POLICY_MAPPING, BATCH_SIZE,
        as_of="2026-01-01", job_id=JOB, **options,
    )
    return report.to_frame(spark).drop("duration_ms")


def _migrated_twice(spark, sf):
    """A workspace in which one job has been rehearsed and then run."""
    space, source = Workspace.temporary(spark), view(spark, sf, "policy_clean")
    for options in ({"dry_run": True}, {"auto_promote": True}):
        run_migration(space, source, POLICY_MAPPING, BATCH_SIZE, as_of="2026-01-01", job_id=JOB, **options)
    return space


@query
def migration_retry(spark, sf):
    space = _migrated_twice(spark, sf)
    live = space.live("policies").agg(F.count(F.lit(1)).alias("live_rows"))
    staged = space.staged(JOB, "policies").agg(F.count(F.lit(1)).alias("staged_rows"))
    jobs = space.table("migration_jobs").agg(F.count(F.lit(1)).alias("jobs"))
    # One row each.
    return live.crossJoin(staged).crossJoin(jobs)


@query
def migration_progress(spark, sf):
    space = _migrated_twice(spark, sf)
    progress = pg.job_progress(space.table("migration_jobs"), space.table("migration_batches"), NOW)
    return progress.select(
        "job_id", "batches_total", "batches_completed", "batches_failed", "total_records", "processed_records",
        "progress_pct",
    )


@query
def migration_two_entities(spark, sf):
    """What is recorded after one job has taken two entities, the second one twice."""
    space = Workspace.temporary(spark)
    run_migration(space, view(spark, sf, "policy_clean"), POLICY_MAPPING, BATCH_SIZE, as_of="2026-01-01", job_id=JOB)
    claims = view(spark, sf, "claims_master")
    for _ in range(2):
        run_migration(space, claims, CLAIM_MAPPING, BATCH_SIZE, job_id=JOB, rules=[rl.not_null_rule("claim_id")])
    lines = space.table("lineage_records").groupBy("target_table").agg(F.count(F.lit(1)).alias("entries"))
    jobs = space.table("migration_jobs").select("entity_type", "status", "total_records", "processed_records")
    named = lines.withColumn("entity_type", F.substring_index("target_table", "_", -1)).drop("target_table")
    return jobs.join(named, "entity_type", "left")


@query
def migration_checksums(spark, sf):
    """The batches of a job: rows, and whether both checksums are there and those of its staged and loaded rows."""
    space, source = Workspace.temporary(spark), view(spark, sf, "policy_clean")
    run_migration(space, source, POLICY_MAPPING, BATCH_SIZE, as_of="2026-01-01", job_id=JOB)
    staged = ex.with_batches(ex.number_rows(space.staged(JOB, "policies")), BATCH_SIZE)
    loaded = space.loaded("policies", batches=True).withColumnRenamed(SLOT_BATCH, ex.BATCH)
    sides = [
        ex.batch_checksums(df, df.drop(ex.BATCH, ex.ROW_INDEX).columns, "xxhash64").select(ex.BATCH, F.col("checksum").alias(name))
        for df, name in ((staged, "_s"), (loaded, "_t"))
    ]
    batches = space.table("migration_batches").join(sides[0], ex.BATCH, "left").join(sides[1], ex.BATCH, "left")
    return batches.select(
        ex.BATCH, "record_count", "status", (F.col("checksum_source") == F.col("_s")).alias("source_is_staged"),
        (F.col("checksum_target") == F.col("_t")).alias("target_is_loaded"),
    )


@query
def migration_durations(spark, sf):
    """Per stage of a real job: batches timed, and whether their times sum up to the stage's own."""
    space = Workspace.temporary(spark)
    report = run_migration(space, view(spark, sf, "policy_clean"), POLICY_MAPPING, BATCH_SIZE, as_of="2026-01-01", job_id=JOB)
    took = spark.createDataFrame([(s.name, s.duration_ms) for s in report.stages], "stage STRING, took BIGINT")
    found = pg.stage_durations(space.table("migration_batches")).join(took, "stage")
    return found.select("stage", "batches", (F.col("total_ms") == F.col("took")).alias("is_whole"))


@query
def migration_report(spark, sf):
    return _migration("policy_clean", spark, sf, auto_promote=True)


@query
def migration_gated(spark, sf):
    return _migration("policy_master", spark, sf, auto_promote=True)


@query
def migration_rolled_back(spark, sf):
    target = [TargetField("product_type", "string", required=True), TargetField("premium_amount", "decimal(5,2)")]
    return _migration("policy_clean", spark, sf, target=target)


@query
def migration_dry_run(spark, sf):
    return _migration("policy_clean", spark, sf, dry_run=True)


@query
def promotion_decision(spark, sf):
    source, target = view(spark, sf, "recon_source"), view(spark, sf, "recon_target")
    damaged = rc.reconciliation_report(rc.reconcile(source, target, _BY_POLICY))
    whole = rc.reconciliation_report(rc.reconcile(source, source, _BY_POLICY))
    cases = [("damaged", damaged, True), ("whole, automatic", whole, True), ("whole, manual", whole, False)]
    rows = [
        pg.promotion_decision(report, auto).select(F.lit(case).alias("scenario"), "match_rate", "action")
        for case, report, auto in cases
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def job_progress(spark, sf):
    batches = view(spark, sf, "job_batches")
    jobs = batches.groupBy("job_id").agg(F.min("started_at").alias("started_at"))
    return pg.job_progress(jobs, batches, NOW)


@query
def stage_durations(spark, sf):
    return pg.stage_durations(view(spark, sf, "job_batches"))
