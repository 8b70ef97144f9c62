"""SQL twins of the queries, for a second engine over the same tables."""

from __future__ import annotations

from ferrytab.operators.mapping import CLAIM_MAPPING, POLICY_MAPPING, EntityMapping
from ferrytab.operators.rules import ALLOWED_TRANSITIONS, PREMIUM_RANGES, VALID_STATUSES
from ferrytab.functions.transforms import STATUS_CODES
from ferrytab.operators.questions import INTENT_PHRASES, KNOWN_COLUMNS, KNOWN_TABLES
from ferrytab.plans.catalogue import AS_OF, BATCH_SIZE, JOB, NOW
from ferrytab.plans.fixtures import with_views

# -- values ------------------------------------------------------------------------------------

_NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(quoted(v) for v in values)


def number(x: str) -> str:
    """Number of a text column."""
    bare = f"lower(trim({x}))"
    return (
        f"CASE WHEN regexp_full_match({bare}, '{_NUMBER}') THEN CAST(ltrim({bare}, '+') AS DOUBLE) "
        f"WHEN {bare} IN ('nan', '+nan', '-nan') THEN CAST('nan' AS DOUBLE) "
        f"WHEN {bare} IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE) "
        f"WHEN {bare} IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE) END"
    )


def trim_string(x):
    return f"nullif(trim({x}), '')"


def date_to_iso(x):
    packed = f"replace(replace(trim({x}), '-', ''), '/', '')"
    return (
        f"CASE WHEN {x} IS NULL OR trim({x}) IN ('', '0', '00000000') THEN NULL "
        f"WHEN length({packed}) = 8 THEN strftime(try_strptime({packed}, '%Y%m%d'), '%Y-%m-%d') ELSE {x} END"
    )


def decimal(x):
    return f"round({number(x)}, 4)"


def status_map(x):
    cases = " ".join(f"WHEN {quoted(code)} THEN {quoted(status)}" for code, status in STATUS_CODES.items())
    return f"CASE upper(trim({x})) {cases} ELSE upper(trim({x})) END"


def title_case(x):
    # upper() of this engine leaves ß as it is; the title form of ß is Ss.
    return (
        r"array_to_string(list_transform(regexp_extract_all(lower(trim(" + x + r")), '(\p{L}+|\P{L}+)'), "
        "lambda w: CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END || substr(w, 2)), '')"
    )


def phone(x):
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN length({digits}) = 10 THEN '+1' || {digits} "
        f"WHEN length({digits}) = 11 AND starts_with({digits}, '1') THEN '+' || {digits} ELSE nullif({digits}, '') END"
    )


def ssn_mask(x):
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({digits}) >= 4 THEN '***-**-' || right({digits}, 4) END"


def null_coalesce(x):
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN '' ELSE {x} END"


def cents(x):
    return f"CAST(round_even({number(x)} * 100, 0) AS BIGINT)"


def bool_flag(x):
    flag = f"upper(trim({x}))"
    return (
        f"CASE WHEN {flag} IN ('Y', 'YES', '1', 'T', 'TRUE') THEN true "
        f"WHEN {flag} IN ('N', 'NO', '0', 'F', 'FALSE') THEN false END"
    )


_TRANSFORMS = {
    "trim_string": trim_string,
    "db2_date_to_iso": date_to_iso,
    "packed_decimal_to_float": decimal,
    "status_code_map": status_map,
    "name_title_case": title_case,
    "phone_normalize": phone,
    "ssn_mask": ssn_mask,
    None: str,
}


def shown(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


def mapped(mapping: EntityMapping, source: str) -> str:
    columns = [f"{_TRANSFORMS[f.transform](f.source_column.lower())} AS {f.target_field}" for f in mapping.fields]
    return f"SELECT {', '.join(columns)} FROM {source}"


MAPPED = mapped(POLICY_MAPPING, "policy_master")

# -- extraction --------------------------------------------------------------------------------

_CLAIM_ORDER = "claim_id, policy_id, claim_amt, claim_dt, status_cd, diag_cd"


def _encoded(columns: list[str]) -> str:
    parts = [
        f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in sorted(columns)
    ]
    return " || ".join(parts)


def _digest(columns: list[str]) -> str:
    return f"CAST('0x' || substr(md5({_encoded(columns)}), 1, 15) AS BIGINT)"


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "day"]
_DIGEST_SUMS = (
    "count(*) AS record_count, CAST(sum(CAST(digest AS HUGEINT)) AS VARCHAR) AS digest_sum, "
    "bit_xor(digest) AS digest_xor"
)
_CHECKSUM = "md5(CAST(record_count AS VARCHAR) || '|' || digest_sum || '|' || CAST(digest_xor AS VARCHAR)) AS checksum"


def _checksums(source: str) -> str:
    """Batch checksums of order rows."""
    return (
        f"SELECT *, {_CHECKSUM} FROM (SELECT batch_number, {_DIGEST_SUMS} FROM (SELECT "
        f"(row_number() OVER (ORDER BY o_orderkey) - 1) // {BATCH_SIZE} AS batch_number, "
        f"{_digest(_ORDER_COLUMNS)} AS digest FROM {source}) GROUP BY batch_number)"
    )


def _draw(field: str, low: int, high: int) -> str:
    return (
        f"(CAST('0x' || substr(md5('7|{field}|' || CAST(o_orderkey AS VARCHAR)), 1, 12) AS BIGINT) "
        f"% {high - low + 1} + {low})"
    )


def _choice(field: str, values: list[str]) -> str:
    return f"([{listed(values)}])[{_draw(field, 1, len(values))}]"


_SYNTHETIC = f"""
SELECT 'POL-' || CAST({_draw("policy", 100000, 999999)} AS VARCHAR) AS policy_id,
       'CTR-' || CAST({_draw("contract", 1000, 9999)} AS VARCHAR) AS contract_id,
       'Policyholder_' || CAST(o_orderkey AS VARCHAR) AS holder_name,
       {_choice("product", ["TERM_LIFE", "WHOLE_LIFE", "ANNUITY", "UNIVERSAL"])} AS product_type,
       {_draw("premium", 5000, 500000)} / 100.0::DOUBLE AS premium_amount,
       {_draw("coverage", 1000000, 200000000)} / 100.0::DOUBLE AS coverage_amount,
       CAST({_draw("year", 2010, 2024)} AS VARCHAR) || '-' || lpad(CAST({_draw("month", 1, 12)} AS VARCHAR), 2, '0')
         || '-' || lpad(CAST({_draw("day", 1, 28)} AS VARCHAR), 2, '0') AS effective_date,
       {_choice("status", ["ACTIVE", "LAPSED", "PAID_UP", "SURRENDERED"])} AS status,
       {_draw("riders", 0, 5)} AS rider_count, '2026-01-15' AS last_modified
FROM orders"""

_RANGE_LOW = "CASE WHEN n = 0 THEN 'POL-' ELSE 'POL-' || lpad(CAST(n * 50 AS VARCHAR), 6, '0') END"
_RANGE_HIGH = "'POL-' || lpad(CAST((n + 1) * 50 AS VARCHAR), 6, '0')"
_SIDE_ROWS = " UNION ALL ".join(
    f"SELECT {side} AS side, (policy_id, holder, premium, status) AS r, CASE WHEN policy_id >= 'POL-' "
    "THEN least(CAST(substr(policy_id, 5) AS BIGINT) // 50, 119) ELSE -1 END AS n "
    f"FROM {name}"
    for side, name in ((1, "recon_source"), (2, "recon_target"))
)

ORACLE: dict[str, str] = {
    "source_count": "SELECT count(*) AS row_count FROM orders WHERE o_totalprice > 100000",
    "extract_page": with_views(
        ["order_rows"], "SELECT * FROM order_rows ORDER BY o_orderkey LIMIT 500 OFFSET 500"
    ),
    "extract_page_deep": with_views(
        ["claims_master"],
        f"SELECT * FROM claims_master ORDER BY {_CLAIM_ORDER} LIMIT {BATCH_SIZE} OFFSET {3 * BATCH_SIZE}",
    ),
    "extract_batches": with_views(
        ["claims_master"],
        f"SELECT *, row_index // {BATCH_SIZE} AS batch_number FROM (SELECT *, "
        f"row_number() OVER (ORDER BY {_CLAIM_ORDER}) - 1 AS row_index FROM claims_master)",
    ),
    "extract_summary": with_views(
        ["claims_master"],
        f"SELECT row_index // {BATCH_SIZE} AS batch_number, count(*) AS record_count, min(claim_id) AS min_key, "
        "max(claim_id) AS max_key FROM (SELECT claim_id, row_number() OVER (ORDER BY claim_id, claim_amt) - 1 "
        "AS row_index FROM claims_master WHERE status_cd <> 'N') GROUP BY ALL",
    ),
    "extract_totals": f"SELECT (count(*) + {BATCH_SIZE - 1}) // {BATCH_SIZE} AS batches, count(*) AS total_records "
    "FROM lineitem",
    "missing_batches": "SELECT batch_number FROM (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 10 "
    "AS batch_number, event_type FROM events) GROUP BY batch_number HAVING count(*) FILTER (event_type = 'purchase') = 0",
    "synthetic_policies": _SYNTHETIC,
    "batch_checksum": with_views(["order_rows"], _checksums("order_rows")),
    "combined_checksum": with_views(
        ["order_rows"],
        "SELECT md5(string_agg(c, '' ORDER BY n)) AS combined_checksum FROM "
        "(SELECT n // 1000 AS n, md5(string_agg(c, '' ORDER BY n)) AS c FROM "
        "(SELECT batch_number // 1000 AS n, md5(string_agg(checksum, '' ORDER BY batch_number)) AS c FROM "
        f"({_checksums('order_rows')}) GROUP BY 1) GROUP BY 1)",
    ),
    "table_checksum": with_views(
        ["claims_master"],
        f"SELECT *, {_CHECKSUM} FROM (SELECT {_DIGEST_SUMS} FROM "
        f"(SELECT {_digest(_CLAIM_ORDER.split(', '))} AS digest FROM claims_master))",
    ),
    "key_ranges": with_views(["claims_master"], "SELECT 1 AS ranges, count(*) AS rows, true AS even FROM claims_master"),
    "checksum_drilldown": with_views(
        ["recon_source", "recon_target"],
        f"SELECT CASE WHEN n >= 0 THEN {_RANGE_LOW} END AS low, CASE WHEN n < 0 THEN 'POL-' WHEN n >= 119 THEN 'POM' ELSE {_RANGE_HIGH} END AS high, "
        "source_rows, target_rows FROM (SELECT n, count(*) FILTER (side = 1) AS source_rows, "
        "count(*) FILTER (side = 2) AS target_rows, "
        "list(r ORDER BY r) FILTER (side = 1) IS DISTINCT FROM list(r ORDER BY r) FILTER (side = 2) AS differs "
        f"FROM ({_SIDE_ROWS}) GROUP BY n) WHERE differs",
    ),
    "checksum_compare": with_views(
        ["order_rows", "order_rows_changed"],
        "SELECT batch_number, s.checksum AS checksum_source, t.checksum AS checksum_target, "
        "s.checksum IS NOT DISTINCT FROM t.checksum AS is_equal "
        f"FROM ({_checksums('order_rows')}) s FULL JOIN ({_checksums('order_rows_changed')}) t USING (batch_number)",
    ),
}

# -- staging and publishing --------------------------------------------------------------------

_POLICY_BATCHES = (
    f"SELECT policy_id, prem_amt, (row_number() OVER (ORDER BY policy_id, prem_amt) - 1) // {BATCH_SIZE} "
    "AS batch_number FROM policy_master"
)
_MISFIT = "policy_id IS NULL OR effective_date IS NULL OR try_cast(effective_date AS DATE) IS NULL"


def _load(dry_run: str) -> str:
    return with_views(
        ["policy_master"],
        f"SELECT 'policies' AS entity, 'green' AS slot, {dry_run} AS dry_run, count(*) FILTER (NOT ({_MISFIT})) AS total_loaded, "
        f"count(*) FILTER ({_MISFIT}) AS total_errors FROM ({MAPPED})",
    )


def _live(step: str, slot: str, source: str) -> str:
    return (
        f"SELECT count(*) AS live_rows, count(status) AS with_status, {quoted(step)} AS step, {quoted(slot)} AS slot "
        f"FROM {source}"
    )


_REFUSED = " UNION ALL ".join(
    [
        "SELECT policy_id, 'policy_id' AS field, CAST(NULL AS VARCHAR) AS value, 'required value is null' AS reason "
        "FROM mapped WHERE policy_id IS NULL",
        "SELECT policy_id, 'effective_date', NULL, 'required value is null' FROM mapped WHERE effective_date IS NULL",
        "SELECT policy_id, 'effective_date', effective_date, 'does not fit date' FROM mapped "
        "WHERE effective_date IS NOT NULL AND try_cast(effective_date AS DATE) IS NULL",
    ]
)

ORACLE |= {
    "load_errors": with_views(["policy_master"], "").rstrip() + f", mapped AS ({MAPPED}) {_REFUSED}",
    "stage_roundtrip": with_views(["policy_master"], _POLICY_BATCHES),
    "stage_list": with_views(
        ["policy_master"], f"SELECT batch_number, count(*) AS record_count FROM ({_POLICY_BATCHES}) GROUP BY 1"
    ),
    "stage_discard": with_views(
        ["policy_master"],
        "SELECT 'staged__policies__extract' AS staged_table, count(*) AS rows_removed, count(*) AS rows_archived "
        "FROM policy_master",
    ),
    "load_slot": _load("false"),
    "load_dry_run": _load("true"),
    "loaded_rows": with_views(
        ["policy_master"],
        "SELECT policy_id, CAST(CAST(effective_date AS DATE) AS VARCHAR) AS effective_date, "
        f"CAST(premium_amount AS DECIMAL(12,2)) AS premium_amount, status FROM ({MAPPED}) WHERE NOT ({_MISFIT})",
    ),
    "publish_slot": with_views(
        ["recon_source", "recon_target"],
        f"{_live('first', 'blue', 'recon_source')} UNION ALL {_live('promoted', 'green', 'recon_target')} "
        f"UNION ALL {_live('swapped back', 'blue', 'recon_source')}",
    ),
    "discard_slot": with_views(
        ["recon_source"], "SELECT count(*) AS live_rows, false AS green_exists FROM recon_source"
    ),
    "rollback_report": with_views(
        ["policy_master"],
        f"SELECT '{JOB}' AS job_id, 'test' AS reason, 'green' AS deployment_rolled_back, true AS success, "
        "CAST(0 AS BIGINT) AS errors, count(*) AS staged_rows_removed, count(*) AS staged_rows_archived, "
        "true AS could_roll_back FROM policy_master",
    ),
    "audit_events": with_views(
        ["event_log"],
        "SELECT event_type, count(*) AS events, count(DISTINCT actor) AS actors, "
        "strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS first_at, "
        "strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS last_at FROM event_log GROUP BY 1",
    ),
}

# -- mapping and transforms --------------------------------------------------------------------

_CODE = f"coalesce({status_map('code')}, 'UNKNOWN')"
_STAT = (
    "SELECT {column} AS column_name, {transform} AS transform, count(*) FILTER ({changed}) AS records_changed, "
    "count(*) AS total_records FROM policy_master"
)


def _stat(column: str, transform: str, before: str, after: str) -> str:
    return _STAT.format(
        column=quoted(column), transform=quoted(transform), changed=f"{before} IS DISTINCT FROM {after}"
    )


def _retyped(column: str, transform: str, before: str, after: str) -> str:
    changed = f"({before}) IS NOT NULL OR ({after}) IS NOT NULL"
    return _STAT.format(column=quoted(column), transform=quoted(transform), changed=changed)


_STEPS = [
    _stat("first_nm", "trim_string", "first_nm", trim_string("first_nm")),
    _stat("first_nm", "name_title_case", trim_string("first_nm"), title_case("first_nm")),
    _stat("last_nm", "trim_string", "last_nm", trim_string("last_nm")),
    _stat("last_nm", "name_title_case", trim_string("last_nm"), title_case("last_nm")),
    _stat("last_nm", "null_coalesce", title_case("last_nm"), null_coalesce(title_case("last_nm"))),
    _retyped("prem_amt", "packed_decimal_to_float", "prem_amt", decimal("prem_amt")),
    _stat("prem_amt", "currency_to_cents", decimal("prem_amt"), f"CAST({cents('prem_amt')} AS DOUBLE)"),
    _stat("status_cd", "trim_string", "status_cd", trim_string("status_cd")),
    _stat("status_cd", "status_code_map", trim_string("status_cd"), status_map("status_cd")),
    _stat("prod_typ", "trim_string", "prod_typ", trim_string("prod_typ")),
    _stat("eff_dt", "db2_date_to_iso", "eff_dt", date_to_iso("eff_dt")),
]

ORACLE |= {
    "map_policies": with_views(["policy_master"], MAPPED),
    "map_claims": with_views(["claims_master"], mapped(CLAIM_MAPPING, "claims_master")),
    "map_defaults": with_views(
        ["probes"],
        f"SELECT id, coalesce({trim_string('padded')}, 'none') AS priority, {_CODE} AS status, "
        f"{date_to_iso('day')} AS day FROM probes",
    ),
    "map_required": with_views(
        ["probes"],
        "SELECT 'day_required' AS rule_name, 'critical' AS severity, "
        f"count(*) FILTER (({date_to_iso('day')}) IS NULL) AS failures FROM probes",
    ),
    "transform_chain": with_views(
        ["policy_master"],
        f"SELECT policy_id, {title_case('first_nm')} AS first_nm, {title_case('last_nm')} AS last_nm, "
        f"{cents('prem_amt')} AS prem_amt, cov_amt, {date_to_iso('eff_dt')} AS eff_dt, "
        f"{status_map('status_cd')} AS status_cd, {trim_string('prod_typ')} AS prod_typ, phone_no, ssn "
        "FROM policy_master",
    ),
    "transform_stats": with_views(
        ["policy_master"], f"SELECT * FROM ({' UNION ALL '.join(_STEPS)}) WHERE records_changed > 0"
    ),
    "transform_custom_udf": "SELECT o_orderkey, 'P' || CAST(CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) * 2 "
    "AS VARCHAR) AS o_orderpriority FROM orders",
    "transform_describe": with_views(
        ["probes"],
        "SELECT id, 'status_code_map(' || coalesce('''' || code || '''', 'None') || ') → ' || "
        f"coalesce('''' || {status_map('code')} || '''', 'None') AS description FROM probes",
    ),
    "tf_title_case": f"SELECT doc_id, text, {title_case('text')} AS result FROM documents",
}
for _key, _build, _column in (
    ("tf_trim_string", trim_string, "padded"),
    ("tf_date_to_iso", date_to_iso, "day"),
    ("tf_decimal", decimal, "amount"),
    ("tf_status_map", status_map, "code"),
    ("tf_phone", phone, "phone"),
    ("tf_ssn_mask", ssn_mask, "ssn"),
    ("tf_null_coalesce", null_coalesce, "padded"),
    ("tf_cents", cents, "amount"),
    ("tf_bool_flag", bool_flag, "flag"),
):
    ORACLE[_key] = with_views(["probes"], f"SELECT id, {_column}, {_build(_column)} AS result FROM probes")

# -- rules -------------------------------------------------------------------------------------

_ISO = (
    "CASE WHEN regexp_full_match(substr(effective_date, 1, 10), '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') "
    "THEN try_strptime(substr(effective_date, 1, 10), '%Y-%m-%d') END"
)
_RANGES = " ".join(f"WHEN {quoted(p)} THEN premium_amount BETWEEN {a} AND {b}" for p, (a, b) in PREMIUM_RANGES.items())
# name, field, severity, expected, text before and after the value in the message, condition
_RULES = [
    ("policy_id_format", "policy_id", "critical", "POL-XXXXXX format", "Invalid policy ID format: ", "",
     "regexp_full_match(policy_id, 'POL-[A-Z0-9]{6,10}')"),
    ("premium_positive", "premium_amount", "critical", "> 0", "Premium must be positive, got: ", "",
     "premium_amount > 0"),
    ("coverage_exceeds_minimum", "coverage_amount", "warning", ">= 1000.00", "Coverage below minimum $1,000: ", "",
     "coverage_amount >= 1000"),
    ("effective_date_valid", "effective_date", "critical", "valid date, not future",
     "Invalid or future effective date: ", "", f"{_ISO} <= DATE '{AS_OF}'"),
    ("status_valid", "status", "critical", "One of " + ", ".join(VALID_STATUSES), "Invalid policy status: ", "",
     f"upper(status) IN ({listed(VALID_STATUSES)})"),
    ("product_type_valid", "product_type", "critical", "One of " + ", ".join(PREMIUM_RANGES),
     "Unknown product type: ", "", f"upper(product_type) IN ({listed(PREMIUM_RANGES)})"),
    ("premium_within_range", "premium_amount", "warning", "Within product range", "Premium ",
     " outside range for product type",
     f"CASE upper(product_type) {_RANGES} ELSE premium_amount BETWEEN 1 AND 1000000 END"),
]
_FAILURES = " UNION ALL ".join(
    f"SELECT policy_id AS record_id, {quoted(n)} AS rule_name, {quoted(f)} AS field_name, {quoted(e)} AS expected, "
    f"{shown(f)} AS actual, {quoted(a)} || {shown(f)} || {quoted(z)} AS message, {quoted(s)} AS severity "
    f"FROM mapped WHERE NOT coalesce({c}, false)"
    for n, f, s, e, a, z, c in _RULES
)


def _on_mapped(body: str) -> str:
    return with_views(["policy_master"], "").rstrip() + f", mapped AS ({MAPPED})\n{body}"


for _key, _name in (
    ("rule_premium_positive", "premium_positive"),
    ("rule_coverage_min", "coverage_exceeds_minimum"),
    ("rule_effective_date", "effective_date_valid"),
    ("rule_status", "status_valid"),
    ("rule_product_type", "product_type_valid"),
    ("rule_premium_range", "premium_within_range"),
):
    _condition = next(r[6] for r in _RULES if r[0] == _name)
    ORACLE[_key] = _on_mapped(f"SELECT policy_id AS record_id, coalesce({_condition}, false) AS passed FROM mapped")

_PAIRS = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in ALLOWED_TRANSITIONS)

ORACLE |= {
    "rule_policy_id": with_views(
        ["claims_master"],
        "SELECT id AS record_id, regexp_full_match(id, 'POL-[A-Z0-9]{6,10}') AS passed FROM "
        "(SELECT claim_id AS id FROM claims_master UNION ALL SELECT policy_id FROM claims_master)",
    ),
    "rule_custom": _on_mapped(
        "SELECT * FROM (SELECT 'coverage_covers_premium' AS rule_name, 'warning' AS severity, "
        "count(*) FILTER (coverage_amount < premium_amount) AS failures FROM mapped UNION ALL "
        "SELECT 'recent', 'critical', count(*) FILTER (effective_date IS NULL) FROM mapped UNION ALL "
        "SELECT 'recent', 'warning', count(*) FILTER (CAST(substr(effective_date, 1, 4) AS INT) < 1993) FROM mapped) "
        "WHERE failures > 0"
    ),
    "validate_failures": _on_mapped(_FAILURES),
    "validate_by_rule": _on_mapped(
        f"SELECT rule_name, severity, count(*) AS failures FROM ({_FAILURES}) GROUP BY ALL"
    ),
    "validate_report": _on_mapped(
        "SELECT total_records, total_checks, total_checks - failed AS passed, failed, critical_failures, "
        "records_failed, (total_checks - failed) / total_checks * 100 AS pass_rate, "
        "critical_failures = 0 AND (total_checks - failed) / total_checks * 100 >= 99.9 AS acceptable FROM "
        "(SELECT count(*) AS failed, count(*) FILTER (severity = 'critical') AS critical_failures, "
        f"count(DISTINCT record_id) AS records_failed FROM ({_FAILURES})), "
        f"(SELECT count(*) AS total_records, count(*) * {len(_RULES)} AS total_checks FROM mapped)"
    ),
    "rule_group_sum": with_views(
        ["beneficiary"],
        "SELECT policy_key, CAST(CAST(sum(share_pct) AS DECIMAL(38,4)) AS VARCHAR) AS total FROM beneficiary "
        "GROUP BY 1 HAVING sum(share_pct) <> 100",
    ),
    "rule_transitions": with_views(
        ["status_history"],
        "SELECT policy_key, event_id, previous_status, status FROM (SELECT *, lag(status) OVER "
        "(PARTITION BY policy_key ORDER BY changed_at, event_id) AS previous_status FROM status_history) "
        "WHERE previous_status IS NOT NULL AND previous_status <> status "
        f"AND (previous_status, status) NOT IN ({_PAIRS})",
    ),
}

# -- reconciliation ----------------------------------------------------------------------------

TEXT, DOUBLE, OTHER = "text", "double", "other"


def _mismatch(name: str, kinds: tuple[str, str], tolerance: float = 0.001) -> str:
    s, t = f"s.{name}", f"t.{name}"
    s_null = f"({s} IS NULL OR isnan({s}))" if kinds[0] == DOUBLE else f"{s} IS NULL"
    t_null = f"({t} IS NULL OR isnan({t}))" if kinds[1] == DOUBLE else f"{t} IS NULL"
    numbers = [
        {DOUBLE: c, TEXT: f"({number(c)})", OTHER: "CAST(NULL AS DOUBLE)"}[k] for c, k in zip((s, t), kinds)
    ]
    a, b = numbers
    close = (
        f"CASE WHEN isnan({a}) OR isnan({b}) THEN false WHEN {a} = {b} THEN true "
        f"WHEN isinf({a}) OR isinf({b}) THEN false "
        f"ELSE abs({a} - {b}) <= greatest(1e-9 * greatest(abs({a}), abs({b})), {tolerance}) END"
    )
    texts = [f"lower(trim(CAST({c} AS VARCHAR), ' \t\n'))" for c in (s, t)]
    equal = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {close} ELSE {texts[0]} = {texts[1]} END"
    return (
        f"CASE WHEN {s_null} AND {t_null} THEN NULL WHEN {t_null} THEN 'missing' WHEN {s_null} THEN 'extra' "
        f"WHEN NOT ({equal}) THEN 'value' END"
    )


def _paired(sides: str, keys: list[str], kinds: dict[str, tuple[str, str]], order_by: list[str] = []) -> str:
    """Records of both sides with the mismatch of each column as m_<column>."""
    order = [*order_by, *(c for c in sorted(kinds) if c not in order_by)]
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)

    def side(name: str) -> str:
        ranked = ", ".join(f"{c} NULLS FIRST" for c in order)
        return (
            f"(SELECT *, {key} AS record_key, count(*) OVER (PARTITION BY {', '.join(keys)}) AS copies "
            f"FROM {sides}_{name} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ranked}) = 1)"
        )

    flags = ", ".join(
        f"CASE WHEN s.record_key IS NOT NULL AND t.record_key IS NOT NULL THEN {_mismatch(c, k)} END AS m_{c}"
        for c, k in kinds.items()
    )
    values = ", ".join(f"s.{c} AS s_{c}, t.{c} AS t_{c}" for c in kinds)
    differs = " OR ".join(f"m_{c} IS NOT NULL" for c in kinds)
    key_differs = " OR ".join(f"coalesce(m_{k} = 'value', false)" for k in keys if k in kinds) or "false"
    return (
        "SELECT *, CASE WHEN t_key IS NULL THEN 'missing_in_target' WHEN s_key IS NULL THEN 'missing_in_source' "
        f"WHEN {differs} THEN 'mismatched' ELSE 'matched' END AS status, "
        f"CASE WHEN t_key IS NULL THEN 'critical' WHEN s_key IS NULL THEN 'warning' WHEN {key_differs} THEN 'critical' "
        f"WHEN {differs} THEN 'warning' ELSE 'info' END AS severity, coalesce(s_key, '') AS source_id, "
        "t_key AS target_id FROM (SELECT s.record_key AS s_key, t.record_key AS t_key, "
        "coalesce(s.copies, 0) AS source_rows, coalesce(t.copies, 0) AS target_rows, "
        f"{flags}, {values} FROM {side('source')} s FULL JOIN {side('target')} t USING (record_key))"
    )


def _detail_rows(paired: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT source_id, {quoted(c)} AS field_name, CAST(s_{c} AS VARCHAR) AS source_value, "
        f"CAST(t_{c} AS VARCHAR) AS target_value, m_{c} AS mismatch_type FROM ({paired}) WHERE m_{c} IS NOT NULL"
        for c in columns
    )


_POLICY_KINDS = {
    "holder": (TEXT, TEXT), "policy_id": (TEXT, TEXT), "premium": (DOUBLE, DOUBLE), "status": (TEXT, TEXT),
}
_PAIRED = _paired("recon", ["policy_id"], _POLICY_KINDS, ["premium"])
_DETAILS = _detail_rows(_PAIRED, list(_POLICY_KINDS))
_SIDES = ["recon_source", "recon_target"]
_STATUS_COUNTS = ", ".join(
    f"count(*) FILTER (status = '{s}') AS {s}" for s in ("matched", "mismatched", "missing_in_target", "missing_in_source")
)
_RATE = "matched / (matched + mismatched + missing_in_target + missing_in_source) * 100"


def _fields(paired: str, columns: list[str]) -> str:
    return (
        f"SELECT field_name, mismatch_type, count(*) AS mismatches FROM ({_detail_rows(paired, columns)}) GROUP BY ALL"
    )


def _details_of(sides: str, kinds: dict[str, tuple[str, str]]) -> str:
    rows = _detail_rows(_paired(sides, ["id"], kinds), list(kinds))
    return with_views([f"{sides}_source", f"{sides}_target"], f"SELECT source_id, field_name, mismatch_type FROM ({rows})")


_REPORT = (
    f"SELECT *, {_RATE} AS match_rate, {_RATE} >= 99.99 AND missing_in_target = 0 AS acceptable FROM "
    "(SELECT CAST(sum(source_rows) AS BIGINT) AS total_source, CAST(sum(target_rows) AS BIGINT) AS total_target, "
    f"{_STATUS_COUNTS} FROM ({_PAIRED}))"
)
_JSON = " || ',' || ".join(f"coalesce('\"{c}\":\"' || m_{c} || '\"', '')" for c in _POLICY_KINDS)
_ID = (DOUBLE, DOUBLE)

ORACLE |= {
    "recon_report": with_views(_SIDES, _REPORT),
    "recon_results": with_views(
        _SIDES,
        "SELECT source_id, target_id, status, severity, "
        + " + ".join(f"CAST(m_{c} IS NOT NULL AS BIGINT)" for c in _POLICY_KINDS)
        + f" AS differing, source_rows, target_rows FROM ({_PAIRED})",
    ),
    "recon_mismatch_detail": with_views(_SIDES, _DETAILS),
    "recon_missing_target": with_views(
        _SIDES, f"SELECT source_id, severity FROM ({_PAIRED}) WHERE status = 'missing_in_target'"
    ),
    "recon_missing_source": with_views(
        _SIDES, f"SELECT source_id, target_id, severity FROM ({_PAIRED}) WHERE status = 'missing_in_source'"
    ),
    "recon_key_setops": with_views(
        _SIDES,
        "SELECT 'common' AS key_set, count(*) AS keys FROM (SELECT policy_id FROM recon_source INTERSECT "
        "SELECT policy_id FROM recon_target) UNION ALL SELECT 'source_only', count(*) FROM (SELECT policy_id "
        "FROM recon_source EXCEPT SELECT policy_id FROM recon_target) UNION ALL SELECT 'target_only', count(*) "
        "FROM (SELECT policy_id FROM recon_target EXCEPT SELECT policy_id FROM recon_source)",
    ),
    "recon_composite": with_views(
        ["lines_source", "lines_target"],
        "SELECT source_id, target_id, status, severity FROM ("
        + _paired(
            "lines",
            ["order_key", "line_no"],
            {"flag": (TEXT, TEXT), "line_no": (OTHER, OTHER), "order_key": (OTHER, OTHER), "price": (DOUBLE, DOUBLE)},
        )
        + ")",
    ),
    "recon_ignore_cols": with_views(_SIDES, _fields(_PAIRED, ["holder", "policy_id", "premium"])),
    "recon_listed_cols": with_views(_SIDES, _fields(_PAIRED, ["premium", "status"])),
    "recon_dedup": with_views(
        ["claims_master"],
        "SELECT claim_id, claim_amt, claim_dt, count(*) OVER (PARTITION BY claim_id) AS copies FROM claims_master "
        "QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY claim_dt NULLS FIRST, claim_amt NULLS FIRST) = 1",
    ),
    "recon_nulls": _details_of("nulls", {"amount": (DOUBLE, DOUBLE), "id": _ID, "kind": (TEXT, TEXT)}),
    "recon_numeric_text": _details_of("spelled", {"as_double": (TEXT, DOUBLE), "as_text": (TEXT, TEXT), "id": _ID}),
    "recon_tolerance": _details_of(
        "near", {"id": _ID, "large": (DOUBLE, DOUBLE), "small": (DOUBLE, DOUBLE), "special": (TEXT, TEXT)}
    ),
    "recon_text": _details_of(
        "text", {"day": (OTHER, TEXT), "holder": (TEXT, TEXT), "id": _ID, "priority": (TEXT, TEXT)}
    ),
    "recon_mismatch_json": with_views(
        _SIDES,
        "SELECT source_id AS source_record_id, target_id AS target_record_id, status, severity, "
        "CASE WHEN status = 'mismatched' THEN '{' || trim(regexp_replace("
        f"{_JSON}, ',+', ',', 'g'), ',') || '}}' END AS mismatched_fields, false AS resolved "
        f"FROM ({_PAIRED}) WHERE status <> 'matched'",
    ),
    "recon_summary": with_views(
        _SIDES,
        f"SELECT total_records, matched, mismatched, missing_in_target, missing_in_source, critical_issues, warnings, "
        f"{_RATE} AS match_rate_pct, '{JOB}' AS job_id FROM (SELECT count(*) AS total_records, {_STATUS_COUNTS}, "
        "count(*) FILTER (severity = 'critical') AS critical_issues, count(*) FILTER (severity = 'warning') AS warnings "
        f"FROM ({_PAIRED}))",
    ),
    "recon_by_field": with_views(_SIDES, _fields(_PAIRED, list(_POLICY_KINDS))),
    "recon_schema_diff": with_views(
        ["probes"],
        "SELECT 'id' AS column_name, 'bigint' AS source_type, 'string' AS target_type, count(id) AS values, "
        "CAST(0 AS BIGINT) AS lost, 'type_mismatch' AS status FROM probes UNION ALL "
        "SELECT 'amount', 'string', 'double', count(amount), count(*) FILTER (amount IS NOT NULL AND "
        f"({number('amount')}) IS NULL), 'type_mismatch' FROM probes UNION ALL "
        "SELECT 'day', 'string', 'date', count(day), count(*) FILTER (day IS NOT NULL AND NOT "
        "regexp_full_match(day, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')), 'type_mismatch' FROM probes",
    ),
}

# -- lineage -----------------------------------------------------------------------------------


def _lineage(mapping: EntityMapping, source: str, job: str) -> str:
    key = _TRANSFORMS[mapping.key.transform](mapping.key.source_column.lower())
    branches = []
    for f in mapping.fields:
        place = f"'|{mapping.source_table}|{f.source_column}|{mapping.target_table}|{f.target_field}'"
        branches.append(
            f"SELECT md5('{job}|' || {shown(key)} || {place}) AS lineage_id, '{job}' AS job_id, {shown(key)} AS record_id, "
            f"'{mapping.source_table}' AS source_table, '{f.source_column}' AS source_column, "
            f"{shown(f.source_column.lower())} AS source_value, '{mapping.target_table}' AS target_table, "
            f"'{f.target_field}' AS target_column, "
            f"{shown(_TRANSFORMS[f.transform](f.source_column.lower()))} AS target_value, "
            f"'{f.transform}' AS transformation, 'c0ffee' AS etl_commit_id FROM {source}"
        )
    return " UNION ALL ".join(branches)


_POLICY_LINEAGE = _lineage(POLICY_MAPPING, "policy_master", JOB)
_CLAIM_LINEAGE = _lineage(CLAIM_MAPPING, "claims_master", "JOB-2")


def _on_lineage(body: str, both: bool = False) -> str:
    rows = f"{_POLICY_LINEAGE} UNION ALL {_CLAIM_LINEAGE}" if both else _POLICY_LINEAGE
    views = ["policy_master", "claims_master"] if both else ["policy_master"]
    return with_views(views, "").rstrip() + f", lineage AS ({rows})\n{body}"


_PAIR_COUNTS = "SELECT DISTINCT source_table, source_column, target_table, target_column FROM lineage"

ORACLE |= {
    "lineage_build": _on_lineage("SELECT * FROM lineage"),
    "lineage_roundtrip": _on_lineage(
        "SELECT target_column, count(*) AS entries, count(DISTINCT target_value) AS target_values FROM lineage GROUP BY 1"
    ),
    "lineage_forward": _on_lineage(
        "SELECT * FROM lineage WHERE source_table = 'db2_policies' AND source_column = 'STATUS_CD'"
    ),
    "lineage_backward": _on_lineage(
        "SELECT * FROM lineage WHERE target_table = 'fast_policies' AND target_column = 'premium_amount'"
    ),
    "lineage_record": _on_lineage("SELECT * FROM lineage WHERE record_id = 'POL-000042'"),
    "lineage_impact": _on_lineage(
        "SELECT source_table, source_column, count(DISTINCT target_table) AS affected_tables, count(*) AS affected_columns, "
        "'{\"' || min(target_table) || '\":[\"' || string_agg(target_column, '\",\"' ORDER BY target_column) || '\"]}' "
        f"AS details FROM ({_PAIR_COUNTS}) GROUP BY 1, 2",
        both=True,
    ),
    "lineage_stats": _on_lineage("SELECT job_id, count(*) AS total_tracked FROM lineage GROUP BY 1", both=True),
    "lineage_filter": _on_lineage(
        "SELECT record_id, source_column, source_value, target_value FROM lineage WHERE job_id = 'JOB-2' "
        "AND target_column = 'status'",
        both=True,
    ),
    "lineage_map": with_views(["policy_master"], "").rstrip()
    + f", mapped AS ({MAPPED}), lineage AS ({_POLICY_LINEAGE}), failed AS (SELECT DISTINCT record_id, "
    f"field_name AS target_column FROM ({_FAILURES})) "
    "SELECT job_id, record_id, count(*) AS total_fields, count(*) AS entries, "
    "(count(*) - count(f.target_column)) / count(*) * 100 AS validation_pass_rate, "
    "coalesce(string_agg(f.target_column, ',' ORDER BY f.target_column), '') AS failed_fields, "
    "string_agg(l.target_column || '=' || target_value, ';' ORDER BY l.target_column) AS transformed "
    "FROM lineage l LEFT JOIN failed f USING (record_id, target_column) GROUP BY 1, 2",
    "lineage_map_jobs": with_views(["policy_master", "claims_master"], "").rstrip()
    + f", mapped AS ({MAPPED}), lineage AS ({_POLICY_LINEAGE} UNION ALL {_CLAIM_LINEAGE}), "
    f"claims AS ({mapped(CLAIM_MAPPING, 'claims_master')}), failed AS ("
    f"SELECT DISTINCT '{JOB}' AS job_id, record_id FROM ({_FAILURES}) UNION SELECT 'JOB-2', claim_id FROM claims "
    f"WHERE NOT coalesce(upper(status) IN ({listed(VALID_STATUSES)}), false) "
    "OR NOT coalesce(regexp_full_match(policy_id, 'POL-[A-Z0-9]{6,10}'), false)) "
    "SELECT job_id, count(DISTINCT record_id) AS records, count(DISTINCT (record_id, target_column)) AS fields, "
    "count(*) AS entries, count(DISTINCT f.record_id) AS failing_records "
    "FROM lineage l LEFT JOIN failed f USING (job_id, record_id) GROUP BY 1",
    "lineage_docs": _on_lineage(
        "SELECT lineage_id, 'Source: ' || source_table || '.' || source_column || ' → Target: ' || target_table || '.' "
        "|| target_column || ' Transform: ' || transformation || ' Job: ' || job_id AS document FROM lineage"
    ),
}

# -- questions ---------------------------------------------------------------------------------


def _intent(x: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({x}), {quoted(p)})" for p in phrases) + f" THEN '{name}'"
        for name, phrases in INTENT_PHRASES
    )
    return f"CASE {cases} ELSE 'general' END"


_KNOWN_COLUMN = (
    "CASE " + " ".join(f"WHEN contains(lower(question), '{c}') THEN '{c}'" for c in KNOWN_COLUMNS) + " END"
)
_KNOWN_TABLE = (
    "CASE " + " ".join(f"WHEN contains(lower(question), '{t}') THEN '{t}'" for t in KNOWN_TABLES) + " END"
)
_ENTITIES = (
    "SELECT question_id, question, nullif(regexp_extract(question, '(?i)POL-[0-9]{6}'), '') AS record_id, "
    rf"coalesce(nullif(regexp_extract(question, '(\w+)\.(\w+)', 1), ''), 'db2_' || {_KNOWN_TABLE}) AS source_table, "
    rf"coalesce(nullif(regexp_extract(question, '(\w+)\.(\w+)', 2), ''), {_KNOWN_COLUMN}) AS source_column, "
    f"'fast_' || {_KNOWN_TABLE} AS target_table, {_KNOWN_COLUMN} AS target_column FROM question_log"
)
_ENTRY = "record_id, source_table, source_column, target_table, target_column, transformation"
_REST = "job_id, lineage_id, source_value, target_value, etl_commit_id"


def _top(lookup: str, a: str, b: str, n: int) -> str:
    return (
        f"SELECT '{lookup}' AS lookup, {a} AS a, {b} AS b, {_ENTRY}, {_REST}, row_number() OVER (PARTITION BY {a}, {b} "
        f"ORDER BY {_ENTRY}, {_REST}) AS rank FROM lineage QUALIFY rank <= {n}"
    )


_ROUTED = (
    "SELECT *, CASE WHEN intent = 'lineage_backward' AND target_column IS NOT NULL THEN 'backward' "
    "WHEN intent = 'lineage_forward' AND source_column IS NOT NULL THEN 'forward' "
    "WHEN intent = 'impact' AND source_column IS NOT NULL THEN 'impact' "
    "WHEN record_id IS NOT NULL THEN 'record' END AS lookup "
    f"FROM (SELECT *, {_intent('question')} AS intent FROM entities)"
)
_CONTEXT = f"""
, entities AS ({_ENTITIES}), routed AS ({_ROUTED}), asked AS (
  SELECT question_id, intent, lookup,
         CASE lookup WHEN 'backward' THEN coalesce(target_table, '') WHEN 'record' THEN record_id
              ELSE coalesce(source_table, '') END AS a,
         CASE lookup WHEN 'backward' THEN target_column WHEN 'record' THEN '' ELSE source_column END AS b
  FROM routed WHERE lookup IS NOT NULL),
entries AS ({_top("backward", "target_table", "target_column", 10)} UNION ALL
            {_top("forward", "source_table", "source_column", 10)} UNION ALL
            {_top("record", "record_id", "''", 20)}),
impacts AS (SELECT source_table AS a, source_column AS b, count(DISTINCT target_table) AS affected_tables,
                   count(DISTINCT (target_table, target_column)) AS affected_columns,
                   '{{"' || min(target_table) || '":["' || string_agg(DISTINCT target_column, '","' ORDER BY target_column)
                   || '"]}}' AS details FROM lineage GROUP BY 1, 2)
SELECT question_id, intent, lookup, CAST(rank AS INTEGER) AS rank, {_ENTRY}, CAST(NULL AS BIGINT) AS affected_tables,
       CAST(NULL AS BIGINT) AS affected_columns, {_REST}, NULL AS details
FROM asked JOIN entries USING (lookup, a, b)
UNION ALL
SELECT question_id, intent, lookup, 1, NULL, a, b, NULL, NULL, NULL, coalesce(affected_tables, 0),
       coalesce(affected_columns, 0), NULL, NULL, NULL, NULL, NULL, coalesce(details, '{{}}')
FROM asked LEFT JOIN impacts USING (a, b) WHERE lookup = 'impact'"""

ORACLE |= {
    "question_intent": with_views(
        ["question_log"], f"SELECT {_intent('question')} AS intent, count(*) AS questions FROM question_log GROUP BY 1"
    ),
    "text_intent": f"SELECT conv_id, turn, {_intent('text')} AS intent FROM conversations",
    "question_entities": with_views(["question_log"], _ENTITIES),
    "question_context": with_views(["policy_master", "claims_master", "question_log"], "").rstrip()
    + f", lineage AS ({_POLICY_LINEAGE} UNION ALL {_CLAIM_LINEAGE}){_CONTEXT}",
    "history_trim": with_views(
        ["question_log"],
        "SELECT session_id, question_id, question FROM question_log QUALIFY row_number() OVER "
        "(PARTITION BY session_id ORDER BY asked_at DESC, question_id DESC) <= 20",
    ),
    "history_trim_short": "SELECT * FROM conversations QUALIFY row_number() OVER "
    "(PARTITION BY conv_id ORDER BY turn DESC) <= 3",
}

# -- pipeline ----------------------------------------------------------------------------------

_CLEAN = mapped(POLICY_MAPPING, "policy_clean")


def _stages(views: list[str], rows: list[str]) -> str:
    """Stage rows: seq, stage, outcome, records, failed, rate, job_status."""
    head = "seq, stage, outcome, records, failed, rate, job_status"
    body = " UNION ALL ".join(rows)
    return with_views(views, f"SELECT {head} FROM ({body}) AS stages({head})")


def _stage(seq, stage, outcome, status, source=None, records=None, failed=None, rate=None) -> str:
    records = records or "NULL"
    failed = failed or "NULL"
    rate = rate or "NULL"
    return (
        f"SELECT CAST({seq} AS BIGINT), '{stage}', '{outcome}', CAST({records} AS BIGINT), CAST({failed} AS BIGINT), "
        f"CAST({rate} AS DOUBLE), '{status}'" + (f" FROM {source}" if source else "")
    )


def _first_stages(source: str, status: str) -> list[str]:
    return [
        _stage(0, "extract", "success", status, source, "count(*)"),
        _stage(1, "stage", "success", status, source, f"(count(*) + {BATCH_SIZE - 1}) // {BATCH_SIZE}"),
        _stage(2, "transform", "success", status, source, f"count(*) * {len(POLICY_MAPPING.fields)}"),
    ]


_GATE_RULES = [
    (n, f, s, e, a, z, c.replace(AS_OF, "2026-01-01")) for n, f, s, e, a, z, c in _RULES
]
_GATE_FAILED = " + ".join(f"count(*) FILTER (NOT coalesce({r[6]}, false))" for r in _GATE_RULES)
_VALID = _stage(3, "validate", "acceptable", "{}", "policy_clean", "count(*)", "0", "100.0")
_MISLOADED = f"SELECT count(*) FILTER (premium_amount >= 1000) AS bad, count(*) AS n FROM ({_CLEAN})"

ORACLE |= {
    "migration_retry": with_views(
        ["policy_clean"],
        "SELECT count(*) AS live_rows, count(*) AS staged_rows, CAST(1 AS BIGINT) AS jobs FROM policy_clean",
    ),
    "migration_progress": with_views(
        ["policy_clean"],
        f"SELECT '{JOB}' AS job_id, CAST(ceil(count(*) / {BATCH_SIZE}) AS BIGINT) AS batches_total, "
        f"CAST(ceil(count(*) / {BATCH_SIZE}) AS BIGINT) AS batches_completed, CAST(0 AS BIGINT) AS batches_failed, "
        "CAST(count(*) AS BIGINT) AS total_records, CAST(count(*) AS BIGINT) AS processed_records, "
        "CAST(100 AS DOUBLE) AS progress_pct FROM policy_clean",
    ),
    "migration_two_entities": with_views(
        ["policy_clean", "claims_master"],
        "SELECT 'policies' AS entity_type, 'completed' AS status, count(*) AS total_records, count(*) AS processed_records, "
        f"count(*) * {len(POLICY_MAPPING.fields)} AS entries FROM policy_clean UNION ALL "
        f"SELECT 'claims', 'completed', count(*), count(*), count(*) * {len(CLAIM_MAPPING.fields)} FROM claims_master",
    ),
    "migration_checksums": with_views(
        ["policy_clean"],
        f"SELECT batch_number, count(*) AS record_count, 'completed' AS status, true AS source_is_staged, "
        f"true AS target_is_loaded FROM (SELECT (row_number() OVER (ORDER BY policy_id) - 1) // {BATCH_SIZE} AS batch_number "
        "FROM policy_clean) GROUP BY 1",
    ),
    "migration_durations": with_views(
        ["policy_clean"],
        "SELECT stage, n AS batches, true AS is_whole FROM (SELECT unnest(['extract', 'transform', 'load']) AS stage), "
        f"(SELECT (count(*) + {BATCH_SIZE - 1}) // {BATCH_SIZE} AS n FROM policy_clean)",
    ),
    "migration_report": _stages(
        ["policy_clean"],
        [
            *_first_stages("policy_clean", "completed"),
            _VALID.format("completed"),
            _stage(4, "load", "success", "completed", "policy_clean", "count(*)", "0"),
            _stage(5, "reconcile", "acceptable", "completed", "policy_clean", "count(*)", "0", "100.0"),
            _stage(6, "promote", "promoted", "completed"),
        ],
    ),
    "migration_gated": _stages(
        ["policy_master"],
        [
            *_first_stages("policy_master", "failed"),
            _stage(
                3, "validate", "not acceptable", "failed", f"({MAPPED})", "count(*)", _GATE_FAILED,
                f"(count(*) * 7 - ({_GATE_FAILED})) / (count(*) * 7) * 100",
            ),
        ],
    ),
    "migration_rolled_back": _stages(
        ["policy_clean"],
        [
            *_first_stages("policy_clean", "failed"),
            _VALID.format("failed"),
            _stage(4, "load", "errors", "failed", f"({_MISLOADED})", "n - bad", "bad"),
            _stage(5, "rollback", "success", "failed", "policy_clean", "count(*)"),
        ],
    ),
    "migration_dry_run": _stages(
        ["policy_clean"],
        [
            *_first_stages("policy_clean", "completed"),
            _VALID.format("completed"),
            _stage(4, "load", "skipped", "completed"),
        ],
    ),
    "promotion_decision": with_views(
        _SIDES,
        "SELECT 'damaged' AS scenario, match_rate, CASE WHEN acceptable THEN 'promoted' ELSE 'blocked' END AS action "
        f"FROM ({_REPORT}) UNION ALL SELECT 'whole, automatic', 100.0, 'promoted' UNION ALL "
        "SELECT 'whole, manual', 100.0, 'awaiting_manual_promotion'",
    ),
    "job_progress": with_views(
        ["job_batches"],
        "SELECT *, batches_completed / batches_total * 100 AS progress_pct, CASE WHEN batches_completed > 0 THEN "
        "elapsed_seconds * (batches_total - batches_completed) / batches_completed END AS estimated_remaining_seconds "
        f"FROM (SELECT job_id, date_diff('second', min(started_at), TIMESTAMP '{NOW}') AS elapsed_seconds, "
        "count(*) AS batches_total, count(*) FILTER (status = 'completed') AS batches_completed, "
        "count(*) FILTER (status = 'failed') AS batches_failed, CAST(sum(record_count) AS BIGINT) AS total_records, "
        "CAST(coalesce(sum(record_count) FILTER (status = 'completed'), 0) AS BIGINT) AS processed_records "
        "FROM job_batches GROUP BY 1)",
    ),
    "stage_durations": with_views(
        ["job_batches"],
        "SELECT job_id, stage, count(*) AS batches, CAST(sum(ms) AS BIGINT) AS total_ms, avg(ms) AS mean_ms, "
        "max(ms) AS max_ms FROM ("
        + " UNION ALL ".join(
            f"SELECT job_id, '{s}' AS stage, {s}_duration_ms AS ms FROM job_batches"
            for s in ("extract", "transform", "load")
        )
        + ") WHERE ms IS NOT NULL GROUP BY 1, 2",
    ),
}

# -- texts: stored mappings and lineage documents ----------------------------------------------

_STORED = (
    "SELECT trim(policy_id) AS policy_id, CAST(round(try_cast(prem_amt AS DOUBLE) * 100) AS BIGINT) AS premium_cents, "
    "upper(trim(status_cd)) AS status, trim(prod_typ) || '-' || status_cd AS product, "
    f"try_cast({_TRANSFORMS['db2_date_to_iso']('eff_dt')} AS DATE) AS effective_date FROM policy_master"
)
_STORED_RULES = {
    "policy_id": "regexp_matches(policy_id, '^POL-[0-9]{6}$')",
    "premium_cents": "premium_cents > 0 AND premium_cents <= 500000",
    "status": "status IN ('A', 'L', '3')",
    "product": "length(product) > 8 OR status = 'A'",
    "effective_date": "effective_date IS NOT NULL",
}
_TERMS = "regexp_extract_all(lower({}), '[a-z0-9]+')"

ORACLE |= {
    "mapping_roundtrip": with_views(["policy_master"], _STORED),
    "validate_from_mapping": with_views(
        ["policy_master"],
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}_rule' AS rule_name, 'critical' AS severity, count(*) FILTER (NOT coalesce({condition}, false)) "
            f"AS failures FROM ({_STORED})"
            for name, condition in _STORED_RULES.items()
        )
        + ") WHERE failures > 0",
    ),
    "lineage_search": with_views(["policy_master", "claims_master", "question_log"], "").rstrip()
    + f", lineage AS ({_POLICY_LINEAGE} UNION ALL {_CLAIM_LINEAGE}), "
    "texts AS (SELECT document, count(*) AS entries FROM (SELECT 'Source: ' || source_table || '.' || source_column || "
    "' → Target: ' || target_table || '.' || target_column || ' Transform: ' || transformation || ' Job: ' || job_id "
    "AS document FROM lineage) GROUP BY 1), "
    f"terms AS (SELECT document, unnest({_TERMS.format('document')}) AS term FROM texts), "
    "sized AS (SELECT document, count(*) AS n FROM terms GROUP BY 1), "
    "whole AS (SELECT (SELECT count(*) FROM texts) AS d, avg(n) AS mean FROM sized), "
    "tf AS (SELECT document, term, count(*) AS f FROM terms GROUP BY 1, 2), "
    "df AS (SELECT term, count(*) AS h FROM tf GROUP BY 1), "
    f"asked AS (SELECT DISTINCT question_id, unnest({_TERMS.format('question')}) AS term FROM question_log), "
    "scored AS (SELECT question_id, document, round(sum(ln(1 + (d - h + 0.5) / (h + 0.5)) * f * 2.2 / "
    "(f + 1.2 * (0.25 + 0.75 * n / mean))), 9) AS score "
    "FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN sized USING (document), whole GROUP BY 1, 2) "
    "SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, document) AS INTEGER) AS rank, "
    "document, entries, score FROM scored JOIN texts USING (document) QUALIFY rank <= 5",
}
