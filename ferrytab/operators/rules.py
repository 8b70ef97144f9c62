"""Row validation rules, failure details, and the report that decides whether a batch is acceptable."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.text import as_number, as_text, column_type, find_column, shown
from ferrytab.sources.extract import ROW_ID, land_ordered, part_of, position_of

CRITICAL, WARNING = "critical", "warning"
MIN_PASS_RATE = 99.9

# Allowed statuses, and products with the lowest and highest premium of each.
VALID_STATUSES = ("ACTIVE", "LAPSED", "PAID_UP", "SURRENDERED", "MATURED", "DEATH_CLAIM", "CANCELLED")
PREMIUM_RANGES = {
    "TERM_LIFE": (10.0, 5000.0),
    "WHOLE_LIFE": (50.0, 20000.0),
    "ANNUITY": (100.0, 100000.0),
    "UNIVERSAL": (50.0, 50000.0),
    "VARIABLE": (100.0, 50000.0),
    "GROUP_LIFE": (5.0, 2000.0),
    "ENDOWMENT": (50.0, 30000.0),
}
OTHER_PREMIUM_RANGE = (1.0, 1000000.0)
MIN_COVERAGE = 1000.0
POLICY_ID_PATTERN = "^POL-[A-Z0-9]{6,10}$"

# Status changes that may happen. Only "active may lapse, lapsed may not become active" is given from
# outside; the other pairs are our reading, and `transition_violations` takes any list.
ALLOWED_TRANSITIONS = (
    ("ACTIVE", "LAPSED"), ("ACTIVE", "PAID_UP"), ("ACTIVE", "SURRENDERED"), ("ACTIVE", "MATURED"),
    ("ACTIVE", "DEATH_CLAIM"), ("ACTIVE", "CANCELLED"), ("LAPSED", "SURRENDERED"),
    ("LAPSED", "DEATH_CLAIM"), ("LAPSED", "CANCELLED"), ("PAID_UP", "SURRENDERED"),
    ("PAID_UP", "MATURED"), ("PAID_UP", "DEATH_CLAIM"), ("PAID_UP", "CANCELLED"),
)


class Row:
    """The cells of a row as columns, for rules to read by name."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df

    def has(self, name: str) -> bool:
        return find_column(self.df, name) is not None

    def value(self, name: str) -> Column:
        return F.col(find_column(self.df, name) or name)

    def type(self, name: str) -> T.DataType:
        return column_type(self.df, name)

    def text(self, name: str) -> Column:
        """``str(value)``; null when the value is null, or the column is absent."""
        return as_text(self.value(name), self.type(name)) if self.has(name) else F.lit(None).cast("string")

    def number(self, name: str) -> Column:
        """``float(value)``; null when it is no number. NaN counts as no number here."""
        return F.nanvl(as_number(self.value(name), self.type(name)), F.lit(None).cast("double"))


@dataclass(frozen=True)
class Rule:
    """A named check of one field.

    ``check(row)`` gives a boolean column; null counts as failed. ``error(row)`` may give a text for
    rows on which the check itself broke; these count as critical whatever the rule's severity.
    ``message`` is the text of a failure, with ``{}`` for the value.
    """

    name: str
    field: str
    check: Callable[[Row], Column]
    severity: str = WARNING
    expected: str = ""
    message: str = "Rule failed: {}"
    error: Callable[[Row], Column] | None = field(default=None, compare=False)

    def outcome(self, row: Row) -> tuple[Column, Column, Column]:
        """Passed, severity and error text of this rule on a row."""
        error = self.error(row) if self.error else F.lit(None).cast("string")
        passed = F.coalesce(self.check(row), F.lit(False))
        severity = F.lit(self.severity)
        if self.error:
            severity = F.when(error.isNotNull(), F.lit(CRITICAL)).otherwise(severity)
        return passed, severity, error


def _iso_day(text: Column) -> Column:
    head = F.substring(text, 1, 10)
    plain = head.rlike("^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    return F.when(plain, head.try_cast("date"))


def _effective_date(name: str, as_of: date | str | None) -> Callable[[Row], Column]:
    def check(row: Row) -> Column:
        kind = row.type(name)
        day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return row.value(name).cast("date") <= day
        return _iso_day(row.text(name)) <= day

    return check


def _premium_range(row: Row) -> Column:
    product = F.upper(row.text("product_type"))
    ranges = F.create_map(
        *[
            part
            for name, (low, high) in PREMIUM_RANGES.items()
            for part in (F.lit(name), F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")))
        ]
    )
    other = F.struct(*[F.lit(x).alias(n) for x, n in zip(OTHER_PREMIUM_RANGE, ("low", "high"))])
    bounds = F.coalesce(F.try_element_at(ranges, product), other)
    return row.number("premium_amount").between(bounds["low"], bounds["high"])


def not_null_rule(name: str) -> Rule:
    """Critical rule: the field has a value."""
    return Rule(
        f"{name}_required", name, lambda row: row.value(name).isNotNull(), CRITICAL, "a value", "Missing value: {}"
    )


def standard_rules(as_of: date | str | None = None) -> list[Rule]:
    """The seven policy rules. ``as_of`` is the day that dates may not lie after (default: today)."""
    statuses = ", ".join(VALID_STATUSES)
    products = ", ".join(PREMIUM_RANGES)
    # (?d): only a line feed may follow the text, as in Python.
    return [
        Rule(
            "policy_id_format", "policy_id",
            lambda row: row.text("policy_id").rlike(f"(?d){POLICY_ID_PATTERN}"),
            CRITICAL, "POL-XXXXXX format", "Invalid policy ID format: {}",
        ),
        Rule(
            "premium_positive", "premium_amount", lambda row: row.number("premium_amount") > 0,
            CRITICAL, "> 0", "Premium must be positive, got: {}",
        ),
        Rule(
            "coverage_exceeds_minimum", "coverage_amount",
            lambda row: row.number("coverage_amount") >= MIN_COVERAGE,
            WARNING, ">= 1000.00", "Coverage below minimum $1,000: {}",
        ),
        Rule(
            "effective_date_valid", "effective_date", _effective_date("effective_date", as_of),
            CRITICAL, "valid date, not future", "Invalid or future effective date: {}",
        ),
        Rule(
            "status_valid", "status", lambda row: F.upper(row.text("status")).isin(*VALID_STATUSES),
            CRITICAL, f"One of {statuses}", "Invalid policy status: {}",
        ),
        Rule(
            "product_type_valid", "product_type",
            lambda row: F.upper(row.text("product_type")).isin(*PREMIUM_RANGES),
            CRITICAL, f"One of {products}", "Unknown product type: {}",
        ),
        Rule(
            "premium_within_range", "premium_amount", _premium_range,
            WARNING, "Within product range", "Premium {} outside range for product type",
        ),
    ]


def python_rule(
    name: str,
    field_name: str,
    function: Callable[[object, dict], bool],
    columns: list[str],
    severity: str = WARNING,
    expected: str = "",
    message: str = "Rule failed: {}",
) -> Rule:
    """A rule from a Python function of the value and the row (as a dict of ``columns``).

    It runs in Arrow batches and gets values as Spark holds them. An exception makes the row fail, with critical severity.
    """

    def run(rows):
        import pyarrow as pa

        passed, errors = [], []
        for record in rows.to_pylist():
            try:
                passed.append(bool(function(record[field_name], record)))
                errors.append(None)
            except Exception as problem:  # noqa: BLE001 - any failure of user code fails the row
                passed.append(False)
                errors.append(f"Rule execution error: {problem}")
        columns = [pa.array(passed, pa.bool_()), pa.array(errors, pa.string())]
        return pa.StructArray.from_arrays(columns, ["passed", "error"])

    udf = F.arrow_udf(run, "passed BOOLEAN, error STRING")
    needed = list(dict.fromkeys([field_name, *columns]))

    def result(row: Row) -> Column:
        return udf(F.struct(*[row.value(c).alias(c) for c in needed]))

    return Rule(
        name, field_name, lambda row: result(row)["passed"], severity, expected, message,
        error=lambda row: result(row)["error"],
    )


def _present(df: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules whose field the table has; the others are skipped."""
    return [rule for rule in rules if find_column(df, rule.field)]


def check_rule(df: DataFrame, rule: Rule, key: str) -> DataFrame:
    """Record id and outcome of one rule on every row."""
    row = Row(df)
    return df.select(_record_id(row, key).alias("record_id"), rule.outcome(row)[0].alias("passed"))


def _record_id(row: Row, key: str) -> Column:
    return shown(row.value(key), row.type(key)) if row.has(key) else F.lit("UNKNOWN")


def validation_failures(df: DataFrame, rules: list[Rule], key: str = "policy_id") -> DataFrame:
    """One row per failed check. All rules are evaluated in one pass over the rows."""
    row = Row(df)

    def entry(rule: Rule) -> Column:
        passed, severity, error = rule.outcome(row)
        actual = shown(row.value(rule.field), row.type(rule.field))
        before, _, after = rule.message.partition("{}")
        message = F.concat(F.lit(before), actual, F.lit(after))
        broke = error.isNotNull() if rule.error else F.lit(False)
        return F.when(
            ~passed,
            F.struct(
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.field).alias("field_name"),
                F.when(~broke, F.lit(rule.expected)).alias("expected"),
                F.when(~broke, actual).alias("actual"),
                F.coalesce(error, message).alias("message"),
                severity.alias("severity"),
            ),
        )

    checked = _present(df, rules)
    if not checked:
        raise ValueError("The table has none of the fields that the rules check")
    # The array goes straight into inline(): from a named column Spark would infer a filter that
    # evaluates every rule once more.
    return df.select(
        _record_id(row, key).alias("record_id"),
        F.inline(F.array_compact(F.array(*[entry(rule) for rule in checked]))),
    )


def counted(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, list[Column], list[Rule]]:
    """``df`` with a flag column per checked rule, the aggregates that count the flags, and the checked rules.

    The aggregates serve an ``agg`` or, where the rows are written anyway, an ``observe`` of that write.
    """
    row = Row(df)
    checked = _present(df, rules)
    flags, counts = [], [F.count(F.lit(1)).alias("total_records")]
    for i, rule in enumerate(checked):
        passed, severity, _ = rule.outcome(row)
        flags += [(~passed).alias(f"_f{i}"), (~passed & (severity == CRITICAL)).alias(f"_c{i}")]
        counts += [F.count_if(f"_f{i}").alias(f"f{i}"), F.count_if(f"_c{i}").alias(f"c{i}")]
    any_failed = reduce(or_, [F.col(f"_f{i}") for i in range(len(checked))], F.lit(False))
    counts.append(F.count_if(any_failed).alias("records_failed"))
    return df.select("*", *flags), counts, checked


def _counts(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, list[Rule]]:
    """One row with the failures of each rule by severity, from one aggregate without a shuffle of rows."""
    flagged, counts, checked = counted(df, rules)
    return flagged.agg(*counts), checked


def validation_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: counts of records, checks and failures, the pass rate, and whether it is acceptable."""
    return report_of(*_counts(df, rules))


def report_of(counts: DataFrame, checked: list[Rule]) -> DataFrame:
    """The validation report from one row of the counts of :func:`counted`."""
    zero = F.lit(0).cast("bigint")
    failed = sum((F.col(f"f{i}") for i in range(len(checked))), zero)
    critical = sum((F.col(f"c{i}") for i in range(len(checked))), zero)
    totals = counts.select(
        "total_records",
        (F.col("total_records") * len(checked)).alias("total_checks"),
        failed.alias("failed"),
        critical.alias("critical_failures"),
        "records_failed",
    )
    return (
        totals.withColumn("passed", F.col("total_checks") - F.col("failed"))
        .withColumn(
            "pass_rate",
            F.when(F.col("total_checks") > 0, F.col("passed") / F.col("total_checks") * 100).otherwise(F.lit(0.0)),
        )
        .withColumn("acceptable", (F.col("critical_failures") == 0) & (F.col("pass_rate") >= MIN_PASS_RATE))
        .select(
            "total_records", "total_checks", "passed", "failed", "critical_failures", "records_failed",
            "pass_rate", "acceptable",
        )
    )


def failures_by_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Failures per rule and severity; rules without failures are left out."""
    counts, checked = _counts(df, rules)
    entries = []
    for i, rule in enumerate(checked):
        critical, other = F.col(f"c{i}"), F.col(f"f{i}") - F.col(f"c{i}")
        for severity, number in ((CRITICAL, critical), (rule.severity, other)):
            entries.append(
                F.struct(
                    F.lit(rule.name).alias("rule_name"), F.lit(severity).alias("severity"), number.alias("failures")
                )
            )
    return counts.select(F.inline(F.array(*entries))).where("failures > 0")


# -- rules over groups of rows -----------------------------------------------------------------


def group_sum_violations(df: DataFrame, group: str, amount: str, expected: float | str = 100) -> DataFrame:
    """Groups whose amounts do not sum to exactly ``expected``; summed before the shuffle."""
    total = F.sum(F.col(amount).cast("decimal(28,4)")).alias("total")
    wanted = F.lit(str(expected)).cast("decimal(28,4)")
    return df.groupBy(group).agg(total).where(F.col("total").isNull() | (F.col("total") != wanted))


def transition_violations(
    df: DataFrame,
    key: str,
    order_by: list[str],
    status: str = "status",
    allowed: tuple[tuple[str, str], ...] = ALLOWED_TRANSITIONS,
) -> DataFrame:
    """Rows whose status may not follow the status before it of the same key.

    The history of one key may be longer than a task should hold. Rows are therefore numbered over
    the whole table in (key, order) order, compared inside each written part, and the first row of a
    part with the last row of the part before it.
    """
    part, position, before = "_part", "_position", "_before"
    landed = land_ordered(df.select(key, *order_by, status), [key, *order_by])
    parts = landed.withColumn(part, part_of(F.col(ROW_ID))).withColumn(position, position_of(F.col(ROW_ID)))
    same = F.struct(F.col(key).alias("key"), F.col(status).alias("status"))
    # A part is one write task's rows, already sorted by row id.
    inside = Window.partitionBy(part).orderBy(ROW_ID)
    ends = parts.groupBy(part).agg(F.max_by(same, ROW_ID).alias("_last"))
    carried = ends.select(part, F.lag("_last").over(Window.orderBy(part)).alias("_carried"))
    compared = (
        parts.withColumn(before, F.lag(same).over(inside))
        .join(F.broadcast(carried), part)
        .withColumn(before, F.when(F.col(position) == 0, F.col("_carried")).otherwise(F.col(before)))
        .where(F.col(before).isNotNull() & F.col(before)["key"].eqNullSafe(F.col(key)))
    )
    earlier = F.col(before)["status"]
    pairs = F.array(*[F.lit(f"{a}>{b}") for a, b in allowed])
    step = F.concat(F.upper(earlier), F.lit(">"), F.upper(F.col(status)))
    legal = F.coalesce(F.upper(earlier) == F.upper(F.col(status)), F.lit(False)) | F.coalesce(
        F.array_contains(pairs, step), F.lit(False)
    )
    return compared.where(~legal).select(key, *order_by, earlier.alias("previous_status"), F.col(status))
