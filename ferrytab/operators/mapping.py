"""Mapping projection and transform chains over the columns of a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.expressions import compile_rule
from ferrytab.functions.text import column_type, find_column, is_numeric
from ferrytab.functions.transforms import TransformRegistry
from ferrytab.operators.rules import CRITICAL, Row, Rule, not_null_rule
from ferrytab.schemas import table_schema


@dataclass(frozen=True)
class FieldMapping:
    """One source column, the target field it becomes, and the transform on the way.

    ``transform`` is the name of a registered transform, or the text of an expression over the row's source columns in which
    ``value`` is the field's own. ``rule`` is the text of a condition on the target fields, likewise. ``target_type`` is what
    the result becomes; values that do not fit are null. Texts are checked by :func:`compile_rule`.
    """

    source_column: str
    target_field: str
    transform: str | None = None
    is_key: bool = False
    is_required: bool = False
    default: str | None = None
    source_type: str | None = None
    target_type: str | None = None
    rule: str | None = None


@dataclass(frozen=True)
class EntityMapping:
    """How the rows of a source table become rows of a target table."""

    entity_type: str
    source_table: str
    target_table: str
    fields: tuple[FieldMapping, ...]

    @property
    def key(self) -> FieldMapping:
        for field in self.fields:
            if field.is_key:
                return field
        raise ValueError(f"The mapping of {self.entity_type} has no key field")

    def required_rules(self) -> list[Rule]:
        """A critical not-null rule for every required target field."""
        return [not_null_rule(field.target_field) for field in self.fields if field.is_required]

    def stored_rules(self, severity: str = CRITICAL) -> list[Rule]:
        """A rule for every field that has the text of one; a text that is refused stops here, before any row is read."""
        targets = {field.target_field.lower(): field.target_field for field in self.fields}

        def rule(field: FieldMapping) -> Rule:
            def check(row: Row) -> Column:
                def name(asked: str) -> Column | None:
                    known = field.target_field if asked == "value" else targets.get(asked.lower())
                    return row.value(known) if known and row.has(known) else None

                return compile_rule(field.rule, name)

            allowed = {"value", *targets}
            compile_rule(field.rule, lambda asked: F.col(asked) if asked.lower() in allowed else None)
            return Rule(f"{field.target_field}_rule", field.target_field, check, severity, field.rule, "Rule not met: {}")

        return [rule(field) for field in self.fields if field.rule]


# The two standard mappings.
POLICY_MAPPING = EntityMapping(
    "policies",
    "db2_policies",
    "fast_policies",
    (
        FieldMapping("POLICY_ID", "policy_id", "trim_string", is_key=True),
        FieldMapping("FIRST_NM", "first_name", "name_title_case"),
        FieldMapping("LAST_NM", "last_name", "name_title_case"),
        FieldMapping("PREM_AMT", "premium_amount", "packed_decimal_to_float"),
        FieldMapping("COV_AMT", "coverage_amount", "packed_decimal_to_float"),
        FieldMapping("EFF_DT", "effective_date", "db2_date_to_iso"),
        FieldMapping("STATUS_CD", "status", "status_code_map"),
        FieldMapping("PROD_TYP", "product_type", "trim_string"),
        FieldMapping("PHONE_NO", "phone_number", "phone_normalize"),
        FieldMapping("SSN", "ssn", "ssn_mask"),
    ),
)
CLAIM_MAPPING = EntityMapping(
    "claims",
    "db2_claims",
    "fast_claims",
    (
        FieldMapping("CLAIM_ID", "claim_id", "trim_string", is_key=True),
        FieldMapping("POLICY_ID", "policy_id", "trim_string"),
        FieldMapping("CLAIM_AMT", "claim_amount", "packed_decimal_to_float"),
        FieldMapping("CLAIM_DT", "claim_date", "db2_date_to_iso"),
        FieldMapping("STATUS_CD", "status", "status_code_map"),
        FieldMapping("DIAG_CD", "diagnosis_code", "trim_string"),
    ),
)


def mapped_column(df: DataFrame, field: FieldMapping, registry: TransformRegistry | None = None) -> Column:
    """The target column of one mapping. A default takes the type of the column it fills."""
    column, kind = F.col(field.source_column), column_type(df, field.source_column)
    registry = registry or TransformRegistry()
    if field.transform in registry.names():
        chosen = registry.get(field.transform)
        column, kind = chosen.build(column, kind), chosen.returns
    elif field.transform:
        column, kind = _by_text(df, field), None
    if field.target_type:
        column, kind = column.try_cast(field.target_type), T.DataType.fromDDL(field.target_type)
    if kind is None:
        kind = df.select(column.alias("_")).schema[0].dataType
    if field.default is not None:
        column = F.coalesce(column, F.lit(field.default).cast(kind))
    return column.alias(field.target_field)


def _by_text(df: DataFrame, field: FieldMapping) -> Column:
    """The column of a transform that is the text of an expression; a word that is no transform is said to be one that is unknown."""
    if field.transform.isidentifier():
        raise ValueError(f"Unknown transform: {field.transform}")

    def name(asked: str) -> Column | None:
        known = find_column(df, field.source_column if asked == "value" else asked)
        return F.col(known) if known else None

    return compile_rule(field.transform, name)


def map_entity(
    df: DataFrame,
    mapping: EntityMapping,
    registry: TransformRegistry | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rename and transform in one projection. Mapped columns the table lacks are left out.

    Columns named in ``keep`` pass through as they are.
    """
    registry = registry or TransformRegistry()
    present = [field for field in mapping.fields if find_column(df, field.source_column)]
    return df.select(*keep, *[mapped_column(df, field, registry) for field in present])


def mapping_rows(spark: SparkSession, mapping: EntityMapping) -> DataFrame:
    """The mapping as rows of the ``entity_mappings`` table."""
    rows = [
        (
            mapping.entity_type, mapping.source_table, field.source_column, field.source_type, field.target_field,
            field.target_type, field.transform, field.rule, field.is_required, field.is_key, field.default,
        )
        for field in mapping.fields
    ]
    return spark.createDataFrame(rows, table_schema("entity_mappings"))


def read_mapping(rows: DataFrame, entity_type: str, target_table: str) -> EntityMapping:
    """The mapping of an entity from rows of the ``entity_mappings`` table (one row per column)."""
    found = rows.where(F.col("entity_type") == entity_type).collect()
    if not found:
        raise ValueError(f"No mapping for entity: {entity_type}")
    return EntityMapping(
        entity_type,
        found[0]["source_table"],
        target_table,
        tuple(
            FieldMapping(
                row["source_column"],
                row["target_field"],
                row["transformation_rule"],
                bool(row["is_key_field"]),
                bool(row["is_required"]),
                row["default_value"],
                row["source_data_type"],
                row["target_data_type"],
                row["validation_rule"],
            )
            for row in found
        ),
    )


# -- transform chains --------------------------------------------------------------------------

_STEP = "_step"


@dataclass(frozen=True)
class _Step:
    column: str
    transform: str
    before: str
    after: str


def _run_chains(
    df: DataFrame, chains: dict[str, list[str]], registry: TransformRegistry
) -> tuple[DataFrame, list[_Step]]:
    """Every chain step as a column of its own, the n-th steps of all chains in one projection."""
    steps: list[_Step] = []
    current = {find_column(df, name): find_column(df, name) for name in chains if find_column(df, name)}
    names = {find_column(df, name): transforms for name, transforms in chains.items() if find_column(df, name)}
    for depth in range(max(map(len, names.values()), default=0)):
        added = {}
        for position, (column, transforms) in enumerate(names.items()):
            if depth < len(transforms):
                before, after = current[column], f"{_STEP}_{position}_{depth}"
                added[after] = registry.apply(transforms[depth], F.col(before), column_type(df, before))
                steps.append(_Step(column, transforms[depth], before, after))
                current[column] = after
        df = df.withColumns(added)
    return df, steps


def transform_columns(
    df: DataFrame, chains: dict[str, list[str]], registry: TransformRegistry | None = None
) -> DataFrame:
    """Apply each column's transforms in order, in place. Columns the table lacks are skipped."""
    done, steps = _run_chains(df, chains, registry or TransformRegistry())
    last = {step.column: step.after for step in steps}
    return done.select(*[F.col(last[c]).alias(c) if c in last else F.col(c) for c in df.columns])


def change_statistics(
    df: DataFrame, chains: dict[str, list[str]], registry: TransformRegistry | None = None
) -> DataFrame:
    """Rows changed by every (column, transform) step, from one pass; unchanged steps are left out.

    Null to null is no change. A value that becomes another type counts as changed, as text and
    number are never equal.
    """
    done, steps = _run_chains(df, chains, registry or TransformRegistry())
    spark = df.sparkSession
    if not steps:
        return spark.createDataFrame(
            [], "column_name STRING, transform STRING, records_changed BIGINT, total_records BIGINT"
        )

    def changed(step: _Step) -> Column:
        before, after = F.col(step.before), F.col(step.after)
        kinds = column_type(done, step.before), column_type(done, step.after)
        if kinds[0] == kinds[1] or all(map(is_numeric, kinds)):
            return ~before.eqNullSafe(after)
        return before.isNotNull() | after.isNotNull()

    counts = done.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(changed(step)).alias(f"n{i}") for i, step in enumerate(steps)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(step.column).alias("column_name"),
                F.lit(step.transform).alias("transform"),
                F.col(f"n{i}").alias("records_changed"),
                F.col("total_records"),
            )
            for i, step in enumerate(steps)
        ]
    )
    return counts.select(F.inline(entries)).where("records_changed > 0")
