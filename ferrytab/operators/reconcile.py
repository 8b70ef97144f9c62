"""Keyed, field-by-field comparison of two tables.

Plan: each side is cut down to one row per key by a partial aggregate before its shuffle, so a key
that holds a large part of the rows reaches the shuffle as one row per task. Both sides then meet in
one full outer join that reuses the two exchanges of these aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.text import as_number, as_text, column_type, find_column, is_numeric, strip

MATCHED, MISMATCHED = "matched", "mismatched"
MISSING_IN_TARGET, MISSING_IN_SOURCE = "missing_in_target", "missing_in_source"
MIN_MATCH_RATE = 99.99
RELATIVE_TOLERANCE = 1e-9


@dataclass(frozen=True)
class Comparison:
    """What makes two records the same record, and what makes them equal.

    ``order_by`` decides which of several rows with one key is compared (the first, nulls first);
    by default the compared columns in name order.
    """

    keys: list[str]
    columns: list[str] | None = None
    tolerance: float = 0.001
    ignore: list[str] = field(default_factory=list)
    order_by: list[str] | None = None

    def compared(self, source: DataFrame, target: DataFrame) -> list[str]:
        """The compared columns: the listed ones, or those both sides have, less the ignored ones."""
        ignored = {name.lower() for name in self.ignore}
        if self.columns:
            return [c for c in self.columns if c.lower() not in ignored]
        return sorted(c for c in source.columns if find_column(target, c) and c.lower() not in ignored)


# -- values ------------------------------------------------------------------------------------


def is_close(left: Column, right: Column, tolerance: float) -> Column:
    """``math.isclose`` with its default relative part and an absolute tolerance."""
    infinity = F.lit(float("inf"))
    allowed = F.greatest(F.greatest(F.abs(left), F.abs(right)) * RELATIVE_TOLERANCE, F.lit(float(tolerance)))
    return (
        F.when(F.isnan(left) | F.isnan(right), F.lit(False))
        .when(left == right, F.lit(True))
        .when((F.abs(left) == infinity) | (F.abs(right) == infinity), F.lit(False))
        .otherwise(F.abs(left - right) <= allowed)
    )


def _is_null(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _same_text(left: Column, right: Column) -> Column:
    """True for one and the same text, which needs no look at its number unless that is not a number."""
    return (left == right) & ~F.lower(left).contains("nan")


def number_columns(left: Column, right: Column, types: tuple[T.DataType, T.DataType]) -> tuple[Column, Column]:
    """Both values as numbers, null where a value is no number or the texts are the same anyway."""
    numbers = as_number(left, types[0]), as_number(right, types[1])
    if all(isinstance(t, T.StringType) for t in types):
        return tuple(F.when(~_same_text(left, right), n) for n in numbers)
    return numbers


def mismatch_type(
    left: Column, right: Column, types: tuple[T.DataType, T.DataType], numbers: tuple[Column, Column], tolerance: float
) -> Column:
    """Null when two values are equal, else ``missing``, ``extra`` or ``value``.

    ``numbers`` are the columns that hold the result of :func:`number_columns`.
    """
    no_left, no_right = _is_null(left, types[0]), _is_null(right, types[1])
    close = is_close(*numbers, tolerance)
    if all(map(is_numeric, types)):
        equal = close
    else:
        texts = [F.lower(strip(as_text(c, t))) for c, t in zip((left, right), types)]
        both = numbers[0].isNotNull() & numbers[1].isNotNull()
        equal = F.when(both, close).otherwise(texts[0] == texts[1])
        if all(isinstance(t, T.StringType) for t in types):
            equal = F.when(_same_text(left, right), F.lit(True)).otherwise(equal)
    return (
        F.when(no_left & no_right, F.lit(None))
        .when(no_right, F.lit("missing"))
        .when(no_left, F.lit("extra"))
        .when(~equal, F.lit("value"))
        .cast("string")
    )


# -- pairing -----------------------------------------------------------------------------------


def key_columns(df: DataFrame, keys: list[str]) -> list[Column]:
    """Key parts as text that is never null (``None`` for null), one column each."""
    return [
        F.coalesce(as_text(F.col(k), column_type(df, k)), F.lit("None")).alias(f"_k{i}") for i, k in enumerate(keys)
    ]


def _key_names(keys: list[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def first_per_key(
    df: DataFrame, keys: list[str], columns: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """One row per key: ``_row`` (struct of ``columns``) of the first row, and ``_rows``, how many there were.

    The order is ``order_by``, then all columns, so that the choice never depends on row order.
    Columns the table lacks are null.
    """
    order = [*(order_by or []), *(c for c in columns if c not in (order_by or []))]
    order = [c for c in order if find_column(df, c)]
    cells = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    slim = df.select(*key_columns(df, keys), F.struct(F.lit(0).alias("_"), *cells).alias("_first"))
    first = slim.groupBy(*_key_names(keys)).agg(F.min("_first").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    place = {c: i for i, c in enumerate(order)}
    cell = {c: F.col(f"_first.o{place[c]}") if c in place else F.lit(None).cast("string") for c in columns}
    row = F.struct(F.lit(0).alias("_"), *[cell[c].alias(f"v{i}") for i, c in enumerate(columns)])
    return first.select(*_key_names(keys), row.alias("_row"), "_rows")


def _kind(df: DataFrame, name: str) -> T.DataType:
    return column_type(df, name) if find_column(df, name) else T.StringType()


def pair_records(source: DataFrame, target: DataFrame, how: Comparison) -> DataFrame:
    """Full outer join of both sides on their keys, with the mismatch type ``_m{i}`` of each column."""
    columns = how.compared(source, target)
    names = _key_names(how.keys)
    left = first_per_key(source, how.keys, columns, how.order_by).select(
        *names, F.col("_row").alias("_source"), F.col("_rows").alias("source_rows")
    )
    right = first_per_key(target, how.keys, columns, how.order_by).select(
        *names, F.col("_row").alias("_target"), F.col("_rows").alias("target_rows")
    )
    both = F.col("source_rows").isNotNull() & F.col("target_rows").isNotNull()
    joined = left.join(right, names, "full_outer")
    cells = [(F.col(f"_source.v{i}"), F.col(f"_target.v{i}")) for i in range(len(columns))]
    kinds = [(_kind(source, name), _kind(target, name)) for name in columns]
    # The numbers stand in a projection of their own, as the comparison reads each several times.
    numbers = {}
    for i, (pair, types) in enumerate(zip(cells, kinds)):
        one, two = number_columns(*pair, types)
        numbers |= {f"_a{i}": one, f"_b{i}": two}
    flags = {
        f"_m{i}": F.when(both, mismatch_type(*pair, types, (F.col(f"_a{i}"), F.col(f"_b{i}")), how.tolerance))
        for i, (pair, types) in enumerate(zip(cells, kinds))
    }
    return joined.withColumns(numbers).withColumns(flags)


def reconcile(source: DataFrame, target: DataFrame, how: Comparison) -> DataFrame:
    """One row per key of either side.

    ``source_id``, ``target_id``, ``status``, ``severity``, ``mismatches`` (an array of field_name,
    source_value, target_value, mismatch_type), ``source_rows`` and ``target_rows``.
    """
    columns = how.compared(source, target)
    paired = pair_records(source, target, how)
    key_names = {k.lower() for k in how.keys}
    flags = [F.col(f"_m{i}") for i in range(len(columns))]
    differs = F.coalesce(*flags).isNotNull() if flags else F.lit(False)
    key_flags = [f for f, c in zip(flags, columns) if c.lower() in key_names]
    key_differs = F.lit(False)
    for flag in key_flags:
        key_differs = key_differs | F.coalesce(flag == "value", F.lit(False))
    source_only, target_only = F.col("target_rows").isNull(), F.col("source_rows").isNull()
    record_id = F.concat_ws("|", *_key_names(how.keys))

    def entry(i: int, name: str) -> Column:
        return F.when(
            F.col(f"_m{i}").isNotNull(),
            F.struct(
                F.lit(name).alias("field_name"),
                as_text(F.col(f"_source.v{i}"), _kind(source, name)).alias("source_value"),
                as_text(F.col(f"_target.v{i}"), _kind(target, name)).alias("target_value"),
                F.col(f"_m{i}").alias("mismatch_type"),
            ),
        )

    no_mismatch = F.array().cast(
        "array<struct<field_name:string,source_value:string,target_value:string,mismatch_type:string>>"
    )
    # The array is built for differing records only, and not at all where a caller does not read it.
    entries = F.array_compact(F.array(*[entry(i, name) for i, name in enumerate(columns)])) if columns else no_mismatch
    return paired.select(
        F.when(target_only, F.lit("")).otherwise(record_id).alias("source_id"),
        F.when(~source_only, record_id).alias("target_id"),
        F.when(source_only, F.lit(MISSING_IN_TARGET))
        .when(target_only, F.lit(MISSING_IN_SOURCE))
        .when(differs, F.lit(MISMATCHED))
        .otherwise(F.lit(MATCHED))
        .alias("status"),
        F.when(source_only, F.lit("critical"))
        .when(target_only, F.lit("warning"))
        .when(key_differs, F.lit("critical"))
        .when(differs, F.lit("warning"))
        .otherwise(F.lit("info"))
        .alias("severity"),
        F.when(differs, entries).otherwise(no_mismatch).alias("mismatches"),
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
    )


# -- reports -----------------------------------------------------------------------------------


def findings(results: DataFrame) -> DataFrame:
    """The records that are not matched."""
    return results.where(F.col("status") != MATCHED)


def mismatch_details(results: DataFrame) -> DataFrame:
    """One row per differing field of a record that both sides have."""
    # Not a filter and inline("mismatches"): both would compare every field once more.
    differing = F.when(F.col("status") == MISMATCHED, F.col("mismatches"))
    return results.select("source_id", F.inline(differing))


def mismatches_by_field(results: DataFrame) -> DataFrame:
    return mismatch_details(results).groupBy("field_name", "mismatch_type").agg(F.count(F.lit(1)).alias("mismatches"))


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint"))


def reconciliation_report(results: DataFrame) -> DataFrame:
    """One row: totals (duplicates included), counts by status, match rate, and whether it is acceptable."""
    statuses = (MATCHED, MISMATCHED, MISSING_IN_TARGET, MISSING_IN_SOURCE)
    return report_gate(
        results.agg(
            _zero(F.sum("source_rows")).alias("total_source"),
            _zero(F.sum("target_rows")).alias("total_target"),
            *[F.count_if(F.col("status") == status).alias(status) for status in statuses],
        )
    )


def report_gate(counts: DataFrame) -> DataFrame:
    """Add ``match_rate`` and ``acceptable`` to counts by status."""
    total = F.col(MATCHED) + F.col(MISMATCHED) + F.col(MISSING_IN_TARGET) + F.col(MISSING_IN_SOURCE)
    return counts.withColumn(
        "match_rate", F.when(total > 0, F.col(MATCHED) / total * 100).otherwise(F.lit(0.0))
    ).withColumn("acceptable", (F.col("match_rate") >= MIN_MATCH_RATE) & (F.col(MISSING_IN_TARGET) == 0))


def reconciliation_summary(results: DataFrame, job_id: str) -> DataFrame:
    """The report of a job, with counts of critical and warning findings."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[
            F.count_if(F.col("status") == status).alias(status)
            for status in (MATCHED, MISMATCHED, MISSING_IN_TARGET, MISSING_IN_SOURCE)
        ],
        F.count_if(F.col("severity") == "critical").alias("critical_issues"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )
    return (
        report_gate(counts)
        .withColumnRenamed("match_rate", "match_rate_pct")
        .drop("acceptable")
        .withColumn("job_id", F.lit(job_id))
    )


def result_rows(results: DataFrame, job_id: str, entity_type: str) -> DataFrame:
    """Findings as rows of the ``reconciliation_results`` table, with the differing fields as JSON maps."""

    def values(name: str) -> Column:
        return F.map_from_entries(F.transform("mismatches", lambda m: F.struct(m["field_name"], m[name])))

    differs = F.size("mismatches") > 0
    return findings(results).select(
        F.lit(job_id).alias("job_id"),
        F.col("source_id").alias("source_record_id"),
        F.col("target_id").alias("target_record_id"),
        F.lit(entity_type).alias("entity_type"),
        "status",
        F.when(differs, F.to_json(values("mismatch_type"))).alias("mismatched_fields"),
        F.when(differs, F.to_json(values("source_value"))).alias("source_values"),
        F.when(differs, F.to_json(values("target_value"))).alias("target_values"),
        "severity",
        F.lit(False).alias("resolved"),
    )


# -- keys and schemas --------------------------------------------------------------------------


def key_sets(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Every key once, with the sides that have it: ``common``, ``source_only`` or ``target_only``.

    Only the key columns are read, and each task sends a key at most once.
    """
    sides = source.select(*key_columns(source, keys), F.lit(1).alias("_side")).unionByName(
        target.select(*key_columns(target, keys), F.lit(2).alias("_side"))
    )
    found = sides.groupBy(*_key_names(keys)).agg(F.bit_or("_side").alias("_side"))
    return found.select(
        F.concat_ws("|", *_key_names(keys)).alias("record_id"),
        F.when(F.col("_side") == 3, F.lit("common"))
        .when(F.col("_side") == 1, F.lit("source_only"))
        .otherwise(F.lit("target_only"))
        .alias("key_set"),
    )


def key_set_counts(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys in each of the three key sets."""
    names = ("common", "source_only", "target_only")
    counts = key_sets(source, target, keys).agg(*[F.count_if(F.col("key_set") == n).alias(n) for n in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("key_set"), F.col(n).alias("keys")) for n in names])))


def schema_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns whose type differs, with the source values that the target type cannot hold."""
    common = [(f.name, f.dataType, _kind(target, f.name)) for f in source.schema.fields if find_column(target, f.name)]
    differing = [(n, s, t) for n, s, t in common if s != t]
    if not differing:
        return source.sparkSession.createDataFrame(
            [], "column_name STRING, source_type STRING, target_type STRING, values BIGINT, lost BIGINT, status STRING"
        )
    counts = source.agg(
        *[F.count(F.col(n)).alias(f"n{i}") for i, (n, _, _) in enumerate(differing)],
        *[
            F.count_if(F.col(n).isNotNull() & F.col(n).cast("string").try_cast(t).isNull()).alias(f"l{i}")
            for i, (n, _, t) in enumerate(differing)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.lit(s.simpleString()).alias("source_type"),
                F.lit(t.simpleString()).alias("target_type"),
                F.col(f"n{i}").alias("values"),
                F.col(f"l{i}").alias("lost"),
                F.lit("type_mismatch").alias("status"),
            )
            for i, (n, s, t) in enumerate(differing)
        ]
    )
    return counts.select(F.inline(rows))
