"""Schemas and allowed values of the metadata tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES: dict[str, str] = {
    "migration_jobs": (
        "job_id STRING, name STRING, entity_type STRING, contract_id STRING, source_system STRING, "
        "target_system STRING, status STRING, total_records BIGINT, processed_records BIGINT, "
        "failed_records BIGINT, error_message STRING, started_at TIMESTAMP, completed_at TIMESTAMP, "
        "created_at TIMESTAMP"
    ),
    "migration_batches": (
        "job_id STRING, batch_number BIGINT, status STRING, record_count BIGINT, extract_path STRING, "
        "transform_path STRING, checksum_source STRING, checksum_target STRING, error_message STRING, "
        "extract_duration_ms BIGINT, transform_duration_ms BIGINT, load_duration_ms BIGINT"
    ),
    "entity_mappings": (
        "entity_type STRING, source_table STRING, source_column STRING, source_data_type STRING, "
        "target_field STRING, target_data_type STRING, transformation_rule STRING, validation_rule STRING, "
        "is_required BOOLEAN, is_key_field BOOLEAN, default_value STRING"
    ),
    "reconciliation_results": (
        "job_id STRING, batch_id STRING, source_record_id STRING, target_record_id STRING, "
        "entity_type STRING, status STRING, mismatched_fields STRING, source_values STRING, "
        "target_values STRING, severity STRING, resolved BOOLEAN, resolution_notes STRING"
    ),
    "lineage_records": (
        "lineage_id STRING, job_id STRING, record_id STRING, source_table STRING, source_column STRING, "
        "source_value STRING, target_table STRING, target_column STRING, target_value STRING, "
        "transformation STRING, etl_commit_id STRING, created_at TIMESTAMP"
    ),
    "audit_events": (
        "event_type STRING, entity_type STRING, job_id STRING, batch_id STRING, actor STRING, "
        "action STRING, details STRING, created_at TIMESTAMP"
    ),
}

# The states a job, a batch, a reconciled record and a finding can have.
JOB_STATUS = (
    "pending", "extracting", "transforming", "loading", "reconciling", "completed", "failed", "rolled_back",
)
BATCH_STATUS = (
    "pending", "extracting", "extracted", "transforming", "transformed", "loading", "loaded",
    "reconciling", "completed", "failed",
)
RECON_STATUS = ("matched", "mismatched", "missing_in_target", "missing_in_source", "type_mismatch")
SEVERITY = ("info", "warning", "critical")

ALLOWED: dict[str, dict[str, tuple[str, ...]]] = {
    "migration_jobs": {"status": JOB_STATUS},
    "migration_batches": {"status": BATCH_STATUS},
    "reconciliation_results": {"status": RECON_STATUS, "severity": SEVERITY},
}


@cache
def table_schema(table: str) -> T.StructType:
    """Schema of a metadata table."""
    return T.StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns of a metadata table in order; absent ones are null.

    A row with a state that the table does not allow stops the write.
    """
    present = {c.lower() for c in df.columns}

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name).cast(field.dataType)
        allowed = ALLOWED.get(table, {}).get(field.name)
        if allowed:
            problem = F.concat(F.lit(f"{table}.{field.name}: not allowed: "), value)
            value = F.when(value.isNull() | value.isin(*allowed), value).otherwise(
                F.raise_error(problem).cast("string")
            )
        return value.alias(field.name)

    return df.select(*[column(field) for field in table_schema(table).fields])
