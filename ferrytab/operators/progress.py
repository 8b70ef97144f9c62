"""Progress of jobs, batch durations, promotion decisions and audit counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.text import column_type

PROMOTED, AWAITING, BLOCKED = "promoted", "awaiting_manual_promotion", "blocked"


def job_progress(jobs: DataFrame, batches: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """One row per job: batches done, percentage, seconds so far and seconds expected to be left.

    Batches are counted per job before they meet the jobs. A job without batches has progress 0.
    """
    done = F.col("status") == "completed"
    counted = batches.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("batches_total"),
        F.count_if(done).alias("batches_completed"),
        F.count_if(F.col("status") == "failed").alias("batches_failed"),
        F.sum("record_count").alias("total_records"),
        F.sum(F.when(done, F.col("record_count"))).alias("processed_records"),
    )
    kind = column_type(jobs, "started_at")
    kind = kind if isinstance(kind, T.TimestampNTZType) else T.TimestampType()
    now = (F.current_timestamp() if as_of is None else F.lit(str(as_of))).cast(kind)
    elapsed = _seconds(now, kind) - _seconds(F.col("started_at").cast(kind), kind)
    totals = jobs.select("job_id", "started_at").join(counted, "job_id", "left")
    numbers = ("batches_total", "batches_completed", "batches_failed", "total_records", "processed_records")
    filled = totals.select("job_id", elapsed.alias("elapsed_seconds"), *[_or_zero(n) for n in numbers])
    left = F.col("batches_total") - F.col("batches_completed")
    return filled.withColumns(
        {
            "progress_pct": F.when(
                F.col("batches_total") > 0, F.col("batches_completed") / F.col("batches_total") * 100
            ).otherwise(F.lit(0.0)),
            "estimated_remaining_seconds": F.when(
                F.col("batches_completed") > 0, F.col("elapsed_seconds") * left / F.col("batches_completed")
            ),
        }
    )


def _seconds(moment: Column, kind: T.DataType) -> Column:
    """Seconds since 1970; those of a time without a zone do not depend on the session's zone."""
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
        return F.unix_date(moment.cast("date")).cast("bigint") * 86400 + clock
    return F.unix_seconds(moment)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def stage_durations(batches: DataFrame) -> DataFrame:
    """Per job and stage: batches timed, and total, mean and longest milliseconds."""
    stages = ("extract", "transform", "load")
    timed = batches.select(
        "job_id",
        F.inline(
            F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"{s}_duration_ms").alias("ms")) for s in stages])
        ),
    ).where("ms is not null")
    return timed.groupBy("job_id", "stage").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("ms").alias("total_ms"),
        F.avg("ms").alias("mean_ms"),
        F.max("ms").alias("max_ms"),
    )


def promotion_decision(report: DataFrame, auto_promote: bool) -> DataFrame:
    """What follows from a reconciliation report."""
    return report.withColumn(
        "action",
        F.when(~F.col("acceptable"), F.lit(BLOCKED)).otherwise(F.lit(PROMOTED if auto_promote else AWAITING)),
    )


def audit_counts(events: DataFrame) -> DataFrame:
    """Events, distinct actors, and first and last time per event type."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("actor").alias("actors"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )
