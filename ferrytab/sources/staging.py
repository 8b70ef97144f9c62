"""Staged tables, two load slots per entity with a view on the live one, and metadata tables.

A :class:`Workspace` is one database of the session catalog. Staged rows lie in one Parquet table per
entity and stage, partitioned by job. The batch number is a column, not a directory: a table of many
billion rows has millions of batches, and row-group statistics find a batch as well. Metadata tables are
kept in a commit log under the database's folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab import schemas
from ferrytab.functions.text import column_type, find_column
from ferrytab.session import scratch_path
from ferrytab.sources.commits import CODEC, Change, CommitLog
from ferrytab.sources.extract import BATCH

BLUE, GREEN = "blue", "green"
SLOTS = (BLUE, GREEN)
# Fixed value: this many error details are shown; all of them stay in the error table.
SHOWN_ERRORS = 100

# Metadata tables whose rows belong to one job and entity.
JOB_TABLES = ("migration_batches", "lineage_records", "reconciliation_results", "migration_jobs")

_SLOT_PROPERTY = "ferrytab.slot"
# Column of a slot that holds the batch a row came with; readers of the slot and of its view do not see it.
SLOT_BATCH = "_ferrytab_batch"
# Columns of the folders that a load writes: whether a row was refused, its problems, and its values as they came.
_REFUSED, _PROBLEMS, _RAW = "_refused", "_problems", "_raw"


@dataclass(frozen=True)
class TargetField:
    """A field of the target table: rows whose value does not fit the type are not loaded."""

    name: str
    type: str
    required: bool = False


class Workspace:
    """A database that holds staged, loaded and metadata tables."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None) -> None:
        self.spark = spark
        self.database = database
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
        described = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE DATABASE {database}").collect()}
        self.location = described["Location"].rstrip("/")
        self.log = CommitLog(spark, f"{self.location}/_records")

    @classmethod
    def temporary(cls, spark: SparkSession) -> Workspace:
        """A new workspace in the shared scratch folder."""
        return cls(spark, f"ferry_{uuid.uuid4().hex[:12]}", scratch_path(spark, "workspace"))

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        if table in schemas.TABLES:
            return bool(self.log.paths(table))
        return self.spark.catalog.tableExists(self.name(table))

    def table(self, table: str) -> DataFrame:
        if table in schemas.TABLES:
            return self.log.read(table, schemas.table_schema(table))
        return self.spark.table(self.name(table))

    def tables(self, prefix: str) -> list[str]:
        names = self.spark.sql(f"SHOW TABLES IN {self.database}").select("tableName").collect()
        return sorted(row["tableName"] for row in names if row["tableName"].startswith(prefix))

    def append(self, df: DataFrame, table: str, partition: str = "job_id") -> None:
        """Append rows to a table partitioned by job, making it first if need be.

        Columns the table lacks are added to it, and columns the rows lack are null in them. A column
        of another type than the table's is an error.
        """
        if not self.exists(table):
            df.write.partitionBy(partition).format("parquet").saveAsTable(self.name(table))
            return
        gives = self._widen(df, table)
        wanted = self.table(table).schema
        rows = [
            (F.col(f"`{f.name}`") if f.name.lower() in gives else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted
        ]
        df.select(*rows).write.insertInto(self.name(table))

    def _widen(self, df: DataFrame, table: str) -> dict[str, T.StructField]:
        """Add the columns of ``df`` that a table lacks; gives those of ``df`` by name in lower case."""
        has = {field.name.lower(): field.dataType for field in self.table(table).schema}
        gives = {field.name.lower(): field for field in df.schema}
        for name, field in gives.items():
            if name in has and has[name] != field.dataType:
                kinds = f"{field.dataType.simpleString()} and {has[name].simpleString()}"
                raise ValueError(f"Column {field.name} of {table} has two types: {kinds}")
        if more := [field for name, field in gives.items() if name not in has]:
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in more)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")
        return gives

    def drop_job(self, table: str, job_id: str) -> None:
        """Remove a job's partition from a table, if both exist."""
        if self.exists(table):
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (job_id = '{_quoted(job_id)}')")

    def forget(self, job_id: str, entity: str) -> None:
        """Remove what a job staged and recorded for an entity; other entities of the job keep theirs.

        Archives and audit events stay. A run that is repeated need not call this: it replaces what it writes.
        """
        for table in self.tables(f"staged__{entity}__".lower()):
            self.drop_job(table, job_id)
        self.log.commit([Change(table, job_id, entity, None) for table in JOB_TABLES])

    # -- staging -------------------------------------------------------------------------------

    def stage(self, df: DataFrame, job_id: str, entity: str, stage: str = "extract") -> str:
        """Append rows (with their batch numbers) to the staged table of a job; gives its name."""
        table = _staged(entity, stage)
        self.append(df.withColumn("job_id", F.lit(job_id)), table)
        return self.name(table)

    def stage_once(self, df: DataFrame, job_id: str, entity: str, stage: str = "extract") -> int:
        """Make rows the whole of what a job has staged for a stage; gives their number.

        They are written to a new folder, and then the job's partition is moved to it. The number is counted while
        they are written. Whoever stops before the move leaves what was staged before; to repeat it is safe.
        """
        table, path, seen = _staged(entity, stage), self.log.new_path("staged"), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC).parquet(path)
        empty = self.spark.createDataFrame([], df.schema).withColumn("job_id", F.lit(job_id))
        if not self.exists(table):
            empty.write.partitionBy("job_id").format("parquet").saveAsTable(self.name(table))
        else:
            self._widen(empty, table)
        at = f"PARTITION (job_id = '{_quoted(job_id)}')"
        self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS {at} LOCATION '{_quoted(path)}'")
        self.spark.sql(f"ALTER TABLE {self.name(table)} {at} SET LOCATION '{_quoted(path)}'")
        self.spark.catalog.refreshTable(self.name(table))
        return seen.get["rows"]

    def staged(self, job_id: str, entity: str, stage: str = "extract") -> DataFrame:
        """Staged rows of a job; only the job's partition is read."""
        return self.table(_staged(entity, stage)).where(F.col("job_id") == job_id).drop("job_id")

    def staged_folder(self, job_id: str, entity: str, stage: str = "extract") -> str | None:
        """The folder that :meth:`stage_once` wrote and a job's staged rows are in, if they are in one."""
        table, at = _staged(entity, stage), f"PARTITION (job_id = '{_quoted(job_id)}')"
        if not self.exists(table) or self.spark.sql(f"SHOW PARTITIONS {self.name(table)} {at}").isEmpty():
            return None
        path = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)} {at}").where("col_name = 'Location'").first()["data_type"]
        return path if "/_records/files/staged-" in path else None

    def staged_batches(self, job_id: str, entity: str, stage: str = "extract") -> DataFrame:
        """Batches of a job with their row counts; only the batch column is read."""
        return self.staged(job_id, entity, stage).groupBy(BATCH).agg(F.count(F.lit(1)).alias("record_count"))

    def discard_staged(self, job_id: str, archive: bool = True) -> DataFrame:
        """Remove a job from all staged tables, after copying it to the archive tables.

        Gives one row per staged table: its name, and the rows removed and archived.
        """
        removed = []
        for table in self.tables("staged__"):
            mine = self.table(table).where(F.col("job_id") == job_id)
            rows = mine.count()
            if not rows:
                continue
            kept = 0
            if archive:
                target = table.replace("staged__", "archive__", 1)
                self.append(mine, target)
                kept = self.table(target).where(F.col("job_id") == job_id).count()
            self.drop_job(table, job_id)
            removed.append((table, rows, kept))
        return self.spark.createDataFrame(removed, "staged_table STRING, rows_removed BIGINT, rows_archived BIGINT")

    # -- slots ---------------------------------------------------------------------------------

    def load(
        self,
        df: DataFrame,
        entity: str,
        slot: str = GREEN,
        dry_run: bool = False,
        target: list[TargetField] | None = None,
    ) -> DataFrame:
        """Write a table into a slot, replacing what the slot had. Gives a one-row load report.

        With ``target``, rows that lack a required value or hold one the type cannot take go to the
        slot's error table instead, with what was wrong with them. A dry run evaluates all rows and writes nothing.
        A column named ``SLOT_BATCH`` stays out of sight of the slot's readers.
        """
        _check_slot(slot)
        if slot == self.live_slot(entity) and not dry_run:
            raise ValueError(f"Slot {slot} of {entity} is live")
        problems = _problems(df, target or [])
        refused = F.size(problems) > 0
        if dry_run:
            counts = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(refused).alias("errors")).first()
        else:
            counts = self._route(df, _slot(entity, slot), problems, target or [])
        return self.spark.createDataFrame(
            [(entity, slot, dry_run, counts["rows"] - counts["errors"], counts["errors"])],
            "entity STRING, slot STRING, dry_run BOOLEAN, total_loaded BIGINT, total_errors BIGINT",
        )

    def _route(self, df: DataFrame, table: str, problems: Column, target: list[TargetField]) -> dict[str, int]:
        """Write good and refused rows in one pass to folders of their own, and put the slot's two tables on them.

        ``df`` is evaluated once: both folders are partitions of one write, which also counts their rows.
        """
        path, seen = self.log.new_path(table), Observation()
        typed = fitted(df, target)
        told = df.select("*", problems.alias(_PROBLEMS)).select("*", (F.size(_PROBLEMS) > 0).alias(_REFUSED))
        refused = F.col(_REFUSED)
        columns = [F.when(~refused, c).alias(name) for name, c in typed.items()]
        raw = F.when(refused, F.struct(*[F.col(f"`{c}`") for c in df.columns if c != SLOT_BATCH]))
        whole = told.select(*columns, raw.alias(_RAW), F.when(refused, F.col(_PROBLEMS)).alias(_PROBLEMS), _REFUSED)
        counted = whole.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(refused).alias("errors"))
        counted.write.option("compression", CODEC).partitionBy(_REFUSED).parquet(path)
        counts = seen.get
        good = T.StructType([f for f in whole.schema if f.name in typed])
        kept = T.StructType([f for f in whole.schema if f.name in (_RAW, _PROBLEMS)])
        self._place(table, good, f"{path}/{_REFUSED}=false")
        self._drop_placed(f"{table}__errors")  # those of an earlier load
        if counts["errors"]:
            self._place(f"{table}__errors", kept, f"{path}/{_REFUSED}=true")
        return counts

    def _place(self, table: str, schema: T.StructType, path: str) -> None:
        """Make a table over a folder; what the table had before goes."""
        self._drop_placed(table)
        self.log.files.make(path)  # a folder without rows is not written
        self.spark.catalog.createTable(self.name(table), path, "parquet", schema)

    def _drop_placed(self, table: str) -> None:
        if self.spark.catalog.tableExists(self.name(table)):
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").where("col_name = 'Location'")
            path = described.first()["data_type"]
            self.spark.sql(f"DROP TABLE {self.name(table)}")
            self.log.files.delete(path)

    def load_errors(self, entity: str, slot: str = GREEN, shown: int | None = SHOWN_ERRORS) -> DataFrame:
        """Up to ``shown`` rows that the last load left out (``None``: all); none if it had no errors.

        The values as they came, and ``problems``: an array of field, value (as text) and reason.
        """
        errors = f"{_slot(entity, slot)}__errors"
        if not self.exists(errors):
            kind = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("field", "value", "reason")]))
            return self.loaded(entity, slot).limit(0).withColumn("problems", F.lit(None).cast(kind))
        rows = self.table(errors).select(f"{_RAW}.*", F.col(_PROBLEMS).alias("problems"))
        return rows if shown is None else rows.limit(shown)

    def loaded(self, entity: str, slot: str = GREEN, batches: bool = False) -> DataFrame:
        """What a slot holds; with ``batches`` also the batch that each row was loaded with, if it has one."""
        rows = self.table(_slot(entity, slot))
        return rows if batches else rows.drop(SLOT_BATCH)

    def live(self, entity: str) -> DataFrame:
        return self.table(entity)

    def live_slot(self, entity: str) -> str | None:
        """The slot that the entity's view shows, or ``None`` before the first promotion."""
        if not self.exists(entity):
            return None
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(entity)}").collect()
        return next((row["value"] for row in properties if row["key"] == _SLOT_PROPERTY), None)

    def promote(self, entity: str, slot: str = GREEN) -> None:
        """Make a slot live: one replacement of the entity's view."""
        _check_slot(slot)
        if not self.exists(_slot(entity, slot)):
            raise ValueError(f"Slot {slot} of {entity} holds nothing")
        columns = ", ".join(f"`{c}`" for c in self.loaded(entity, slot).columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(entity)} TBLPROPERTIES ('{_SLOT_PROPERTY}' = '{slot}') "
            f"AS SELECT {columns} FROM {self.name(_slot(entity, slot))}"
        )

    def discard(self, entity: str, slot: str = GREEN) -> None:
        """Drop what a slot holds; the live slot is never dropped."""
        _check_slot(slot)
        if slot == self.live_slot(entity):
            raise ValueError(f"Slot {slot} of {entity} is live")
        self._drop_placed(_slot(entity, slot))
        self._drop_placed(f"{_slot(entity, slot)}__errors")

    # -- rollback ------------------------------------------------------------------------------

    def can_rollback(self, entity: str, slot: str = GREEN) -> bool:
        """True while the slot is not live, or the other slot can take its place."""
        _check_slot(slot)
        return self.live_slot(entity) != slot or self.exists(_slot(entity, _other(slot)))

    def rollback(
        self, job_id: str, entity: str, reason: str, slot: str = GREEN, archive: bool = True
    ) -> DataFrame:
        """Discard the slot, archive and discard staged rows, and note it. Gives a one-row report.

        A step that fails does not stop the others; its message is in ``errors``.
        """
        errors, rows, kept = [], 0, 0
        try:
            self.discard(entity, slot)
        except Exception as problem:  # noqa: BLE001 - reported, the other steps go on
            errors.append(f"Slot rollback failed: {problem}")
        try:
            totals = self.discard_staged(job_id, archive).agg(F.sum("rows_removed"), F.sum("rows_archived")).first()
            rows, kept = totals[0] or 0, totals[1] or 0
        except Exception as problem:  # noqa: BLE001 - reported
            errors.append(f"Staging cleanup failed: {problem}")
        self.audit("rollback", job_id, f"rolled back slot {slot}", entity, details=reason)
        return self.spark.createDataFrame(
            [(job_id, reason, slot, not errors, errors, rows, kept)],
            "job_id STRING, reason STRING, deployment_rolled_back STRING, success BOOLEAN, "
            "errors ARRAY<STRING>, staged_rows_removed BIGINT, staged_rows_archived BIGINT",
        )

    def emergency_swap(self, entity: str) -> DataFrame:
        """After a promotion: show the slot that is not live again. Gives a one-row report; writes an audit event."""
        live = self.live_slot(entity)
        slot = _other(live) if live else None
        try:
            if slot is None:
                raise ValueError(f"{entity} has no live slot")
            self.promote(entity, slot)
            row = (True, f"swapped_to_{slot}", slot, None)
        except Exception as problem:  # noqa: BLE001 - reported
            row = (False, None, slot, str(problem))
        self.audit("emergency_swap", "", row[1] or "failed", entity, details=row[3])
        return self.spark.createDataFrame([row], "success BOOLEAN, action STRING, slot STRING, error STRING")

    # -- metadata ------------------------------------------------------------------------------

    def record(self, df: DataFrame, table: str) -> None:
        """Append rows to a metadata table; states it does not allow stop the write."""
        path = self.log.stage(schemas.conform(df, table), table)
        self.log.commit([Change(table, None, None, uuid.uuid4().hex, path)])

    def prepared(self, df: DataFrame, table: str, job_id: str, entity: str, part: str = "all") -> tuple[Change, int]:
        """Rows of a metadata table written but not visible, and their number.

        The change shows them, in place of the earlier rows of that part.
        """
        path, seen = self.log.new_path(table), Observation()
        rows = schemas.conform(df, table).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.option("compression", CODEC).parquet(path)
        return Change(table, job_id, entity, part, path), seen.get["rows"]

    def records(self, table: str, job_id: str, entity: str) -> DataFrame:
        """What a job recorded for an entity; no other job's files are listed."""
        return self.log.read(table, schemas.table_schema(table), job_id, entity)

    def audit(
        self, event_type: str, job_id: str, action: str, entity: str | None = None,
        actor: str = "system", details: str | None = None,
    ) -> None:
        """Append one audit event."""
        event = self.spark.range(1).select(
            *[
                F.lit(value).cast("string").alias(name)
                for name, value in (
                    ("event_type", event_type), ("entity_type", entity), ("job_id", job_id),
                    ("actor", actor), ("action", action), ("details", details),
                )
            ],
            F.current_timestamp().alias("created_at"),
        )
        self.record(event, "audit_events")


def _staged(entity: str, stage: str) -> str:
    return f"staged__{entity}__{stage}"


def _slot(entity: str, slot: str) -> str:
    return f"{entity}__{slot}"


def _other(slot: str) -> str:
    return BLUE if slot == GREEN else GREEN


def _check_slot(slot: str) -> None:
    if slot not in SLOTS:
        raise ValueError(f"Unknown slot: {slot}")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def fitted(df: DataFrame, target: list[TargetField]) -> dict[str, Column]:
    """The columns of ``df`` by name, in the types of the target's fields; values that do not fit are null."""
    fields = {field.name.lower(): field for field in target}

    def column(name: str) -> Column:
        field = fields.get(name.lower())
        value = F.col(f"`{name}`")
        # The text form keeps a value that does not fit from stopping the write.
        return value.cast("string").try_cast(field.type) if field else value

    return {name: column(name) for name in df.columns}


def _problems(df: DataFrame, target: list[TargetField]) -> Column:
    """Why the target cannot take a row: an array of field, value (as text) and reason, empty for a good row."""

    def entry(field: TargetField, value: Column, reason: str) -> Column:
        return F.struct(F.lit(field.name).alias("field"), value.alias("value"), F.lit(reason).alias("reason"))

    found = []
    for field in target:
        nothing = F.lit(None).cast("string")
        if not find_column(df, field.name):
            if field.required:
                found.append(entry(field, nothing, "no such column"))
            continue
        value = F.col(f"`{field.name}`")
        if field.required:
            found.append(F.when(value.isNull(), entry(field, nothing, "required value is null")))
        if column_type(df, field.name) != T.DataType.fromDDL(field.type):
            text = value.cast("string")
            misfit = value.isNotNull() & text.try_cast(field.type).isNull()
            found.append(F.when(misfit, entry(field, text, f"does not fit {field.type}")))
    kind = "array<struct<field:string,value:string,reason:string>>"
    return F.array_compact(F.array(*found)).cast(kind) if found else F.array().cast(kind)
