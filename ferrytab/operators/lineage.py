"""Field-level lineage: where each target value came from, and what a source column feeds."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.text import column_type, find_column, shown
from ferrytab.functions.transforms import TransformRegistry
from ferrytab.operators.mapping import EntityMapping, FieldMapping, mapped_column
from ferrytab.operators.rules import Row, Rule

DIRECT_COPY = "direct_copy"
_ID_PARTS = ("job_id", "record_id", "source_table", "source_column", "target_table", "target_column")
_SHOWN = ("target_column", "source_table", "source_column", "source_value", "target_value", "transformation", "etl_commit_id")

#: Entries of a task that are sealed together (:func:`_sealed`).
LOT = 1 << 18
#: Bytes of lineage per bucket of records, most buckets, and buckets for lineage of unknown size.
BUCKET_BYTES, MOST_BUCKETS, SOME_BUCKETS = 16 << 20, 1 << 14, 1 << 10


def wide_rows(
    df: DataFrame, mapping: EntityMapping, registry: TransformRegistry | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Each row's target fields, and the text of the source value of each (``_s0``, ``_s1``, ...).

    One projection: whoever writes it evaluates the transforms once and can take the mapped rows, their
    lineage and their data map from it. Columns in ``keep`` pass through; mapped columns the table lacks are left out.
    """
    registry = registry or TransformRegistry()
    present = present_fields(df, mapping)
    sources = [
        shown(F.col(f.source_column), column_type(df, f.source_column)).alias(f"_s{i}") for i, f in enumerate(present)
    ]
    return df.select(*keep, *[mapped_column(df, f, registry) for f in present], *sources)


def present_fields(df: DataFrame, mapping: EntityMapping) -> list[FieldMapping]:
    """The fields of a mapping whose source column the table has."""
    return [f for f in mapping.fields if find_column(df, f.source_column)]


def rows_of_records(
    df: DataFrame, mapping: EntityMapping, records: DataFrame, registry: TransformRegistry | None = None
) -> DataFrame:
    """The source rows whose lineage has a ``record_id`` that ``records`` has; only the key's transform runs on the others."""
    registry = registry or TransformRegistry()
    key = mapped_column(df, mapping.key, registry)
    record = shown(key, df.select(key).schema[0].dataType)
    wanted = records.select(F.col("record_id").alias("_record")).distinct()
    return df.join(wanted, record == F.col("_record"), "left_semi")


def build_lineage(
    df: DataFrame,
    mapping: EntityMapping,
    job_id: str,
    etl_commit_id: str = "",
    created_at: datetime | str | None = None,
    registry: TransformRegistry | None = None,
) -> DataFrame:
    """One lineage row per record and mapped field, from one pass over the source rows.

    ``lineage_id`` follows from job, record and field, so a job that runs again gives the same ids.
    """
    present = present_fields(df, mapping)
    return lineage_of(wide_rows(df, mapping, registry), mapping, present, job_id, etl_commit_id, created_at)


def lineage_of(
    wide: DataFrame,
    mapping: EntityMapping,
    present: list[FieldMapping],
    job_id: str,
    etl_commit_id: str = "",
    created_at: datetime | str | None = None,
) -> DataFrame:
    """The lineage of :func:`wide_rows`; no transform runs."""
    key = next(i for i, f in enumerate(present) if f.is_key)
    numbered = [(F.col(f"`{f.target_field}`").alias(f"t{i}"), F.col(f"_s{i}").alias(f"s{i}")) for i, f in enumerate(present)]
    mapped = wide.select(*[column for pair in numbered for column in pair])
    targets = [shown(F.col(f"t{i}"), column_type(mapped, f"t{i}")) for i in range(len(present))]
    # Texts, and the part of an id that the fields of a record share, are made once per record, before it becomes entries.
    # An entry picks its own from an array: a choice by cases makes a method that is too long for the JVM to compile.
    texts = mapped.select(
        targets[key].alias("record_id"),
        F.array(*[F.col(f"s{i}") for i in range(len(present))]).alias("_sources"),
        F.array(*targets).alias("_targets"),
    )
    head = F.concat_ws("|", F.lit(job_id), "record_id", F.lit(mapping.source_table))

    # What does not depend on the row is one constant array. The values are picked afterwards, so a
    # reader that leaves them out does not pay for the transforms.
    constant = F.array(
        *[
            F.struct(
                F.lit(i).alias("_field"),
                F.lit(f.source_column).alias("source_column"),
                F.lit(f.target_field).alias("target_column"),
                F.lit(f.transform or DIRECT_COPY).alias("transformation"),
                F.lit("|".join((f.source_column, mapping.target_table, f.target_field))).alias("_tail"),
            )
            for i, f in enumerate(present)
        ]
    )

    stamp = F.current_timestamp() if created_at is None else F.lit(str(created_at)).cast("timestamp")
    full = (
        texts.select("*", head.alias("_head"), F.inline(constant))
        .withColumns(
            {
                # The texts of _ID_PARTS, joined.
                "lineage_id": F.md5(F.concat_ws("|", "_head", "_tail")),
                "source_value": F.get("_sources", "_field"),
                "target_value": F.get("_targets", "_field"),
                "job_id": F.lit(job_id),
                "source_table": F.lit(mapping.source_table),
                "target_table": F.lit(mapping.target_table),
                "etl_commit_id": F.lit(etl_commit_id),
                "created_at": stamp,
            }
        )
    )
    return full.select(
        "lineage_id", "job_id", "record_id", "source_table", "source_column", "source_value", "target_table", "target_column",
        "target_value", "transformation", "etl_commit_id", "created_at",
    )


def _where(lineage: DataFrame, **values: str | None) -> DataFrame:
    for name, value in values.items():
        if value is not None:
            lineage = lineage.where(F.col(name) == value)
    return lineage


def forward(lineage: DataFrame, source_table: str, source_column: str, job_id: str | None = None) -> DataFrame:
    """Entries that a source column went into."""
    return _where(lineage, source_table=source_table, source_column=source_column, job_id=job_id)


def backward(lineage: DataFrame, target_table: str, target_column: str, job_id: str | None = None) -> DataFrame:
    """Entries that a target column came from."""
    return _where(lineage, target_table=target_table, target_column=target_column, job_id=job_id)


def of_record(lineage: DataFrame, record_id: str, job_id: str | None = None) -> DataFrame:
    """All entries of one record."""
    return _where(lineage, record_id=record_id, job_id=job_id)


def search(
    lineage: DataFrame,
    record_id: str | None = None,
    entity_type: str | None = None,
    field_name: str | None = None,
    etl_commit_id: str | None = None,
    job_id: str | None = None,
) -> DataFrame:
    """Entries that meet every condition given. ``field_name`` is the target column."""
    found = _where(
        lineage, record_id=record_id, target_column=field_name, etl_commit_id=etl_commit_id, job_id=job_id
    )
    if entity_type is not None:
        found = found.where(
            (F.col("source_table") == f"db2_{entity_type}") | (F.col("target_table") == f"fast_{entity_type}")
        )
    return found


def impacts(lineage: DataFrame) -> DataFrame:
    """Per source column: the target tables and columns it feeds.

    ``affected_tables``, ``affected_columns`` and ``details`` (target table to its sorted columns).
    Entries collapse to the distinct column pairs before they are collected, so what is collected is
    bounded by the number of columns, not of records.
    """
    source = ("source_table", "source_column")
    pairs = lineage.groupBy(*source, "target_table", "target_column").agg(F.count(F.lit(1)).alias("_n"))
    tables = pairs.groupBy(*source, "target_table").agg(F.array_sort(F.collect_list("target_column")).alias("columns"))
    return tables.groupBy(*source).agg(
        F.count(F.lit(1)).alias("affected_tables"),
        F.sum(F.size("columns")).alias("affected_columns"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("target_table", "columns")))).alias("details"),
    )


def impact_of(lineage: DataFrame, source_table: str, source_column: str) -> DataFrame:
    """One row for one source column; counts are 0 when it feeds nothing."""
    found = impacts(forward(lineage, source_table, source_column))
    wanted = lineage.sparkSession.range(1).select(
        F.lit(source_table).alias("source_table"), F.lit(source_column).alias("source_column")
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    return wanted.join(found, ["source_table", "source_column"], "left").select(
        F.concat_ws(".", "source_table", "source_column").alias("source"),
        F.coalesce("affected_tables", F.lit(0)).alias("affected_tables"),
        F.coalesce("affected_columns", F.lit(0)).alias("affected_columns"),
        F.coalesce("details", empty).alias("details"),
    )


def statistics(lineage: DataFrame) -> DataFrame:
    """Stored entries per job."""
    return lineage.groupBy("job_id").agg(F.count(F.lit(1)).alias("total_tracked"))


def documents(lineage: DataFrame) -> DataFrame:
    """A line of text per entry, for full-text search outside."""
    return lineage.select(
        "lineage_id",
        F.format_string(
            "Source: %s.%s → Target: %s.%s Transform: %s Job: %s",
            *[F.coalesce(c, F.lit("")) for c in ("source_table", "source_column", "target_table", "target_column")],
            F.coalesce("transformation", F.lit(DIRECT_COPY)),
            F.coalesce("job_id", F.lit("")),
        ).alias("document"),
    )


def _packed(rows: DataFrame) -> DataFrame:
    """(``_job``, ``_record``, ``_packed``): entries of one record that stand in one batch of a task, as an array.

    ``rows`` are entries with ``_failed``. Of entries of one field of a record the least stays, with their number ``_n``, so
    a record that fills a batch makes one array no longer than the mapping. Their ``job_id`` and ``record_id`` say whether
    these are null; ``_job`` and ``_record`` hold them, empty for null.
    """
    fields = [f for f in rows.schema if f.name != "_failed"]

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = [f.name for f in fields]
        for batch in batches:
            if not batch.num_rows:
                continue
            filled = {p: pc.fill_null(batch.column(p), "") for p in _ID_PARTS}
            key, size, record = np.zeros(batch.num_rows, np.int64), 1, None
            for column in (*filled.values(), batch.column("_failed")):
                coded = pc.dictionary_encode(column)
                if size * len(coded.dictionary) > 1 << 60:
                    key = np.unique(key, return_inverse=True)[1]
                    size = int(key.max()) + 1
                size *= len(coded.dictionary)
                key = key * len(coded.dictionary) + coded.indices.to_numpy()
                if record is None and column is filled["record_id"]:
                    record = key.copy()
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            if len(first) < batch.num_rows:
                table = pa.table([pa.array(key), *(batch.column(n) for n in names)], ["_key", *names])
                by = [(n, "ascending") for n in table.column_names]
                order = pc.sort_indices(table, sort_keys=by, null_placement="at_start").to_numpy()
                first = order[np.cumsum(times) - times]
            starts = np.flatnonzero(np.diff(record[first], prepend=-1))
            kept = batch.take(pa.array(first))
            # The two ids lead the packed row; an entry only tells which of them is null.
            plain = [kept.column(n).is_null() if n in ("job_id", "record_id") else kept.column(n) for n in names]
            values = [*plain, kept.column("_failed"), pa.array(times, pa.int64())]
            lists = pa.ListArray.from_arrays(
                pa.array([*starts, len(first)], pa.int32()), pa.StructArray.from_arrays(values, [*names, "_failed", "_n"])
            )
            heads = pa.array(first[starts])
            yield pa.RecordBatch.from_arrays(
                [filled["job_id"].take(heads), filled["record_id"].take(heads), lists], ["_job", "_record", "_packed"]
            )

    flat = [T.StructField(f.name, T.BooleanType()) if f.name in ("job_id", "record_id") else f for f in fields]
    whole = T.StructType([*flat, T.StructField("_failed", T.BooleanType()), T.StructField("_n", T.LongType())])
    kind = T.StructType(
        [T.StructField("_job", T.StringType()), T.StructField("_record", T.StringType()), T.StructField("_packed", T.ArrayType(whole))]
    )
    return rows.mapInArrow(pack, kind)


def _buckets(lineage: DataFrame, places: int) -> int:
    """Buckets of records: a bucket is merged in one piece, so there are more of them for more lineage."""
    size = int(lineage._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size // BUCKET_BYTES if size < 1 << 60 else SOME_BUCKETS
    return max(4 * places, min(MOST_BUCKETS, known))


def _sealed(packed: DataFrame, buckets: int) -> DataFrame:
    """(``_bucket``, ``_sealed``, ``_size``): rows of :func:`_packed`, those of one bucket in a lot as one compressed Arrow stream.

    Texts that many entries share are there once a stream, so a shuffle moves little more than values and record ids.
    """

    def seal(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def streams(lot: list) -> pa.RecordBatch:
            whole = pa.Table.from_batches(lot).combine_chunks()
            buckets = whole["_bucket"].to_numpy()
            order = np.argsort(buckets, kind="stable")
            whole, buckets = whole.take(pa.array(order)).combine_chunks(), buckets[order]
            lists = whole["_packed"].chunk(0)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            record = pa.array(np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)))
            entries = lists.flatten()
            named = {n: whole[n].chunk(0).take(record) for n in ("_job", "_record")}
            named |= dict(zip([f.name for f in entries.type], entries.flatten(), strict=True))
            flat = pa.RecordBatch.from_pydict(named)
            last = np.flatnonzero(np.diff(buckets, append=-1))
            out, sizes, at = [], [], 0
            for end in ends[last].tolist():
                part, at = flat.slice(at, end - at), end
                plain = ("job_id", "record_id", "source_value", "target_value", "_failed", "_n")
                coded = {n: c if n in plain else c.dictionary_encode() for n, c in zip(part.schema.names, part.columns, strict=True)}
                part = pa.RecordBatch.from_pydict(coded)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as stream:
                    stream.write_batch(part)
                raw = sink.getvalue()
                out.append(pa.Codec("zstd").compress(raw, asbytes=True))
                sizes.append(raw.size)
            return pa.RecordBatch.from_pydict({"_bucket": buckets[last], "_sealed": out, "_size": sizes})

        lot, entries = [], 0
        for batch in batches:
            if batch.num_rows:
                lot.append(batch)
                entries += pc.sum(pc.list_value_length(batch.column("_packed"))).as_py()
            if entries >= LOT:
                yield streams(lot)
                lot, entries = [], 0
        if lot:
            yield streams(lot)

    bucket = F.pmod(F.xxhash64("_job", "_record"), F.lit(buckets)).alias("_bucket")
    return packed.select(bucket, "_job", "_record", "_packed").mapInArrow(seal, "_bucket long, _sealed binary, _size long")


def _merged(lineage: DataFrame, failures: DataFrame, places: int, fields: T.StructType) -> DataFrame:
    """(``job_id``, ``record_id``, ``_entries``, ``_broken``, ``entries``) per record that has entries, from both as :func:`_sealed`.

    Entries that agree in all of ``_ID_PARTS``, null as empty, are one, the least of them; it says whether its job and record are null.
    """

    def merge(ours, theirs):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = []
        for side in (ours, theirs):
            for data, size in zip(side["_sealed"], side["_size"].to_pylist(), strict=True):
                parts.append(pa.ipc.open_stream(pa.Codec("zstd").decompress(data.as_buffer(), size)).read_all())
        whole = pa.concat_tables(parts).unify_dictionaries().combine_chunks()
        columns = {n: whole[n].chunk(0) for n in whole.column_names}
        columns = {n: c.dictionary_decode() if n in ("transformation", "etl_commit_id") else c for n, c in columns.items()}
        # Whether the job and the record are null; a null sorts before an empty text.
        null = {n: columns[n].to_numpy(zero_copy_only=False) for n in ("job_id", "record_id")}
        failed, times = columns["_failed"].to_numpy(zero_copy_only=False), columns["_n"].to_numpy()

        def codes(column: pa.DictionaryArray) -> tuple[np.ndarray, int]:
            values = column.dictionary
            empty = pc.index(values, pa.scalar("", values.type)).as_py()
            return column.indices.fill_null(empty if empty >= 0 else len(values)).to_numpy().astype(np.int64), len(values) + 1

        def joined(keys: list[tuple[np.ndarray, int]]) -> np.ndarray:
            key, size = np.zeros(len(keys[0][0]), np.int64), 1
            for code, n in keys:
                if size * n > 1 << 60:
                    key = np.unique(key, return_inverse=True)[1]
                    size = int(key.max()) + 1
                key, size = key * n + code, size * n
            return key

        of_record = [codes(columns["_job"]), codes(columns["_record"])]
        key = joined([*of_record, *[codes(columns[n]) for n in _ID_PARTS[2:]], (failed.astype(np.int64), 2)])
        _, first, group, copies = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        times = np.bincount(group, weights=times, minlength=len(first)).astype(np.int64)
        again = np.flatnonzero(copies[group] > 1)
        if len(again):
            some = pa.array(again)
            ranks = [(f"_{i}", pa.array(c[again].astype(np.int64))) for i, c in enumerate((group, ~null["job_id"], ~null["record_id"]))]
            for n in (*_ID_PARTS[2:], "source_value", "target_value", "transformation", "etl_commit_id"):
                values = columns[n].take(some)
                ranks.append((f"c_{n}", values.dictionary_decode() if n in _ID_PARTS else values))
            ranked = pa.table(dict(ranks))
            order = pc.sort_indices(ranked, sort_keys=[(n, "ascending") for n in ranked.column_names], null_placement="at_start").to_numpy()
            least = again[order]
            starts = np.flatnonzero(np.diff(group[least], prepend=-1))
            first[group[least[starts]]] = least[starts]

        record = joined([*[(c[first], n) for c, n in of_record], *[(null[n][first].astype(np.int64), 2) for n in ("job_id", "record_id")]])
        order = np.argsort(record, kind="stable")
        first, times, record = first[order], times[order], np.unique(record[order], return_inverse=True)[1]
        number, good = int(record[-1]) + 1, ~failed[first]
        broken = first[~good], record[~good]
        named = np.flatnonzero(columns["target_column"].take(pa.array(broken[0])).is_valid().to_numpy(zero_copy_only=False))
        broken = broken[0][named], broken[1][named]
        first, times, record = first[good], times[good], record[good]
        present, starts = np.unique(record, return_index=True)  # failures of records without lineage have no entries
        texts = {n: columns[n].take(pa.array(first)) for n in _SHOWN}
        texts = {n: c.dictionary_decode() if pa.types.is_dictionary(c.type) else c for n, c in texts.items()}
        held = np.isin(broken[1], present)
        broken = broken[0][held], np.searchsorted(present, broken[1][held])
        failing = columns["target_column"].take(pa.array(broken[0])).dictionary_decode()
        heads = pa.array(first[starts])
        ids = [
            pc.if_else(columns[flag].take(heads), pa.scalar(None, pa.string()), columns[n].take(heads).dictionary_decode())
            for flag, n in (("job_id", "_job"), ("record_id", "_record"))
        ]
        counts = np.bincount(record, weights=times, minlength=number)[present].astype(np.int64)
        out = pa.table(
            {
                "job_id": ids[0],
                "record_id": ids[1],
                "_entries": pa.ListArray.from_arrays(
                    pa.array([*starts, len(first)], pa.int32()), pa.StructArray.from_arrays(list(texts.values()), list(texts))
                ),
                "_broken": pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(broken[1], np.arange(len(present) + 1)), pa.int32()), failing
                ),
                "entries": pa.array(counts),
            }
        )
        return pa.Table.from_batches(out.to_batches(max_chunksize=4_096), out.schema)

    text = T.StringType()
    kind = T.StructType(
        [
            T.StructField("job_id", text),
            T.StructField("record_id", text),
            T.StructField("_entries", T.ArrayType(T.StructType([T.StructField(n, fields[n].dataType) for n in _SHOWN]))),
            T.StructField("_broken", T.ArrayType(text)),
            T.StructField("entries", T.LongType()),
        ]
    )
    sides = [side.repartition(places, "_bucket").groupBy("_bucket") for side in (lineage, failures)]
    return sides[0].cogroup(sides[1]).applyInArrow(merge, kind)


def data_map(lineage: DataFrame, failures: DataFrame, job_id: str | None = None) -> DataFrame:
    """One row per job and record: its fields with their validation outcome, and the pass rate.

    A failure counts for the job in its ``job_id``; ``job_id`` names the job of failures without that
    column. Entries of one field of a record collapse to one before they are collected, so a record that
    occurs many times costs no more than one that occurs once. ``entries`` keeps their number.
    Entries and failures go through one shuffle each, as streams of many records (:func:`_packed`, :func:`_sealed`), to the task
    that merges the records of their bucket; there is no join.
    """
    if "job_id" not in failures.columns:
        if job_id is None:
            raise ValueError("The failures have no job_id column, and no job is named for them")
        failures = failures.withColumn("job_id", F.lit(job_id))
    values = F.struct(*_ID_PARTS, "source_value", "target_value", "transformation", "etl_commit_id")
    broken = F.struct("job_id", "record_id", F.col("field_name").alias("target_column"))
    rows = lineage.select(values.alias("_v")).withColumn("_failed", F.lit(False))
    theirs = failures.select(
        F.struct(
            *[
                (broken[f.name] if f.name in ("job_id", "record_id", "target_column") else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in rows.schema["_v"].dataType.fields
            ]
        ).alias("_v"),
        F.lit(True).alias("_failed"),
    )
    places = int(lineage.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = _buckets(lineage, places)
    sealed = [_sealed(_packed(side.select("_v.*", "_failed")), buckets) for side in (rows, theirs)]
    collected = _merged(*sealed, places, rows.schema["_v"].dataType)

    def field(entry: Column) -> Column:
        return F.struct(
            entry["target_column"].alias("field_name"),
            entry["source_table"].alias("source_table"),
            entry["source_column"].alias("source_column"),
            entry["source_value"].alias("source_value"),
            entry["target_value"].alias("transformed_value"),
            entry["transformation"].alias("transformation_applied"),
            (~F.coalesce(F.array_contains("_broken", entry["target_column"]), F.lit(False))).alias("validation_passed"),
            entry["etl_commit_id"].alias("etl_commit_id"),
        )

    mapped = collected.select(
        "job_id", "record_id", F.array_sort(F.transform("_entries", field)).alias("fields"), "entries"
    )
    passed = F.size(F.filter("fields", lambda f: f["validation_passed"]))
    return mapped.select(
        "job_id",
        "record_id",
        "fields",
        F.size("fields").cast("bigint").alias("total_fields"),
        "entries",
        (passed / F.size("fields") * 100).alias("validation_pass_rate"),
    )


def data_map_of(
    wide: DataFrame,
    mapping: EntityMapping,
    present: list[FieldMapping],
    rules: list[Rule],
    job_id: str,
    etl_commit_id: str = "",
) -> DataFrame:
    """The data map of :func:`wide_rows`, equal to :func:`data_map` of their lineage and validation failures.

    A record's fields stand side by side in its row and the rules look at that row, so one aggregate by record is
    enough: a row per record and task is shuffled, not one per field. A field of a record that occurs more than once
    shows its smallest source value, and has failed if any of them failed.
    """
    row = Row(wide)
    failed = {}
    for rule in rules:
        if row.has(rule.field):
            flag = ~rule.outcome(row)[0]
            name = rule.field.lower()
            failed[name] = failed[name] | flag if name in failed else flag
    key = next(i for i, f in enumerate(present) if f.is_key)
    shown_ = [shown(F.col(f"`{f.target_field}`"), column_type(wide, f.target_field)) for f in present]
    slim = wide.select(
        shown_[key].alias("record_id"),
        *[F.struct(F.col(f"_s{i}").alias("s"), shown_[i].alias("t")).alias(f"_v{i}") for i in range(len(present))],
        *[failed.get(f.target_field.lower(), F.lit(False)).alias(f"_f{i}") for i, f in enumerate(present)],
    )
    records = slim.groupBy("record_id").agg(
        *[F.min(f"_v{i}").alias(f"_v{i}") for i in range(len(present))],
        *[F.bool_or(f"_f{i}").alias(f"_f{i}") for i in range(len(present))],
        (F.count(F.lit(1)) * len(present)).alias("entries"),
    )
    fields = F.array(
        *[
            F.struct(
                F.lit(f.target_field).alias("field_name"),
                F.lit(mapping.source_table).alias("source_table"),
                F.lit(f.source_column).alias("source_column"),
                F.col(f"_v{i}.s").alias("source_value"),
                F.col(f"_v{i}.t").alias("transformed_value"),
                F.lit(f.transform or DIRECT_COPY).alias("transformation_applied"),
                (~F.col(f"_f{i}")).alias("validation_passed"),
                F.lit(etl_commit_id).alias("etl_commit_id"),
            )
            for i, f in sorted(enumerate(present), key=lambda pair: (pair[1].target_field, pair[1].source_column))
        ]
    )
    whole = records.select(F.lit(job_id).alias("job_id"), "record_id", fields.alias("fields"), "entries")
    passed = F.size(F.filter("fields", lambda f: f["validation_passed"]))
    return whole.select(
        "job_id",
        "record_id",
        "fields",
        F.size("fields").cast("bigint").alias("total_fields"),
        "entries",
        (passed / F.size("fields") * 100).alias("validation_pass_rate"),
    )
