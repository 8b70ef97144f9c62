"""Extraction of whole tables in numbered batches, with mergeable checksums per batch.

The row number of a table in key order is found with one range shuffle. The sorted rows are written
once below the shared scratch folder; the position of a row inside its written part, plus the number
of rows in the parts before it, is its row number. No window runs over the rows, no page sorts the
table again, and a lost executor cannot change a number that is already in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.functions.text import as_text
from ferrytab.session import scratch_path

ROW_ID = "_row_id"
ROW_INDEX = "row_index"
BATCH = "batch_number"
DEFAULT_BATCH_SIZE = 10_000

# monotonically_increasing_id() keeps the position within a part in its lower 33 bits.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1
_COPY = "_copy"
_PART = "_part"

# Batch checksums are folded in blocks of this many, three times, so no task sees more than one block.
_FOLD = 1_000


# -- sources -----------------------------------------------------------------------------------


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    partitions: int,
    fetch_size: int = DEFAULT_BATCH_SIZE,
    **options: str,
) -> DataFrame:
    """A database table read by ``partitions`` parallel connections over ranges of a column.

    Filters and column choices on the result reach the database.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(partitions),
            fetchsize=str(fetch_size),
            **options,
        )
        .load()
    )


def source_count(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    """One row with the number of rows that meet an optional predicate."""
    return _chosen(df, None, where).agg(F.count(F.lit(1)).alias("row_count"))


def synthetic_policies(ids: DataFrame, id_column: str, seed: int = 0) -> DataFrame:
    """One made-up policy per id; the same id and seed always give the same policy."""

    def number(field: str, low: int, high: int) -> Column:
        key = F.concat_ws("|", F.lit(str(seed)), F.lit(field), F.col(id_column).cast("string"))
        draw = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("bigint")
        return F.pmod(draw, F.lit(high - low + 1)) + F.lit(low)

    def choice(field: str, values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (number(field, 1, len(values))).cast("int"))

    def padded(field: str, low: int, high: int, width: int) -> Column:
        return F.lpad(number(field, low, high).cast("string"), width, "0")

    # Ranges and choices of the made-up fields.
    return ids.select(
        F.concat(F.lit("POL-"), number("policy", 100000, 999999).cast("string")).alias("policy_id"),
        F.concat(F.lit("CTR-"), number("contract", 1000, 9999).cast("string")).alias("contract_id"),
        F.concat(F.lit("Policyholder_"), F.col(id_column).cast("string")).alias("holder_name"),
        choice("product", ["TERM_LIFE", "WHOLE_LIFE", "ANNUITY", "UNIVERSAL"]).alias("product_type"),
        (number("premium", 5000, 500000) / 100.0).alias("premium_amount"),
        (number("coverage", 1000000, 200000000) / 100.0).alias("coverage_amount"),
        F.concat_ws(
            "-",
            number("year", 2010, 2024).cast("string"),
            padded("month", 1, 12, 2),
            padded("day", 1, 28, 2),
        ).alias("effective_date"),
        choice("status", ["ACTIVE", "LAPSED", "PAID_UP", "SURRENDERED"]).alias("status"),
        number("riders", 0, 5).alias("rider_count"),
        F.lit("2026-01-15").alias("last_modified"),
    )


# -- batches -----------------------------------------------------------------------------------


def order_rows(df: DataFrame, order_by: list[str], unique: bool = False) -> DataFrame:
    """Rows range-partitioned and sorted by ``order_by``, with an increasing ``_row_id``.

    Ties are broken by the other columns. A key, or a row, that makes up a large part of the table
    spreads over many parts: equal rows get a copy number as the last sort column. The copy number
    comes from rows sorted by content, so a task that runs again hands out the same numbers.
    ``unique=True`` says that ``order_by`` has no ties and skips that sort.
    """
    if unique:
        placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    else:
        full_order = [*order_by, *(c for c in df.columns if c not in order_by)]
        marked = df.sortWithinPartitions(F.xxhash64(*df.columns)).withColumn(
            _COPY, F.monotonically_increasing_id()
        )
        placed = (
            marked.repartitionByRange(*full_order, _COPY).sortWithinPartitions(*full_order, _COPY).drop(_COPY)
        )
    return placed.withColumn(ROW_ID, F.monotonically_increasing_id())


def land_ordered(df: DataFrame, order_by: list[str], unique: bool = False, path: str | None = None) -> DataFrame:
    """Write :func:`order_rows` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "ordered")
    ordered = order_rows(df, order_by, unique)
    ordered.write.parquet(path)
    return spark.read.schema(ordered.schema).parquet(path)


def part_of(row_id: Column) -> Column:
    """Number of the written part that holds a row."""
    return F.shiftright(row_id, _POSITION_BITS)


def position_of(row_id: Column) -> Column:
    """Position of a row inside its part."""
    return row_id.bitwiseAND(F.lit(_POSITION_MASK))


def _part_offsets(landed: DataFrame) -> DataFrame:
    """Rows before each written part. One row per write task, so it is small at any table size."""
    sizes = landed.groupBy(part_of(F.col(ROW_ID)).alias(_PART)).agg(
        (F.max(position_of(F.col(ROW_ID))) + 1).alias("_rows")
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))


def number_rows(landed: DataFrame) -> DataFrame:
    """Add ``row_index`` (0, 1, 2, ... in key order) to a landed table."""
    return (
        landed.withColumn(_PART, part_of(F.col(ROW_ID)))
        .join(F.broadcast(_part_offsets(landed)), _PART)
        .withColumn(ROW_INDEX, F.col("_before") + position_of(F.col(ROW_ID)))
        .drop(_PART, "_before", ROW_ID)
    )


def with_batches(numbered: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Add ``batch_number``; every batch but the last has exactly ``batch_size`` rows."""
    return numbered.withColumn(BATCH, F.expr(f"{ROW_INDEX} div {int(batch_size)}"))


def _chosen(df: DataFrame, columns: list[str] | None, where: str | Column | None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def extract_batches(
    df: DataFrame,
    key: str,
    columns: list[str] | None = None,
    where: str | Column | None = None,
    batch_size: int = DEFAULT_BATCH_SIZE,
    unique_key: bool = False,
) -> DataFrame:
    """All rows with their ``row_index`` and ``batch_number`` in key order."""
    landed = land_ordered(_chosen(df, columns, where), [key], unique_key)
    return with_batches(number_rows(landed), batch_size)


def extract_page(
    df: DataFrame,
    key: str,
    batch_number: int,
    columns: list[str] | None = None,
    where: str | Column | None = None,
    batch_size: int = DEFAULT_BATCH_SIZE,
    unique_key: bool = False,
) -> DataFrame:
    """The rows of one batch, at any depth.

    The ordered rows are written once for this page. Use :func:`land_ordered` and :func:`page_of` to
    read several pages of one landed table.
    """
    return page_of(land_ordered(_chosen(df, columns, where), [key], unique_key), batch_number, batch_size)


def page_of(landed: DataFrame, batch_number: int, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """One page of a landed table, read from the parts and row groups that hold it."""
    start, stop = batch_number * batch_size, (batch_number + 1) * batch_size
    offsets = _part_offsets(landed)
    # At most a few parts overlap a page; their bounds go into the scan as literals.
    ends = F.lead("_before").over(Window.orderBy(_PART))
    parts = (
        offsets.withColumn("_after", ends)
        .where((F.col("_before") < stop) & (F.col("_after").isNull() | (F.col("_after") > start)))
        .agg(F.min(_PART).alias("first"), F.max(_PART).alias("last"))
        .first()
    )
    if parts is None or parts["first"] is None:
        return landed.drop(ROW_ID).limit(0)
    bounds = offsets.where(F.col(_PART).isin(parts["first"], parts["last"])).collect()
    before = {row[_PART]: row["_before"] for row in bounds}
    low = (parts["first"] << _POSITION_BITS) + max(start - before[parts["first"]], 0)
    high = (parts["last"] << _POSITION_BITS) + (stop - before[parts["last"]])
    return landed.where((F.col(ROW_ID) >= low) & (F.col(ROW_ID) < high)).drop(ROW_ID)


# -- checksums ---------------------------------------------------------------------------------


def row_digest(df: DataFrame, columns: list[str] | None = None, algorithm: str = "xxhash64") -> Column:
    """64-bit digest of a row over its columns in name order.

    Each value goes in with its length and null has its own mark, so two different rows never give
    the same input. ``md5`` gives the same numbers in any engine, ``xxhash64`` is faster.
    """
    names = sorted(columns or df.columns)
    types = {field.name: field.dataType for field in df.schema.fields}

    def encoded(name: str) -> Column:
        text = as_text(F.col(name), types[name])
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    whole = F.concat(*[encoded(name) for name in names])
    if algorithm == "xxhash64":
        return F.xxhash64(whole)
    if algorithm == "md5":
        return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"Unknown digest: {algorithm}")


def digest_aggregates(digest: Column) -> list[Column]:
    """Order-free, mergeable aggregates of row digests: count, sum and exclusive or."""
    return [
        F.count(F.lit(1)).alias("record_count"),
        F.sum(digest.cast("decimal(38,0)")).cast("string").alias("digest_sum"),
        F.bit_xor(digest).alias("digest_xor"),
    ]


def merged_digests() -> list[Column]:
    """The aggregates that make the digests of a whole from those of its parts."""
    return [
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("record_count"),
        F.sum(F.col("digest_sum").cast("decimal(38,0)")).cast("string").alias("digest_sum"),
        F.bit_xor("digest_xor").alias("digest_xor"),
    ]


def batch_checksums(batches: DataFrame, columns: list[str] | None = None, algorithm: str = "xxhash64") -> DataFrame:
    """One row per batch: record_count, digest_sum, digest_xor and a checksum text of the three."""
    names = columns or [c for c in batches.columns if c not in (BATCH, ROW_INDEX, ROW_ID)]
    digested = batches.select(BATCH, row_digest(batches, names, algorithm).alias("_digest"))
    return with_checksum(digested.groupBy(BATCH).agg(*digest_aggregates(F.col("_digest"))))


def with_checksum(summary: DataFrame) -> DataFrame:
    parts = [F.col(c).cast("string") for c in ("record_count", "digest_sum", "digest_xor")]
    return summary.withColumn("checksum", F.md5(F.concat_ws("|", *parts)))


def table_checksum(df: DataFrame, columns: list[str] | None = None, algorithm: str = "xxhash64") -> DataFrame:
    """One-row checksum of a whole table, whatever the order of its rows."""
    digested = df.select(row_digest(df, columns, algorithm).alias("_digest"))
    return with_checksum(digested.agg(*digest_aggregates(F.col("_digest"))))


def combined_checksum(summary: DataFrame) -> DataFrame:
    """One checksum over the batch checksums in batch order, folded block by block."""
    level = summary.select(F.col(BATCH).alias("_n"), F.col("checksum").alias("_c"))
    for _ in range(2):
        level = _fold(level.withColumn("_block", F.expr(f"_n div {_FOLD}")), ["_block"]).withColumnRenamed(
            "_block", "_n"
        )
    return _fold(level, []).select(F.col("_c").alias("combined_checksum"))


def _fold(level: DataFrame, by: list[str]) -> DataFrame:
    in_order = F.array_sort(F.collect_list(F.struct("_n", "_c")))
    return level.groupBy(*by).agg(
        F.md5(F.array_join(F.transform(in_order, lambda entry: entry["_c"]), "")).alias("_c")
    )


def compare_checksums(source: DataFrame, target: DataFrame) -> DataFrame:
    """Batches of both sides with their checksums and whether these are equal."""
    left = source.select(BATCH, F.col("checksum").alias("checksum_source"))
    right = target.select(BATCH, F.col("checksum").alias("checksum_target"))
    return left.join(right, BATCH, "full_outer").withColumn(
        "is_equal", F.col("checksum_source").eqNullSafe(F.col("checksum_target"))
    )


# -- summaries ---------------------------------------------------------------------------------


def batch_headers(batches: DataFrame, key: str) -> DataFrame:
    """One row per batch: record_count, lowest and highest key."""
    return batches.groupBy(BATCH).agg(
        F.count(F.lit(1)).alias("record_count"), F.min(key).alias("min_key"), F.max(key).alias("max_key")
    )


def extraction_totals(headers: DataFrame) -> DataFrame:
    """One row over the batch headers: batches and records in total."""
    return headers.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
    )


def missing_batches(headers: DataFrame, total_records: int, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Batch numbers that a table of ``total_records`` must have and that did not arrive."""
    expected = -(-total_records // batch_size)
    numbers = headers.sparkSession.range(expected).withColumnRenamed("id", BATCH)
    return numbers.join(headers.select(BATCH), BATCH, "left_anti")
