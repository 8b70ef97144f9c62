"""Question logs: intent and entities of each question, the lineage it asks for, and message history."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrytab.operators.lineage import impacts
from ferrytab.session import scratch_path

# Intents in the order they are tried, with the phrases that give them.
INTENT_PHRASES = (
    ("lineage_backward", ("come from", "source of", "origin", "where did")),
    ("lineage_forward", ("go to", "feeds into", "used by", "downstream")),
    ("reconciliation", ("reconcil", "match", "mismatch", "discrepan")),
    ("transformation", ("transform", "convert", "changed", "mapped")),
    ("status", ("status", "progress", "how many", "complete")),
    ("impact", ("impact", "affect", "break", "change")),
)
OTHER_INTENT = "general"

# Column and table names that are looked for, in this order.
KNOWN_COLUMNS = (
    "premium_amount", "policy_id", "claim_amount", "effective_date", "coverage_amount", "agent_id",
    "status", "product_type", "first_name", "last_name", "ssn", "phone_number",
)
KNOWN_TABLES = ("policies", "claims", "premiums", "coverage", "agents")

# Entries that a question by column and a question by record bring back; kept messages.
COLUMN_ENTRIES, RECORD_ENTRIES = 10, 20
KEPT_MESSAGES = 20

# Lookup keys that go whole to every task; share of the entries among which bounds of the first ones are sought.
ASKED_ROWS, BOUND_SHARE = 1 << 18, 1 / 256

Fetch = Callable[[DataFrame], DataFrame]

_LOOKUP = ["lookup", "_a", "_b"]
# Names of a lineage entry in the order that ranks entries of one lookup, and its other columns, which break ties.
_NAMES = ("record_id", "source_table", "source_column", "target_table", "target_column", "transformation", "job_id")
_REST = ("lineage_id", "source_value", "target_value", "etl_commit_id")
_LOWERED = "_lowered"
_DETAILS = "map<string,array<string>>"


def intent(question: Column) -> Column:
    """The first intent one of whose phrases is in the question."""
    return _intent_of(F.lower(question))


def _intent_of(lowered: Column) -> Column:
    chosen = F.lit(OTHER_INTENT)
    for name, phrases in reversed(INTENT_PHRASES):
        chosen = F.when(reduce(or_, [lowered.contains(p) for p in phrases]), F.lit(name)).otherwise(chosen)
    return chosen


def _first_contained(text: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.when(text.contains(word), F.lit(word)) for word in words])


def with_entities(questions: DataFrame, text: str = "question", keep_lowered: bool = False) -> DataFrame:
    """Add ``record_id``, ``source_table``, ``source_column``, ``target_table`` and ``target_column``.

    A dotted reference names the source; known column and table names fill in what is still open.
    """
    question, lowered = F.col(text), F.col(_LOWERED)

    def found(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(question, pattern, group), F.lit(""))

    column, table = _first_contained(lowered, KNOWN_COLUMNS), _first_contained(lowered, KNOWN_TABLES)
    dotted = r"(?U)(\w+)\.(\w+)"
    # Columns that are read several times stand in projections of their own.
    words = questions.withColumn(_LOWERED, F.lower(text)).withColumns({"_column": column, "_table": table})
    return words.withColumns(
        {
            "record_id": found("(?i)POL-[0-9]{6}", 0),
            "source_table": F.coalesce(found(dotted, 1), F.concat(F.lit("db2_"), F.col("_table"))),
            "source_column": F.coalesce(found(dotted, 2), F.col("_column")),
            "target_table": F.concat(F.lit("fast_"), F.col("_table")),
            "target_column": F.col("_column"),
        }
    ).drop("_column", "_table", *([] if keep_lowered else [_LOWERED]))


def intent_counts(questions: DataFrame, text: str = "question") -> DataFrame:
    return questions.groupBy(intent(F.col(text)).alias("intent")).agg(F.count(F.lit(1)).alias("questions"))


def _with_lookup(questions: DataFrame, text: str) -> DataFrame:
    """Each question's intent, and what to look up for it (``none`` where there is nothing).

    The three lookup columns are never null: for nullable join keys Spark would infer filters, push
    them down, and evaluate all of this a second time.
    """
    known = with_entities(questions, text, keep_lowered=True).withColumn("intent", _intent_of(F.col(_LOWERED)))
    by_target = (F.col("intent") == "lineage_backward") & F.col("target_column").isNotNull()
    by_source = (F.col("intent") == "lineage_forward") & F.col("source_column").isNotNull()
    by_impact = (F.col("intent") == "impact") & F.col("source_column").isNotNull()
    kind = (
        F.when(by_target, F.lit("backward"))
        .when(by_source, F.lit("forward"))
        .when(by_impact, F.lit("impact"))
        .when(F.col("record_id").isNotNull(), F.lit("record"))
        .otherwise(F.lit("none"))
    )
    routed = known.withColumn("lookup", kind)

    def part(target: str, source: str, record: Column) -> Column:
        value = (
            F.when(F.col("lookup") == "backward", F.col(target))
            .when(F.col("lookup").isin("forward", "impact"), F.col(source))
            .when(F.col("lookup") == "record", record)
        )
        return F.coalesce(value, F.lit(""))

    return routed.select(
        *questions.columns,
        "intent",
        "lookup",
        part("target_table", "source_table", F.col("record_id")).alias("_a"),
        part("target_column", "source_column", F.lit("")).alias("_b"),
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first(entries: DataFrame, keep: int) -> DataFrame:
    """The first entries of every lookup key by their names, with their rank; every task cuts to them before the shuffle."""
    order = Window.partitionBy(*_LOOKUP).orderBy(*_NAMES)
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _entries(lineage: DataFrame, routed: DataFrame, by_column: int, by_record: int, fetch: Fetch | None) -> DataFrame:
    """The first entries of every lookup key that a question asks for, whole.

    Entries of other keys leave first, by a semi-join with the distinct keys asked for: up to ``ASKED_ROWS`` of them go to
    every task, so that entries stay where they are. What is left is ranked by its names alone; the values, which take the
    transforms where the lineage is not stored, are fetched for the first few only. Records that are asked for are fetched
    before they become entries.
    """
    asked = _written(routed.where(F.col("lookup").isin("backward", "forward", "record")).select(*_LOOKUP).distinct(), "asked")
    few = asked.count() <= ASKED_ROWS

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    def lookup(kind: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(kind).alias("lookup"), a.alias("_a"), b.alias("_b"))

    def wanted(entries: DataFrame, kinds: list[Column], names: tuple[str, ...]) -> DataFrame:
        keys = asked.where(F.col("lookup").isin(*names))
        return entries.select(*_NAMES, F.inline(F.array(*kinds))).join(small(keys), _LOOKUP, "left_semi")

    columns = [
        lookup("backward", F.col("target_table"), F.col("target_column")),
        lookup("forward", F.col("source_table"), F.col("source_column")),
    ]
    by_name = wanted(lineage, columns, ("backward", "forward"))
    # The last of the first few in any subset has no fewer before it in the whole: nothing after it can be chosen.
    bounds = _first(by_name.sample(BOUND_SHARE, seed=0), by_column).where(F.col("rank") == by_column)
    bounds = bounds.select(*_LOOKUP, F.struct(*_NAMES).alias("_bound"))
    by_name = by_name.join(small(bounds), _LOOKUP, "left").where(F.col("_bound").isNull() | (F.struct(*_NAMES) <= F.col("_bound")))

    records = asked.where(F.col("lookup") == "record").select(F.col("_a").alias("record_id"))
    by_id = wanted(fetch(records) if fetch else lineage, [lookup("record", F.col("record_id"), F.lit(""))], ("record",))
    found = _first(by_name.drop("_bound"), by_column).unionByName(_first(by_id, by_record))
    # A few rows per key asked for, read several times.
    chosen = _written(found.select(*_LOOKUP, *[F.col(c).alias(f"_{c}") for c in _NAMES]).distinct(), "chosen")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _NAMES]
    source = fetch(chosen.select(F.col("_record_id").alias("record_id"))) if fetch else lineage
    whole = source.select(*_NAMES, *_REST).join(chosen, reduce(and_, same)).drop(*[f"_{c}" for c in _NAMES])
    order = Window.partitionBy(*_LOOKUP).orderBy(*_NAMES, *_REST)
    keep = F.when(F.col("lookup") == "record", by_record).otherwise(by_column)
    return whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def question_context(
    questions: DataFrame,
    lineage: DataFrame,
    question_id: str = "question_id",
    text: str = "question",
    by_column: int = COLUMN_ENTRIES,
    by_record: int = RECORD_ENTRIES,
    fetch: Fetch | None = None,
) -> DataFrame:
    """The lineage each question asks for: up to ``by_column`` entries by column, up to ``by_record`` by
    record, or one impact row with its ``details`` (target table to its columns). Entries are whole. ``fetch`` gives
    the lineage of the records in a frame (``record_id``), where it is not stored and would cost all transforms otherwise.

    Questions that ask for nothing leave before the join. Many questions with one lookup make a
    large partition on the left side only, which AQE splits.
    """
    routed = _with_lookup(questions, text).where(F.col("lookup") != "none")
    entries = _entries(lineage, routed, by_column, by_record, fetch).withColumns(
        {
            "affected_tables": F.lit(None).cast("bigint"),
            "affected_columns": F.lit(None).cast("bigint"),
            "details": F.lit(None).cast(_DETAILS),
        }
    )
    effects = impacts(lineage).select(
        F.lit("impact").alias("lookup"),
        F.col("source_table").alias("_a"),
        F.col("source_column").alias("_b"),
        "source_table",
        "source_column",
        F.lit(1).alias("rank"),
        "affected_tables",
        "affected_columns",
        "details",
    )
    lookup = entries.unionByName(effects, allowMissingColumns=True)
    joined = routed.select(question_id, "intent", *_LOOKUP).join(lookup, _LOOKUP, "left")
    is_impact = F.col("lookup") == "impact"

    def or_none_found(name: str, value: Column) -> Column:
        return F.when(is_impact, F.coalesce(F.col(name), value)).otherwise(F.col(name)).alias(name)

    return joined.where(is_impact | F.col("rank").isNotNull()).select(
        question_id,
        "intent",
        "lookup",
        or_none_found("rank", F.lit(1)),
        "record_id",
        or_none_found("source_table", F.col("_a")),
        or_none_found("source_column", F.col("_b")),
        "target_table",
        "target_column",
        "transformation",
        or_none_found("affected_tables", F.lit(0)),
        or_none_found("affected_columns", F.lit(0)),
        "job_id",
        *_REST,
        or_none_found("details", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))),
    )


def trim_history(messages: DataFrame, session: str, order_by: list[str], keep: int = KEPT_MESSAGES) -> DataFrame:
    """The last ``keep`` messages of every session; each task cuts a session down before the shuffle."""
    newest = Window.partitionBy(session).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    numbered = messages.withColumn("_newest", F.row_number().over(newest))
    return numbered.where(F.col("_newest") <= keep).drop("_newest")
