"""Line dedup with a log-template tree of fixed depth.

A line is parsed by its number of tokens and its leading tokens; below that leaf, variable fields are
generalised. Templates that recur across documents are dropped everywhere but in the first document.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytab.llm.common import landed, packed, unpacked_columns

#: Leading tokens that a line must share with a template.
DEPTH = 3
#: Parts of the tokens after them; one part at a time may be a variable field.
FIELDS = 3
#: Tokens after the leading ones that a line needs before a part of them may vary.
VARIABLE_FROM = 6
#: Templates with fewer constant tokens than this share do not count; a line as it stands always does.
LEAST_CONSTANT = 0.5
#: Documents in which a template must occur.
LEAST_DOCUMENTS = 5

WILD = b"<*>"


def line_templates(line: bytes) -> list[bytes]:
    """Templates of a line: its tokens as they stand, those with digits generalised, and these with one wild part.

    Tokens are runs of anything but ASCII white space; one that holds a digit is a variable field. Every
    line with a token has the first template, so that a line repeated word for word recurs whatever
    its length and its digits; a row of other numbers is no repeat of it.
    """
    tokens = line.split()
    n = len(tokens)
    if not n:
        return []
    exact = b" ".join(tokens)
    if line.translate(None, b"0123456789") != line:
        tokens = [WILD if t.translate(None, b"0123456789") != t else t for t in tokens]
    rest = n - DEPTH
    found = [tokens]
    if rest >= VARIABLE_FROM:
        cuts = [DEPTH + rest * k // FIELDS for k in range(FIELDS + 1)]
        found += [tokens[:a] + [WILD] * (b - a) + tokens[b:] for a, b in zip(cuts, cuts[1:])]
    return list(dict.fromkeys([exact, *(b" ".join(t) for t in found if n - t.count(WILD) >= LEAST_CONSTANT * n)]))


def _digests(line: bytes) -> list[int]:
    from hashlib import blake2b

    return [int.from_bytes(blake2b(t, digest_size=8).digest(), "little", signed=True) for t in line_templates(line)]


def template_uses(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``line``, ``template``, ``new``) of every line; templates are 64-bit hashes.

    ``new`` marks the first line of a document with the template. Null text has no lines.
    """

    def parse(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known: dict[bytes, list[int]] = {}
        for batch in batches:
            ids, lines, templates, new = [], [], [], []
            texts = batch.column(2)
            for i in range(batch.num_rows):
                text, met = texts[i].as_py(), set()
                for number, line in enumerate(text.split(b"\n") if text else ()):
                    found = known.get(line)
                    if found is None:
                        found = _digests(line)
                        if len(line) < 200:
                            if len(known) >= 50_000:
                                known.clear()
                            known[line] = found
                    for template in found:
                        ids.append(i)
                        lines.append(number)
                        templates.append(template)
                        new.append(template not in met)
                        met.add(template)
                if len(ids) > 100_000 or i == batch.num_rows - 1:
                    at = pa.array(np.array(ids, np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(lines, pa.int32()),
                         pa.array(templates, pa.int64()), pa.array(new, pa.bool_())],
                        ["doc_id", "text_hash", "line", "template", "new"],
                    )
                    ids, lines, templates, new = [], [], [], []

    slim = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary"))
    return slim.mapInArrow(parse, "doc_id long, text_hash long, line int, template long, new boolean")


@F.arrow_udf(T.StringType())
def _without_lines(texts, dropped):
    import pyarrow as pa

    out = []
    for text, lines in zip(texts, dropped):
        text, gone = text.as_py(), lines.as_py()
        if text is not None and gone:
            gone = set(gone)
            text = "\n".join([line for i, line in enumerate(text.split("\n")) if i not in gone])
        out.append(text)
    return pa.array(out, pa.string())


def drop_template_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` with lines of recurring templates taken out of ``text``, and ``n_lines``, ``n_dropped``.

    A template recurs if it occurs in ``least_documents`` documents; the document with the smallest
    doc_id (null last) keeps its lines, the others lose theirs. Documents are rows: rows that repeat a
    doc_id count, but none of those under the first id loses a line. Lines end at ``\\n``. Null text
    stays null and has no lines; a text without recurring lines is unchanged. Columns of ``docs`` may
    have any names but ``n_lines`` and ``n_dropped``, which are replaced.

    A template's documents are counted from one row per document and by partial aggregates, so a line
    in a third of all documents costs one row per task; the join that marks its uses may split it.
    Lines to drop are gathered per document, which is no larger than the document.
    """
    whole = docs.drop("n_lines", "n_dropped")
    docs = packed(whole, ["doc_id", "text"])
    uses = landed(template_uses(docs), "line-templates")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    recurring = (
        uses.groupBy("template")
        .agg(F.sum(F.col("new").cast("long")).alias("n"), F.min(place).alias("first"))
        .where(F.col("n") >= least_documents)
        .select("template", "first")
    )
    dropped = (
        uses.join(recurring, "template")
        .where(place > F.col("first"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set("line").alias("_gone"))
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    lines = F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 0).otherwise(F.size(F.split("text", "\n", -1)))
    gone = F.coalesce(F.col("_gone"), F.array().cast("array<int>"))
    out = docs.join(dropped, same, "left").withColumn("n_lines", lines.cast("long"))
    out = out.withColumn("n_dropped", F.size(gone).cast("long")).withColumn("text", _without_lines("text", gone))
    return out.select(*unpacked_columns(whole, ["doc_id", "text"]), "n_lines", "n_dropped")
