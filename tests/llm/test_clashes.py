"""Operators over tables whose other columns are named as the operators' own."""

import pytest
from pyspark.sql import functions as F

from ferrytab.llm import jaccard, lines, mixing, passages

NAMES = ["_id", "_hash", "_gone", "_key", "_tag", "_first", "_bytes", "_source", "source_size", "_size", "_part", "_use", "_chunk", "_row",
         "_own", "_order", "n", "root", "size", "target", "times", "template", "a.b", "c0", "_ferrytab_extra"]
ROWS = [(i, f"line {i} of many words here\nPosted in news\n" + "same words again and again " * 6, "ab"[i % 2]) for i in range(12)]
ROWS += [(None, None, None), (3, "", "a"), (2, ROWS[2][1], "a")]


@pytest.fixture(scope="module")
def tables(session, frame):
    plain = frame(ROWS).drop("lang", "n_chars")
    wide = plain
    for i, name in enumerate(NAMES):
        wide = wide.withColumn(name, F.lit(i))
    return plain, wide.select(*[f"`{c}`" for c in (*NAMES[:3], *plain.columns, *NAMES[3:])])


OPERATORS = {
    "lines": lines.drop_template_lines,
    "mixing": mixing.repeat_documents,
    "jaccard": lambda docs: jaccard.keep_one_of_each(docs, 80, 5),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_pass_through(tables, name):
    plain, wide = tables
    got, want = OPERATORS[name](wide), OPERATORS[name](plain)
    assert got.columns[: len(wide.columns)] == wide.columns
    quoted = [f"`{c}`" for c in want.columns]
    assert sorted(map(str, got.select(*quoted).collect())) == sorted(map(str, want.collect()))
    for row in got.select(*[f"`{c}`" for c in NAMES]).collect():
        assert list(row) == list(range(len(NAMES)))


def test_passages_keep_columns_of_any_name(tables):
    plain, wide = tables
    keep = ["doc_id", *NAMES]
    got = passages.drop_repeats(wide, keep).collect()
    want = passages.drop_repeats(plain, ["doc_id"]).collect()
    assert sorted((str(r["doc_id"]), r["kept"], r["n_removed"]) for r in got) == sorted((str(r["doc_id"]), r["kept"], r["n_removed"]) for r in want)
    assert all([r[c] for c in NAMES] == list(range(len(NAMES))) for r in got)


def test_empty_tables(session, frame):
    for operator in OPERATORS.values():
        assert operator(frame([])).count() == 0
