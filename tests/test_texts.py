"""Rule texts, mappings that hold them, and search over documents."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ferrytab.functions.expressions import RuleError, compile_rule
from ferrytab.operators.mapping import EntityMapping, FieldMapping, map_entity, mapping_rows, read_mapping
from ferrytab.operators.rules import validation_failures, validation_report
from ferrytab.operators.search import search_text, text_index

ROW = {"value": " Ab ", "amount": 12.5, "count": 7, "gone": None, "code": "x1"}
TEXTS = {
    "upper(strip(value))": "AB",
    "len(value) == 4 and not count > 7": True,
    "0 < amount <= 12.5": True,
    "count % 4 + 2 * 3 - 1": 8,
    "amount / 0": None,
    "gone is None and code is not None": True,
    "code in ['x1', 'y'] or gone == 1": True,
    "count not in (1, 2, -7)": True,
    "matches(code, '^[a-z][0-9]$')": True,
    "concat(code, '-', str(count))": "x1-7",
    "coalesce(gone, 5) >= 5": True,
    "round(float('2.346'), 2)": 2.35,
    "int('x') is None": True,
    "replace(code, 'x', '') == '1' and substr(code, 1, 1) == 'x'": True,
    "abs(-count) == 7": True,
    "gone > 1": None,
}


def test_rule_texts(spark):
    row = spark.createDataFrame([tuple(ROW.values())], "value string, amount double, count int, gone int, code string")
    names = {c: F.col(c) for c in ROW}
    found = row.select(*[compile_rule(text, names.get).alias(f"c{i}") for i, text in enumerate(TEXTS)]).first()
    assert list(found) == list(TEXTS.values())


@pytest.mark.parametrize(
    "text",
    ["other > 1", "eval('1')", "value.upper()", "__import__('os')", "[x for x in value]", "value[0]", "lambda: 1", "a b", "", "value is 1",
     "value in code", "len(value, value)", "upper(x=value)", "matches(value, code)", "(1, 2)", "f'{value}'", "value if count else 1", "value ** 2", "b'x'"],
)
def test_what_is_refused(text):
    with pytest.raises(RuleError):
        compile_rule(text, {c: F.lit(1) for c in ROW}.get)


MAPPING = EntityMapping(
    "things", "old", "new",
    (
        FieldMapping("ID", "key", is_key=True, rule="value is not None"),
        FieldMapping("AMT", "cents", "float(value) * 100", target_type="int", default="0", rule="value > low"),
        FieldMapping("LOW", "low", target_type="int"),
        FieldMapping("NAME", "name", "concat(name, '/', id)"),
    ),
)


def test_a_mapping_with_texts(spark):
    mapping = read_mapping(mapping_rows(spark, MAPPING), "things", "new")
    assert mapping == MAPPING
    rows = spark.createDataFrame([("a", "1.5", "10", "n"), ("b", "x", "1", None), (None, "2", "900", "z")], "id string, amt string, low string, name string")
    mapped = map_entity(rows, mapping)
    assert mapped.dtypes == [("key", "string"), ("cents", "int"), ("low", "int"), ("name", "string")]
    assert [tuple(r) for r in mapped.collect()] == [("a", 150, 10, "n/a"), ("b", 0, 1, None), (None, 200, 900, None)]
    rules = mapping.stored_rules()
    failed = {(r["rule_name"], r["actual"], r["expected"]) for r in validation_failures(mapped, rules, "key").collect()}
    assert failed == {("key_rule", "None", "value is not None"), ("cents_rule", "0", "value > low"), ("cents_rule", "200", "value > low")}
    assert validation_report(mapped, rules).first()["critical_failures"] == 3


def test_a_mapping_with_texts_that_are_refused(spark):
    rows = spark.createDataFrame([("a",)], "id string")
    with pytest.raises(ValueError, match="Unknown transform"):
        map_entity(rows, EntityMapping("e", "s", "t", (FieldMapping("ID", "k", "no_such"),)))
    with pytest.raises(RuleError, match="Unknown name other"):
        map_entity(rows, EntityMapping("e", "s", "t", (FieldMapping("ID", "k", "other + 1"),)))
    with pytest.raises(RuleError, match="Unknown name other"):
        EntityMapping("e", "s", "t", (FieldMapping("ID", "k", rule="other > 1"),)).stored_rules()


def bm25(documents, question, keep):
    texts = [re.findall("[a-z0-9]+", d.lower()) for d in documents]
    mean = sum(map(len, texts)) / len(texts)
    out = []
    for document, words in zip(documents, texts):
        score = 0.0
        for term in set(re.findall("[a-z0-9]+", question.lower())):
            n, f = sum(term in t for t in texts), Counter(words)[term]
            if f:
                score += math.log(1 + (len(texts) - n + 0.5) / (n + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(words) / mean))
        if score:
            out.append((-round(score, 9), document))
    return [(d, -s) for s, d in sorted(out)[:keep]]


def test_search(spark):
    documents = ["premium amount of policies", "policies, policies and claims", "Claim_Amount: of claims", "nothing here", "status", "premium amount of claims " * 3]
    rows = [(d,) for d in documents for _ in range(3)] + [(None,), ("!!",)]
    index = text_index(spark.createDataFrame(rows, "document string"))
    questions = ["Where does premium_amount come from?", "claims or POLICIES", "of of of", "unknown words", "", None, "claims or POLICIES"]
    asked = spark.createDataFrame(list(enumerate(questions)), "question_id long, question string")
    found = search_text(asked, index, keep=2).orderBy("question_id", "rank").collect()
    want = [(i, d, s) for i, q in enumerate(questions) for d, s in bm25([*documents, "!!"], q or "", 2)]
    assert [(r["question_id"], r["document"]) for r in found] == [(i, d) for i, d, _ in want]
    assert all(abs(r["score"] - s) < 1e-8 and r["entries"] == 3 for r, (_, _, s) in zip(found, want))
    assert search_text(asked, text_index(spark.createDataFrame([], "document string"))).count() == 0
