import base64
import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from ferrytab.llm import urls, warc
from ferrytab.llm.graph import components
from ferrytab.llm.queries import QUERIES, URL_RULES

SCHEMA = "page_id long, url string, html string"


def judged(session, rows, edges=None):
    pages = session.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("clash")).withColumn("own", F.lit("x"))
    found = urls.filter_urls(pages, URL_RULES, edges).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}


def test_rules_and_parts_of_urls(session):
    rows = [
        (1, "HTTP://A.Example.ORG/es/x?q#f", None), (2, "http://example.org/en/12", ""), (3, "x://b.com/fr/", "x"),
        (4, "https://b.com/de/a", "x"), (5, "no scheme", "x"), (6, None, "x"), (7, "http://net", "x"),
        (8, "a?u=http://b.com/de/", "x"), (9, "http://notexample.org/es/", "x"), (10, "http://com?x=/de/", "x"),
    ]
    assert judged(session, rows) == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("b.com", "/fr/", "com/fr/", "allow"), 4: ("b.com", "/de/a", "com/de/", "block"), 5: ("", "", None, "allow"),
        6: ("", "", None, "allow"), 7: ("net", "", None, "allow"), 8: ("b.com", "/de/", "com/de/", "block"),
        9: ("notexample.org", "/es/", "org/", "allow"), 10: ("com", "", None, "allow"),
    }
    assert judged(session, []) == {}


def test_decisions_reach_aliases(session):
    link = '<html><link rel="canonical" href="{}">'
    rows = [
        (1, "http://a.net/1", link.format("http://b.com/de/x")),
        (2, "http://a.net/2", '<meta http-equiv="refresh" content="0; url=/1">'),
        (3, "http://c.net/", link.format("//d.net/y")), (4, "https://d.net/y#top", link.format("http://b.com/de/z")),
        (5, "http://e.net/", link.format("http://d.org/")), (6, "http://f.net/", link.format("http://e.net/")),
        (7, "http://d.org/", link.format("http://b.com/de/q")), (8, "http://b.com/de/q", ""), (9, "http://g.net/a/b", link.format("c")),
    ]
    verdicts = {k: v[3] for k, v in judged(session, rows).items()}
    # 5, 6 and 7 share a component with a blocked page, but 7 is allowed by a rule of its own.
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow"}
    more = session.createDataFrame([("g.net/a/c", "b.com/de/r")], "node string, alias string")
    assert judged(session, rows, more)[9][3] == "block"


def test_components_of_chains_and_a_hub(session):
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(300)]
    hub = [(f"h{i}", "hub") for i in range(500)] + [("loop", "loop")]
    edges = session.createDataFrame(chain + hub, "node string, alias string")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert {roots[a] for pair in chain for a in pair} == {"c0000"}
    assert {roots[a] for pair in hub[:-1] for a in pair} == {"h0"} and "loop" not in roots


def test_url_query_is_native(session, sf_dir):
    plan = QUERIES["op9_url_filters"](session, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def expected(rows):
    first = {}
    for key, _, html in rows:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        lead = first.get(html or "")
        again = lead is not None and lead != key
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "revisit" if again else "response", lead if again else None))
    return sorted(out, key=str)


def round_trip(session, rows, dictionary, **options):
    pages = session.createDataFrame(rows, SCHEMA).withColumn("size", F.lit(1))
    read = warc.read_archives(warc.write_archives(pages, dictionary, **options)).collect()
    for r in read:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
    return read


def facts(read):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in read), key=str)


def test_archives_round_trip(session):
    rows = [(i, f"http://x/{i}", f"<html>{i % 7} some shared words of a page" * 3) for i in range(60)]
    rows += [(100, "http://long/", "é" * 400_000), (101, None, None), (102, "a\r\nb", ""), (None, "http://n/", None), (5, "http://x/5", rows[5][2])]
    dictionary = warc.train_dictionary(session.createDataFrame(rows, SCHEMA))
    read = round_trip(session, rows, dictionary)
    assert facts(read) == expected(rows)
    kept = {r["page_id"]: r["payload"].decode() for r in read if r["record_type"] == "response"}
    assert kept[100] == "é" * 400_000 and kept[3] == rows[3][2]
    small = round_trip(session, rows, b"", min_bytes=10**9)
    assert {r["record_type"] for r in small} == {"response"}
    assert round_trip(session, [], b"") == []


def test_broken_archives_are_refused():
    record = warc.record_bytes(1, "http://x/", b"body", hashlib.sha1(b"body").hexdigest(), 4, 1, "2000-01-01T00:00:00Z")
    frame = zstandard.ZstdCompressor().compress(record)
    lead = warc.SKIPPABLE + bytes(4)
    assert [warc.parse_record(d)["payload"] for _, d in warc.frames(lead + frame + frame)] == [b"body"] * 2
    for content in (frame, lead + frame[:-3], lead + b"junk" + frame, warc.SKIPPABLE + b"\xff\x00\x00\x00" + frame):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(content))
    for bad in (record[:-1], record.replace(b"WARC-Date", b"WARC-Dote"), record.replace(b"body", b"boby"), b"WARC/9" + record[8:]):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_compressed_dictionary_frame(session):
    rows = [(i, "u", f"<html>{i} many words that come again and again {i * 7}" * 5) for i in range(40)]
    dictionary = warc.train_dictionary(session.createDataFrame(rows, SCHEMA), 2_048)
    if dictionary:
        squeezed = zstandard.ZstdCompressor().compress(dictionary)
        content = warc.SKIPPABLE + len(squeezed).to_bytes(4, "little") + squeezed
        known = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        assert [d for _, d in warc.frames(content + known.compress(b"some record"))] == [b"some record"]


def test_warc_query(session, sf_dir):
    rows = [tuple(r) for r in session.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, QUERIES["op10_warc"](session, sf_dir).collect()), key=str) == expected(rows)
