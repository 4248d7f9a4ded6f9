import hashlib

import pytest

from tidemill.llm import warc


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], "page_id bigint, url string, html string, payload_digest string")


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None and len(data) >= 100:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data)
        refers = None if refers == page_id else refers
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def rows_of():
    rows = [(i, f"http://www{i % 5}.example.org/{i % 11}", f"<p>{'page' * 30} {i % 40}</p>") for i in range(3, 200)]
    rows += [(300 + i, "https://hot.example.org/", "h" * 99) for i in range(30)] + [(400 + i, "https://hot.example.org/", "é" * 50) for i in range(30)]
    return rows + [(500, None, None), (501, "no url at all\r\n", ""), (502, "http://[bad", "x\r\n\r\ny" * 40), (503, "http://x.org:80", "x\r\n\r\ny" * 40),
                   (504, "http://é.org/ü?q=1#f", "z" * 500_000), (None, "http://x.org", "n" * 200), (None, None, "n" * 200), (None, "u", "é" * 50),
                   (3, "http://again.org", "same id " * 40), (3, "http://again.org", "same id " * 40)]


@pytest.mark.parametrize("block", [2, 256])
def test_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(warc, "BLOCK", block)
    rows = rows_of()
    pages = pages_of(spark, rows).repartition(4)
    archives = warc.archive_pages(pages)
    found = archives.read(archives.locate(pages), payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=repr) == brute(rows)
    texts = {(p, (h or "").encode()) for p, _, h in rows}
    assert all((r.page_id, bytes(r.payload)) in texts for r in found if r.record_type == "response")


def test_lookup_of_some_and_of_absent_keys(spark):
    pages = pages_of(spark, rows_of())
    archives = warc.archive_pages(pages)
    asked = spark.createDataFrame([("https://hot.example.org", 405), ("http://nowhere.org", 1), ("https://hot.example.org/", 9)], "url string, page_id bigint")
    (row,) = archives.read(archives.locate(asked)).collect()
    assert (row.page_id, row.record_type, row.refers_to) == (405, "revisit", 400)


def test_empty_table(spark):
    pages = pages_of(spark, rows_of()).limit(0)
    archives = warc.archive_pages(pages)
    assert archives.read(archives.locate(pages)).collect() == []


def test_url_keys():
    keys = {u: warc.url_key(u) for u in ("http://www.Example.org:80/a?b#c", "https://u:p@a.b.c", "https://x.org:8080/", None, "plain", "http://[bad")}
    assert list(keys.values()) == ["org,example,www)/a?b", "c,b,a)/", "org,x:8080)/", "", "plain", "http://[bad"]


def test_records_are_checked():
    good = warc.record(5, "http://x.org/a b\n", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.parsed(good)[:2] == (5, "response")
    with pytest.raises(ValueError):
        warc.parsed(warc.record(5, None, b"payload", "0" * 64, None))
