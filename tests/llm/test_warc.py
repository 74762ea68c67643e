import hashlib

import pytest
from pyspark.sql import functions as F

from cohortforge.llm import warc

PAGES = "page_id long, url string, html string"


def brute(rows):
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        target = last.get(html or "")
        target = target if len(payload) >= warc.LEAST and target is not None and page != target else None
        kind = "response" if target is None else "revisit"
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), kind, target))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a.example.com/x", "é" * 600), (2, "https://A.example.com:443/x#f", "é" * 600), (3, None, "é" * 600),
    (4, "not a url\nX: y", "short"), (5, "http://b.example.org", "short"), (6, "http://[bad", None), (7, "", ""),
    (None, "http://a.example.com/x", "é" * 600), (8, "http://a.example.com/x", "z" * 300_000), (9, "u", "y" * 1000),
    (9, "u", "y" * 1000), (10, "u", "y" * 999), (11, "u", "y" * 999), (None, "n", "q" * 2000), (None, "n", "q" * 2000),
    (12, "http://a.example.com/y", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n" * 50),
]


def test_edges_and_extra_columns(spark):
    pages = spark.createDataFrame(ROWS, PAGES)
    for name in ("digest", "key", "last", "n", "path", "refers_to"):
        pages = pages.withColumn(name, F.lit("mine"))
    assert sorted(map(tuple, warc.write_and_read(pages).collect()), key=str) == brute(ROWS)
    assert warc.write_and_read(pages.limit(0)).collect() == []


def test_lookup_by_url(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 3)
    rows = [(k, f"http://h{k % 40}.example.com/p?q={k % 90}", f"page {k} " * 20) for k in range(400)]
    rows += [(1000 + k, "http://hot.example.com/", f"hot {k}") for k in range(30)]
    manifest = warc.index(warc.write(spark.createDataFrame(rows, PAGES).repartition(5)))
    for url in {r[1] for r in rows[:60]} | {"http://hot.example.com/"}:
        wanted = sorted(html for _, u, html in rows if u == url)
        records = warc.lookup(manifest, url)
        assert sorted(payload.decode() for _, payload in records) == wanted
        assert all(warc.surt(h["WARC-Target-URI"]) == warc.surt(url) for h, _ in records)
    assert warc.lookup(manifest, "http://none.example.com/") == []


def test_keys_and_records():
    assert warc.surt("HTTP://user@www.Example.COM:80/a/b?c=d#e") == "com,example,www)/a/b?c=d"
    assert warc.surt("https://example.com:8443") == "com,example:8443)/"
    assert [warc.surt(x) for x in (None, "", "plain text", "http://[bad")] == ["", "", "plain text", "http://[bad"]
    sha1 = hashlib.sha1(b"body").digest()
    headers, payload = warc.parse(warc.compressed(warc.record(4, "http://x/", b"body", sha1, None)))
    assert payload == b"body" and warc.page_of(headers["WARC-Record-ID"]) == 4
    headers, payload = warc.parse(warc.compressed(warc.record(5, "http://x/", b"body", sha1, 4)))
    assert payload == b"" and headers["WARC-Refers-To"] == "<urn:page:4>" and headers["WARC-Payload-Length"] == "4"
    with pytest.raises(ValueError):
        warc.parse(warc.compressed(warc.record(4, "http://x/", b"other", sha1, None)))
