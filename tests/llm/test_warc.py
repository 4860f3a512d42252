import gzip
import hashlib
import os
import random
from glob import glob

import pytest

from campaignlake.llm import queries, warc

from .util import SF

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) per page, plainly."""
    top = {}
    for i, _, html in rows:
        key = html or ""
        top[key] = max((x for x in (top.get(key), i) if x is not None), default=None)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and i != top[html or ""]
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
                    top[html or ""] if again else None))
    return sorted(out, key=str)


def odd_pages():
    long = "<p>" + "ü 🙂 same page " * 100 + "</p>"
    rows = [(i, f"http://Host.Example.COM:80{'/a' if i % 2 else ''}/x?q={i % 3}#f", long) for i in range(40)]
    rows += [(100, "https://u:p@a.b.c/", "short"), (101, "https://a.b.c", "short"), (102, None, None), (103, "", ""),
             (104, "no scheme/path", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
             (105, "http://x.y/a b\r\nWARC-Type: revisit", "é" * 499 + "\r\n"), (106, "http://x.y/ö", "é" * 500),
             (107, "http://x.y/", "é" * 500), (None, "http://x.y/", "é" * 500), (None, None, "z" * 2000),
             (108, "http://x.y/", "\r\n\r\n" * 400), (108, "http://x.y/", "\r\n\r\n" * 400),
             (109, "http://x.y/", "q" * 3_000_000), (-5, "http://x.y/", "q" * 3_000_000),
             (110, "http://x.y/", "\x00\x01 control"), (111, "http://x.y/", "n" * 999), (112, "http://x.y/", "n" * 999)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as digest", "1 as id", "'y' as payload").repartition(6)


def result(df):
    rows = df.orderBy("index_row").collect()
    assert [r["index_row"] for r in rows] == list(range(len(rows)))
    keys = [(r["url_key"].encode(), r["captured_at"], r["archive"], r["offset"]) for r in rows]
    assert keys == sorted(keys)
    return rows, sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                         for r in rows), key=str)


@pytest.mark.parametrize("sent", [100_000, 0])
def test_odd_pages(spark, tmp, monkeypatch, sent):
    monkeypatch.setattr(warc, "SENT_REVISITS", sent)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = odd_pages()
    got, digests = result(warc.capture_history(frame(spark, rows), f"{tmp}/w{sent}"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert digests == expected(rows)
    # Offsets and lengths find the records in the files; revisits hold no payload.
    for r in got:
        with gzip.open(f"{tmp}/w{sent}/{r['archive']}") as f:
            f.seek(r["offset"])
            record = f.read(r["length"])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        head, _, block = record.partition(b"\r\n\r\n")
        assert f"WARC-Type: {r['record_type']}".encode() in head
        body = block[:-4].partition(b"\r\n\r\n")[2]
        assert len(body) == (r["payload_bytes"] if r["record_type"] == "response" else 0)
    assert sum(os.path.getsize(p) for p in glob(f"{tmp}/w{sent}/*.gz")) > 0


def test_query_reads_all_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.op12_warc_capture_index(spark, SF).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)


def test_one_url_spreads_over_ranges(spark, tmp):
    rows = [(i, "http://hot.example/", f"page {i % 7}") for i in range(3000)]
    warc.write_archives(frame(spark, rows), tmp + "/w", at=warc.F.col("page_id") % 5)
    captures = warc.read_archives(spark, tmp + "/w")
    merged = warc.merge_runs(captures, range_captures=200)
    got, digests = result(merged)
    assert digests == expected(rows) and len({r["archive"] for r in got}) > 3


def test_empty_table(spark, tmp):
    assert warc.capture_history(frame(spark, []), f"{tmp}/none").collect() == []


def test_damaged_archives_are_errors():
    good = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-capture:1>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            b"WARC-Payload-Digest: sha1:" + hashlib.sha1(b"abc").hexdigest().encode() + b"\r\nContent-Length: 47\r\n\r\n"
            b"HTTP/1.1 200 OK\r\nX: y\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    assert [c[2:7] for c in warc.captures_of("a", gzip.compress(good) + gzip.compress(good))] == [
        (1, "response", None, hashlib.sha1(b"abc").hexdigest(), 3)] * 2
    for bad in (good[:-6], good[:40], good.replace(b"abc", b"abd"), b"x" + good, good.replace(b": 47", b": 46")):
        with pytest.raises(ValueError):
            warc.captures_of("a", gzip.compress(bad))


def test_loser_tree():
    rng = random.Random(2)
    for k in [0, 1, 2, 3, 5, 8, 13]:
        runs = [sorted(rng.randrange(100) for _ in range(rng.randrange(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://Www.Example.ORG:8080/A/b?q=1#top") == "org,example,www)/A/b?q=1"
    assert warc.url_key("https://user:pw@a.b") == "b,a)"
    assert warc.url_key("plain#x") == "plain" and warc.url_key("") == ""
