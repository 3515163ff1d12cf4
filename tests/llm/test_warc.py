"""WARC archives against the pages they were written from; the merge against sorting."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadmill.llm import warc as W

PAGES = "page_id long, url string, html string, extra int, run string, seq int"


def rows():
    rng = random.Random(3)
    out = [(i, f"http://www.h{rng.randrange(5)}.example.com/p{rng.randrange(9)}?b=1&a={i % 3}", f"page {i % 40}") for i in range(200)]
    out += [(1000 + i, "http://hot.example/", "the same page") for i in range(90)]  # one payload and URL of a third of all rows
    out += [(2000, None, None), (2001, "", ""), (2002, "http://[bad", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n")]
    out += [(2003, "http://e.example/ä b\r\nX: y", "ä€😀" * 50_000), (2004, "HTTPS://Sub.E.example:443/A#frag", "\r\n\r\n")]
    out += [(None, "http://n.example/", "no id"), (None, "http://n.example/", "the same page"), (1089, "http://again.example/", "the same page")]
    out += [(3000, "http://t.example/", "twice"), (3000, "http://t.example/", "twice")]
    return [(i, u, h, 7, "r", 1) for i, u, h in out]


def brute(data, min_bytes=0):
    winner = {}
    for i, _, h, *_ in data:
        winner.setdefault(h or "", []).append(i)
    out = []
    for i, _, h, *_ in data:
        b = (h or "").encode()
        ids = [x for x in winner[h or ""] if x is not None]
        best = max(ids) if ids else None
        revisit = len(b) >= min_bytes and i != best
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), digest, "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("min_bytes,archive", [(0, 1 << 20), (8, 2000)])
def test_round_trip(spark, monkeypatch, min_bytes, archive):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", archive)
    pages = spark.createDataFrame(rows(), PAGES).repartition(3)
    got = W.archive_index(pages, F.timestamp_seconds("page_id"), min_bytes=min_bytes).collect()
    assert sorted((tuple(r[f] for f in FIELDS) for r in got), key=repr) == brute(rows(), min_bytes)
    got.sort(key=lambda r: (r.range, r.position))
    keys = [(r.url_key, r.captured, W._low(r.page_id)) for r in got]
    assert keys == sorted(keys)
    hot = [r.page_id for r in got if r.url_key == "example,hot)/"]
    assert hot == list(range(1000, 1090))


def test_ranges_and_hot_url(spark, monkeypatch):
    """Small ranges cut a hot URL; the order holds across them."""
    monkeypatch.setattr(W, "RANGE_ROWS", 40)
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 500)
    pages = spark.createDataFrame(rows(), PAGES).repartition(4)
    got = W.archive_index(pages, F.lit("2020-02-03 04:05:06").cast("timestamp")).collect()
    got.sort(key=lambda r: (r.range, r.position))
    assert len({r.range for r in got if r.url_key == "example,hot)/"}) > 1
    assert len({r.run for r in got}) > 20
    keys = [(r.url_key, r.captured, W._low(r.page_id), r.run, r.seq) for r in got]
    assert keys == sorted(keys) and {r.captured for r in got} == {"20200203040506"}


def test_empty_table(spark):
    assert W.archive_index(spark.createDataFrame([], PAGES), F.lit(None)).count() == 0


def test_offsets_point_at_members(spark, tmp_path):
    pages = spark.createDataFrame(rows(), PAGES).coalesce(1)
    path = str(tmp_path / "w")
    W.write_archives(pages, path, F.timestamp_seconds(F.lit(5)))
    files = {f.name: f.read_bytes() for f in (tmp_path / "w").glob("part-*")}
    assert all(gzip.decompress(f).startswith(W.VERSION) for f in files.values())  # plain gzip tools read them
    for r in W.read_archives(spark, path).collect():
        record = gzip.decompress(files[r.run][r.offset : r.offset + r.length])
        assert f"<urn:page:{'' if r.page_id is None else r.page_id}>".encode() in record


def test_damage_is_found():
    one = gzip.compress(W._record(1, "http://x/", "2020-01-01T00:00:00Z", hashlib.sha1(b"abc").digest(), 3, b"abc", None))
    assert W.parse_archive(one + W.NOTHING)[0]["payload_bytes"] == 3
    wrong = gzip.compress(W._record(1, "http://x/", "2020-01-01T00:00:00Z", hashlib.sha1(b"abd").digest(), 3, b"abc", None))
    for bad in (wrong, one[:-9], b"junk" + one, gzip.compress(b"junk")):
        with pytest.raises(ValueError):
            W.parse_archive(bad)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16, 33])
def test_loser_tree(k):
    rng = random.Random(k)
    keys, starts, ends = [], [], []
    for _ in range(k):
        run = sorted(rng.randrange(30) for _ in range(rng.choice([0, 1, 5, 40])))
        starts.append(len(keys))
        keys += run
        ends.append(len(keys))
    assert W.merge_order(keys, starts, ends) == sorted(range(len(keys)), key=lambda i: (keys[i], i))


def test_url_key():
    assert W.url_key("http://www2.Example.com:80/A?b=2&a=1#x") == "com,example)/a?a=1&b=2"
    assert W.url_key("https://example.com:8443") == "com,example:8443)/"
    assert W.url_key(None) == W.url_key("") == ""
