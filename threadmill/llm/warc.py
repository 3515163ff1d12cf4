"""WARC archives of captured pages and one ordered index of all captures.

``write_archives`` writes one WARC/1.1 record a row. Rows with equal payloads
(SHA-256) of at least ``min_bytes`` bytes are stored once: the row with the
largest page_id is a response record, the others are revisit records that refer
to it and hold headers only. Only payloads of possible responses are shuffled, by
(payload, page_id), so a payload that a third of all rows share is spread over
its page_ids; the payload's winner is a partial aggregate. Tasks pack records,
one gzip member each as usual, into archives of about ``ARCHIVE_BYTES``; Spark's
text writer writes one file an archive (its line end is an empty gzip member), so
a lost task leaves nothing half written. Offset and length of a capture are those
of its member in the file.

``read_archives`` reads the files member by member and each record by the lengths
in its headers, recomputes the digest of every response, and raises where a
record is cut or a digest is wrong. The captures of each archive come back as one run, sorted by URL key
(host reversed, as in SURT), capture time and page_id.

``merge_runs`` merges these runs externally: runs are stored, cut at global
ranges of (URL key, time, page_id, archive, position), and each range merges its
pieces of all runs with a loser tree of k leaves, log2 k comparisons a capture.
A range holds about ``RANGE_ROWS`` captures; the last parts of its key are
unique, so a hot URL is cut too. Output partitions in order, and the rows of
each, are the capture histories of all URLs.

Defined results: a null payload is empty; a null or empty URL has no target
header and the empty key; control and non-ASCII characters of a URL are
percent-encoded in UTF-8; a null time is 1970-01-01; a null page_id is below all
others and null again when read; rows that repeat the page_id and payload of a
response are responses too; an empty table gives no captures.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm.common import stored
from threadmill.session import scratch_path

#: Bytes of an archive before the next one is begun (one record at least).
ARCHIVE_BYTES = 16 << 20
#: Bytes decompressed at once when an archive is read.
READ_BYTES = 1 << 16
#: Captures a merge task is meant to hold.
RANGE_ROWS = 1 << 17
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: A gzip member without content.
NOTHING = gzip.compress(b"", mtime=0)

CAPTURES = (
    "run string, seq int, url_key string, captured string, url string, page_id long, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, offset long, length long"
)
ORDER = ["url_key", "captured", "page_id", "run", "seq"]


def url_key(url: str | None) -> str:
    """Sort key of a URL: host reversed by commas, no scheme, www, default port
    or fragment, lower case, query arguments sorted."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = u.hostname or "", u.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    at = ",".join(reversed(host.split(".")))
    if port and (u.scheme, port) not in (("http", 80), ("https", 443)):
        at += f":{port}"
    query = "&".join(sorted(u.query.split("&")))
    return f"{at}){u.path or '/'}{'?' + query if query else ''}".lower()


def _record(page_id, url, date, digest: bytes, n: int, payload: bytes | None, refers_to) -> bytes:
    """One record; ``payload`` None is a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n
    head = [VERSION.decode(), f"WARC-Type: {'response' if payload is not None else 'revisit'}"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    head.append(f"WARC-Date: {date}")
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}")
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = http + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return ("\r\n".join(head) + END).encode("ascii") + body + END.encode()


def _pack(budget: int):
    def run(batches):
        held: list[bytes] = []
        size = 0

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.large_binary())], ["value"])

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("page_id", "url", "date", "sha1", "n", "payload", "refers_to")]
            for page_id, url, date, sha1, n, payload, refers_to in zip(*cols):
                one = gzip.compress(_record(page_id, url, date, bytes.fromhex(sha1), n, payload, refers_to), mtime=0)
                if held and size + len(one) > budget:
                    yield archive()
                    held, size = [], 0
                held.append(one)
                size += len(one)
        if held:
            yield archive()

    return run


def write_archives(
    pages: DataFrame, path: str, captured: Column, payload: str = "html", min_bytes: int = 0
) -> None:
    """Write ``pages`` (page_id, url, ``payload``) as WARC files below ``path``."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    time = F.coalesce(captured.cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        body.alias("payload"),
    ).withColumns({"sha1": F.sha1("payload"), "sha2": F.sha2("payload", 256), "n": F.octet_length("payload").cast("long")})
    narrow = stored(keyed.drop("payload"), "captures_without_payload")
    winners = narrow.where(F.col("n") >= min_bytes).groupBy("sha2").agg(F.max("page_id").alias("winner"))
    winners = stored(winners, "responses").withColumnRenamed("sha2", "same")
    fields = ["page_id", "url", "date", "sha1", "n"]
    is_winner = (F.col("sha2") == F.col("same")) & F.col("page_id").eqNullSafe(F.col("winner"))
    none = F.lit(None)
    responses = keyed.where(F.col("n") >= min_bytes).join(winners, is_winner, "left_semi")
    responses = responses.union(keyed.where(F.col("n") < min_bytes))
    revisits = narrow.where(F.col("n") >= min_bytes).join(winners, F.col("sha2") == F.col("same"))
    revisits = revisits.where(~F.col("page_id").eqNullSafe(F.col("winner")))
    records = responses.select(*fields, "payload", none.cast("long").alias("refers_to")).union(
        revisits.select(*fields, none.cast("binary").alias("payload"), F.col("winner").alias("refers_to"))
    )
    archives = records.mapInArrow(_pack(ARCHIVE_BYTES), "value binary").select(F.col("value").cast("string"))
    files = archives.write.option("encoding", "ISO-8859-1").option("lineSep", NOTHING.decode("latin-1"))
    files.option("maxRecordsPerFile", 1).text(path)


def _page_id(urn: str) -> int | None:
    n = urn[len("<urn:page:") : -1]
    return int(n) if n else None


def members(data: bytes, name: str = "") -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a file."""
    at, view = 0, memoryview(data)
    while at < len(data):
        unzip, out, end = zlib.decompressobj(31), [], at
        while not unzip.eof:
            if end >= len(data):
                raise ValueError(f"{name}: the record at byte {at} is cut")
            try:
                out.append(unzip.decompress(view[end : end + READ_BYTES]))
            except zlib.error as e:
                raise ValueError(f"{name}: no record at byte {at}") from e
            end = min(end + READ_BYTES, len(data)) - len(unzip.unused_data)
        yield at, end - at, b"".join(out)
        at = end


def parse_archive(data: bytes, name: str = "") -> list[dict]:
    """The captures of one archive, in the order of its records."""
    out = []
    for at, length, record in members(data, name):
        if not record:
            continue
        body = record.find(END.encode()) + len(END)
        head = record[: max(body - len(END), 0)].split(b"\r\n")
        if head[0] != VERSION:
            raise ValueError(f"{name}: no record at byte {at}")
        h = dict(line.decode("ascii").split(": ", 1) for line in head[1:])
        stop = body + int(h["Content-Length"])
        if record[stop:] != END.encode():
            raise ValueError(f"{name}: the record at byte {at} is cut")
        inner = record.index(END.encode(), body, stop) + len(END)
        http = dict(line.decode("latin-1").split(": ", 1) for line in record[body:inner].strip().split(b"\r\n")[1:])
        n, digest = int(http["Content-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:")
        if h["WARC-Type"] == "response":
            got = base64.b32encode(hashlib.sha1(memoryview(record)[inner:stop]).digest()).decode()
            if stop - inner != n or got != digest:
                raise ValueError(f"{name}: the payload at byte {at} is not the one written")
        url = h.get("WARC-Target-URI")
        out.append(
            {
                "url_key": url_key(url),
                "captured": re.sub(r"\D", "", h["WARC-Date"]),
                "url": url,
                "page_id": _page_id(h["WARC-Record-ID"]),
                "record_type": h["WARC-Type"],
                "refers_to": _page_id(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None,
                "payload_bytes": n,
                "payload_digest": digest,
                "offset": at,
                "length": length,
            }
        )
    return out


def _low(page_id: int | None) -> tuple:
    return (page_id is not None, page_id or 0)


def _parsed(schema: pa.Schema):
    def run(batches):
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content")):
                name = path.rsplit("/", 1)[-1]
                rows = parse_archive(data.as_py(), name)
                rows.sort(key=lambda r: (r["url_key"], r["captured"], _low(r["page_id"]), r["offset"]))
                for i, r in enumerate(rows):
                    r |= {"run": name, "seq": i}
                yield from pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=10_000)

    return run


ARROW_CAPTURES = pa.schema(
    [
        (c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]])
        for c in CAPTURES.split(", ")
    ]
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``: one sorted run an archive."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_parsed(ARROW_CAPTURES), CAPTURES)


def merge_order(keys: list, starts: list[int], ends: list[int]) -> list[int]:
    """Indexes of ``keys`` in sorted order, by a loser tree over the sorted runs
    [starts[i], ends[i]); equal keys go to the earlier run."""
    k = len(starts)
    at = list(starts)

    def before(a: int, b: int) -> bool:
        if at[a] == ends[a] or at[b] == ends[b]:
            return at[a] != ends[a]
        x, y = keys[at[a]], keys[at[b]]
        return x < y or (x == y and a < b)

    losers = [-1] * max(k, 1)  # losers[0] is the winner
    for leaf in range(k):
        node, who = (leaf + k) // 2, leaf
        while node > 0:
            if losers[node] < 0:  # wait here for the other side
                losers[node], who = who, -1
                break
            if before(losers[node], who):
                losers[node], who = who, losers[node]
            node //= 2
        if who >= 0:
            losers[0] = who
    out = []
    for _ in range(sum(ends) - sum(starts)):
        who = losers[0]
        out.append(at[who])
        at[who] += 1
        node = (who + k) // 2
        while node > 0:
            if before(losers[node], who):
                losers[node], who = who, losers[node]
            node //= 2
        losers[0] = who
    return out


def _merged(batches):
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()  # sorted by (run, seq)
    run = pc.run_end_encode(t["run"].combine_chunks())
    ends = run.run_ends.to_pylist()
    starts = [0, *ends[:-1]]
    cols = [t[c].to_pylist() for c in ("url_key", "captured", "page_id", "run", "seq")]
    keys = [(u, c, _low(p), r, s) for u, c, p, r, s in zip(*cols)]
    order = merge_order(keys, starts, ends)
    t = t.take(pa.array(order, pa.int64()))
    part = np.full(t.num_rows, TaskContext.get().partitionId(), np.int32)
    t = t.append_column("range", pa.array(part)).append_column("position", pa.array(np.arange(t.num_rows)))
    yield from t.to_batches(max_chunksize=10_000)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in the order of URL key, time and page_id: by ``range``, then
    ``position``. ``runs`` is read twice; store it first."""
    n = runs.count()
    least = min(runs.sparkSession.sparkContext.defaultParallelism, -(-n // 4096))
    ranges = runs.repartitionByRange(max(1, least, -(-n // RANGE_ROWS)), *ORDER)
    return ranges.sortWithinPartitions("run", "seq").mapInArrow(_merged, CAPTURES + ", range int, position long")


def archive_index(pages: DataFrame, captured: Column, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back, and
    return the merged index of their captures."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, captured, min_bytes=min_bytes)
    return merge_runs(stored(read_archives(spark, path), "capture_runs"))
