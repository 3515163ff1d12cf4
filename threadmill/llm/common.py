"""Helpers shared by the operators: narrow document frames, whole-batch word
hashing inside Arrow tasks, and tables stored in the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.session import configure, lend_setting, scratch_path

#: Text bytes worked on at once inside a task; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

M1 = np.uint64(0xFF51AFD7ED558CCD)
M2 = np.uint64(0xC4CEB9FE1A85EC53)
S33 = np.uint64(33)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: Arrow batches bounded by rows and bytes,
    and the shuffle files of a stored step removed once it is written. They hold
    until the next ``configure``, so other queries run with the session's own."""
    configure(spark)
    lend_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    lend_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    lend_setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def documents(docs: DataFrame) -> DataFrame:
    """Only (doc_id long, text string) of a table that may hold more columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read
    again: cuts lineage, survives lost executors, and feeds several readers."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    col = batch.column(column)
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def slices(texts: list, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``budget`` bytes of text each, of one row at least."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > budget:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), vectorised."""
    x = x ^ (x >> S33)
    x = x * M1
    x ^= x >> S33
    x = x * M2
    x ^= x >> S33
    return x


class _Powers:
    """Powers of an odd number and of its inverse mod 2**64, grown on demand."""

    def __init__(self, m: int):
        self.m, self.inv = np.uint64(m), np.uint64(pow(m, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            out = []
            for x in (self.m, self.inv):
                p = np.full(size, x, np.uint64)
                p[0] = 1
                out.append(np.multiply.accumulate(p))
            self.up, self.down = out
        return self.up[:n], self.down[:n]


POWERS = _Powers(0x9E3779B97F4A7C15)
POWERS2 = _Powers(0xD1342543DE82EF95)
POWERS3 = _Powers(0x8CB92BA72F3D8DD7)
#: A random 64-bit value for each byte; the second table reads A-Z as a-z.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * M2)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


class Prefix:
    """Fingerprints of ranges of ``h`` from prefix sums of h[i] * m**i (mod 2**64)."""

    def __init__(self, h: np.ndarray, powers: _Powers):
        up, self.down = powers.get(len(h) + 1)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[: len(h)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts: 64-bit hashes in order,
    byte ranges in ``joined``, and their number by text."""

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        self.joined = b" ".join(t or b"" for t in texts) + b" "
        buf = np.frombuffer(self.joined, np.uint8)
        blank = BLANK[buf]
        edge = np.empty(len(buf), bool)
        edge[0] = not blank[0]
        np.not_equal(blank[1:], blank[:-1], out=edge[1:])
        at = np.flatnonzero(edge)
        self.begin, self.end = at[0::2], at[1::2]
        lens = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        self.offsets = starts_of(lens + 1)
        self.first = np.searchsorted(self.begin, self.offsets)
        self.counts = np.diff(self.first)
        self.hashes = Prefix((BYTE_LOWER if lower else BYTE)[buf], POWERS3).of(self.begin, self.end)


def starts_of(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out
