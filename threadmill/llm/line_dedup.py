"""Line dedup: explode normalised lines, hash, count documents per hash, drop
the lines of common hashes and reassemble the rest by position.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with
A-Z lower-cased. Keys of ``min_chars`` code points or more that stand in
``min_docs`` documents or more lose all their lines, except in the largest
doc_id that holds them. Lines are hashed to 128 bits inside the scan (one row
per distinct key and document); documents are counted after a shuffle by key and
document, so a key that stands in a third of all documents is dealt to all
tasks and then arrives as one row from each of them. The join back to the documents has plain shuffles on both sides, which lets Spark split
a hot key.

Defined results: a null or empty text is one empty line and stays as it is;
rows that repeat a doc_id count as one document and lose the same keys; rows
with a null doc_id count as none and lose nothing; an empty table gives an empty table; extra columns
pass through unchanged whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.llm.common import documents, free_name, stored, text_bytes

OCC = "doc_id long, hi long, lo long"
ADDED = ("n_lines", "n_dropped")


def _key(line: bytes, min_chars: int) -> bytes | None:
    """16-byte hash of a line's key, None for short keys."""
    k = line.strip()
    if len(k) < min_chars or (not k.isascii() and len(k.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(k.lower())


def _explode(min_chars: int):
    def run(batches):
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            out_ids, keys = [], []
            for i, t in zip(ids, text_bytes(b)):
                if t:
                    found = {_key(x, min_chars) for x in t.split(b"\n")}
                    found.discard(None)
                    out_ids += [i] * len(found)
                    keys += found
            h = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_ids, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1])], ["doc_id", "hi", "lo"]
            )

    return run


def dropped_keys(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, keys array<struct<hi, lo>>): the line hashes each document loses."""
    occ = documents(docs).mapInArrow(_explode(min_chars), OCC)
    common = stored(
        occ.groupBy("hi", "lo")
        .agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last_doc"))
        .where(F.col("n") >= min_docs)
        .drop("n"),
        "common_lines",
    )
    return (
        occ.join(common, ["hi", "lo"])
        .where(F.col("doc_id") < F.col("last_doc"))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("hi", "lo")).alias("keys"))
    )


def _reassemble(names: list[str], text_col: str, keys_col: str, min_chars: int):
    def run(batches):
        for b in batches:
            texts = text_bytes(b, text_col)
            col = b.column(keys_col)
            kept, n_lines, n_dropped = [], [], []
            for i, t in enumerate(texts):
                if not t or not col[i].is_valid:
                    kept.append(t)
                    n_lines.append(t.count(b"\n") + 1 if t else 1)
                    n_dropped.append(0)
                    continue
                v = col[i].values
                raw = np.stack([v.field("hi").to_numpy(), v.field("lo").to_numpy()], 1).astype("<i8").tobytes()
                drop = {raw[k : k + 16] for k in range(0, len(raw), 16)}
                lines = t.split(b"\n")
                stay = [x for x in lines if _key(x, min_chars) not in drop]
                kept.append(b"\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            cols = [
                pa.array(kept, pa.binary()).cast(pa.string()) if n == text_col else b.column(n) for n in names
            ] + [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [f"c{k}" for k in range(len(cols))])

    return run


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> tuple[DataFrame, str, str]:
    """``docs`` with the kept lines as ``text``, plus two counts (lines before,
    lines dropped) whose column names are returned with the frame."""
    drop = dropped_keys(docs, min_chars, min_docs)
    k = free_name(docs.columns, "dropped_keys")
    did = free_name([*docs.columns, k], "dropped_doc")
    drop = drop.select(F.col("doc_id").alias(did), F.col("keys").alias(k))
    joined = docs.join(drop, docs["doc_id"].cast("long") == drop[did], "left").drop(did)
    added = [free_name(docs.columns, a) for a in ADDED]
    fields = [*docs.schema.fields, *(T.StructField(a, T.LongType()) for a in added)]
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    text_col = next(c for c in docs.columns if c.lower() == "text")
    out = joined.mapInArrow(_reassemble(docs.columns, text_col, k, min_chars), inner)
    return out.toDF(*(f.name for f in fields)), *added
