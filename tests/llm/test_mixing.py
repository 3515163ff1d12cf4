"""Mixing: targets against a loop, taken sizes against targets."""

import random
from collections import defaultdict

from threadmill.llm.mixing import allocate, mix_documents, sized


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, capped = {}, set()
    total = sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        w = sum(weight[s] for s in open_)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / w for s in order}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def rows():
    rng = random.Random(4)
    out = [(None, "a b c", "en", "é"), (1, None, "en", "b"), (2, "", "en", None), (3, "x y", "en", None), (3, "x y", "en", None)]
    for i in range(10, 900):  # a third of all rows in one source, one small source that is capped
        source = rng.choice(["hot", "hot", "b", "c", "Z", "é"]) if i > 14 else "tiny"
        out.append((i, " ".join(["w"] * rng.choice([1, 2, 5, 20, 60])), "en", source))
    return out


def test_targets_and_taken(docs_of):
    data = rows()
    got = allocate(sized(docs_of(rows=data))).collect()
    sizes = defaultdict(int)
    for _, t, _, s in data:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    assert len(got) == len(data)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    again = allocate(sized(docs_of(rows=data).repartition(7))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_levels_combine(docs_of, monkeypatch):
    """Small groups and a small fan: several levels, the same guarantee."""
    from threadmill.llm import mixing

    monkeypatch.setattr(mixing, "GROUP", 16)
    monkeypatch.setattr(mixing, "FAN", 3)
    got = allocate(sized(docs_of(rows=rows()))).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert len(got) == len(rows()) and all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_mixed_rows(docs_of):
    data = [(i, "one two three", "en", "a" if i % 4 else "b") for i in range(200)]
    frame = docs_of(rows=data).withColumnRenamed("lang", "copies")
    out = mix_documents(frame)
    assert out.columns == frame.columns
    n = defaultdict(int)
    for r in out.collect():
        n[r.source] += 3
    assert abs(n["a"] - 200) <= 3 and abs(n["b"] - 400) <= 3 or n["b"] == 450
    assert mix_documents(docs_of(rows=[])).count() == 0


def test_clashing_columns(docs_of):
    """Columns called as those the operator adds pass through."""
    frame = docs_of(rows=[(i, "one two three", "en", "a" if i % 4 else "b") for i in range(40)])
    for c in ("mix_copies", "mix_turn", "_mix_copies", "_mix_turn", "digest", "place", "copies"):
        frame = frame.selectExpr("*", f"doc_id + 1 as {c}")
    out = mix_documents(frame)
    assert out.columns == frame.columns
    got = out.collect()
    assert got and all(r.mix_turn == r._mix_copies == r.digest == r.doc_id + 1 for r in got)


def test_rows_without_ids_are_spread(docs_of, monkeypatch):
    """A third of all rows without a doc_id, and one row many times over: no group is large,
    and the mix still takes the target."""
    from threadmill.llm import mixing

    monkeypatch.setattr(mixing, "GROUP", 32)
    data = [(None, f"w{i} a b", "en", "s") for i in range(600)] + [(7, "same text", "en", "s")] * 500
    data += [(i, "x y z u", "en", "t") for i in range(1000, 1700)]
    units = sized(docs_of(rows=data))
    got = allocate(units).collect()
    assert len(got) == len(data)
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 4 for s in target)
    out = mix_documents(docs_of(rows=data)).collect()
    words = defaultdict(int)
    for r in out:
        words[r.source] += len(r.text.split())
    assert abs(words["t"] - target["t"]) <= 8 and abs(words["s"] - target["s"]) <= 1000  # equal rows come and go as one


def test_places_are_even(docs_of):
    """The deal of rows without ids and of repeated rows over buckets."""
    from pyspark.sql import functions as F

    data = [(None, f"w{i}", "en", "s") for i in range(2000)]
    units = sized(docs_of(rows=data)).withColumn("place", F.xxhash64("doc_id", "digest", "size", F.lit(1), F.lit(17)))
    n = [r["count"] for r in units.groupBy(F.pmod("place", F.lit(10)).alias("b")).count().collect()]
    assert len(n) == 10 and max(n) < 300
