"""Comment trees: JSON thread documents and adjacency rows (FIXTURES §1.2)."""

import json

from pyspark.sql import functions as F

from threadmill.operators import threads as TH
from threadmill.sources import json_docs as jd


def c(cid, body="text", replies=None, **kw):
    d = {"id": cid, "body": body, "author": "u_" + cid, "score": 1, "created_utc": 1.0, "parent_id": "t1_x"}
    d.update(kw)
    d["replies"] = "" if replies is None else {"kind": "Listing", "data": {"children": replies}}
    return {"kind": "t1", "data": d}


MORE = {"kind": "more", "data": {"children": ["x", "y"]}}
TREE = [c("a", replies=[c("b", replies=[c("c")]), c("d"), MORE]), c("e", body="[deleted]", replies=[c("f")]), c("g")]


def thread_doc(top, post_id="P"):
    return json.dumps([{"data": {"children": [{"kind": "t3", "data": {"id": post_id, "subreddit": "s"}}]}},
                       {"data": {"children": top}}])


def parsed(spark, bodies):
    return jd.parse_bodies(spark.createDataFrame([(b,) for b in bodies], "body string"))


def ordered(df):
    return [(r["id"], r["parent"], r["depth"]) for r in df.orderBy("post_id", "path").collect()]


def test_full_flatten(spark):
    out = TH.flatten_thread_docs(parsed(spark, [thread_doc(TREE)]), mode="full").withColumnRenamed("tree_parent", "parent")
    assert ordered(out) == [("a", None, 0), ("b", "a", 1), ("c", "b", 2), ("d", "a", 1), ("e", None, 0), ("f", "e", 1), ("g", None, 0)]
    row = out.where("id = 'e'").first()
    assert row["body"] == "[deleted]" and row["post_id"] == "P" and row["post_subreddit"] == "s"


def test_slim_flatten_prunes_subtrees(spark):
    out = TH.flatten_thread_docs(parsed(spark, [thread_doc(TREE)]), mode="slim", discovered_by="w1")
    got = [(r["id"], r["parent_id"], r["depth"]) for r in out.orderBy("path").collect()]
    assert got == [("a", "P", 0), ("b", "a", 1), ("c", "b", 2), ("d", "a", 1), ("g", "P", 0)]
    capped = TH.cap_per_post(out, 3)
    assert [r["id"] for r in capped.orderBy("path").collect()] == ["a", "b", "c"]


def test_more_placeholders_counted(spark):
    r = TH.more_placeholder_count(parsed(spark, [thread_doc(TREE)])).first()
    assert r["more_ids"] == 2 and r["more_nodes"] == 1


def test_thread_edge_documents(spark):
    short = json.dumps([{"data": {"children": []}}])
    no_replies = thread_doc([{"kind": "t1", "data": {"id": "z", "body": "x"}}])
    empty_body = thread_doc([c("h", body="")])
    out = TH.flatten_thread_docs(parsed(spark, [short, no_replies, empty_body]), mode="full")
    assert sorted(r["id"] for r in out.collect()) == ["h", "z"]
    slim = TH.flatten_thread_docs(parsed(spark, [short, no_replies, empty_body]), mode="slim")
    assert [r["id"] for r in slim.collect()] == ["z"]


def test_flatten_count_equals_t1_nodes(spark):
    # slim rows are a subset of full rows
    docs = parsed(spark, [thread_doc(TREE, "P1"), thread_doc([c("q", replies=[c("r")])], "P2")])
    full = {r["id"] for r in TH.flatten_thread_docs(docs, mode="full").collect()}
    slim = {r["id"] for r in TH.flatten_thread_docs(docs, mode="slim").collect()}
    assert len(full) == 9 and slim <= full


def test_adjacency_tree_and_pruning(spark):
    rows = [("P", "a", None, 1, "x"), ("P", "b", "a", 1, "x"), ("P", "c", "b", 1, "x"), ("P", "d", "a", 2, "x"),
            ("P", "e", None, 2, "[removed]"), ("P", "f", "e", 1, "x"), ("Q", "g", None, 1, "x")]
    df = spark.createDataFrame(rows, "post_id string, id string, parent_id string, k int, body string")
    full = TH.flatten_adjacency(df, F.col("k"))
    assert [(r["id"], r["depth"]) for r in full.orderBy("post_id", "path").collect()] == [
        ("a", 0), ("b", 1), ("c", 2), ("d", 1), ("e", 0), ("f", 1), ("g", 0)]
    pruned = TH.flatten_adjacency(df, F.col("k"), keep_node=F.col("body") != "[removed]")
    assert sorted(r["id"] for r in pruned.collect()) == ["a", "b", "c", "d", "g"]
    assert TH.comments_by_depth(full).collect()[0]["n_comments"] == 3


def test_depth_guard_raises_instead_of_truncating(spark):
    import pytest
    rows = [("P", "a", None, 1), ("P", "b", "a", 1), ("P", "c", "b", 1)]
    df = spark.createDataFrame(rows, "post_id string, id string, parent_id string, k int")
    with pytest.raises(RuntimeError):
        TH.flatten_adjacency(df, F.col("k"), max_depth=1)
    assert TH.flatten_adjacency(df, F.col("k"), max_depth=2).count() == 3


def py_paths(rows):
    """(post, id) -> path of the rows that a root leads to."""
    below = {}
    for p, i, parent, k, *_ in rows:
        below.setdefault((p, parent), []).append((i, k))
    out, todo = {}, [(p, None, ()) for p in {r[0] for r in rows}]
    while todo:
        p, parent, path = todo.pop()
        for i, k in below.get((p, parent), []):
            out[p, i] = path + (k,)
            todo.append((p, i, path + (k,)))
    return out


ADJACENCY = "post_id string, id string, parent_id string, k int, at string, path string, key int"


def test_adjacency_equals_plain_walk(spark):
    """Random trees, a hot parent, absent parents, cycles, clashing column names."""
    import random
    rng = random.Random(4)
    rows = []
    for p in range(6):
        ids = [f"n{i}" for i in range(60)]
        for i, one in enumerate(ids):
            rows.append((f"P{p}", one, rng.choice([None, *ids[:i]][-8:]) if i else None, i))
    rows += [("H", "top", None, 0)] + [("H", f"r{i}", "top", i) for i in range(400)]
    rows += [("P0", "lost", "nobody", 1), ("P0", "below", "lost", 1)]
    rows += [("P1", "x", "y", 1), ("P1", "y", "z", 1), ("P1", "z", "x", 1), ("P1", "w", "x", 2)]
    rows = [(*r, "a", "b", 1) for r in rows]
    tree = TH.flatten_adjacency(spark.createDataFrame(rows, ADJACENCY).drop("path").repartition(3), F.col("k"))
    got = {(r.post_id, r.id): tuple(r.path) for r in tree.collect()}
    assert got == py_paths(rows) and all(r.depth == len(r.path) - 1 and r.at == "a" for r in tree.collect())
    left = TH.unreached(spark.createDataFrame(rows, ADJACENCY), tree)
    assert sorted(r.id for r in left.collect()) == ["below", "lost", "w", "x", "y", "z"]


def test_deep_chain_takes_logarithmic_rounds(spark):
    rows = [("P", str(i), str(i - 1) if i else None, i % 3, "", "", 0) for i in range(1000)]
    rounds = []
    tree = TH.flatten_adjacency(spark.createDataFrame(rows, ADJACENCY).drop("path"), F.col("k"), rounds=rounds)
    got = {r.id: (r.depth, list(r.path)) for r in tree.collect()}
    assert len(rounds) <= 12 and len(got) == 1000
    assert got["999"] == (999, [i % 3 for i in range(1000)])


def test_repeated_rows_and_cycles_of_them_end(spark):
    rows = [("P", "a", None, 1), ("P", "a", None, 1), ("P", "b", "a", 1), ("P", "x", "y", 1), ("P", "x", "y", 2), ("P", "y", "x", 1), ("P", "y", "x", 2)]
    df = spark.createDataFrame(rows, "post_id string, id string, parent_id string, k int")
    assert sorted(r.id for r in TH.flatten_adjacency(df, F.col("k")).collect()) == ["a", "a", "b"]


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "post_id string, id string, parent_id string, k int")
    assert TH.flatten_adjacency(df, F.col("k")).count() == 0
    assert TH.flatten_thread_docs(parsed(spark, [])).count() == 0


def test_path_text_keeps_long_positions_apart_and_in_order(spark):
    paths = [[0], [5], [5, 0], [999999], [999999, 3], [1000000], [1234567], [12345678], [2**31 - 1]]
    df = spark.createDataFrame([(p,) for p in paths], "p array<int>").select("p", TH.path_text(F.col("p")).alias("t"))
    assert [list(r.p) for r in df.orderBy("t").collect()] == paths
    assert df.select("t").distinct().count() == len(paths)


def test_threads_deeper_than_one_job(spark):
    """A chain of three jobs' depth beside a wide thread; nothing nested is left in the output."""
    node = None
    depth = 3 * TH.STEPS + 1
    for i in reversed(range(depth)):
        node = c(f"d{i}", replies=[node] if node else None)
    wide = [c(f"w{i}", replies=[c(f"w{i}_{j}") for j in range(3)]) for i in range(20)]
    for mode in ("full", "slim"):
        out = TH.flatten_thread_docs(parsed(spark, [thread_doc([node], "D"), thread_doc(wide, "W")]), mode=mode)
        rows = out.collect()
        assert {r.id: r.depth for r in rows if r.post_id == "D"} == {f"d{i}": i for i in range(depth)}
        assert [r.id for r in out.where("post_id = 'W'").orderBy("path").collect()] == [
            x for i in range(20) for x in (f"w{i}", *(f"w{i}_{j}" for j in range(3)))]
