"""Registered queries: comment trees and the joins around them (H, E1, D2, C1-C4, G-U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import posts as P
from ..operators import threads as TH
from ..sources import json_docs as jd
from . import sqlkit as S
from . import views as V
from .registry import query

W = V.with_views
CAP = 3  # max_comments_per_post used by the capped query (parameter of E1)


def _tree(spark, sf_dir, pruned: bool):
    c = V.comments_v(spark, sf_dir)
    keep = None
    if pruned:
        b = F.col("body")
        keep = b.isNotNull() & (b != "") & ~b.isin(*C.DELETED_BODIES)
    return TH.flatten_adjacency(c, F.col("turn"), keep_node=keep)


def _tree_sql(pruned: bool) -> str:
    cond = "WHERE body IS NOT NULL AND body <> '' AND body NOT IN ('[deleted]', '[removed]')" if pruned else ""
    return (
        "WITH RECURSIVE " + V.COMMENTS_V_SQL.strip() + ",\n"
        f"nodes AS (SELECT * FROM comments_v {cond}),\n"
        f"""tree(post_id, id, parent_id, author, depth, path) AS (
  SELECT post_id, id, parent_id, author, 0, {S.path_part('turn')} FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT c.post_id, c.id, c.parent_id, c.author, t.depth + 1, t.path || '.' || {S.path_part('c.turn')}
  FROM nodes c JOIN tree t ON c.post_id = t.post_id AND c.parent_id = t.id
)
""")


@query("thread_tree", _tree_sql(False) + "SELECT post_id, id, parent_id, CAST(depth AS BIGINT) AS depth, path FROM tree")
def q_thread_tree(spark, sf_dir):
    """Full flatten of reply trees: depth from 0 and pre-order path; all posts' comments in one table (H1, H4, G-U2, S10)."""
    t = _tree(spark, sf_dir, False)
    return t.select("post_id", "id", "parent_id", F.col("depth").cast("bigint").alias("depth"), TH.path_text(F.col("path")).alias("path"))


@query("thread_tree_pruned", _tree_sql(True) + """SELECT post_id, id, coalesce(parent_id, post_id) AS parent_id,
  CAST(depth AS BIGINT) AS depth, path FROM tree""")
def q_thread_tree_pruned(spark, sf_dir):
    """Slim flatten: deleted/removed/empty comments dropped with their subtree;
    root parent = post id (H2, S11, S12)."""
    t = _tree(spark, sf_dir, True)
    return t.select("post_id", "id", F.coalesce("parent_id", "post_id").alias("parent_id"),
                    F.col("depth").cast("bigint").alias("depth"), TH.path_text(F.col("path")).alias("path"))


@query("comments_capped", _tree_sql(True) + f"""SELECT post_id, id, CAST(depth AS BIGINT) AS depth FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY path, id) AS rn FROM tree) WHERE rn <= {CAP}""")
def q_comments_capped(spark, sf_dir):
    """First n slim comments per post in pre-order."""
    t = TH.cap_per_post(_tree(spark, sf_dir, True), CAP)
    return t.select("post_id", "id", F.col("depth").cast("bigint").alias("depth"))


@query("replies_per_parent", _tree_sql(False) + """SELECT post_id, parent_id,
  CAST(replace(string_split(path, '.')[-1], '~', '') AS BIGINT) AS position, id AS reply_id FROM tree WHERE parent_id IS NOT NULL""")
def q_replies_per_parent(spark, sf_dir):
    """Direct replies per parent with their position (H3)."""
    out = TH.replies_per_parent(_tree(spark, sf_dir, False))
    return out.withColumn("position", F.col("position").cast("bigint"))


@query("thread_unreached", _tree_sql(True) + """SELECT n.post_id, n.id, n.parent_id FROM nodes n
WHERE NOT EXISTS (SELECT 1 FROM tree t WHERE t.post_id = n.post_id AND t.id = n.id)""")
def q_thread_unreached(spark, sf_dir):
    """Comments with a body that stand below a dropped one: what the slim flatten leaves out."""
    c = V.comments_v(spark, sf_dir)
    b = F.col("body")
    kept = c.where(b.isNotNull() & (b != "") & ~b.isin(*C.DELETED_BODIES))
    return TH.unreached(kept, _tree(spark, sf_dir, True)).select("post_id", "id", "parent_id")


@query("comments_by_depth", _tree_sql(False) + "SELECT CAST(depth AS BIGINT) AS depth, count(*) AS n_comments FROM tree GROUP BY 1")
def q_comments_by_depth(spark, sf_dir):
    """Comments per depth, sorted."""
    t = _tree(spark, sf_dir, False).withColumn("depth", F.col("depth").cast("bigint"))
    return TH.comments_by_depth(t)


@query("comments_with_posts", W(V.POSTS_V_SQL, V.COMMENTS_V_SQL) + """SELECT c.id, c.post_id, p.subreddit AS post_subreddit
FROM comments_v c JOIN posts_v p ON c.post_id = p.id""")
def q_comments_with_posts(spark, sf_dir):
    """Comment -> post by post_id (C1, B17): the planner picks broadcast or
    sort-merge from runtime sizes (AQE)."""
    c = V.comments_v(spark, sf_dir)
    p = V.posts_v(spark, sf_dir).select(F.col("id").alias("post_id"), F.col("subreddit").alias("post_subreddit"))
    return c.join(p, "post_id").select("id", "post_id", "post_subreddit")


@query("posts_missing_comments", W(V.POSTS_V_SQL, V.COMMENTS_V_SQL) + """SELECT id FROM posts_v p
WHERE coalesce(num_comments, 0) > 0 AND NOT EXISTS (SELECT 1 FROM comments_v c WHERE c.post_id = p.id)""")
def q_posts_missing_comments(spark, sf_dir):
    """Posts with comments upstream but none fetched yet (C2, left anti)."""
    p = P.with_comments(V.posts_v(spark, sf_dir))
    c = V.comments_v(spark, sf_dir).select(F.col("post_id").alias("id"))
    return p.join(c, "id", "left_anti").select("id")


@query("posts_having_comments", W(V.POSTS_V_SQL, V.COMMENTS_V_SQL) + """SELECT id FROM posts_v p
WHERE EXISTS (SELECT 1 FROM comments_v c WHERE c.post_id = p.id)""")
def q_posts_having_comments(spark, sf_dir):
    """Posts with at least one comment row (C3, left semi)."""
    c = V.comments_v(spark, sf_dir).select(F.col("post_id").alias("id"))
    return V.posts_v(spark, sf_dir).join(c, "id", "left_semi").select("id")


@query("reply_parent_pairs", W(V.COMMENTS_V_SQL) + """SELECT c.id, c.parent_id, p.author AS parent_author
FROM comments_v c LEFT JOIN comments_v p ON c.post_id = p.post_id AND c.parent_id = p.id""")
def q_reply_parent_pairs(spark, sf_dir):
    """Comment -> parent comment (C4, self equi-join, left outer)."""
    c = V.comments_v(spark, sf_dir)
    p = c.select(F.col("post_id").alias("_pp"), F.col("id").alias("_pid"), F.col("author").alias("parent_author"))
    return c.join(p, (c["post_id"] == p["_pp"]) & (c["parent_id"] == p["_pid"]), "left").select("id", "parent_id", "parent_author")


@query("union_mixed", _tree_sql(True).replace("WITH RECURSIVE ", "WITH RECURSIVE " + V.POSTS_V_SQL.strip() + ",\n") + """
SELECT 'post' AS record_type, id, title, CAST(NULL AS VARCHAR) AS parent_id FROM posts_v
UNION ALL SELECT 'comment', id, NULL, coalesce(parent_id, post_id) FROM tree""")
def q_union_mixed(spark, sf_dir):
    """Posts and slim comments in one batch, columns aligned by name (G-U3)."""
    posts = V.posts_v(spark, sf_dir).select(F.lit("post").alias("record_type"), "id", "title")
    slim = _tree(spark, sf_dir, True).select(F.lit("comment").alias("record_type"), "id",
                                              F.coalesce("parent_id", "post_id").alias("parent_id"))
    return posts.unionByName(slim, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# JSON thread documents, one a conversation: turns 0, 3, 6, ... stand at the top,
# each with the two turns after it nested below; even conversations end with a
# placeholder of two ids.
# ---------------------------------------------------------------------------

MORE_NODE = '{"kind":"more","data":{"children":["x","y"]}}'


def thread_documents(spark, sf_dir):
    """(body): raw thread documents."""
    c = V.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    row = F.struct("turn", "role", "text")
    at = [F.max(F.when(F.col("turn") % 3 == k, row)).alias(f"n{k}") for k in range(3)]
    g = c.groupBy("conv_id", F.floor(F.col("turn") / 3).alias("g")).agg(*at)

    def node(name, replies):
        n = F.col(name)
        data = F.struct(
            F.concat_ws("_", F.col("conv_id").cast("string"), n["turn"].cast("string")).alias("id"),
            F.when(n["turn"] % 5 == 3, F.lit(C.DELETED_BODIES[0])).otherwise(n["text"]).alias("body"),
            n["role"].alias("author"), (F.length(n["text"]) % 20).alias("score"), F.lit(True).alias("stickied"),
            (F.lit(V.EPOCH0) + F.col("conv_id") * 3600 + n["turn"] * 60).cast("double").alias("created_utc"),
            replies.alias("replies"))
        return F.when(n.isNotNull(), F.struct(F.lit("t1").alias("kind"), data.alias("data")))

    def listing(child):
        return F.when(child.isNotNull(), F.struct(F.lit("Listing").alias("kind"), F.struct(F.array(child).alias("children")).alias("data")))

    g = g.withColumn("n2", node("n2", F.lit("")))
    g = g.withColumn("n1", node("n1", listing(F.col("n2"))))
    g = g.withColumn("top", F.to_json(node("n0", listing(F.col("n1")))))
    doc = g.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("g", "top"))).alias("tops"))
    tops = F.concat(F.transform("tops", lambda t: t["top"]),
                    F.when(F.col("conv_id") % 2 == 0, F.array(F.lit(MORE_NODE))).otherwise(F.array().cast("array<string>")))
    post = F.to_json(F.struct(F.concat(F.lit("p"), F.col("conv_id").cast("string")).alias("id"), F.lit("s").alias("subreddit")))
    return doc.select(F.concat(F.lit('[{"data":{"children":[{"kind":"t3","data":'), post, F.lit('}]}},{"data":{"children":['),
                               F.array_join(tops, ","), F.lit("]}}]")).alias("body"))


THREADS_SQL = f"""
node AS (
  SELECT 'p' || CAST(conv_id AS VARCHAR) AS post_id, CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id,
         CASE WHEN turn % 3 > 0 THEN CAST(conv_id AS VARCHAR) || '_' || CAST(turn - 1 AS VARCHAR) END AS tree_parent,
         CAST(turn % 3 AS BIGINT) AS depth, conv_id, turn,
         {S.path_part('turn // 3')} || repeat('.000000', CAST(turn % 3 AS INTEGER)) AS path, role AS author,
         CASE WHEN turn % 5 = 3 THEN '[deleted]' ELSE text END AS raw, CAST(length(text) % 20 AS BIGINT) AS score,
         CAST({V.EPOCH0} + conv_id * 3600 + turn * 60 AS DOUBLE) AS created_utc
  FROM conversations
),
said AS (SELECT *, raw IS NOT NULL AND raw <> '' AND raw NOT IN ('[deleted]', '[removed]') AS ok FROM node),
slim AS (
  SELECT a.* FROM said a
  LEFT JOIN said b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1
  LEFT JOIN said c ON c.conv_id = a.conv_id AND c.turn = a.turn - 2
  WHERE a.ok AND (a.depth = 0 OR b.ok) AND (a.depth < 2 OR c.ok)
)
"""


def _thread_docs(spark, sf_dir):
    return jd.parse_bodies(thread_documents(spark, sf_dir))


@query("parse_thread", W(THREADS_SQL) + """SELECT post_id, CAST(turn // 3 AS BIGINT) AS pos, 't1' AS kind, id FROM node WHERE depth = 0
UNION ALL SELECT 'p' || CAST(conv_id AS VARCHAR), CAST(max(turn) // 3 + 1 AS BIGINT), 'more', NULL FROM conversations WHERE conv_id % 2 = 0 GROUP BY conv_id""")
def q_parse_thread(spark, sf_dir):
    """Thread documents -> their post and top-level children."""
    roots = jd.thread_roots(_thread_docs(spark, sf_dir))
    return roots.select(F.try_variant_get("post", "$.id", "string").alias("post_id"), F.col("pos").cast("bigint").alias("pos"), "kind",
                        F.try_variant_get("data", "$.id", "string").alias("id"))


@query("flatten_thread_full", W(THREADS_SQL) + f"SELECT post_id, id, tree_parent, depth, path, author, {S.clean('raw')} AS body, score FROM node")
def q_flatten_thread_full(spark, sf_dir):
    """Full flatten of JSON threads, deleted comments included, in pre-order (H1, H4)."""
    t = TH.flatten_thread_docs(_thread_docs(spark, sf_dir), mode="full")
    return t.select("post_id", "id", "tree_parent", "depth", TH.path_text(F.col("path")).alias("path"), "author", "body", "score")


@query("flatten_thread_slim", W(THREADS_SQL) + f"""SELECT post_id, id, coalesce(tree_parent, post_id) AS parent_id, depth, author,
  {S.clean('raw')} AS body, score, created_utc, 'w1' AS discovered_by FROM slim""")
def q_flatten_thread_slim(spark, sf_dir):
    """Slim flatten of JSON threads: removed comments go with what is below them."""
    t = TH.flatten_thread_docs(_thread_docs(spark, sf_dir), mode="slim", discovered_by="w1")
    return t.select("post_id", "id", "parent_id", F.col("depth").cast("bigint").alias("depth"), "author", "body", "score", "created_utc",
                    "discovered_by")


@query("extract_comments", W(THREADS_SQL) + f"""SELECT id, author, {S.clean('raw')} AS body, score, CAST(0 AS BIGINT) AS ups, created_utc,
  CAST(NULL AS VARCHAR) AS link_id, TRUE AS stickied, FALSE AS edited, post_id, 's' AS post_subreddit FROM node""")
def q_extract_comments(spark, sf_dir):
    """Comment fields with their defaults, from JSON threads."""
    t = TH.flatten_thread_docs(_thread_docs(spark, sf_dir), mode="full")
    return t.select("id", "author", "body", "score", "ups", "created_utc", "link_id", "stickied", "edited", "post_id", "post_subreddit")


@query("more_placeholder_count", """SELECT CAST(2 * count(DISTINCT conv_id) AS BIGINT) AS more_ids, count(DISTINCT conv_id) AS more_nodes
FROM conversations WHERE conv_id % 2 = 0""")
def q_more_placeholder_count(spark, sf_dir):
    """Ids held back in placeholders, at every level."""
    return TH.more_placeholder_count(_thread_docs(spark, sf_dir)).select("more_ids", "more_nodes")
