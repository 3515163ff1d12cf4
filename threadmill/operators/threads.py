"""Comment trees -> flat, ordered comment rows.

Adjacency rows are resolved by pointer doubling: every comment knows an ancestor
and the sibling keys from there down to itself; each round it takes over its
ancestor's, so both reach twice as far, and a tree of depth d takes log2 d
rounds. JSON documents are expanded by a chain of ``STEPS`` generators in one job:
each takes the children out of every comment it emits, so the nested replies of
a comment are carried on only until it is expanded, and are written down
only where a tree is deeper than ``STEPS`` levels. No tree is gathered into one
task, and a parent of very many replies is looked up from a bounded broadcast.

Order is carried as ``path``: the array of sibling positions/keys from the root.
Arrays compare element-wise, so ordering by ``(post_id, path)`` is exactly
pre-order (a parent sorts before its children, siblings in their order).
Rounds are written to the shared scratch folder, which cuts lineage; nothing
stays cached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from ..functions import text as tx
from ..session import scratch_path
from ..sources import json_docs as jd
from .hot_keys import hot_keys, lookup

MAX_DEPTH = 1000
#: Levels of a JSON document expanded in one job.
STEPS = 6


def _observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``df`` written to the shared scratch folder and read from there, with metrics
    taken while it is written."""
    path = scratch_path(df.sparkSession, name)
    seen = Observation()
    df.observe(seen, *[m.alias(k) for k, m in metrics.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def _union(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def path_text(path: Column, width: int = 6) -> Column:
    """Printable pre-order key: positions padded with zeros to ``width`` digits, joined
    by '.'. A longer position is written in full, after a '~' for each digit it has
    beyond ``width``: it sorts behind all shorter ones, and no two paths are alike."""
    def padded(x: Column) -> Column:
        text = x.cast("string")
        return F.when(F.length(text) <= width, F.lpad(text, width, "0")).otherwise(
            F.concat(F.repeat(F.lit("~"), F.length(text) - width), text))

    return F.array_join(F.transform(path, padded), ".")


# ---------------------------------------------------------------------------
# Adjacency rows (post_id, id, parent_id, sort key) -> tree rows
# ---------------------------------------------------------------------------

def flatten_adjacency(
    nodes: DataFrame,
    sort_key: Column | str,
    keep_node: Column | None = None,
    max_depth: int = MAX_DEPTH,
    rounds: list | None = None,
) -> DataFrame:
    """Place adjacency rows below the roots (``parent_id`` NULL).

    ``nodes`` needs ``post_id, id, parent_id``; other columns are carried.
    ``keep_node`` (optional predicate) prunes a node *and its whole subtree*
    (S11). Output adds ``depth INT`` and ``path`` (array of sibling keys). Nodes
    that no root leads to (an absent or pruned parent, a cycle) are not part of
    the tree; ``unreached`` returns them. Rows equal in post, id, parent and key
    are one ancestor. A tree deeper than ``max_depth`` raises instead of being cut.
    ``rounds``, where given, collects the number of unresolved rows by round.
    """
    key = F.col(sort_key) if isinstance(sort_key, str) else sort_key
    base = nodes.withColumn("_key", key)
    if keep_node is not None:
        base = base.where(keep_node)
    cols = [c for c in base.columns if c != "_key"]
    # ``at``: the node; ``up``: the ancestor that ``path`` starts below (NULL: none).
    at = F.struct(F.col("post_id").alias("p"), F.col("id").cast("string").alias("i"))
    up = F.when(F.col("parent_id").isNotNull(), F.struct(F.col("post_id").alias("p"), F.col("parent_id").cast("string").alias("i")))
    steps = base.select(at.alias("at"), F.col("parent_id").alias("parent"), F.col("_key").alias("key"),
                        up.alias("up"), F.array("_key").alias("path")).distinct()
    taken = {"open": F.count_if(F.col("up").isNotNull()), "rows": F.count(F.lit(1)),
             "deepest": F.max(F.when(F.col("up").isNull(), F.size("path") - 1))}
    steps, seen = _observed(steps, "steps", **taken)
    while seen["open"]:
        before = seen
        above = steps.select(F.col("at").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        waiting = steps.where(F.col("up").isNotNull())
        hot = hot_keys(waiting.groupBy("up").agg(F.count(F.lit(1)).alias("n")), "up", seen["open"])
        higher = lookup(waiting, above, "up", hot).select(
            "at", "parent", "key", F.col("_up").alias("up"), F.concat("_path", "path").alias("path"))
        # Rows whose ancestor is absent drop out here.
        steps, seen = _observed(steps.where(F.col("up").isNull()).unionByName(higher), "steps", **taken)
        if rounds is not None:
            rounds.append(seen["open"])
        if seen["rows"] - seen["open"] <= before["rows"] - before["open"] and seen["open"] >= before["open"]:
            break  # no root was reached: what is left hangs on a cycle
    paths = steps.where(F.col("up").isNull()).select(
        F.col("at").alias("_at"), F.col("parent").alias("_parent"), F.col("key").alias("_same_key"), F.col("path").alias("_path"))
    same = (at == F.col("_at")) & F.col("parent_id").eqNullSafe(F.col("_parent")) & F.col("_key").eqNullSafe(F.col("_same_key"))
    tree = base.join(paths, same).select(*cols, (F.size("_path") - 1).alias("depth"), F.col("_path").alias("path"))
    if (seen["deepest"] or 0) > max_depth:
        raise RuntimeError(f"reply tree deeper than max_depth={max_depth}")
    return tree


def cap_per_post(tree: DataFrame, n: int = C.MAX_COMMENTS_PER_POST, order: Column | None = None) -> DataFrame:
    """First ``n`` comments per post in pre-order.

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so at most ``n`` rows per post leave each map task.
    """
    w = Window.partitionBy("post_id").orderBy(order if order is not None else F.col("path"), F.col("id"))
    return tree.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def replies_per_parent(tree: DataFrame) -> DataFrame:
    """Direct replies of each parent in order (H3): one row (post_id,
    parent_id, position, reply_id) a reply. ``position`` is the sibling key at
    the end of the path, so there is one row shape at every size, no list to
    gather and no shuffle.
    """
    return tree.where(F.col("parent_id").isNotNull()).select(
        "post_id", "parent_id", F.element_at("path", -1).alias("position"), F.col("id").alias("reply_id"))


def unreached(nodes: DataFrame, tree: DataFrame) -> DataFrame:
    """Nodes that no root leads to: their parent, or one above it, is absent or
    was pruned. With the tree they make up all of ``nodes``."""
    return nodes.join(tree.select("post_id", "id"), ["post_id", "id"], "left_anti")


def comments_by_depth(tree: DataFrame) -> DataFrame:
    """Comment count per depth, sorted."""
    return tree.groupBy("depth").agg(F.count(F.lit(1)).alias("n_comments")).orderBy("depth")


# ---------------------------------------------------------------------------
# JSON thread documents -> comment rows
# ---------------------------------------------------------------------------

def _replies(data: Column) -> Column:
    """Children of a comment's ``replies`` listing ('' or missing -> empty)."""
    kids = F.try_variant_get(data, "$.replies.data.children", "array<variant>")
    return F.coalesce(kids, F.array().cast("array<variant>"))


def _flatten(roots: DataFrame, keep: list[str], fields: list[Column], admit: Column, max_depth: int) -> DataFrame:
    """All nodes below ``roots`` (keep..., depth, path, tree_parent, kind, data): the
    columns ``fields`` of each node's ``data``, beside keep, depth, path, tree_parent
    and kind. ``admit`` drops a node with its subtree. Only ``t1`` nodes have children.

    A row waits while it holds ``data``; a step emits it with its fields instead and
    adds its children, which wait in turn."""
    place = ["depth", "path", "tree_parent", "kind"]
    got = F.struct(*fields)
    kind_of_got = roots.select(got.alias("got")).schema["got"].dataType
    rows = roots.select(*keep, *place, "data", F.lit(None).cast(kind_of_got).alias("got")).where(admit)
    node_id = F.try_variant_get("data", "$.id", "string")
    done: list[DataFrame] = []
    while True:
        for _ in range(STEPS):
            me = F.struct(*place, F.lit(None).cast("variant").alias("data"), got.alias("got"))
            kids = F.transform(
                F.when(F.col("kind") == "t1", _replies(F.col("data"))).otherwise(F.array().cast("array<variant>")),
                lambda c, i: F.struct(
                    (F.col("depth") + 1).alias("depth"), F.concat(F.col("path"), F.array(i)).alias("path"),
                    F.col("_id").alias("tree_parent"), F.try_variant_get(c, "$.kind", "string").alias("kind"),
                    F.coalesce(F.try_variant_get(c, "$.data", "variant"), F.parse_json(F.lit("{}"))).alias("data"),
                    F.lit(None).cast(kind_of_got).alias("got")))
            as_is = F.array(F.struct(*place, "data", "got"))
            rows = rows.withColumn("_id", node_id)
            rows = rows.select(*keep, F.inline(F.when(F.col("data").isNull(), as_is).otherwise(F.concat(F.array(me), kids))))
            rows = rows.where(F.col("data").isNull() | admit)
        rows, seen = _observed(rows, "nodes", waiting=F.count_if(F.col("data").isNotNull()), deepest=F.max("depth"))
        if (seen["deepest"] or 0) > max_depth:
            raise RuntimeError(f"reply tree deeper than max_depth={max_depth}")
        done.append(rows.where(F.col("data").isNull()).select(*keep, *place, "got.*"))
        if not seen["waiting"]:
            return _union(done)
        rows = rows.where(F.col("data").isNotNull())


def flatten_thread_docs(
    parsed: DataFrame,
    doc: str = "doc",
    mode: str = "full",
    max_depth: int = MAX_DEPTH,
    discovered_by: str | None = None,
) -> DataFrame:
    """Thread documents -> flat comments in pre-order (H1 ``full``, H2 ``slim``).

    full: every ``t1`` node, deleted ones included; depth from 0; full comment
          fields plus ``post_id``, ``post_subreddit`` (from element 0), our
          derived ``tree_parent`` and ``path``.
    slim: nodes whose body is empty/[deleted]/[removed] are dropped together
          with their subtree; ``parent_id`` is the parent's id, or the post id
          at the root (S11, S12).
    """
    has_key = "post_key" in parsed.columns
    roots = jd.thread_roots(parsed, doc, keep=("post_key",) if has_key else ())
    post_id = F.coalesce(F.try_variant_get("post", "$.id", "string"),
                         F.col("post_key") if has_key else F.lit(None).cast("string"))
    roots = roots.select(
        post_id.alias("_post_id"), F.try_variant_get("post", "$.subreddit", "string").alias("_post_subreddit"),
        F.lit(0).alias("depth"), F.array(F.col("pos")).alias("path"), F.lit(None).cast("string").alias("tree_parent"), "kind", "data")
    keep = ["_post_id", "_post_subreddit"]
    d = F.col("data")
    admit = F.col("kind") == "t1"
    if mode == "slim":
        body = F.try_variant_get("data", "$.body", "string")
        admit = admit & body.isNotNull() & (body != "") & ~body.isin(*C.DELETED_BODIES)
        fields = [F.try_variant_get("data", "$.id", "string").alias("id"), tx.clean_text(body).alias("body"),
                  jd.field(d, "author", "string", C.DELETED_AUTHOR).alias("author"), jd.field(d, "score", "bigint", 0).alias("score"),
                  jd.field(d, "created_utc", "double", 0.0).alias("created_utc")]
        nodes = _flatten(roots, keep, fields, admit, max_depth)
        return nodes.select(
            "id", F.col("_post_id").alias("post_id"), F.coalesce("tree_parent", "_post_id").alias("parent_id"), "body", "author", "score",
            "created_utc", F.col("depth").cast("int").alias("depth"), F.lit(discovered_by).cast("string").alias("discovered_by"), "path")
    fields = jd.extract(d, [f for f in schemas.COMMENT_FIELDS if f[0] != "depth"])
    nodes = _flatten(roots, keep, fields, admit, max_depth)
    names = [c for c in nodes.columns if c not in (*keep, "depth", "path", "tree_parent", "kind")]
    return nodes.select(*names, F.col("depth").cast("bigint").alias("depth"), F.col("_post_id").alias("post_id"),
                        F.col("_post_subreddit").alias("post_subreddit"), "tree_parent", "path")


def more_placeholder_count(parsed: DataFrame, doc: str = "doc", max_depth: int = MAX_DEPTH) -> DataFrame:
    """Unexpanded ids held in ``more`` placeholders, at every level below ``t1``
    comments (D11)."""
    roots = jd.thread_roots(parsed, doc).select(
        F.lit(0).alias("depth"), F.array(F.col("pos")).alias("path"), F.lit(None).cast("string").alias("tree_parent"), "kind", "data")
    held = F.size(F.coalesce(F.try_variant_get("data", "$.children", "array<variant>"), F.array().cast("array<variant>")))
    nodes = _flatten(roots, [], [held.alias("n_held")], F.col("kind").isin("t1", "more"), max_depth)
    return nodes.where(F.col("kind") == "more").agg(
        F.coalesce(F.sum("n_held"), F.lit(0)).cast("bigint").alias("more_ids"), F.count(F.lit(1)).alias("more_nodes"))
