"""Listing / post-detail JSON -> posts (FIXTURES §1.1, §1.3)."""

import json


from threadmill import config as C
from threadmill.operators import posts as P
from threadmill.sources import json_docs as jd

AS_OF = 1706659200.0
DAY = 86400


def listing(children, after="t3_zzz"):
    return json.dumps({"kind": "Listing", "data": {"after": after, "children": children}})


def post(pid, **kw):
    d = {"id": pid, "title": f"T {pid}", "selftext": "body", "author": "u1", "created_utc": AS_OF - 3600,
         "subreddit": "startups", "score": 12, "num_comments": 2, "permalink": f"/r/startups/comments/{pid}/x/"}
    d.update(kw)
    return {"kind": "t3", "data": {k: v for k, v in d.items() if v is not ...}}


def parse(spark, bodies):
    raw = spark.createDataFrame([(b,) for b in bodies], "body string")
    return jd.parse_bodies(raw)


def test_listing_cases(spark):
    kids = [
        post("aaa1", title=" First\r\nline\u0000 ", edited=False, link_flair_text="Ask", media=None, media_embed={}),
        {"kind": "t5", "data": {"id": "skip"}},                      # L1
        post("aaa2", title=...),                                      # L2 missing title
        post("aaa3", title=None),                                     # L3 null title
        post("aaa4", author=...),                                     # L4 missing author
        post("aaa5", author=None),                                    # L4 null author
        post("aaa6", score=...),                                      # L5 missing score
        post("aaa7", score=3),                                        # L6
        post("aaa8", created_utc=AS_OF - 7 * DAY),                    # L7
        post("aaa9", created_utc=AS_OF - 7 * DAY - 1),                # L8
        post("ab10", edited=1706500100.0),                            # L9
        post("ab11", permalink=...),                                  # L13
    ]
    rows = {r["id"]: r for r in jd.posts_from_listings(parse(spark, [listing(kids)])).collect()}
    assert "skip" not in rows and "aaa2" not in rows
    a = rows["aaa1"]
    assert a["title"] == "First\nline" and a["flair"] == "Ask" and a["edited"] is False and a["edited_utc"] is None
    assert a["media"] is None and a["media_embed"] == "{}"
    assert rows["aaa3"]["title"] == ""
    assert rows["aaa4"]["author"] == C.DELETED_AUTHOR and rows["aaa5"]["author"] is None
    assert rows["aaa6"]["score"] == 0
    assert rows["ab10"]["edited"] is True and rows["ab10"]["edited_utc"] == 1706500100.0
    assert rows["ab11"]["permalink"] == C.PERMALINK_BASE
    assert rows["aaa1"]["permalink"] == C.PERMALINK_BASE + "/r/startups/comments/aaa1/x/"

    kept = {r["id"] for r in P.passes_filters(jd.posts_from_listings(parse(spark, [listing(kids)])), AS_OF).collect()}
    assert "aaa6" not in kept and "aaa7" in kept and "aaa8" in kept and "aaa9" not in kept


def test_next_page_tokens(spark):
    docs = parse(spark, [listing([post("p1")], after="t3_p1"), listing([post("p2")], after=None), listing([], after="t3_x")])
    assert [r["after"] for r in jd.next_page_tokens(docs).collect()] == ["t3_p1"]


def test_quarantine_keeps_good_rows(spark):
    raw = spark.createDataFrame([("{\"a\": 1}",), ("not json",), ("[1, 2]",)], "body string")
    good, bad = jd.quarantine(raw)
    assert good.count() == 2
    assert [r["body"] for r in bad.collect()] == ["not json"]


def test_duplicate_keys_keep_last(spark):
    docs = parse(spark, ['{"data": {"children": [{"kind": "t3", "data": {"id": "x1", "id": "x2", "title": "t", "created_utc": 1, "subreddit": "s"}}]}}'])
    assert [r["id"] for r in jd.posts_from_listings(docs).collect()] == ["x2"]


def test_post_detail_not_filtered(spark):
    old = post("old1", created_utc=0.0, score=-5)
    body = json.dumps([{"data": {"children": [old]}}, {"data": {"children": []}}])
    rows = jd.post_detail(parse(spark, [body, "[]", json.dumps([{"data": {"children": []}}])])).collect()
    assert len(rows) == 1 and rows[0]["id"] == "old1" and rows[0]["detail_fetch"] is True
