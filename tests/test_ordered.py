"""Ordered passes over time series, and tables in buckets of their key."""

import random
import re
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from forumlens.operators import layout, ordered, snapshots, state
from forumlens.plans.registry import all_queries

from conftest import SF_SMALL, rows
from test_plans import plan

T0 = datetime(2024, 1, 1)
SNAP = ("id bigint, post_reddit_id bigint, scraped_at timestamp_ntz, score bigint, upvote_ratio double, "
        "num_comments bigint, is_pinned boolean")


def _series(n, seed=1):
    """Snapshots of 30 posts; post 7 has a third of all; some share a time, some metrics are null."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        p = 7 if rng.random() < 0.33 else rng.randrange(30)
        score = None if rng.random() < 0.1 else rng.randrange(100)
        out.append((i, p, T0 + timedelta(hours=rng.randrange(n // 4)), score, None, rng.randrange(9), False))
    return out


def test_trend_of_a_hot_post(spark):
    data = _series(600) + [(9000, None, T0, 1, None, 1, False)]
    got = {r.id: r for r in snapshots.snapshot_trend(spark.createDataFrame(data, SNAP), parts=16).collect()}
    last = {}
    for i, p, at, score, _, n, _ in sorted(data[:-1], key=lambda x: (x[1], x[2], x[0])):
        before = last.get(p)
        r = got.pop(i)
        assert r.previous_scraped_at == (before and before[0])
        assert r.score_change == (None if before is None or None in (score, before[1]) else score - before[1])
        assert r.num_comments_change == (None if before is None else n - before[2])
        last[p] = (at, score, n)
    assert not got


def test_a_hot_key_is_dealt_to_many_parts(spark):
    df = spark.createDataFrame(_series(2000), SNAP)
    parts = ordered.range_parts(df, "post_reddit_id", ["scraped_at", "id"], 16)
    sizes = {r._part: r["count"] for r in parts.groupBy("_part").count().collect()}
    assert len(sizes) >= 14 and max(sizes.values()) < 3 * 2000 / 16
    hot = parts.where("post_reddit_id = 7").select("_part").distinct().count()
    assert hot >= 4  # a third of 16 parts, about
    assert parts.groupBy("_part").agg(F.min("post_reddit_id")).count() == len(sizes)


def test_carry_over_several_parts(spark):
    """A value is carried through parts without one, never into another key."""
    data = [(1, t, v) for t, v in enumerate([None, 5, *[None] * 40, 7, *[None] * 20])] + [(2, t, None) for t in range(20)]
    df = spark.createDataFrame(data, "k int, t int, v int")
    parts = ordered.range_parts(df, "k", ["t"], 12)
    assert parts.select("_part").distinct().count() > 8
    for inclusive in (True, False):
        got = {(r.k, r.t): r.c for r in ordered.carried(parts, "k", ["t"], F.col("v"), "c", inclusive).collect()}
        held = {}
        for k, t, v in data:
            if inclusive and v is not None:
                held[k] = v
            assert got[k, t] == held.get(k)
            if v is not None:
                held[k] = v
    assert ordered.carried(ordered.range_parts(df.limit(0), "k", ["t"]), "k", ["t"], F.col("v"), "c", True).count() == 0


def test_history_by_hand(spark):
    posts = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None)], "reddit_id bigint, subreddit string")
    h = lambda n: T0 + timedelta(hours=n)
    reports = spark.createDataFrame([(10, "a", h(1)), (11, "a", h(5)), (12, "a", h(9)), (13, "c", h(1))],
                                    "id bigint, subreddit string, generated_at timestamp_ntz")
    snaps = spark.createDataFrame([
        (1, 1, h(1), 10, 0.5, 3, False),    # exactly at the first report: counts
        (2, 1, h(6), 15, 0.75, 4, False), (3, 1, h(6), 16, 0.75, None, False),  # same time: larger id
        (4, 2, h(3), 1, 0.25, 1, True), (5, 9, h(1), 1, 0.25, 1, False), (6, None, h(1), 1, 0.25, 1, False)], SNAP)
    got = snapshots.report_history(posts, snaps, reports, parts=5)
    cols = ("post_reddit_id", "report_id", "score", "previous_report_at", "new_since_previous_report", "score_change",
            "num_comments_change")
    assert rows(got, *cols) == sorted([
        (1, 10, 10, None, None, None, None), (1, 11, 10, h(1), False, 0, 0), (1, 12, 16, h(5), False, 6, None),
        (2, 10, None, None, None, None, None), (2, 11, 1, h(1), True, None, None), (2, 12, 1, h(5), False, 0, 0)], key=repr)


def test_history_of_many_reports(spark):
    data = _series(500, seed=3)
    posts = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(32)], "reddit_id bigint, subreddit string")
    reports = [(i, "ab"[i % 2], T0 + timedelta(hours=3 * i, minutes=i % 3)) for i in range(40)]
    got = snapshots.report_history(posts, spark.createDataFrame(data, SNAP), spark.createDataFrame(
        reports, "id bigint, subreddit string, generated_at timestamp_ntz"), parts=9)
    seen = {(r.post_reddit_id, r.report_id): r for r in got.collect()}
    assert len(seen) == got.count() == 32 * 20
    for (p, i), r in seen.items():
        at = [max([(x[2], x[0]) for x in data if x[1] == p and x[2] <= y[2]], default=None)
              for y in reports if y[0] in (i, i - 2) and y[1] == r.subreddit]
        assert r.scraped_at == (at[-1] and at[-1][0])
        if i >= 2:
            assert r.new_since_previous_report == (at[0] is None)


# ------------------------------------------------------------- buckets

def _exchanges(p):
    return len(re.findall(r"^\(\d+\) Exchange", p, re.M))


def _no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_stored_side_is_not_shuffled(spark):
    """B1, B3 and E1 on bucketed tables: at most the batch is exchanged."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    _no_broadcast(spark)
    try:
        q = all_queries()
        for name, most in (("bucketed_upsert_posts", 1), ("bucketed_upsert_comments", 1), ("bucketed_latest_snapshot", 0)):
            p = plan(q[name](spark, SF_SMALL))
            assert _exchanges(p) == most and "Bucketed: true" in p, (name, p)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_merge_in_buckets_is_the_same_merge(spark):
    stored = spark.createDataFrame([("p1", "s", "old", "x", T0, T0), ("p2", "s", "kept", None, T0, T0)],
                                   "reddit_id string, subreddit string, title string, author string, "
                                   "first_scraped_at timestamp_ntz, last_scraped_at timestamp_ntz")
    t1 = T0 + timedelta(hours=1)
    batch = spark.createDataFrame([(1, 0, t1, "p1", "s", "a", "y"), (1, 1, t1, "p1", "s", "b", None), (1, 2, t1, "p3", "r", "c", "z"),
                                   (1, 3, t1, "", "r", "c", "z"), (1, 4, t1, None, "r", "c", "z")],
                                  "batch_id bigint, position bigint, scraped_at timestamp_ntz, reddit_id string, "
                                  "subreddit string, title string, author string")
    cols = ("subreddit", "title", "author")
    table = layout.write_bucketed(stored, f"t_{uuid.uuid4().hex}", "reddit_id", 3)
    once = layout.merge_bucketed(table, batch, "reddit_id", cols)
    assert rows(once) == rows(state._upsert(stored, batch, "reddit_id", cols, ("batch_id", "position")))
    assert rows(once) == sorted([("p1", "s", "b", None, T0, t1), ("p2", "s", "kept", None, T0, T0),
                                 ("p3", "r", "c", "z", t1, t1)], key=repr)
    again = layout.merge_bucketed(layout.write_bucketed(once, f"t_{uuid.uuid4().hex}", "reddit_id", 3), batch, "reddit_id", cols)
    assert rows(again) == rows(once)
    empty = layout.merge_bucketed(layout.write_bucketed(stored.limit(0), f"t_{uuid.uuid4().hex}", "reddit_id", 3), batch,
                                  "reddit_id", cols)
    assert rows(empty, "reddit_id") == [("p1",), ("p3",)]
