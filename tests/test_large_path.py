"""The plans taken at scale: no side passes the broadcast size check and
Spark's own broadcast threshold is off, so every join shuffles.  Results
must still equal the oracles."""

import pytest

from forumlens.operators import guards
from forumlens.plans.oracle_check import compare, duck_connect
from forumlens.plans.registry import entries

from conftest import SF_SMALL

QUERIES = ["report_deltas", "asof_snapshot", "latest_post_snapshot", "context_document", "top_comments", "upsert_posts",
           "upsert_comments", "by_id_list", "stale_posts", "link_grounding", "nest_comments", "stream_ingest"]


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(guards, "MAX_BROADCAST_ROWS", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", QUERIES)
def test_shuffle_plans_match_oracle(spark, no_broadcast, name):
    e = entries()[name]
    r = compare(spark, duck_connect(SF_SMALL), name, e.fn, e.sql, SF_SMALL)
    assert r["status"] == "ok", r


def test_no_broadcast_in_forced_plan(spark, no_broadcast):
    import contextlib
    import io
    df = entries()["report_deltas"].fn(spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "BroadcastHashJoin" not in buf.getvalue()


@pytest.mark.parametrize("name", ["report_deltas", "asof_snapshot", "context_document", "null_safe_delta"])
def test_hot_key_split_matches_oracle(spark, no_broadcast, monkeypatch, name):
    """Every post with more than 3 snapshots is treated as hot; the post
    table (200 rows) is over the broadcast bound, the hot set (15) under it."""
    monkeypatch.setattr(guards, "HOT_KEY_ROWS", 3)
    monkeypatch.setattr(guards, "MAX_BROADCAST_ROWS", 150)
    e = entries()[name]
    r = compare(spark, duck_connect(SF_SMALL), name, e.fn, e.sql, SF_SMALL)
    assert r["status"] == "ok", r


def test_hot_key_split_in_plan(spark, no_broadcast, monkeypatch):
    import contextlib
    import io
    monkeypatch.setattr(guards, "HOT_KEY_ROWS", 3)
    monkeypatch.setattr(guards, "MAX_BROADCAST_ROWS", 150)
    df = entries()["report_deltas"].fn(spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "Union" in plan and "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_repeated_and_null_keys_fare_alike(spark, monkeypatch):
    """The size check picks a plan, never an answer."""
    from forumlens.operators import snapshots, state
    ts = "timestamp_ntz'2024-01-0%d 00:00:00'"
    posts = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (2, None), (3, "c")],
                                  "reddit_id bigint, subreddit string")
    snaps = spark.sql(" union all ".join(
        f"select bigint({i}) id, bigint({p}) post_reddit_id, {ts % d} scraped_at, bigint({s}) score, "
        f"double(0.5) upvote_ratio, bigint(1) num_comments, false is_pinned"
        for i, p, d, s in ((1, 1, 1, 5), (2, 1, 3, 9), (3, 2, 1, 1), (4, "null", 1, 1))))
    reports = spark.sql(" union all ".join(
        f"select bigint({i}) id, '{x}' subreddit, {ts % d} generated_at" for i, x, d in ((1, "a", 2), (2, "b", 1), (3, "c", 1))))
    stored = spark.sql(f"select bigint(k) reddit_id, t title, {ts % 1} first_scraped_at, {ts % 1} last_scraped_at "
                       "from values (1, 'x'), (7, 'y'), (7, 'z'), (null, 'n') v(k, t)")
    batch = spark.sql(f"select bigint(k) reddit_id, t title, {ts % 2} scraped_at, bigint(0) batch_id, bigint(p) position "
                      "from values (1, 'new', 0), (1, 'newer', 1), (9, 'q', 2), (null, 'm', 3) v(k, t, p)")
    answers = []
    for bound in (0, 2_000_000):
        monkeypatch.setattr(guards, "MAX_BROADCAST_ROWS", bound)
        answers.append([sorted(map(str, df.collect())) for df in (
            snapshots.report_deltas(posts, snaps, reports), snapshots.asof_snapshot(posts, snaps, reports),
            state.upsert_posts(stored, batch, value_cols=("title",)))])
    assert answers[0] == answers[1]
    assert len(answers[0][0]) == 5 and len(answers[0][2]) == 5
