"""Edge rows of FIXTURES.md §4 for E1-E4 and G2."""

import datetime as dt

from forumlens.operators import snapshots as S
from forumlens.operators import threads

from conftest import rows

T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return T0 + dt.timedelta(hours=h)


SNAP = "id bigint, post_reddit_id bigint, scraped_at timestamp_ntz, score bigint, upvote_ratio double, num_comments bigint, is_pinned boolean"


def test_latest_snapshot_ties_and_missing(spark):
    posts = spark.createDataFrame([(1, "a"), (2, "a")], "reddit_id bigint, subreddit string")
    snaps = spark.createDataFrame([(10, 1, ts(1), 5, 0.5, 1, False), (11, 1, ts(1), 7, 0.6, 2, True)], SNAP)
    out = {r["reddit_id"]: r for r in S.latest_post_snapshot(posts, snaps).collect()}
    assert out[1]["score"] == 7 and out[1]["is_pinned"] is True     # same time: larger id wins
    assert out[2]["score"] is None and out[2]["is_pinned"] is False  # never scraped


def test_report_deltas_three_valued(spark):
    posts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "reddit_id bigint, subreddit string")
    reports = spark.createDataFrame([(1, "a", ts(5))], "id bigint, subreddit string, generated_at timestamp_ntz")
    snaps = spark.createDataFrame([
        (1, 1, ts(5), 10, 0.5, 3, False),   # exactly at the cutoff: as-of row
        (2, 1, ts(8), 15, 0.6, 4, False),   # current
        (3, 2, ts(9), 1, 0.1, 1, False),    # only after the report: new
        (4, 3, ts(1), 1, 0.1, 1, False),    # subreddit never reported
        (5, 4, ts(2), None, 0.2, 1, False),  # as-of score null
        (6, 4, ts(7), 9, 0.2, 1, False),
    ], SNAP)
    out = {r["reddit_id"]: r for r in S.report_deltas(posts, snaps, reports).collect()}
    assert out[1]["new_since_previous_report"] is False
    assert out[1]["score_change_since_previous_report"] == 5
    assert abs(out[1]["upvote_ratio_change_since_previous_report"] - 0.1) < 1e-9
    assert out[2]["new_since_previous_report"] is True and out[2]["score_change_since_previous_report"] is None
    assert out[3]["new_since_previous_report"] is None and out[3]["previous_report_at"] is None
    assert out[4]["new_since_previous_report"] is False and out[4]["score_change_since_previous_report"] is None
    assert out[4]["comment_count_change_since_previous_report"] == 0


def test_asof_never_after_cutoff(spark):
    posts = spark.createDataFrame([(1, "a")], "reddit_id bigint, subreddit string")
    reports = spark.createDataFrame([(1, "a", ts(5)), (2, "a", ts(3))],
                                    "id bigint, subreddit string, generated_at timestamp_ntz")
    snaps = spark.createDataFrame([(i, 1, ts(i), i, 0.1, 1, False) for i in range(10)], SNAP)
    r = S.asof_snapshot(posts, snaps, reports).collect()
    assert len(r) == 1 and r[0]["scraped_at"] == ts(5) and r[0]["previous_report_at"] == ts(5)


def test_top_comments_null_as_minus_one(spark):
    c = spark.createDataFrame([("c1", 1, "x", 3), ("c2", 1, "x", None), ("c3", 1, "x", -1), ("c4", 1, "x", -5),
                               ("c5", 1, "[deleted]", 100)],
                              "reddit_id string, post_reddit_id bigint, body string, score bigint")
    got = [r["reddit_id"] for r in threads.top_comments(c).orderBy("crank").collect()]
    assert got == ["c1", "c3", "c2", "c4"]


def test_top_comments_cap(spark):
    c = spark.createDataFrame([(f"c{i:02d}", 1, "x", i) for i in range(30)],
                              "reddit_id string, post_reddit_id bigint, body string, score bigint")
    got = rows(threads.top_comments(c, k=12), "score")
    assert [g[0] for g in got] == sorted(range(18, 30), key=repr)


def test_messages_to_prompt_parts(spark):
    msgs = spark.createDataFrame([(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(5)] +
                                 [(2, 0, "system", None)], "conv_id bigint, turn bigint, role string, text string")
    full = {r["conv_id"]: r["prompt"] for r in threads.messages_to_prompt(msgs).collect()}
    assert full[1] == "\n\n".join(f"{'USER' if t % 2 == 0 else 'ASSISTANT'}:\nm{t}" for t in range(5))
    assert full[2] == "SYSTEM:\n"
    for turns in (1, 2, 3):
        assert {r["conv_id"]: r["prompt"] for r in threads.messages_to_prompt(msgs, block_turns=turns).collect()} == full


def test_comments_by_score_puts_missing_scores_last(spark):
    c = spark.createDataFrame([("a", 1, -5), ("b", 1, None), ("c", 1, 3), ("d", 1, 3)],
                              "reddit_id string, post_reddit_id bigint, score bigint")
    got = rows(threads.comments_by_score(c), "pos", "reddit_id")
    assert got == [(1, "c"), (2, "d"), (3, "a"), (4, "b")]


def test_nest_comments_keeps_lonely_posts(spark):
    posts = spark.createDataFrame([(1,), (2,)], "reddit_id bigint")
    comments = spark.createDataFrame([("c1", 1, 5), ("c2", 1, None), ("c3", 9, 1)],
                                     "reddit_id string, post_reddit_id bigint, score bigint")
    got = rows(threads.nest_comments(posts, comments), "reddit_id", "comment_id")
    assert got == sorted([(1, "c1"), (1, "c2"), (2, None)], key=repr)
