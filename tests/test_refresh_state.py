"""Edge rows for refresh (E6, D4, A3, D1) and state."""

import datetime as dt

from pyspark.sql import functions as F

from forumlens.operators import refresh as R
from forumlens.operators import state as S
from forumlens.sources.tables import ntz

from conftest import rows

T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return T0 + dt.timedelta(hours=h)


def test_stale_posts_boundary(spark):
    posts = spark.createDataFrame([(1,), (2,), (3,)], "reddit_id bigint")
    comments = spark.createDataFrame([(1, ts(3)), (2, ts(2.99))], "post_reddit_id bigint, last_scraped_at timestamp_ntz")
    got = rows(R.stale_posts(posts, posts, comments, ntz("2024-01-01 05:00:00")), "reddit_id")
    assert got == [(2,), (3,)]     # exactly as_of - 2h is fresh; no comments is stale


def test_skip_pinned_may_return_fewer(spark):
    pinned = [True, True, False, True, True, True, False]
    listing = spark.createDataFrame([("s", i, 100 - i, p) for i, p in enumerate(pinned)],
                                    "subreddit string, reddit_id bigint, score bigint, is_pinned boolean")
    got = rows(R.skip_pinned(listing, 2, R.listing_order("top")), "reddit_id")
    assert got == [(2,)]


def test_ingest_comments_cap_then_body(spark):
    data = [(f"c{i}", 1, i, None if i == 49 else "b") for i in range(51)]
    c = spark.createDataFrame(data, "reddit_id string, post_reddit_id bigint, position bigint, body string")
    assert R.ingest_comments(c).count() == 49


def test_valid_keys(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "reddit_id string")
    assert rows(R.valid_keys(df)) == [("x",)]


BATCH = ("batch_id bigint, position bigint, scraped_at timestamp_ntz, reddit_id string, subreddit string, "
         "title string, selftext string, url string, author string, created_utc string, score bigint, "
         "upvote_ratio double, num_comments bigint, is_pinned boolean")
STORED = ("reddit_id string, subreddit string, title string, selftext string, url string, author string, "
          "created_utc string, first_scraped_at timestamp_ntz, last_scraped_at timestamp_ntz")


def _batch(spark):
    return spark.createDataFrame([
        (7, 0, ts(10), "p1", "s", "first", "", "u", "alice", None, 1, 0.5, 1, False),
        (7, 1, ts(10), "p1", "s", "second", "", "u", None, None, 2, 0.5, 1, False),   # last duplicate wins
        (7, 2, ts(10), "p2", "s", "new", "", "u", "bob", None, 3, 0.5, 1, True),
        (7, 3, ts(10), "", "s", "no id", "", "u", "x", None, 3, 0.5, 1, True),
    ], BATCH)


def test_upsert_posts_semantics(spark):
    stored = spark.createDataFrame([("p1", "s", "old", "", "u", "carol", None, ts(1), ts(2))], STORED)
    out = {r["reddit_id"]: r for r in S.upsert_posts(stored, _batch(spark)).collect()}
    assert set(out) == {"p1", "p2"}
    assert out["p1"]["title"] == "second" and out["p1"]["author"] is None      # null overwrites
    assert out["p1"]["first_scraped_at"] == ts(1) and out["p1"]["last_scraped_at"] == ts(10)
    assert out["p2"]["first_scraped_at"] == ts(10)
    assert S.post_snapshot_rows(_batch(spark)).count() == 3                    # one per occurrence


def test_upsert_replay_idempotent(spark):
    stored = spark.createDataFrame([("p1", "s", "old", "", "u", "carol", None, ts(1), ts(2))], STORED)
    once = S.upsert_posts(stored, _batch(spark))
    twice = S.upsert_posts(once, _batch(spark))
    assert rows(once) == rows(twice)
    split = S.upsert_posts(S.upsert_posts(stored, _batch(spark).where("position < 2")),
                           _batch(spark).where("position >= 2"))
    assert rows(split) == rows(once)


def test_upsert_comments_reparent(spark):
    b = spark.createDataFrame([(1, 0, ts(1), "c1", "p1", "x", "a", None, None),
                               (2, 0, ts(2), "c1", "p2", "y", "a", None, None)],
                              "batch_id bigint, position bigint, scraped_at timestamp_ntz, reddit_id string, "
                              "post_reddit_id string, body string, author string, url string, created_utc string")
    r = S.upsert_comments(None, b).first()
    assert r["post_reddit_id"] == "p2" and r["first_scraped_at"] == ts(1)


def test_link_report_news_insert_or_ignore(spark):
    existing = spark.createDataFrame([(1, 10, "q", ts(0))], "report_id bigint, news_item_id bigint, query string, included_at timestamp_ntz")
    cand = spark.createDataFrame([(1, 10, "q", ts(5)), (1, None, "q", ts(5)), (1, 11, "q", ts(5)), (1, 11, "q", ts(5))],
                                 "report_id bigint, news_item_id bigint, query string, included_at timestamp_ntz")
    got = rows(S.link_report_news(existing, cand), "report_id", "news_item_id", "included_at")
    assert got == sorted([(1, 10, ts(0)), (1, 11, ts(5))], key=repr)


def test_append_reports_ids(spark):
    existing = spark.createDataFrame([(5, "a", ts(1))], "id bigint, subreddit string, generated_at timestamp_ntz")
    new = spark.createDataFrame([("b", ts(2)), ("a", ts(2))], "subreddit string, generated_at timestamp_ntz")
    got = rows(S.append_reports(existing, new), "id", "subreddit")
    assert got == sorted([(5, "a"), (6, "a"), (7, "b")], key=repr)


def test_quarantine_not_null(spark):
    b = _batch(spark).withColumn("title", F.when(F.col("position") == 2, F.lit(None)).otherwise(F.col("title")))
    clean, held = S.quarantine(b, S.POST_NOT_NULL)
    assert clean.count() == 3 and rows(held, "position", "violations") == [(2, "title")]
    out = {r["reddit_id"] for r in S.upsert_posts(None, clean).collect()}
    assert out == {"p1"}


def test_versioned_write_and_fixed_schema_read(spark):
    from forumlens.sources.tables import read_relation
    stored = spark.createDataFrame([("p1", "s", "old", "", "u", "carol", None, ts(1), ts(2))], STORED)
    once = S.upsert_posts(stored, _batch(spark))
    path = S.write_version(once, spark, "posts_test", 1)
    back = read_relation(spark, path, "posts")
    assert [f.name for f in back.schema.fields][:3] == ["reddit_id", "subreddit", "title"]
    assert rows(back.select(*once.columns)) == rows(once)


def test_attach_only_refreshed_and_refresh_set(spark):
    batch = spark.createDataFrame([(1,), (2,), (3,)], "reddit_id bigint")
    fetched = spark.createDataFrame([("c1", 1), ("c2", 1), ("c3", 2)], "reddit_id string, post_reddit_id bigint")
    new = spark.createDataFrame([(1,), (9,)], "reddit_id bigint")
    stale = spark.createDataFrame([(1,), (3,)], "reddit_id bigint")
    refresh_ids = R.refresh_set(new, stale)
    assert rows(refresh_ids) == [(1,), (3,), (9,)]
    got = rows(R.attach_fetched_comments(batch, fetched, refresh_ids), "reddit_id", "comment_id")
    # post 2 was not refreshed: its fetched comment is not attached (empty list)
    assert got == sorted([(1, "c1"), (1, "c2"), (2, None), (3, None)], key=repr)
    assert [r[0] for r in R.refresh_worklist(refresh_ids).collect()] == [1, 3, 9]


def test_existing_and_new_ids(spark):
    batch = spark.createDataFrame([(1,), (2,), (5,)], "reddit_id bigint")
    posts = spark.createDataFrame([(1,), (5,), (7,)], "reddit_id bigint")
    assert rows(R.existing_ids(batch, posts)) == [(1,), (5,)]
    assert rows(R.new_ids(batch, posts)) == [(2,)]
    empty = spark.createDataFrame([], "reddit_id bigint")
    assert R.by_id_list(posts, empty).count() == 0          # an empty id list gives nothing
