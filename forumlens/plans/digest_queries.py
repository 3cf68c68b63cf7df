"""Snapshot, ranking, nesting and refresh queries."""

from __future__ import annotations


import uuid

from ..operators import layout, snapshots
from ..sources import fixtures as fx
from .oracle_views import with_views
from .registry import entry_sql, query

# ---------------------------------------------------------------- E1 / E2 / G1

_LATEST_SNAP_SQL = """
ls AS (select post_reddit_id, scraped_at, score, upvote_ratio, num_comments, is_pinned,
              row_number() over (partition by post_reddit_id order by scraped_at desc, id desc) as rn
       from post_snapshots)"""


@query("latest_post_snapshot", "E1", with_views(f""", {_LATEST_SNAP_SQL}
select p.reddit_id, p.subreddit, p.title, ls.scraped_at, ls.score, ls.upvote_ratio,
       ls.num_comments, coalesce(ls.is_pinned, false) as is_pinned
from posts p left join ls on ls.post_reddit_id = p.reddit_id and ls.rn = 1""",
    "posts", "post_snapshots"))
def q_latest_post_snapshot(spark, sf):
    posts = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit", "title")
    return snapshots.latest_post_snapshot(posts, fx.post_snapshots(spark, sf)).select(
        "reddit_id", "subreddit", "title", "scraped_at", "score", "upvote_ratio",
        "num_comments", "is_pinned")


_LATEST_CSNAP_SQL = """
lc AS (select comment_reddit_id, score,
              row_number() over (partition by comment_reddit_id
                                 order by scraped_at desc, id desc, score desc nulls last) as rn
       from comment_snapshots)"""


@query("latest_comment_snapshot", "E2", with_views(f""", {_LATEST_CSNAP_SQL}
select c.reddit_id, c.post_reddit_id, c.author, lc.score
from comments c left join lc on lc.comment_reddit_id = c.reddit_id and lc.rn = 1""",
    "comments", "comment_snapshots"))
def q_latest_comment_snapshot(spark, sf):
    c = fx.comments(spark, sf).select("reddit_id", "post_reddit_id", "author")
    return snapshots.latest_comment_snapshot(c, fx.comment_snapshots(spark, sf)).select(
        "reddit_id", "post_reddit_id", "author", "score")


@query("latest_per_key", "G1", with_views("""
select post_reddit_id, id, scraped_at, score, rn from (
  select post_reddit_id, id, scraped_at, score,
         row_number() over (partition by post_reddit_id order by scraped_at desc, id desc) as rn
  from post_snapshots) t where rn <= 3""", "post_snapshots"))
def q_latest_per_key(spark, sf):
    s = fx.post_snapshots(spark, sf).select("post_reddit_id", "id", "scraped_at", "score")
    return snapshots.latest_per_key(s, "post_reddit_id", k=3)


# ---------------------------------------------------------------- F2 / E3 / E4

@query("latest_report", "F2", with_views("""
select subreddit, generated_at as previous_report_at, id as previous_report_id from (
  select subreddit, generated_at, id,
         row_number() over (partition by subreddit order by generated_at desc, id desc) as rn
  from reports) t where rn = 1""", "reports"))
def q_latest_report(spark, sf):
    return snapshots.latest_report(fx.reports(spark, sf))


_CUT_SQL = """
cut AS (select subreddit, generated_at as previous_report_at from (
          select subreddit, generated_at,
                 row_number() over (partition by subreddit order by generated_at desc, id desc) as rn
          from reports) t where rn = 1),
pc AS (select p.reddit_id, p.subreddit, cut.previous_report_at from posts p left join cut using (subreddit))"""


@query("asof_snapshot", "E3", with_views(f""", {_CUT_SQL}
select post_reddit_id, scraped_at, score, upvote_ratio, num_comments, is_pinned, previous_report_at from (
  select s.post_reddit_id, s.scraped_at, s.score, s.upvote_ratio, s.num_comments, s.is_pinned,
         pc.previous_report_at,
         row_number() over (partition by s.post_reddit_id order by s.scraped_at desc, s.id desc) as rn
  from post_snapshots s join pc on pc.reddit_id = s.post_reddit_id
  where s.scraped_at <= pc.previous_report_at) t
where rn = 1""", "posts", "post_snapshots", "reports"))
def q_asof_snapshot(spark, sf):
    posts = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit")
    return snapshots.asof_snapshot(posts, fx.post_snapshots(spark, sf), fx.reports(spark, sf))


REPORT_DELTAS_SQL = with_views(f""", {_CUT_SQL}, {_LATEST_SNAP_SQL},
prev AS (select post_reddit_id, score, upvote_ratio, num_comments from (
           select s.post_reddit_id, s.score, s.upvote_ratio, s.num_comments,
                  row_number() over (partition by s.post_reddit_id order by s.scraped_at desc, s.id desc) as rn
           from post_snapshots s join pc on pc.reddit_id = s.post_reddit_id
           where s.scraped_at <= pc.previous_report_at) t where rn = 1)
select pc.reddit_id, pc.subreddit, ls.score, ls.upvote_ratio, ls.num_comments,
       coalesce(ls.is_pinned, false) as is_pinned, pc.previous_report_at,
       case when pc.previous_report_at is null then null else prev.post_reddit_id is null end
         as new_since_previous_report,
       ls.score - prev.score as score_change_since_previous_report,
       ls.num_comments - prev.num_comments as comment_count_change_since_previous_report,
       ls.upvote_ratio - prev.upvote_ratio as upvote_ratio_change_since_previous_report
from pc
left join ls on ls.post_reddit_id = pc.reddit_id and ls.rn = 1
left join prev on prev.post_reddit_id = pc.reddit_id""", "posts", "post_snapshots", "reports")


@query("report_deltas", "E4", REPORT_DELTAS_SQL)
def q_report_deltas(spark, sf):
    posts = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit")
    return snapshots.report_deltas(posts, fx.post_snapshots(spark, sf), fx.reports(spark, sf))


# ------------------------------------------------- E3 / E4 at every report, and from snapshot to snapshot

@query("report_history", "E3", with_views("""
, taken AS (select post_reddit_id, scraped_at, score, upvote_ratio, num_comments, is_pinned from (
    select *, row_number() over (partition by post_reddit_id, scraped_at order by id desc) as rn
    from post_snapshots) t where rn = 1),
asked AS (select p.reddit_id as post_reddit_id, r.subreddit, r.id as report_id, r.generated_at
          from posts p join reports r using (subreddit)),
now AS (select a.*, t.scraped_at, t.score, t.upvote_ratio, t.num_comments, t.is_pinned
        from asked a asof left join taken t
          on a.post_reddit_id = t.post_reddit_id and a.generated_at >= t.scraped_at)
select *, lag(generated_at) over w as previous_report_at,
       case when lag(report_id) over w is not null then lag(scraped_at) over w is null end as new_since_previous_report,
       score - lag(score) over w as score_change,
       num_comments - lag(num_comments) over w as num_comments_change,
       upvote_ratio - lag(upvote_ratio) over w as upvote_ratio_change
from now window w as (partition by post_reddit_id order by generated_at, report_id)""",
    "posts", "post_snapshots", "reports"))
def q_report_history(spark, sf):
    posts = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit")
    return snapshots.report_history(posts, fx.post_snapshots(spark, sf), fx.reports(spark, sf))


@query("snapshot_trend", "G1", with_views("""
select post_reddit_id, id, scraped_at, score, lag(scraped_at) over w as previous_scraped_at,
       score - lag(score) over w as score_change, num_comments - lag(num_comments) over w as num_comments_change,
       upvote_ratio - lag(upvote_ratio) over w as upvote_ratio_change
from post_snapshots window w as (partition by post_reddit_id order by scraped_at, id)""", "post_snapshots"))
def q_snapshot_trend(spark, sf):
    return snapshots.snapshot_trend(fx.post_snapshots(spark, sf))


@query("bucketed_latest_snapshot", "E1", entry_sql("latest_post_snapshot"))
def q_bucketed_latest_snapshot(spark, sf):
    """E1 over tables that lie in buckets of the post id."""
    name, n = uuid.uuid4().hex, int(spark.conf.get("spark.sql.shuffle.partitions"))
    posts = layout.write_bucketed(fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit", "title"),
                                  f"posts_{name}", "reddit_id", n)
    series = layout.write_bucketed(fx.post_snapshots(spark, sf), f"post_snapshots_{name}", "post_reddit_id", n)
    return layout.latest_bucketed(posts, series).select(
        "reddit_id", "subreddit", "title", "scraped_at", "score", "upvote_ratio", "num_comments", "is_pinned")
