"""New/stale detection, comment refresh and listing filters (SURVEY A3, D1-D4,
E5, E6, E8, E9, F1, H5, H6, I1, I2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import refresh, snapshots
from ..sources import fixtures as fx
from ..sources.tables import ntz, table
from .oracle_views import with_views
from .registry import query

AS_OF = "2024-01-01 05:00:00"   # refresh check time for the fixture comments

_STALE_SQL = f"""
ex AS (select reddit_id from listing_batch_ids intersect select reddit_id from posts),
nw AS (select reddit_id from listing_batch_ids except select reddit_id from posts),
fresh AS (select distinct post_reddit_id from comments
          where date_diff('second', last_scraped_at, timestamp '{AS_OF}') <= 7200),
st AS (select reddit_id from ex
       where not exists (select 1 from fresh where fresh.post_reddit_id = ex.reddit_id)),
rs AS (select reddit_id from nw union select reddit_id from st)"""
_STALE_VIEWS = ("posts", "comments", "listing_batch_ids")


def _refresh_parts(spark, sf):
    batch = fx.listing_batch_ids(spark, sf)
    posts = fx.posts(spark, sf, with_text=False).select("reddit_id")
    existing = refresh.existing_ids(batch, posts)
    new = refresh.new_ids(batch, posts)
    stale = refresh.stale_posts(existing, posts, fx.comments(spark, sf), ntz(AS_OF))
    return batch, existing, new, stale


@query("existing_ids", "E5", with_views(f", {_STALE_SQL}\nselect reddit_id from ex", *_STALE_VIEWS))
def q_existing_ids(spark, sf):
    return _refresh_parts(spark, sf)[1]


@query("new_ids", "I1", with_views(f", {_STALE_SQL}\nselect reddit_id from nw", *_STALE_VIEWS))
def q_new_ids(spark, sf):
    return _refresh_parts(spark, sf)[2]


@query("stale_posts", "E6", with_views(f", {_STALE_SQL}\nselect reddit_id from st", *_STALE_VIEWS))
def q_stale_posts(spark, sf):
    return _refresh_parts(spark, sf)[3]


@query("refresh_set", "I2", with_views(f", {_STALE_SQL}\nselect reddit_id from rs", *_STALE_VIEWS))
def q_refresh_set(spark, sf):
    _, _, new, stale = _refresh_parts(spark, sf)
    return refresh.refresh_set(new, stale)


@query("refresh_worklist", "H6", with_views(f", {_STALE_SQL}\nselect reddit_id from rs order by reddit_id",
                                            *_STALE_VIEWS))
def q_refresh_worklist(spark, sf):
    return refresh.refresh_worklist(q_refresh_set(spark, sf))


@query("last_comment_scrape", "F1", with_views("""
select post_reddit_id, max(last_scraped_at) as comments_scraped_at from volume_comments group by post_reddit_id""",
    "volume_comments"))
def q_last_comment_scrape(spark, sf):
    return refresh.last_comment_scrape(fx.volume_comments(spark, sf))


_FETCHED_SQL = """
fetched AS (select reddit_id, post_reddit_id, turn as position, body from (
  select c.*, row_number() over (partition by post_reddit_id order by turn) as rn from comments c) t
  where rn <= 50 and body is not null)"""


def _fetched(spark, sf):
    c = fx.comments(spark, sf).select("reddit_id", "post_reddit_id", F.col("turn").alias("position"), "body")
    return refresh.ingest_comments(c)


@query("ingest_comments", "A3", with_views(f", {_FETCHED_SQL}\nselect reddit_id, post_reddit_id, position from fetched",
                                           "comments"))
def q_ingest_comments(spark, sf):
    return _fetched(spark, sf).select("reddit_id", "post_reddit_id", "position")


@query("attach_fetched_comments", "E8", with_views(f""", {_STALE_SQL}, {_FETCHED_SQL}
select b.reddit_id, f.reddit_id as comment_id
from listing_batch_ids b
left join (select * from fetched where post_reddit_id in (select reddit_id from rs)) f
  on f.post_reddit_id = b.reddit_id""", *_STALE_VIEWS))
def q_attach_fetched_comments(spark, sf):
    batch, _, new, stale = _refresh_parts(spark, sf)
    return refresh.attach_fetched_comments(batch, _fetched(spark, sf).select("reddit_id", "post_reddit_id"),
                                           refresh.refresh_set(new, stale))


@query("ordered_lookup", "E9", with_views("""
select e.event_id as pos, p.reddit_id, p.title
from events e join posts p on p.reddit_id = e.user_id""", "posts"))
def q_ordered_lookup(spark, sf):
    ids = table(spark, sf, "events").select(F.col("event_id").alias("pos"), F.col("user_id").alias("reddit_id"))
    posts = fx.posts(spark, sf, with_text=False).select("reddit_id", "title")
    return refresh.ordered_lookup(ids, posts).select("pos", "reddit_id", "title")


@query("valid_keys", "D1", """
select page_id, regexp_extract(url, '/([0-9]+)$', 1) as reddit_id from pages
where coalesce(regexp_extract(url, '/([0-9]+)$', 1), '') <> ''""")
def q_valid_keys(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", r"/([0-9]+)$", 1).alias("reddit_id"))
    return refresh.valid_keys(p)


@query("by_subreddit", "D2", with_views("select reddit_id, title from posts where subreddit = 'src3'", "posts"))
def q_by_subreddit(spark, sf):
    return refresh.by_subreddit(fx.posts(spark, sf, with_text=False), "src3").select("reddit_id", "title")


@query("by_id_list", "D3", with_views("""
select reddit_id, subreddit from posts where reddit_id in (select doc_id from labels)""", "posts"))
def q_by_id_list(spark, sf):
    ids = table(spark, sf, "labels").select(F.col("doc_id").alias("reddit_id"))
    return refresh.by_id_list(fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit"), ids)


_LISTING_SQL = """
, ls AS (select post_reddit_id, score, is_pinned from (
    select s.*, row_number() over (partition by post_reddit_id order by scraped_at desc, id desc) rn
    from post_snapshots s) t where rn = 1),
listing AS (select p.reddit_id, p.subreddit, p.first_scraped_at as created_at, ls.score,
                   coalesce(ls.is_pinned, false) as is_pinned
            from posts p left join ls on ls.post_reddit_id = p.reddit_id)"""


def _listing(spark, sf):
    p = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit",
                                                     F.col("first_scraped_at").alias("created_at"))
    return snapshots.latest_post_snapshot(p, fx.post_snapshots(spark, sf)).select(
        "reddit_id", "subreddit", "created_at", "score", "is_pinned")


@query("skip_pinned", "D4", with_views(f"""{_LISTING_SQL}
select subreddit, reddit_id, listing_pos from (
  select subreddit, reddit_id, row_number() over (partition by subreddit order by rn) as listing_pos from (
    select l.*, row_number() over (partition by subreddit order by score desc nulls last, reddit_id asc) as rn
    from listing l) a
  where rn <= 30 and not is_pinned) b
where listing_pos <= 10""", "posts", "post_snapshots"))
def q_skip_pinned(spark, sf):
    return refresh.skip_pinned(_listing(spark, sf), 10, refresh.listing_order("top")).select(
        "subreddit", "reddit_id", "listing_pos")


@query("listing_order", "H5", with_views(f"""{_LISTING_SQL},
landed AS (select *, (reddit_id * 7919) % 100003 as hot_rank, (reddit_id * 104729) % 100019 as rising_rank from listing)
""" + " union all ".join(f"""
select '{mode}' as mode, subreddit, reddit_id,
       row_number() over (partition by subreddit order by {by}, reddit_id asc) as listing_rank
from landed""" for mode, by in (("top", "score desc nulls last"), ("new", "created_at desc"), ("hot", "hot_rank"),
                                ("rising", "rising_rank"))), "posts", "post_snapshots"))
def q_listing_order(spark, sf):
    """All four orders; the remote service's ranks of hot and rising come with
    the landed listing (here made of the id)."""
    landed = _listing(spark, sf).withColumns({"hot": F.col("reddit_id") * 7919 % 100003,
                                              "rising": F.col("reddit_id") * 104729 % 100019})
    out = None
    for mode in ("top", "new", "hot", "rising"):
        rows = landed.withColumn("listing_rank", F.col(mode)) if mode in ("hot", "rising") else landed
        part = refresh.listed(rows, mode).select(F.lit(mode).alias("mode"), "subreddit", "reddit_id",
                                                 F.col("listing_pos").alias("listing_rank"))
        out = part if out is None else out.unionByName(part)
    return out
