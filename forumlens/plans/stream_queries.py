"""Streaming queries: each runs its stream to completion over
everything landed (``availableNow``) and returns the final state as a batch
DataFrame, which is what the oracle compares."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources import fixtures as fx
from ..sources.tables import table
from ..streaming import ingest as I
from ..streaming import staleness as W
from ..streaming import streams as K
from .registry import query
from .state_queries import _LISTING_BATCH_SQL


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return K.read_landed(spark, sf, "events.parquet", schema)


def _listing(events: DataFrame) -> DataFrame:
    return fx.listing_from_events(events)


def _snapshots(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("id"), F.col("user_id").alias("post_reddit_id"),
                         F.col("ts").alias("scraped_at"), F.floor(F.col("value") * 10).cast("bigint").alias("score"),
                         F.round(F.col("value") / 100.0, 4).alias("upvote_ratio"),
                         (F.col("event_id") % 97).alias("num_comments"),
                         (F.col("event_type") == "signup").alias("is_pinned"))


def _ingested(spark: SparkSession, sf: str) -> I.Tables:
    base = shared_path(spark, "streams", "ingest", uuid.uuid4().hex)
    return I.run_ingest(spark, fx.with_nested_comments(_listing(_events_stream(spark, sf))), base)


@query("stream_ingest", "K1", f"""WITH {_LISTING_BATCH_SQL},
ranked AS (select *, row_number() over (partition by reddit_id order by position desc) as rn,
                  min(scraped_at) over (partition by reddit_id) as first_seen
           from listing)
select reddit_id, subreddit, title, author, first_seen as first_scraped_at, scraped_at as last_scraped_at
from ranked where rn = 1""")
def q_stream_ingest(spark, sf):
    return I.final_state(spark, _ingested(spark, sf).posts).select(
        "reddit_id", "subreddit", "title", "author", "first_scraped_at", "last_scraped_at")


@query("stream_ingest_post_snapshots", "K1", f"""WITH {_LISTING_BATCH_SQL}
select position, reddit_id as post_reddit_id, scraped_at, score, upvote_ratio, num_comments,
       cast(is_pinned as integer) as is_pinned from listing""")
def q_stream_ingest_post_snapshots(spark, sf):
    return spark.read.parquet(_ingested(spark, sf).post_snapshots).select(
        "position", "post_reddit_id", "scraped_at", "score", "upvote_ratio", "num_comments", "is_pinned")


# The nested comments of fixtures.with_nested_comments, exploded.
_NESTED_SQL = f"""{_LISTING_BATCH_SQL},
nested AS (select position, i, scraped_at, reddit_id as post_reddit_id,
                  case when (position + i) % 11 = 0 then ''
                       when (position + i) % 13 = 0 then null
                       else 'c' || cast((reddit_id // 2) * 10 + (position + i) % 10 as varchar) end as reddit_id,
                  'note ' || cast(i as varchar) || ' ' || selftext as body, author,
                  url || '#' || cast(i as varchar) as url, score - i as score
           from (select *, unnest(range(1, position % 4 + 1)) as i from listing)),
said AS (select * from nested where coalesce(reddit_id, '') <> '')"""


@query("stream_ingest_comments", "K1", f"""WITH {_NESTED_SQL},
ranked AS (select *, row_number() over (partition by reddit_id order by scraped_at desc, position desc, i desc) as rn,
                  min(scraped_at) over (partition by reddit_id) as first_scraped_at from said)
select reddit_id, post_reddit_id, body, author, url, first_scraped_at, scraped_at as last_scraped_at
from ranked where rn = 1""")
def q_stream_ingest_comments(spark, sf):
    """Comments of the nested listings, each under the post that it was last seen at."""
    return I.final_state(spark, _ingested(spark, sf).comments).select(
        "reddit_id", "post_reddit_id", "body", "author", "url", "first_scraped_at", "last_scraped_at")


@query("stream_ingest_comment_snapshots", "K1", f"""WITH {_NESTED_SQL}
select reddit_id as comment_reddit_id, scraped_at, score, position, i - 1 as nth from said""")
def q_stream_ingest_comment_snapshots(spark, sf):
    return spark.read.parquet(_ingested(spark, sf).comment_snapshots).select(
        "comment_reddit_id", "scraped_at", "score", "position.position",
        F.col("position.cpos").cast("bigint").alias("nth"))


def _landed(spark: SparkSession, sf: str) -> I.Tables:
    base = shared_path(spark, "streams", "landed", uuid.uuid4().hex)
    listing = fx.with_nested_comments(_listing(table(spark, sf, "events"))).withColumn(
        "scraped_at", F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss"))
    fx.landed_lines(listing).write.text(f"{base}/lines")
    return I.run_landed(spark, f"{base}/lines", base)


@query("stream_listing_posts", "A2", f"""WITH {_LISTING_BATCH_SQL},
good AS (select * from listing where position % 50 <> 7 and position % 53 <> 5 and position % 61 <> 5),
ranked AS (select *, row_number() over (partition by reddit_id order by scraped_at desc, position desc) as rn,
                  min(scraped_at) over (partition by reddit_id) as first_scraped_at from good)
select cast(reddit_id as varchar) as reddit_id, subreddit, case when position % 59 = 5 then '' else title end as title,
       selftext, author, first_scraped_at, scraped_at as last_scraped_at from ranked where rn = 1""")
def q_stream_listing_posts(spark, sf):
    """A2 as a stream: posts of the landed JSON lines that keep the table's rules."""
    return I.final_state(spark, _landed(spark, sf).posts).select(
        "reddit_id", "subreddit", "title", "selftext", "author", "first_scraped_at", "last_scraped_at")


@query("stream_quarantine", "A2", f"""WITH {_LISTING_BATCH_SQL},
bad AS (select position, case when position % 50 = 7 then 'malformed'
                   when position % 53 = 5 and position % 61 = 5 then 'title,subreddit'
                   when position % 53 = 5 then 'title' when position % 61 = 5 then 'subreddit' end as violations
        from listing)
select violations, count(*) as n from bad where violations is not null group by violations""")
def q_stream_quarantine(spark, sf):
    """A2 as a stream: lines held back, counted by what is wrong about them."""
    return spark.read.parquet(_landed(spark, sf).quarantine).groupBy("violations").agg(
        F.count(F.lit(1)).alias("n"))


@query("stream_dedupe", "K2", """
select event_id as id, user_id as post_reddit_id, ts as scraped_at, cast(floor(value*10) as bigint) as score
from events""")
def q_stream_dedupe(spark, sf):
    base = shared_path(spark, "streams", "dedupe", uuid.uuid4().hex)
    # The landed file delivered twice (a replay): two sources over the same files.
    s = _snapshots(_events_stream(spark, sf)).unionByName(_snapshots(_events_stream(spark, sf)))
    out = f"{base}/out"
    keys = ["id", "post_reddit_id", "scraped_at"]
    I.run_to_end(K.deduplicated(s, keys, "scraped_at", "1 day"), K.dedupe_sink(out, keys, "scraped_at"), base)
    return spark.read.parquet(out).select("id", "post_reddit_id", "scraped_at", "score")


@query("stream_latest", "K3", """
select post_reddit_id, scraped_at, score, upvote_ratio, num_comments, is_pinned from (
  select user_id as post_reddit_id, ts as scraped_at, cast(floor(value*10) as bigint) as score,
         round(value/100.0, 4) as upvote_ratio, event_id % 97 as num_comments, event_type = 'signup' as is_pinned,
         row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from events) t where rn = 1""")
def q_stream_latest(spark, sf):
    base = shared_path(spark, "streams", "latest", uuid.uuid4().hex)
    latest = K.latest_metrics(_snapshots(_events_stream(spark, sf)), "post_reddit_id",
                              ["score", "upvote_ratio", "num_comments", "is_pinned"])
    q = (latest.writeStream.outputMode("update").foreachBatch(K.merge_updates_sink(f"{base}/state", "post_reddit_id"))
               .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return K.current_view(spark, f"{base}/state", "post_reddit_id").select(
        "post_reddit_id", "scraped_at", "score", "upvote_ratio", "num_comments", "is_pinned")


@query("stream_staleness", "K4", """
with seen as (select o_orderkey as post, max(l_shipdate) as last from orders left join lineitem on l_orderkey = o_orderkey
              group by o_orderkey),
clock as (select greatest((select max(l_shipdate) from lineitem), (select max(o_orderdate) from orders)) - interval 1 day as as_of)
select post as post_reddit_id, last as comments_scraped_at from seen, clock
where last is null or last < as_of - interval 2 hour""")
def q_stream_staleness(spark, sf):
    """Posts whose comments are stale, from keyed state with event-time timers,
    at the newest scrape seen less one day; posts without comments among them."""
    base = shared_path(spark, "streams", "staleness", uuid.uuid4().hex)
    li = K.read_landed(spark, sf, "lineitem.parquet", table(spark, sf, "lineitem").schema)
    orders = K.read_landed(spark, sf, "orders.parquet", table(spark, sf, "orders").schema)
    comments = li.select(F.col("l_orderkey").alias("post_reddit_id"), F.col("l_shipdate").alias("last_scraped_at"))
    posts = orders.select(F.col("o_orderkey").alias("reddit_id"), F.col("o_orderdate").alias("last_scraped_at"))
    out = W.run_staleness(spark, W.staleness_changes(comments, timedelta(days=1), posts), base)
    return W.stale_now(spark, out).select("post_reddit_id", "comments_scraped_at")
