"""State maintenance and declared-constraint checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import layout, quality, state
from ..schemas import STORED
from ..session import shared_path
from ..sources import fixtures as fx
from ..sources.tables import table
from . import duck_text as D
from .news_queries import NEWS_SQL
from .oracle_views import VIEWS, with_views
from .registry import entry_sql, query

# Landed listing batches derived from events: one batch per hour of scraping
# (``scraped_at`` = the hour), ``position`` = arrival order in the batch.
_LISTING_BATCH_SQL = """
listing AS (select cast(strftime(date_trunc('hour', ts), '%Y%m%d%H') as bigint) as batch_id,
                   event_id as position, date_trunc('hour', ts) as scraped_at,
                   user_id as reddit_id, 'src' || cast(user_id % 20 as varchar) as subreddit,
                   'post ' || cast(user_id as varchar) || ' ' || event_type as title, props as selftext,
                   'https://example.com/' || cast(user_id as varchar) as url,
                   case when event_type = 'error' then null else 'u' || cast(event_id % 7 as varchar) end as author,
                   cast(null as varchar) as created_utc,
                   cast(floor(value*10) as bigint) as score, round(value/100.0, 4) as upvote_ratio,
                   event_id % 97 as num_comments, event_type = 'signup' as is_pinned
            from events)"""


def listing_batches(spark, sf):
    lst = fx.listing_from_events(table(spark, sf, "events"))
    return lst.withColumn("batch_id", F.date_format("scraped_at", "yyyyMMddHH").cast("bigint"))


def _stored_posts(spark, sf):
    return fx.posts(spark, sf).select("reddit_id", "subreddit", "title", "selftext", "url", "author",
                                      F.lit(None).cast("string").alias("created_utc"),
                                      "first_scraped_at", "last_scraped_at")


@query("upsert_posts", "B1", with_views(f""", {_LISTING_BATCH_SQL},
allrows AS (
  select reddit_id, subreddit, title, selftext, url, author, cast(null as varchar) as created_utc, 0 as src,
         cast(null as bigint) as batch_id, cast(null as bigint) as position,
         first_scraped_at, last_scraped_at from posts
  union all
  select reddit_id, subreddit, title, selftext, url, author, created_utc, 1, batch_id, position,
         scraped_at, scraped_at from listing),
ranked AS (select *, row_number() over (partition by reddit_id
             order by src desc, batch_id desc nulls last, position desc nulls last) as rn,
           min(case when src = 0 then first_scraped_at end) over (partition by reddit_id) as kept_first,
           min(first_scraped_at) over (partition by reddit_id) as any_first
           from allrows)
select reddit_id, subreddit, title, md5(selftext) as selftext_md5, url, author,
       coalesce(kept_first, any_first) as first_scraped_at, last_scraped_at
from ranked where rn = 1""", "posts"))
def q_upsert_posts(spark, sf):
    out = state.upsert_posts(_stored_posts(spark, sf), listing_batches(spark, sf))
    return out.select("reddit_id", "subreddit", "title", F.md5(F.col("selftext").cast("binary")).alias("selftext_md5"),
                      "url", "author", "first_scraped_at", "last_scraped_at")


@query("append_post_snapshots", "B2", with_views(f""", {_LISTING_BATCH_SQL}
select batch_id, position, reddit_id as post_reddit_id, scraped_at, score, upvote_ratio, num_comments,
       cast(coalesce(is_pinned, false) as integer) as is_pinned
from listing""", ))
def q_append_post_snapshots(spark, sf):
    return state.post_snapshot_rows(listing_batches(spark, sf))


@query("bucketed_upsert_posts", "B1", entry_sql("upsert_posts"))
def q_bucketed_upsert_posts(spark, sf):
    """B1 into a stored table that lies in buckets of the post id."""
    stored = layout.write_bucketed(_stored_posts(spark, sf), f"posts_{uuid.uuid4().hex}", "reddit_id", _buckets(spark))
    out = layout.merge_bucketed(stored, listing_batches(spark, sf), "reddit_id", state.POST_COLUMNS)
    return out.select("reddit_id", "subreddit", "title", F.md5(F.col("selftext").cast("binary")).alias("selftext_md5"),
                      "url", "author", "first_scraped_at", "last_scraped_at")


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Comment observations from lineitem: comment = part, post = order, one batch
# per ship date.  A part seen under several orders re-parents to the newest.
_COMMENT_BATCH_SQL = """
cobs AS (select 'c' || cast(l_partkey as varchar) as reddit_id, l_orderkey as post_reddit_id,
                'qty ' || cast(cast(l_quantity as bigint) as varchar) as body,
                case when l_returnflag = 'R' then null else 'u' || cast(l_suppkey as varchar) end as author,
                cast(null as varchar) as url, cast(null as varchar) as created_utc,
                l_shipdate as scraped_at, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                cast(l_quantity as bigint) - 10 as score
         from lineitem)"""


def comment_batches(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        F.concat(F.lit("c"), li.l_partkey.cast("string")).alias("reddit_id"),
        li.l_orderkey.alias("post_reddit_id"),
        F.concat(F.lit("qty "), li.l_quantity.cast("bigint").cast("string")).alias("body"),
        F.when(li.l_returnflag == "R", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), li.l_suppkey.cast("string"))).alias("author"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("created_utc"),
        li.l_shipdate.alias("scraped_at"), li.l_shipdate.alias("batch_id"),
        F.struct(li.l_orderkey, li.l_linenumber, li.l_partkey, li.l_suppkey).alias("position"),
        (li.l_quantity.cast("bigint") - 10).alias("score"))


@query("upsert_comments", "B3", f"""WITH {_COMMENT_BATCH_SQL},
ranked AS (select *, row_number() over (partition by reddit_id
             order by scraped_at desc, l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc) as rn,
           min(scraped_at) over (partition by reddit_id) as first_scraped_at
           from cobs)
select reddit_id, post_reddit_id, body, author, first_scraped_at, scraped_at as last_scraped_at
from ranked where rn = 1""")
def q_upsert_comments(spark, sf):
    out = state.upsert_comments(None, comment_batches(spark, sf))
    return out.select("reddit_id", "post_reddit_id", "body", "author", "first_scraped_at", "last_scraped_at")


@query("bucketed_upsert_comments", "B3", entry_sql("upsert_comments"))
def q_bucketed_upsert_comments(spark, sf):
    """B3 in two batches, the second into the first one's bucketed table:
    comments shipped from 1995 on, which may move them to other posts."""
    seen, later = (comment_batches(spark, sf).where(f"scraped_at {op} TIMESTAMP_NTZ'1995-01-01 00:00:00'")
                   for op in ("<", ">="))
    first = state.upsert_comments(None, seen)
    stored = layout.write_bucketed(first, f"comments_{uuid.uuid4().hex}", "reddit_id", _buckets(spark))
    out = layout.merge_bucketed(stored, later, "reddit_id", state.COMMENT_COLUMNS)
    return out.select("reddit_id", "post_reddit_id", "body", "author", "first_scraped_at", "last_scraped_at")


@query("append_comment_snapshots", "B4", f"""WITH {_COMMENT_BATCH_SQL}
select reddit_id as comment_reddit_id, scraped_at, score, l_orderkey, l_linenumber from cobs""")
def q_append_comment_snapshots(spark, sf):
    rows = state.comment_snapshot_rows(comment_batches(spark, sf))
    return rows.select("comment_reddit_id", "scraped_at", "score",
                       F.col("position.l_orderkey").alias("l_orderkey"),
                       F.col("position.l_linenumber").alias("l_linenumber"))


@query("append_report", "B5", with_views(f"""
, newr AS (select subreddit, max(last_scraped_at) as generated_at,
                  '**Subject:** ' || cast(count(*) as varchar) || ' posts' as markdown from posts group by subreddit)
select id, report_date, subreddit, llm_provider, llm_model, markdown, generated_at from reports
union all
select cast((select coalesce(max(id), 0) from reports) + row_number() over (order by subreddit, generated_at) as bigint),
       cast({D.new_york('generated_at')} as date), subreddit, 'p9', 'm9', markdown, generated_at
from newr""", "reports", "posts"))
def q_append_report(spark, sf):
    existing = fx.reports(spark, sf).select([f.name for f in STORED["reports"].fields])
    new = (fx.posts(spark, sf, with_text=False).groupBy("subreddit")
           .agg(F.max("last_scraped_at").alias("generated_at"), F.count(F.lit(1)).alias("n"))
           .select("subreddit", "generated_at", F.lit("p9").alias("llm_provider"), F.lit("m9").alias("llm_model"),
                   F.concat(F.lit("**Subject:** "), F.col("n").cast("string"), F.lit(" posts")).alias("markdown")))
    return state.append_reports(existing, new)


# Report-news links: the items that the report's query found on its day.
_LINK_SQL = f"""{NEWS_SQL},
news_items AS (select id, provider, query, title, url, fetched_at from nb
               union all
               select id + 1000000000, provider, query, title, url, fetched_at + interval 1 day from nb where id % 5 = 0),
links AS (select r.id as report_id, n.id as news_item_id, n.query, r.generated_at as included_at
          from reports r join news_items n
            on n.query = (['en', 'de', 'fr', 'es'])[1 + cast(substr(r.subreddit, 4) as int) % 4]
           and cast(n.fetched_at as date) = cast(r.generated_at as date))"""


@query("link_report_news", "B6", with_views(f""", {_LINK_SQL}
select distinct * from links""", "reports"))
def q_link_report_news(spark, sf):
    """The English links are stored already; all candidates come twice."""
    cand = fx.report_links(spark, sf)
    return state.link_report_news(cand.where(F.col("query") == "en"), cand.unionByName(cand))


# ---------------------------------------------------------------- C1-C3

_RELATIONS = ("posts", "comments", "post_snapshots", "comment_snapshots", "reports")


def _relations(spark, sf):
    """The seven stored relations; texts stay out where no check reads them."""
    return {"posts": fx.posts(spark, sf, with_text=False), "comments": fx.comments(spark, sf),
            "post_snapshots": fx.post_snapshots(spark, sf), "comment_snapshots": fx.comment_snapshots(spark, sf),
            "reports": fx.reports(spark, sf), "news_items": fx.news_items(spark, sf),
            "report_news_items": fx.report_links(spark, sf)}


_KEYS = {"posts": "reddit_id", "comments": "reddit_id", "post_snapshots": "id", "comment_snapshots": "id",
         "reports": "id", "news_items": "id", "report_news_items": ("report_id", "news_item_id", "query")}


def _sql_name(relation: str) -> str:
    return "links" if relation == "report_news_items" else relation


def _primary_key_sql() -> str:
    parts = []
    for name, key in _KEYS.items():
        cols = [key] if isinstance(key, str) else key
        value = " || '|' || ".join(f"cast({c} as varchar)" for c in cols)
        parts.append(f"select '{name}' as relation, {value} as key_value, count(*) as n from {_sql_name(name)} "
                     f"group by {', '.join(cols)} having count(*) > 1")
    return with_views(f", {_LINK_SQL}\n" + "\nunion all ".join(parts), *_RELATIONS)


@query("dq_primary_key", "C1", _primary_key_sql())
def q_dq_primary_key(spark, sf):
    tables = _relations(spark, sf)
    return quality.primary_key_violations({name: (tables[name], key) for name, key in _KEYS.items()})


_REFERENCES = (("comments", "post_reddit_id", "posts"), ("post_snapshots", "post_reddit_id", "posts"),
               ("comment_snapshots", "comment_reddit_id", "comments"), ("report_news_items", "report_id", "reports"),
               ("report_news_items", "news_item_id", "news_items"))


@query("dq_foreign_key", "C2", with_views(f", {_LINK_SQL}\n" + "\nunion all ".join(
    f"select '{child}.{key}' as relation, count(*) filter (where {key} not in (select {_KEYS[parent]} from {parent})) "
    f"as orphans from {_sql_name(child)}" for child, key, parent in _REFERENCES), *_RELATIONS))
def q_dq_foreign_key(spark, sf):
    tables = _relations(spark, sf)
    return quality.foreign_key_orphans([(f"{child}.{key}", tables[child], key, tables[parent], _KEYS[parent])
                                        for child, key, parent in _REFERENCES])


_NOT_NULL_SQL = with_views(f", {_LINK_SQL}\nselect * from (" + " union all ".join(
    f"select '{name}' as relation, '{c}' as column_name, count(*) filter (where {c} is null) as nulls from {_sql_name(name)}"
    for name in _KEYS for c in quality.not_null_columns(name)) + ") t", *_RELATIONS)


@query("dq_not_null", "C3", _NOT_NULL_SQL)
def q_dq_not_null(spark, sf):
    return quality.not_null_counts([(name, df, quality.not_null_columns(name))
                                    for name, df in _relations(spark, sf).items()])


@query("dq_not_null_on_write", "C3", _NOT_NULL_SQL)
def q_dq_not_null_on_write(spark, sf):
    """The same counts from the tasks that write the relations."""
    base, told = shared_path(spark, "observed", uuid.uuid4().hex), []
    for name, df in _relations(spark, sf).items():
        found = quality.write_observed(df, f"{base}/{name}", name)
        told += [(name, column, n) for column, n in found.items()]
    return spark.createDataFrame(told, "relation string, column_name string, nulls bigint")


assert VIEWS  # views used above are all defined


# ---------------------------------------------------------------- A2

@query("ingest_listing", "A2", """
select event_id as position, user_id as reddit_id, 'post ' || cast(user_id as varchar) || ' ' || event_type as title,
       case when event_type = 'error' then null else 'u' || cast(event_id % 7 as varchar) end as author,
       date_trunc('second', ts) as created_at, event_type = 'signup' as is_pinned
from events""")
def q_ingest_listing(spark, sf):
    """Listing records land as JSON lines (written here from events), then
    are read back with the fixed schema and normalised."""
    from ..functions import text as T
    from ..sources import landing
    secs = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    landed = listing_batches(spark, sf).join(
        table(spark, sf, "events").select(F.col("event_id").alias("position"),
                                          T.py_float_str(secs.cast("double")).alias("created_utc2")), "position")
    landed = (landed.drop("created_utc").withColumnRenamed("created_utc2", "created_utc")
                    .withColumn("is_pinned", F.when(F.col("is_pinned"), F.lit(True)))   # absent when false
                    .withColumn("reddit_id", F.col("reddit_id").cast("string")))
    path = shared_path(spark, "landing", uuid.uuid4().hex)
    landed.write.mode("overwrite").json(path)
    posts = landing.ingest_listing(landing.read_listing(spark, path))
    return posts.select("position", F.col("reddit_id").cast("bigint").alias("reddit_id"), "title", "author",
                        "created_at", "is_pinned")
