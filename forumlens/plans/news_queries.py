"""News queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import news_text as N
from ..operators import news, quality
from ..sources import fixtures as fx
from ..sources.tables import table
from . import duck_text as D
from .registry import query

NEWS_SQL = f"""
nb AS (
  select page_id as id, 'google_news' as provider,
         regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) as query,
         {D.clean_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} as title,
         url, regexp_extract(url, '^https?://([^/?#]+)', 1) as source_name,
         case page_id % 5
           when 0 then strftime(ts0, '%a, %d %b %Y %H:%M:%S') || ' GMT'
           when 1 then strftime(ts0, '%a, %d %b %Y %H:%M:%S') || ' -0400'
           when 2 then strftime(ts0, '%a, %d %b %Y %H:%M:%S')
           when 3 then strftime(ts0, '%a, %d %b %Y %H:%M:%S') || ' EST'
           else case when page_id % 10 = 4 then strftime(ts0, '%Y-%m-%dT%H:%M:%S') else 'soon' end end
           as published_raw,
         {D.clean_text("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} as summary,
         timestamp '2024-01-01 00:00:00' + to_minutes(page_id) as fetched_at
  from (select *, timestamp '2024-01-01 00:00:00' + to_hours(page_id) as ts0 from pages) p)"""

_RESP = """
resp AS (select conv_id, turn, text from conversations where role = 'assistant'),
lines AS (select conv_id, turn, unnest(range(len(arr))) as line_pos, unnest(arr) as line
          from (select conv_id, turn, string_split({strip}, chr(10)) as arr from resp) t)""".format(
    strip=D.strip("coalesce(text, '')"))


def _responses(spark, sf):
    return table(spark, sf, "conversations").where(F.col("role") == "assistant").select("conv_id", "turn", "text")


# ---------------------------------------------------------------- J9 / L2 / J10

@query("clean_text", "J9", f"""
select page_id, {D.clean_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} as title,
       {D.clean_text("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} as article
from pages""")
def q_clean_text(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id",
                    N.clean_text(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)).alias("title"),
                    N.clean_text(F.regexp_extract("html", r"(?s)<article>(.*)</article>", 1)).alias("article"))


@query("unescape_html", "L2", f"""
select page_id, {D.clean_text("html")} as text from pages""")
def q_unescape_html(spark, sf):
    """Entity decoding of every whole page."""
    p = table(spark, sf, "pages")
    return p.select("page_id", N.clean_text(F.col("html")).alias("text"))


@query("parse_rfc822", "J10", f"""WITH {NEWS_SQL}
select id, published_raw, {D.rfc822('published_raw')} as published_at from nb""")
def q_parse_rfc822(spark, sf):
    b = fx._page_news_base(spark, sf)
    return b.select("id", "published_raw", N.parse_rfc822(F.col("published_raw")).alias("published_at"))


# ---------------------------------------------------------------- A4

@query("ingest_rss", "A4", f"""WITH {NEWS_SQL},
pl AS (select nb.*, cast(floor(id / 10) as bigint) as bucket,
              case when id % 7 = 0 then '' else title end as t2,
              row_number() over (partition by query, floor(id / 10) order by id) - 1 as item_pos
       from nb),
cl AS (select query, bucket, item_pos, {D.clean_text('t2')} as title, {D.clean_text('url')} as url,
              {D.clean_text('source_name')} as source_name, {D.rfc822('published_raw')} as published_at,
              summary
       from pl)
select query, bucket, item_pos, title, url, source_name, published_at, summary, 'google_news' as provider
from (select cl.*, row_number() over (partition by query, bucket order by item_pos) as rn
      from cl where title <> '' and url <> '') t
where rn <= 3""")
def q_ingest_rss(spark, sf):
    return news.ingest_rss(fx.rss_payloads(spark, sf), ["query", "bucket"]).select(
        "query", "bucket", "item_pos", "title", "url", "source_name", "published_at", "summary", "provider")


# ---------------------------------------------------------------- C4

_ITEMS = """
items AS (select id, provider, query, url, fetched_at from nb
          union all
          select id + 1000000000, provider, query, url, fetched_at + interval 1 day from nb where id % 5 = 0)"""


@query("dedupe_news", "C4", f"""WITH {NEWS_SQL}, {_ITEMS}
select id, provider, query, url, fetched_at from (
  select items.*, row_number() over (partition by provider, query, url order by fetched_at, id) as rn
  from items) t where rn = 1""")
def q_dedupe_news(spark, sf):
    items = fx.news_items(spark, sf).select("id", "provider", "query", "url", "fetched_at")
    return quality.dedupe_news(items)


# ---------------------------------------------------------------- G5 / F6

_CAPPED = f"""
ci AS (select * from (
  select nb.*, {D.rfc822('published_raw')} as published_at,
         row_number() over (partition by query order by id) as irank from nb) t where irank <= 3),
listed AS (select subreddit, query, row_number() over (partition by subreddit order by n desc, query) as qrank from (
  select source as subreddit, lang || case doc_id % 3 when 0 then '' else '-' || cast(doc_id % 3 as varchar) end as query,
         count(*) as n from documents group by all)),
capped AS (select listed.subreddit, listed.qrank, ci.* from listed join ci using (query) where qrank <= 8)"""


def _capped(spark, sf):
    items = fx._page_news_base(spark, sf).withColumn("published_at", N.parse_rfc822(F.col("published_raw")))
    return news.cap_per_query(fx.news_queries(spark, sf), items, ["subreddit"], F.col("id"))


@query("cap_per_query", "G5", f"""WITH {NEWS_SQL}, {_CAPPED}
select subreddit, query, id, qrank, irank from capped""")
def q_cap_per_query(spark, sf):
    return _capped(spark, sf).select("subreddit", "query", "id", "qrank", "irank")


_ITEM_BLOCK = (f"concat_ws(chr(10), '{N.ITEM_TITLE}' || coalesce(title, ''), "
               f"case when coalesce(source_name, '') <> '' then '{N.ITEM_SOURCE}' || source_name end, "
               f"case when coalesce(published_at, '') <> '' then '{N.ITEM_PUBLISHED}' || published_at end, "
               f"case when coalesce(summary, '') <> '' then '{N.ITEM_SUMMARY}' || summary end, "
               f"'{N.ITEM_URL}' || coalesce(url, ''))")


NEWS_CONTEXT_SQL = f"""WITH {NEWS_SQL}, {_CAPPED},
qb AS (select subreddit, qrank,
              query || ':' || chr(10) || string_agg({_ITEM_BLOCK}, chr(10) order by irank) as qb
       from capped group by subreddit, query, qrank)
select subreddit, '{N.NEWS_CONTEXT_HEADER}' || chr(10) || string_agg(qb, chr(10) order by qrank) || chr(10)
       as news_context
from qb group by subreddit"""


@query("news_context", "F6", NEWS_CONTEXT_SQL)
def q_news_context(spark, sf):
    return news.news_context(_capped(spark, sf), ["subreddit"])


# ---------------------------------------------------------------- L5 / D8 / J16 / J15

@query("query_line_clean", "J16", f"""WITH {_RESP}
select conv_id, turn, line_pos, {D.query_clean('line')} as clean from lines""")
def q_query_line_clean(spark, sf):
    return news.response_lines(_responses(spark, sf), ["conv_id", "turn"]).select(
        "conv_id", "turn", "line_pos", "clean")


@query("query_line_filter", "D8", f"""WITH {_RESP}
select conv_id, turn, line_pos, clean from (
  select conv_id, turn, line_pos, {D.query_clean('line')} as clean from lines) t
where {D.query_keep('clean')}""")
def q_query_line_filter(spark, sf):
    from ..functions import text as T
    l = news.response_lines(_responses(spark, sf), ["conv_id", "turn"])
    return l.where(T.query_line_keep(F.col("clean"))).select("conv_id", "turn", "line_pos", "clean")


_EXTRACT = f"""
kept AS (select conv_id, turn, line_pos, clean from (
  select conv_id, turn, line_pos, {D.query_clean('line')} as clean from lines) t
  where {D.query_keep('clean')}),
q AS (select * from (
  select conv_id, turn, row_number() over (partition by conv_id, turn order by line_pos) as qpos,
         clean as query from kept) t where qpos <= 8)"""


@query("extract_queries", "L5", f"""WITH {_RESP}, {_EXTRACT}
select conv_id, turn, qpos, query from q""")
def q_extract_queries(spark, sf):
    return news.extract_queries(_responses(spark, sf), ["conv_id", "turn"])


@query("news_fetch_worklist", "J15", f"""WITH {_RESP}, {_EXTRACT}
select conv_id, turn, qpos,
       'https://news.google.com/rss/search?q=' || replace(url_encode(query), '%20', '+')
         || '&hl=en-US&gl=US&ceid=US%3Aen' as url
from q""")
def q_news_fetch_worklist(spark, sf):
    q = news.extract_queries(_responses(spark, sf), ["conv_id", "turn"])
    return q.select("conv_id", "turn", "qpos", N.news_search_url(F.col("query")).alias("url"))
