"""Letter analytics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import letter_qa as Q
from ..operators import snapshots
from ..sources import fixtures as fx
from ..sources.tables import table
from .oracle_views import LETTERS_SQL, with_views
from .registry import query

# Patterns of the SQL's own, not the code's: an entry's label has no mark of its
# line's markup, a link's address no space.
_ENTRY = r"^[*][*]([\[]?)([^\n\]*]+?)([\]]?):[*][*]\s*([^\n]*)$"
_LINK = r"[\[]([^\]]+)[\]][(]([^\s)]+)[)]"
_SENTENCE = r"[!.?]+(?:\s|$)"
_TOKEN = r"^[A-Z][A-Z][A-Z]?[A-Z]?[A-Z]?$"

_M1 = f"""
ents AS (select subreddit, letter_date, unnest(range(len(e))) as entry_pos, unnest(e) as line from (
  select subreddit, letter_date,
         list_filter(regexp_split_to_array(coalesce(markdown, ''), '\\n+'),
                     lambda l: regexp_matches(l, '{_ENTRY}')
                               and regexp_extract(l, '{_ENTRY}', 2) not in ('To', 'Date', 'Subject')) as e
  from letters) t),
m1 AS (select subreddit, letter_date, entry_pos, trim(regexp_extract(line, '{_ENTRY}', 2)) as ticker,
              regexp_extract(line, '{_ENTRY}', 4) as body from ents)"""

_KIND = ("case when regexp_matches(url, '^https?://(www\\.|old\\.)?reddit\\.com/') "
         "and regexp_matches(url, '/comments/[^/]+/[^/]+/[^/]+/?$') then 'comment' "
         "when regexp_matches(url, '^https?://(www\\.|old\\.)?reddit\\.com/') "
         "and regexp_matches(url, '/comments/[^/]+(/[^/]+)?/?$') then 'post' "
         "when regexp_matches(url, '^https?://news\\.google\\.com/') then 'news' else 'external' end")

_M3 = f"""
lk AS (select subreddit, letter_date, entry_pos, unnest(range(len(tx))) as link_pos, unnest(tx) as text,
              unnest(ux) as url
       from (select subreddit, letter_date, entry_pos, regexp_extract_all(body, '{_LINK}', 1) as tx,
                    regexp_extract_all(body, '{_LINK}', 2) as ux from m1) t),
m3 AS (select subreddit, letter_date, entry_pos, link_pos, text, url, {_KIND} as kind from lk)"""


def _entries(spark, sf):
    return Q.letter_entries(fx.letters(spark, sf))


@query("letter_entries", "M1", f"""WITH {LETTERS_SQL}, {_M1}
select subreddit, letter_date, entry_pos, ticker, body from m1""")
def q_letter_entries(spark, sf):
    return _entries(spark, sf)


@query("ticker_mentions", "M2", f"""WITH {LETTERS_SQL}, {_M1},
t AS (select subreddit, letter_date, trim(unnest(string_split(ticker, '/'))) as ticker from m1)
select subreddit, letter_date, ticker, count(*) as mentions,
       row_number() over (partition by subreddit, letter_date order by count(*) desc, ticker) as rank
from t where ticker <> '' group by subreddit, letter_date, ticker""")
def q_ticker_mentions(spark, sf):
    return Q.ticker_mentions(_entries(spark, sf))


@query("entry_links", "M3", f"""WITH {LETTERS_SQL}, {_M1}, {_M3}
select subreddit, letter_date, entry_pos, link_pos, text, url, kind from m3""")
def q_entry_links(spark, sf):
    return Q.entry_links(_entries(spark, sf))


@query("letter_qa", "M4", f"""WITH {LETTERS_SQL}, {_M1},
per AS (select subreddit, letter_date, count(*) as n_entries,
               count(*) filter (where len(regexp_extract_all(body, '{_LINK}', 0)) = 0) as entries_without_link,
               max(len(regexp_extract_all(regexp_replace(body, '{_LINK}', '\\1', 'g'), '{_SENTENCE}', 0)))
                 as max_sentences
        from m1 group by subreddit, letter_date),
base AS (select subreddit, letter_date,
                regexp_matches(markdown, '(?m)^#{{1,6}} ') as has_heading,
                regexp_matches(markdown, '(?m)^\\*\\*To:\\*\\*') and regexp_matches(markdown, '(?m)^\\*\\*Date:\\*\\*')
                  and regexp_matches(markdown, '(?m)^\\*\\*Subject:\\*\\*') as header_ok,
                coalesce(starts_with(list_filter(string_split(markdown, chr(10)), lambda x: trim(x) <> '')[-1],
                                     'Link:'), false) as trailing_link_line
         from letters),
j AS (select base.subreddit, base.letter_date, cast(coalesce(n_entries, 0) as bigint) as n_entries,
             cast(coalesce(entries_without_link, 0) as bigint) as entries_without_link,
             cast(coalesce(max_sentences, 0) as bigint) as max_sentences,
             has_heading, header_ok, trailing_link_line
      from base left join per using (subreddit, letter_date))
select *, (n_entries between 8 and 12) and entries_without_link = 0 and max_sentences <= 3
          and not has_heading and header_ok and not trailing_link_line as passes
from j""")
def q_letter_qa(spark, sf):
    return Q.letter_qa(fx.letters(spark, sf))


_TEXTS_SQL = """
, ls AS (select post_reddit_id, score from (
    select post_reddit_id, score, row_number() over (partition by post_reddit_id order by scraped_at desc, id desc) rn
    from post_snapshots) t where rn = 1),
lc AS (select comment_reddit_id, score from (
    select comment_reddit_id, score,
           row_number() over (partition by comment_reddit_id order by scraped_at desc, id desc, score desc nulls last) rn
    from comment_snapshots) t where rn = 1),
texts AS (select p.title || ' ' || coalesce(p.selftext, '') as text, ls.score
          from posts p left join ls on ls.post_reddit_id = p.reddit_id
          union all
          select c.body, lc.score from comments c left join lc on lc.comment_reddit_id = c.reddit_id)"""


@query("weighted_themes", "M5", with_views(f"""{_TEXTS_SQL}
select token, cast(sum(coalesce(score, 0)) as bigint) as weighted_score, count(*) as mentions from (
  select unnest(list_filter(regexp_split_to_array(coalesce(text, ''), '[^A-Za-z0-9_]+'),
                            lambda t: regexp_matches(t, '{_TOKEN}'))) as token, score from texts) x
group by token""", "posts", "post_snapshots", "comments", "comment_snapshots"))
def q_weighted_themes(spark, sf):
    posts = fx.posts(spark, sf).select("reddit_id", "title", "selftext")
    p = snapshots.latest_post_snapshot(posts, fx.post_snapshots(spark, sf)).select(
        F.concat_ws(" ", "title", F.coalesce("selftext", F.lit(""))).alias("text"), "score")
    c = snapshots.latest_comment_snapshot(fx.comments(spark, sf).select("reddit_id", "body"),
                                          fx.comment_snapshots(spark, sf)).select(F.col("body").alias("text"), "score")
    return Q.weighted_themes(p.unionByName(c))


_SOURCES_SQL = """
src AS (select 'https://www.reddit.com/r/' || lower(c.c_mktsegment) || '/comments/' || cast(o.o_orderkey as varchar)
                 || '/order_' || cast(o.o_orderkey as varchar) || '/' as post,
               o.o_custkey, o.o_orderkey, o.o_orderstatus
        from orders o join customer c on o.o_custkey = c.c_custkey),
sources AS (select post as url from src where o_orderstatus <> 'P'
            union all select post || 'c' || cast(o_custkey as varchar) || '/' from src
            union all select 'https://news.google.com/rss/articles/' || cast(o_orderkey as varchar) from src)"""


def _sources(spark, sf):
    """Source URLs a letter may cite: posts (not the partially filled
    orders), their comments, and news items -- one pass over the orders,
    three URLs per order."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    key = o.o_orderkey.cast("string")
    post = F.concat(F.lit("https://www.reddit.com/r/"), F.lower("c_mktsegment"), F.lit("/comments/"), key,
                    F.lit("/order_"), key, F.lit("/"))
    urls = F.array(F.when(o.o_orderstatus != "P", post),
                   F.concat(post, F.lit("c"), o.o_custkey.cast("string"), F.lit("/")),
                   F.concat(F.lit("https://news.google.com/rss/articles/"), key))
    j = o.join(c, o.o_custkey == c.c_custkey).select(F.explode(urls).alias("url"))
    return j.where(F.col("url").isNotNull())


@query("link_grounding", "E10", f"""WITH {LETTERS_SQL}, {_M1}, {_M3}, {_SOURCES_SQL}
select subreddit, letter_date, entry_pos, link_pos, url, kind from m3
where url not in (select url from sources)""")
def q_link_grounding(spark, sf):
    links = Q.entry_links(_entries(spark, sf))
    return Q.link_grounding(links, _sources(spark, sf)).select(
        "subreddit", "letter_date", "entry_pos", "link_pos", "url", "kind")
