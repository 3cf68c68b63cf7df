"""The fixture projections as DuckDB SQL, inlined as CTEs in oracle queries.

Same semantics as ``sources/fixtures.py``; only the raw driver tables are
registered in the oracle, so each oracle query carries the views it reads.
"""

from __future__ import annotations

VIEWS = {
    "post_snapshots": """
        select event_id as id, user_id as post_reddit_id, ts as scraped_at,
               cast(floor(value*10) as bigint) as score, round(value/100.0, 4) as upvote_ratio,
               event_id % 97 as num_comments, event_type = 'signup' as is_pinned
        from events""",
    "posts": """
        select d.doc_id as reddit_id, d.source as subreddit, split_part(d.text, chr(10), 1) as title,
               substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) as selftext,
               case when d.doc_id % 3 = 0
                    then 'https://www.reddit.com/r/' || d.source || '/comments/' || cast(d.doc_id as varchar) || '/'
                    else 'https://' || d.source || '.example.com/p/' || cast(d.doc_id as varchar) end as url,
               d.lang as author,
               coalesce(e.f, timestamp '2024-01-01 00:00:00') as first_scraped_at,
               coalesce(e.l, timestamp '2024-01-01 00:00:00') as last_scraped_at
        from documents d
        left join (select user_id, min(ts) f, max(ts) l from events group by user_id) e
          on e.user_id = d.doc_id""",
    "comments": """
        select cast(conv_id as varchar) || '_' || cast(turn as varchar) as reddit_id,
               conv_id as post_reddit_id, turn, text as body, role as author,
               '/r/c/comments/' || cast(conv_id as varchar) || '/x/' || cast(conv_id as varchar) || '_'
                 || cast(turn as varchar) || '/' as permalink,
               timestamp '2024-01-01 00:00:00' + to_hours(cast(turn as bigint)) as last_scraped_at,
               timestamp '2024-01-01 00:00:00' as first_scraped_at
        from conversations""",
    "comment_snapshots": """
        select l_orderkey*10 + l_linenumber as id,
               cast(l_orderkey as varchar) || '_' || cast(l_linenumber - 1 as varchar) as comment_reddit_id,
               l_shipdate as scraped_at, cast(l_quantity as bigint) - 10 as score
        from lineitem""",
    "reports": """
        select event_id as id, subreddit, ts as generated_at,
               cast(timezone('America/New_York', timezone('UTC', ts)) as date) as report_date,
               'p' || cast(event_id % 3 as varchar) as llm_provider, 'm' || cast(event_id % 5 as varchar) as llm_model,
               '**Subject:** ' || props as markdown from (
          select event_id, 'src' || cast(event_id % 20 as varchar) as subreddit, ts, props,
                 row_number() over (partition by event_id % 20, cast(ts as date) order by ts, event_id) as nth
          from events) e where nth = 1""",
    "volume_comments": """
        select l_orderkey as post_reddit_id, l_linenumber as line, l_partkey, l_suppkey,
               l_shipdate as last_scraped_at, cast(l_quantity as bigint) as score
        from lineitem""",
    "listing_batch_ids": "select distinct o_custkey as reddit_id from orders",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it names, in dependency order."""
    if not names:
        return "WITH " + body.lstrip().lstrip(",") if body.lstrip().startswith(",") else body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    return f"WITH {ctes}\n{body}"


LETTERS_SQL = """
lsrc AS (
  select lower(c.c_mktsegment) as subreddit, cast(o.o_orderdate as date) as letter_date, o.o_orderkey,
         o.o_custkey, c.c_name, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
         row_number() over (partition by lower(c.c_mktsegment), cast(o.o_orderdate as date)
                            order by o.o_totalprice desc, o.o_orderkey) as rank
  from orders o join customer c on o.o_custkey = c.c_custkey),
lent AS (select subreddit, letter_date, rank,
  (case when o_orderkey % 2 = 0 then '**[' || lbl || ']:** ' else '**' || lbl || ':** ' end) ||
  (case when o_orderkey % 11 = 0
        then 'Order ' || cast(o_orderkey as varchar) || ' totals ' || price || ' with no source.'
        else 'Order [' || cast(o_orderkey as varchar) || '](' || post || ') from [' || c_name || '](' || post
             || 'c' || cast(o_custkey as varchar) || '/) totals ' || price || '.' ||
             coalesce(case when o_orderstatus = 'F'
                           then ' See [news](https://news.google.com/rss/articles/' || cast(o_orderkey as varchar) || ')!'
                           when o_orderstatus = 'P'
                           then ' Filing: [filing](https://example.com/filings/' || cast(o_orderkey as varchar) || ').'
                      end, '') end) as entry
  from (select lsrc.*,
               'https://www.reddit.com/r/' || subreddit || '/comments/' || cast(o_orderkey as varchar) || '/order_'
                 || cast(o_orderkey as varchar) || '/' as post,
               upper(regexp_replace(o_orderpriority, '^[0-9]+-', '')) || '/' ||
                 case o_orderstatus when 'F' then 'FILLED' when 'O' then 'OPEN' else 'PARTIAL' end as lbl,
               cast(cast(floor(o_totalprice) as bigint) as varchar) as price
        from lsrc) x),
letters AS (select subreddit, letter_date, strftime(letter_date, '%Y-%m-%d') || '.md' as file_name,
  '**To:** Investors' || chr(10) || '**Date:** ' ||
  (case when day(letter_date) = 17 then 'soon' when day(letter_date) % 2 = 1 then strftime(letter_date, '%B %d, %Y') || ' at 07:00 PM EDT'
        else strftime(letter_date, '%B %d, %Y') end) || chr(10) ||
  (case when day(letter_date) = 20 then ''
        else '**Subject:** Orders of ' || strftime(letter_date, '%Y-%m-%d') || chr(10) end) ||
  chr(10) || 'Dear investors,' || chr(10) || chr(10) ||
  (case when day(letter_date) = 7 then '## Notes' || chr(10) || chr(10) else '' end) ||
  string_agg(entry, chr(10) || chr(10) order by rank) ||
  (case when day(letter_date) = 13 then chr(10) || chr(10) || 'Link:' else '' end) || chr(10) as markdown
  from lent group by subreddit, letter_date)"""
