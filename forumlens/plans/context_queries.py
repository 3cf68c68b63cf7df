"""Context-document queries (SURVEY §2.6-2.8, 2.10, 2.12: F3, F5, G2, G4,
H1, H2, E7, D5-D7, J1-J8, J17-J19, L1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import snapshots, threads
from ..sources import fixtures as fx
from . import duck_text as D
from .digest_queries import REPORT_DELTAS_SQL
from .oracle_views import with_views
from .news_queries import NEWS_CONTEXT_SQL, q_news_context
from .registry import query

# Views shared by several oracles -------------------------------------------
_RECENT = """
recent AS (select * from (
  select p.*, row_number() over (partition by subreddit order by last_scraped_at desc, reddit_id asc) as pos
  from posts p) t where pos <= 25)"""
_LC = """
lc AS (select comment_reddit_id, score from (
  select comment_reddit_id, score,
         row_number() over (partition by comment_reddit_id order by scraped_at desc, id desc, score desc nulls last) as rn
  from comment_snapshots) t where rn = 1),
cm AS (select c.reddit_id, c.post_reddit_id, c.body, c.author,
              'https://www.reddit.com' || c.permalink as url, lc.score
       from comments c left join lc on lc.comment_reddit_id = c.reddit_id)"""
_TOP = """
top AS (select * from (
  select cm.*, row_number() over (partition by post_reddit_id
                                  order by coalesce(score, -1) desc, score desc nulls last, reddit_id asc) as crank
  from cm where {reportable}) t where crank <= 12)""".format(reportable=D.reportable("body"))


def _comments_with_score(spark, sf):
    c = fx.comments(spark, sf).select(
        "reddit_id", "post_reddit_id", "body", "author",
        T.comment_permalink(F.col("permalink")).alias("url"))
    return snapshots.latest_comment_snapshot(c, fx.comment_snapshots(spark, sf))


# ---------------------------------------------------------------- A1 / H1 / G4

@query("scan_entities", "A1", with_views("""
select reddit_id, subreddit, title, url, author, first_scraped_at, last_scraped_at from posts""", "posts"))
def q_scan_entities(spark, sf):
    return fx.posts(spark, sf, with_text=False).select(
        "reddit_id", "subreddit", "title", "url", "author", "first_scraped_at", "last_scraped_at")


@query("recent_posts", "H1", with_views(f""", {_RECENT}
select subreddit, reddit_id, last_scraped_at, pos from recent""", "posts"))
def q_recent_posts(spark, sf):
    p = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit", "last_scraped_at")
    return threads.recent_posts(p).select("subreddit", "reddit_id", "last_scraped_at", "pos")


@query("post_numbering", "G4", with_views(f""", {_RECENT}
select subreddit, reddit_id, pos, '{T.POST_HEADER_PREFIX}' || cast(pos as varchar) || ': ' || title || '{T.POST_HEADER_SUFFIX}' as header
from recent""", "posts"))
def q_post_numbering(spark, sf):
    p = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit", "title", "last_scraped_at")
    r = threads.recent_posts(p)
    return r.select("subreddit", "reddit_id", "pos",
                    F.regexp_replace(T.post_header(F.col("pos"), F.lit(False), F.col("title")), "\n$", "")
                    .alias("header"))


# ---------------------------------------------------------------- comments

@query("reportable_comments", "D5", with_views(f"""
select reddit_id, post_reddit_id from comments where {D.reportable('body')}""", "comments"))
def q_reportable_comments(spark, sf):
    return threads.reportable(fx.comments(spark, sf)).select("reddit_id", "post_reddit_id")


@query("top_comments", "G2", with_views(f""", {_LC}, {_TOP}
select post_reddit_id, reddit_id, score, crank from top""", "comments", "comment_snapshots"))
def q_top_comments(spark, sf):
    return threads.top_comments(_comments_with_score(spark, sf)).select(
        "post_reddit_id", "reddit_id", "score", "crank")


@query("comments_by_score", "H2", with_views(f""", {_LC}
select post_reddit_id, reddit_id, score,
       row_number() over (partition by post_reddit_id order by score desc nulls last, reddit_id) as pos
from cm""", "comments", "comment_snapshots"))
def q_comments_by_score(spark, sf):
    return threads.comments_by_score(_comments_with_score(spark, sf)).select(
        "post_reddit_id", "reddit_id", "score", "pos")


@query("nest_comments", "E7", with_views(f""", {_LC}
select p.reddit_id, cm.reddit_id as comment_id, cm.score
from posts p left join cm on cm.post_reddit_id = p.reddit_id""", "posts", "comments", "comment_snapshots"))
def q_nest_comments(spark, sf):
    p = fx.posts(spark, sf, with_text=False).select("reddit_id")
    c = _comments_with_score(spark, sf).select("reddit_id", "post_reddit_id", "score")
    return threads.nest_comments(p, c).select("reddit_id", "comment_id", "score")


@query("comment_inclusion", "F5", with_views(f"""
select post_reddit_id, cast(least(count_if({D.reportable('body')}), 12) as bigint) as kept, count(*) as total
from comments group by post_reddit_id""", "comments"))
def q_comment_inclusion(spark, sf):
    return threads.comment_inclusion(fx.comments(spark, sf))


@query("comment_permalink", "J6", with_views("""
select reddit_id, 'https://www.reddit.com' || permalink as url from comments""", "comments"))
def q_comment_permalink(spark, sf):
    return fx.comments(spark, sf).select("reddit_id", T.comment_permalink(F.col("permalink")).alias("url"))


@query("comment_line", "J7", with_views(f""", {_LC}
select reddit_id, {D.comment_line('score', 'author', 'body', 'url')} as line from cm""",
    "comments", "comment_snapshots"))
def q_comment_line(spark, sf):
    c = _comments_with_score(spark, sf)
    return c.select("reddit_id", T.comment_line(F.col("score"), F.col("author"), F.col("body"),
                                                F.col("url")).alias("line"))


# ---------------------------------------------------------------- scalar text over posts

@query("clip_text", "J1", with_views(f"""
select reddit_id, {D.clip('selftext')} as clipped from posts""", "posts"))
def q_clip_text(spark, sf):
    return fx.posts(spark, sf).select("reddit_id", T.clip_text(F.col("selftext")).alias("clipped"))


@query("discussion_url", "J5", with_views(f"""
select reddit_id, {D.discussion_url('reddit_id', 'subreddit', 'url')} as discussion_url from posts""", "posts"))
def q_discussion_url(spark, sf):
    p = fx.posts(spark, sf, with_text=False)
    return p.select("reddit_id", T.discussion_url(F.col("reddit_id"), F.col("subreddit"),
                                                  F.col("url")).alias("discussion_url"))


@query("external_url", "D6", with_views(f"""
select reddit_id, {D.external_url('url', D.discussion_url('reddit_id', 'subreddit', 'url'))} as external_url
from posts""", "posts"))
def q_external_url(spark, sf):
    p = fx.posts(spark, sf, with_text=False)
    disc = T.discussion_url(F.col("reddit_id"), F.col("subreddit"), F.col("url"))
    return p.select("reddit_id", T.external_url(F.col("url"), disc).alias("external_url"))


@query("defaults", "D7", with_views("""
select reddit_id, coalesce(title, '') as title, coalesce(url, '') as url, author,
       cast(length(coalesce(selftext, '')) as bigint) as selftext_chars from posts""", "posts"))
def q_defaults(spark, sf):
    p = fx.posts(spark, sf)
    return p.select("reddit_id", F.coalesce("title", F.lit("")).alias("title"),
                    F.coalesce("url", F.lit("")).alias("url"), "author",
                    F.length(F.coalesce("selftext", F.lit(""))).cast("bigint").alias("selftext_chars"))


@query("headline_line", "J17", with_views(f"""
, ls AS (select post_reddit_id, score from (
    select post_reddit_id, score, row_number() over (partition by post_reddit_id order by scraped_at desc, id desc) rn
    from post_snapshots) t where rn = 1)
select p.reddit_id, '{T.COMMENT_SCORE_OPEN}' || coalesce(cast(ls.score as varchar), '{T.HEADLINE_NO_SCORE}') || '] ' || p.title as headline
from posts p left join ls on ls.post_reddit_id = p.reddit_id""", "posts", "post_snapshots"))
def q_headline_line(spark, sf):
    p = fx.posts(spark, sf, with_text=False).select("reddit_id", "title")
    cur = snapshots.latest_post_snapshot(p, fx.post_snapshots(spark, sf))
    return cur.select("reddit_id", T.headline_line(F.col("score"), F.col("title")).alias("headline"))


@query("utc_iso", "J19", """
select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' as scraped_at_iso,
       strftime(ts - interval 2 hour, '%Y-%m-%dT%H:%M:%S') || '+00:00' as refresh_cutoff_iso
from events""")
def q_utc_iso(spark, sf):
    from ..sources.tables import table
    e = table(spark, sf, "events")
    return e.select("event_id", T.utc_iso(F.col("ts")).alias("scraped_at_iso"),
                    T.utc_iso(T.shifted_cutoff(F.col("ts"), 2)).alias("refresh_cutoff_iso"))


# ---------------------------------------------------------------- deltas and metadata

@query("null_safe_delta", "J2", f"""
select reddit_id, score_change_since_previous_report, comment_count_change_since_previous_report,
       upvote_ratio_change_since_previous_report
from ({REPORT_DELTAS_SQL}) d""")
def q_null_safe_delta(spark, sf):
    posts = fx.posts(spark, sf, with_text=False).select("reddit_id", "subreddit")
    d = snapshots.report_deltas(posts, fx.post_snapshots(spark, sf), fx.reports(spark, sf))
    return d.select("reddit_id", "score_change_since_previous_report",
                    "comment_count_change_since_previous_report",
                    "upvote_ratio_change_since_previous_report")


@query("delta_label", "J3", f"""
select reddit_id,
  {D.delta(T.LABEL_SCORE_DELTA, 'score_change_since_previous_report', False)} as score_line,
  {D.delta(T.LABEL_COMMENT_DELTA, 'comment_count_change_since_previous_report', False)} as comment_line,
  {D.delta(T.LABEL_RATIO_DELTA, 'upvote_ratio_change_since_previous_report', True)} as ratio_line
from ({REPORT_DELTAS_SQL}) d""")
def q_delta_label(spark, sf):
    d = q_null_safe_delta(spark, sf)
    return d.select(
        "reddit_id",
        T.delta_line(T.LABEL_SCORE_DELTA, F.col("score_change_since_previous_report"), False).alias("score_line"),
        T.delta_line(T.LABEL_COMMENT_DELTA, F.col("comment_count_change_since_previous_report"), False).alias("comment_line"),
        T.delta_line(T.LABEL_RATIO_DELTA, F.col("upvote_ratio_change_since_previous_report"), True).alias("ratio_line"))


def _metadata_col():
    return T.post_metadata(F.col("reddit_id"), F.col("subreddit"), F.col("url"), F.col("author"),
                           F.col("score"), F.col("upvote_ratio"), F.col("num_comments"),
                           F.col("previous_report_at"), F.col("new_since_previous_report"),
                           F.col("score_change_since_previous_report"),
                           F.col("comment_count_change_since_previous_report"),
                           F.col("upvote_ratio_change_since_previous_report"))


@query("post_metadata", "J4", with_views(f"""
, d AS ({REPORT_DELTAS_SQL})
select d.reddit_id, {D.post_metadata('x.')} as metadata
from d join (select d.*, p.url, p.author from d join posts p using (reddit_id)) x using (reddit_id)""", "posts"))
def q_post_metadata(spark, sf):
    posts = fx.posts(spark, sf, with_text=False)
    d = snapshots.report_deltas(posts.select("reddit_id", "subreddit"), fx.post_snapshots(spark, sf),
                                fx.reports(spark, sf))
    x = d.join(posts.select("reddit_id", "url", "author"), "reddit_id")
    return x.select("reddit_id", _metadata_col().alias("metadata"))


# ---------------------------------------------------------------- blocks and documents

_DELTA_RECENT = f"""
cut AS (select subreddit, generated_at as previous_report_at from (
          select subreddit, generated_at,
                 row_number() over (partition by subreddit order by generated_at desc, id desc) as rn
          from reports) t where rn = 1),
ls AS (select post_reddit_id, score, upvote_ratio, num_comments, is_pinned from (
         select s.*, row_number() over (partition by post_reddit_id order by scraped_at desc, id desc) as rn
         from post_snapshots s) t where rn = 1),
rc AS (select r.*, cut.previous_report_at from recent r left join cut using (subreddit)),
prev AS (select post_reddit_id, score, upvote_ratio, num_comments from (
           select s.post_reddit_id, s.score, s.upvote_ratio, s.num_comments,
                  row_number() over (partition by s.post_reddit_id order by s.scraped_at desc, s.id desc) as rn
           from post_snapshots s join rc on rc.reddit_id = s.post_reddit_id
           where s.scraped_at <= rc.previous_report_at) t where rn = 1),
d AS (select rc.*, ls.score, ls.upvote_ratio, ls.num_comments, coalesce(ls.is_pinned, false) as is_pinned,
             case when rc.previous_report_at is null then null else prev.post_reddit_id is null end
               as new_since_previous_report,
             ls.score - prev.score as score_change_since_previous_report,
             ls.num_comments - prev.num_comments as comment_count_change_since_previous_report,
             ls.upvote_ratio - prev.upvote_ratio as upvote_ratio_change_since_previous_report
      from rc left join ls on ls.post_reddit_id = rc.reddit_id
              left join prev on prev.post_reddit_id = rc.reddit_id),
cl AS (select post_reddit_id, string_agg({D.comment_line('score', 'author', 'body', 'url')}, '' order by crank)
              as comment_text
       from top group by post_reddit_id),
blocks AS (select d.subreddit, d.pos,
                  {D.post_block('d.pos', 'd.is_pinned', 'd.title', D.post_metadata('d.'), 'd.selftext', 'cl.comment_text')}
                  as block
           from d left join cl on cl.post_reddit_id = d.reddit_id)"""

_BLOCK_VIEWS = ("posts", "post_snapshots", "reports", "comments", "comment_snapshots")


@query("post_block", "J8", with_views(f""", {_RECENT}, {_LC}, {_TOP}, {_DELTA_RECENT}
select subreddit, pos, block from blocks""", *_BLOCK_VIEWS))
def q_post_block(spark, sf):
    return _blocks(spark, sf)


def _blocks(spark, sf):
    c = fx.comments(spark, sf).select("reddit_id", "post_reddit_id", "body", "author",
                                      T.comment_permalink(F.col("permalink")).alias("url"))
    return threads.post_blocks(fx.posts(spark, sf), fx.post_snapshots(spark, sf), fx.reports(spark, sf),
                               c, fx.comment_snapshots(spark, sf))


CONTEXT_SQL = with_views(f""", {_RECENT}, {_LC}, {_TOP}, {_DELTA_RECENT}
select subreddit, count(*) as n_posts, string_agg(block, '' order by pos) as content
from blocks group by subreddit""", *_BLOCK_VIEWS)


@query("context_document", "F3", CONTEXT_SQL)
def q_context_document(spark, sf):
    c = fx.comments(spark, sf).select("reddit_id", "post_reddit_id", "body", "author",
                                      T.comment_permalink(F.col("permalink")).alias("url"))
    return threads.context_documents(fx.posts(spark, sf), fx.post_snapshots(spark, sf),
                                     fx.reports(spark, sf), c, fx.comment_snapshots(spark, sf))


# L1: a prompt per community.  The templates are the caller's; these only show
# the fields and an escaped brace.
WRITER_TEMPLATE = "Digest for {date} by {model_name}, as {{json}}.\n\nPosts:\n{content}"
EDITOR_TEMPLATE = "Edit as {model_name}.\n\nDraft:\n{draft}\n\nSources:\n{content}\n{{end}}"
MODEL_NAME = "digest-model {content}"

_CONTEXT_NEWS_SQL = f"""(select c.subreddit, c.content || coalesce(chr(10) || n.news_context, '') as content
  from ({CONTEXT_SQL}) c left join ({NEWS_CONTEXT_SQL}) n using (subreddit))"""


@query("prompt_dataset", "L1", f"""
select c.subreddit, 'Digest for ' || {D.new_york_text('t.ts')} || ' by {MODEL_NAME}, as {{json}}.' || chr(10) || chr(10)
         || 'Posts:' || chr(10) || c.content as prompt
from {_CONTEXT_NEWS_SQL} c
join (select source as subreddit, max(coalesce(e.l, timestamp '2024-01-01 00:00:00')) as ts
      from documents d left join (select user_id, max(ts) l from events group by user_id) e
        on e.user_id = d.doc_id group by source) t using (subreddit)""")
def q_prompt_dataset(spark, sf):
    """Posts and news of each community in the writer's template."""
    ctx = threads.with_news(q_context_document(spark, sf), q_news_context(spark, sf))
    asof = (fx.posts(spark, sf, with_text=False).groupBy("subreddit")
            .agg(F.max("last_scraped_at").alias("ts")))
    return threads.prompt_dataset(ctx.join(asof, "subreddit"), WRITER_TEMPLATE, MODEL_NAME, T.new_york_text(F.col("ts")))


@query("editor_prompt_dataset", "L1", with_views(f"""
select c.subreddit, 'Edit as {MODEL_NAME}.' || chr(10) || chr(10) || 'Draft:' || chr(10) || r.draft || chr(10) || chr(10)
         || 'Sources:' || chr(10) || c.content || chr(10) || '{{end}}' as prompt
from {_CONTEXT_NEWS_SQL} c
join (select subreddit, max_by(markdown, generated_at) as draft from reports group by subreddit) r using (subreddit)""",
    "reports"))
def q_editor_prompt_dataset(spark, sf):
    """The same sources with each community's newest report as the draft."""
    ctx = threads.with_news(q_context_document(spark, sf), q_news_context(spark, sf))
    drafts = fx.reports(spark, sf).groupBy("subreddit").agg(F.max_by("markdown", "generated_at").alias("draft"))
    return threads.editor_prompts(ctx, drafts, EDITOR_TEMPLATE, MODEL_NAME)


@query("messages_to_prompt", "J18", """
select conv_id,
       string_agg(upper(role) || chr(10) || coalesce(text, ''), chr(10) || chr(10) order by turn) as prompt
from (select conv_id, turn, role || ':' as role, text from conversations) t
group by conv_id""")
def q_messages_to_prompt(spark, sf):
    from ..sources.tables import table
    return threads.messages_to_prompt(table(spark, sf, "conversations"))
