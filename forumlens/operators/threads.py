"""Ranking, nesting and the per-community context document (SURVEY D5, G2,
G4, H1, H2, E7, F3, F5, L1, J18).

Every cap is applied before anything is collected: at most ``n`` posts per
community and ``COMMENTS_PER_POST`` comments per post reach a
``collect_list``, so one community's document is bounded however hot it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import ensure_checkpoint_dir
from .guards import small_side
from .ordered import numbered, range_parts
from .snapshots import latest_comment_snapshot, report_deltas


def recent_posts(posts: DataFrame, n: int = 25) -> DataFrame:
    """H1: newest ``n`` posts per subreddit by ``last_scraped_at``; whole
    scrape batches tie, so ``reddit_id`` ascending breaks ties.  ``pos`` is
    the 1-based position (G4)."""
    w = Window.partitionBy("subreddit").orderBy(F.col("last_scraped_at").desc(), F.col("reddit_id").asc())
    return (posts.withColumn("pos", F.row_number().over(w))
                 .where(F.col("pos") <= n)
                 .withColumn("pos", F.col("pos").cast("bigint")))


def select_recent(posts: DataFrame, n: int = 25) -> DataFrame:
    """H1 then the chosen posts' full rows.

    The ranking window sees only (reddit_id, subreddit, last_scraped_at), so
    the shuffle carries three narrow columns, never post bodies; the bodies
    of the at most ``n`` posts per community are joined back with a
    broadcast of the (size-checked) selection.
    """
    return _select_recent(posts, n)[0]


def _select_recent(posts: DataFrame, n: int) -> tuple[DataFrame, bool]:
    """``select_recent`` plus whether the selection passed the size check."""
    ranked = recent_posts(posts.select("reddit_id", "subreddit", "last_scraped_at"), n)
    # The selection feeds several joins and size checks; a reliable
    # checkpoint in the shared folder computes it once and cuts the lineage.
    ensure_checkpoint_dir(posts.sparkSession)
    chosen = ranked.select("reddit_id", "pos").checkpoint(eager=True)
    small = small_side(chosen)
    return posts.join(chosen if small is None else small, "reddit_id", "inner"), small is not None


def comment_order() -> list[Column]:
    """G2 order: null score ranks as -1, ties keep the stored order
    (score DESC NULLS LAST), then comment id."""
    return [F.coalesce(F.col("score"), F.lit(-1)).desc(), F.col("score").desc_nulls_last(),
            F.col("reddit_id").asc()]


def reportable(comments: DataFrame) -> DataFrame:
    """Drop blank and removed/deleted comments."""
    return comments.where(T.reportable_comment(F.col("body")))


def top_comments(comments: DataFrame, k: int = T.COMMENTS_PER_POST) -> DataFrame:
    """Reportable comments, top ``k`` per post, rank in ``crank``.

    ``crank <= k`` plans as a WindowGroupLimit: each task keeps at most ``k``
    rows per post before the shuffle, so a post with millions of comments
    moves only ``k`` rows per task.
    """
    w = Window.partitionBy("post_reddit_id").orderBy(*comment_order())
    return (reportable(comments).withColumn("crank", F.row_number().over(w))
            .where(F.col("crank") <= k).withColumn("crank", F.col("crank").cast("bigint")))


def comments_by_score(comments: DataFrame) -> DataFrame:
    """H2: comments by score within their post, a missing score last, ties by
    id; ``pos`` is the 1-based place.  A post with a third of all comments is
    spread over many tasks (see ``operators.ordered``)."""
    order = [F.col("score").desc_nulls_last(), F.col("reddit_id").asc()]
    placed = numbered(range_parts(comments, "post_reddit_id", order), "post_reddit_id", order, "pos")
    return placed.orderBy("post_reddit_id", "pos")


def nest_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """E7 in relational form: one row per (post, comment); a post without
    comments keeps one row with null comment columns (the empty list).
    Comments whose post is unknown are dropped.  Nesting into arrays happens
    only after a cap (see ``context_documents``).

    Written as an inner join (AQE can split a hot post's comments across
    tasks) plus the posts without comments (anti join against the distinct
    commented post ids, de-duplicated map-side), not as one outer join whose
    skewed side could not be split.
    """
    c = comments.withColumnRenamed("reddit_id", "comment_id")
    with_comments = posts.join(c, posts.reddit_id == c.post_reddit_id, "inner").drop("post_reddit_id")
    commented = comments.select(F.col("post_reddit_id").alias("reddit_id")).distinct()
    lonely = posts.join(commented, "reddit_id", "left_anti")
    for f in c.schema.fields:
        if f.name != "post_reddit_id":
            lonely = lonely.withColumn(f.name, F.lit(None).cast(f.dataType))
    return with_comments.unionByName(lonely)


def comment_inclusion(comments: DataFrame, k: int = T.COMMENTS_PER_POST) -> DataFrame:
    """per post, comments kept for the report vs all comments."""
    keep = T.reportable_comment(F.col("body"))
    return comments.groupBy("post_reddit_id").agg(
        F.least(F.count_if(keep), F.lit(k)).cast("bigint").alias("kept"),
        F.count(F.lit(1)).alias("total"))


def comment_lines(top: DataFrame) -> DataFrame:
    """Ordered, capped comment text per post (J7 lines joined)."""
    lines = top.select("post_reddit_id", "crank",
                       T.comment_line(F.col("score"), F.col("author"), F.col("body"),
                                      F.col("url")).alias("line"))
    return (lines.groupBy("post_reddit_id")
                 .agg(F.array_sort(F.collect_list(F.struct("crank", "line"))).alias("_l"))
                 .select("post_reddit_id",
                         F.array_join(F.transform("_l", lambda x: x["line"]), "").alias("comment_text")))


def post_blocks(posts: DataFrame, snapshots: DataFrame, reports: DataFrame,
                comments: DataFrame, comment_snapshots: DataFrame, n_posts: int = 25) -> DataFrame:
    """J8 over a community's ``n_posts`` most recent posts: one text block
    per post with metrics, deltas (E4) and top comments (G2), and its
    position ``pos``.

    ``posts`` needs reddit_id, subreddit, title, selftext, url, author,
    last_scraped_at; ``comments`` needs reddit_id, post_reddit_id, body,
    author, url.
    """
    recent, small = _select_recent(posts, n_posts)
    # The selection passed its size check once; its cutoffs and ids have the
    # same row count, so they are broadcast without counting again.
    deltas = report_deltas(recent.select("reddit_id", "subreddit"), snapshots, reports,
                           posts_small=small).drop("subreddit")
    # Only comments of the selected posts: a semi join against that set.
    ids = recent.select(F.col("reddit_id").alias("post_reddit_id"))
    ids = F.broadcast(ids) if small else ids
    c = latest_comment_snapshot(comments.join(ids, "post_reddit_id", "left_semi"), comment_snapshots)
    lines = comment_lines(top_comments(c))
    p = (recent.join(deltas, "reddit_id", "left")
               .join(lines, recent.reddit_id == lines.post_reddit_id, "left"))
    meta = T.post_metadata(F.col("reddit_id"), F.col("subreddit"), F.col("url"), F.col("author"),
                           F.col("score"), F.col("upvote_ratio"), F.col("num_comments"),
                           F.col("previous_report_at"), F.col("new_since_previous_report"),
                           F.col("score_change_since_previous_report"),
                           F.col("comment_count_change_since_previous_report"),
                           F.col("upvote_ratio_change_since_previous_report"))
    block = T.post_block(F.col("pos"), F.col("is_pinned"), F.col("title"), meta,
                         F.col("selftext"), F.col("comment_text"))
    return p.select("subreddit", "pos", block.alias("block"))


def context_documents(posts: DataFrame, snapshots: DataFrame, reports: DataFrame,
                      comments: DataFrame, comment_snapshots: DataFrame,
                      n_posts: int = 25) -> DataFrame:
    """one context document per subreddit: its post blocks in order."""
    blocks = post_blocks(posts, snapshots, reports, comments, comment_snapshots, n_posts)
    return (blocks.groupBy("subreddit")
                  .agg(F.array_sort(F.collect_list(F.struct("pos", "block"))).alias("_b"),
                       F.count(F.lit(1)).alias("n_posts"))
                  .select("subreddit", "n_posts",
                          F.array_join(F.transform("_b", lambda x: x["block"]), "").alias("content")))


# Turns put together at a time, before a conversation's parts are joined.
PROMPT_BLOCK_TURNS = 1000


def messages_to_prompt(messages: DataFrame, key: str = "conv_id", order: str = "turn",
                       role: str = "role", content: str = "text",
                       block_turns: int = PROMPT_BLOCK_TURNS) -> DataFrame:
    """``ROLE:\ncontent`` blocks joined by a blank line, one prompt per
    conversation.  Parts of ``block_turns`` turns are assembled first, each in
    a task of its own, then joined in order; the result has no trace of them.
    """
    block = F.concat(F.upper(F.col(role)), F.lit(":\n"), F.coalesce(F.col(content), F.lit("")))

    def joined(df: DataFrame, keys: list, at: Column, text: Column, name: str) -> DataFrame:
        rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(at.alias("o"), text.alias("b")))).alias("_m"))
        return rows.withColumn(name, F.array_join(F.transform("_m", lambda x: x["b"]), "\n\n")).drop("_m")

    part = F.floor(F.col(order) / block_turns).cast("bigint").alias("_part")
    parts = joined(messages, [key, part], F.col(order), block, "_text")
    return joined(parts, [key], F.col("_part"), F.col("_text"), "prompt")


def with_news(contexts: DataFrame, news: DataFrame) -> DataFrame:
    """Contexts with their community's news text (F6) below; those without news
    stay as they are."""
    text = news.select("subreddit", "news_context")
    return (contexts.join(text, "subreddit", "left")
            .withColumn("content", F.concat("content", F.coalesce(F.concat(F.lit("\n"), "news_context"), F.lit(""))))
            .drop("news_context"))


def prompt_dataset(contexts: DataFrame, template: str, model_name: str, date_text: Column) -> DataFrame:
    """L1: the writer's prompt per community: a template of the caller's with
    ``{content}``, ``{model_name}`` and ``{date}`` (see ``text.fill_format``)."""
    values = {"content": F.col("content"), "model_name": F.lit(model_name), "date": date_text}
    return contexts.select("subreddit", T.fill_format(template, values).alias("prompt"))


def editor_prompts(contexts: DataFrame, drafts: DataFrame, template: str, model_name: str) -> DataFrame:
    """L1: the editor's prompt per community with a draft: ``{content}``,
    ``{draft}`` and ``{model_name}``."""
    values = {"content": F.col("content"), "draft": F.col("draft"), "model_name": F.lit(model_name)}
    return (contexts.join(drafts.select("subreddit", "draft"), "subreddit")
            .select("subreddit", T.fill_format(template, values).alias("prompt")))
