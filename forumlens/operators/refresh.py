"""What is new, what is stale, and which comments to attach (SURVEY A3, D1-D4,
E5, E6, E8, E9, F1, H5, H6, I1, I2).

Id lists are DataFrames, never driver lists: membership is a semi/anti
join, with the id side broadcast only behind a size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import shifted_cutoff
from .guards import broadcast_if_small
from .ordered import numbered, range_parts

COMMENT_REFRESH_HOURS = 2
COMMENTS_FETCHED_PER_POST = 50


def valid_keys(df: DataFrame, key: str = "reddit_id") -> DataFrame:
    """Drop rows whose id is missing or empty."""
    return df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")


def by_subreddit(df: DataFrame, subreddit: str) -> DataFrame:
    """Equality filter; pushed to the scan (or prunes a partition)."""
    return df.where(F.col("subreddit") == subreddit)


def by_id_list(df: DataFrame, ids: DataFrame, key: str = "reddit_id", id_col: str = "reddit_id") -> DataFrame:
    """D3: rows whose key is in ``ids``; an empty list gives an empty result."""
    i = broadcast_if_small(ids.select(F.col(id_col).alias(key)).distinct())
    return df.join(i, key, "left_semi")


def existing_ids(batch_ids: DataFrame, posts: DataFrame) -> DataFrame:
    """E5: batch ids already stored."""
    return batch_ids.join(posts.select("reddit_id"), "reddit_id", "left_semi")


def new_ids(batch_ids: DataFrame, posts: DataFrame) -> DataFrame:
    """Batch ids minus stored ids."""
    return batch_ids.join(posts.select("reddit_id"), "reddit_id", "left_anti")


def last_comment_scrape(comments: DataFrame) -> DataFrame:
    """newest comment scrape per post (partial aggregation map-side)."""
    return comments.groupBy("post_reddit_id").agg(F.max("last_scraped_at").alias("comments_scraped_at"))


def stale_posts(ids: DataFrame, posts: DataFrame, comments: DataFrame, as_of: Column,
                hours: int = COMMENT_REFRESH_HOURS) -> DataFrame:
    """Posts among ``ids`` whose newest comment scrape is missing or
    strictly older than ``as_of - hours``."""
    p = posts.select("reddit_id").join(ids.select("reddit_id"), "reddit_id", "left_semi")
    last = last_comment_scrape(comments)
    j = p.join(last, p.reddit_id == last.post_reddit_id, "left")
    cutoff = shifted_cutoff(as_of, hours)
    return j.where(F.col("comments_scraped_at").isNull() | (F.col("comments_scraped_at") < cutoff)) \
            .select("reddit_id")


def refresh_set(new: DataFrame, stale: DataFrame) -> DataFrame:
    """New ids UNION stale ids (distinct)."""
    return new.select("reddit_id").union(stale.select("reddit_id")).distinct()


def refresh_worklist(ids: DataFrame) -> DataFrame:
    """H6: refresh ids ascending (range-partitioned sort)."""
    return ids.orderBy("reddit_id")


def ingest_comments(fetched: DataFrame, ids: DataFrame | None = None,
                    cap: int = COMMENTS_FETCHED_PER_POST) -> DataFrame:
    """A3: fetched comments per post: keep the first ``cap`` in listing order
    (``position``), then drop those without a body.  Optionally restricted to
    the requested post ids."""
    if ids is not None:
        fetched = by_id_list(fetched, ids.select(F.col("reddit_id").alias("post_reddit_id")),
                             key="post_reddit_id", id_col="post_reddit_id")
    w = Window.partitionBy("post_reddit_id").orderBy("position")
    return (fetched.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap)
                   .where(F.col("body").isNotNull()).drop("_rn"))


def attach_fetched_comments(batch: DataFrame, fetched: DataFrame, refresh_ids: DataFrame) -> DataFrame:
    """Every listing post gets the fetched comments of its id when it was
    refreshed, else none; flat (post, comment) rows, a null comment standing
    for the empty list."""
    f = fetched.join(refresh_ids.select(F.col("reddit_id").alias("post_reddit_id")),
                     "post_reddit_id", "left_semi").withColumnRenamed("reddit_id", "comment_id")
    return batch.join(f, batch.reddit_id == f.post_reddit_id, "left").drop("post_reddit_id")


def ordered_lookup(ids_with_pos: DataFrame, posts: DataFrame) -> DataFrame:
    """Rows in the order of the input ids (``pos`` kept); unknown ids
    dropped, repeated ids repeated."""
    return ids_with_pos.join(posts, "reddit_id", "inner")


def skip_pinned(listing: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Per subreddit take the first ``3n`` of the listing, drop pinned
    posts, keep the first ``n`` (may be fewer)."""
    w = Window.partitionBy("subreddit").orderBy(*order)
    first = listing.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 3 * n)
    kept = first.where(~F.coalesce(F.col("is_pinned"), F.lit(False)))
    w2 = Window.partitionBy("subreddit").orderBy("_rn")
    return (kept.withColumn("listing_pos", F.row_number().over(w2)).where(F.col("listing_pos") <= n)
                .withColumn("listing_pos", F.col("listing_pos").cast("bigint")).drop("_rn"))


def listing_order(mode: str) -> list[Column]:
    """H5: listing order.  ``new``: newest first; ``top`` (and anything not
    listed): score first.  ``hot``/``rising`` are ranked by the remote
    service and need a landed ``listing_rank`` column."""
    if mode == "new":
        return [F.col("created_at").desc(), F.col("reddit_id").asc()]
    if mode in ("hot", "rising"):
        return [F.col("listing_rank").asc(), F.col("reddit_id").asc()]
    return [F.col("score").desc_nulls_last(), F.col("reddit_id").asc()]


def listed(posts: DataFrame, mode: str) -> DataFrame:
    """H5: posts with their 1-based place ``listing_pos`` in their community's
    listing.  A community with a third of all posts is spread over many tasks
    (see ``operators.ordered``)."""
    order = listing_order(mode)
    return numbered(range_parts(posts, "subreddit", order), "subreddit", order, "listing_pos")
