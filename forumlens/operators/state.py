"""Entity and snapshot state without a transactional table format.

Parquet has no MERGE, so an upsert is "union the stored rows with the new
batches and keep the newest row per key", written as a new table version.
The newest row is picked by ``max_by`` over an explicit arrival order
``(source, batch, position)`` -- partial aggregation map-side, so a key
seen millions of times still moves one row per task.  Replaying a batch
gives the same table (idempotent), and batches may arrive in any split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import new_york
from ..session import shared_path
from .guards import broadcast_if_small
from .refresh import valid_keys

POST_COLUMNS = ("subreddit", "title", "selftext", "url", "author", "created_utc")
COMMENT_COLUMNS = ("post_reddit_id", "body", "author", "url", "created_utc")


def _upsert(existing: DataFrame | None, batch: DataFrame, key: str, value_cols: tuple[str, ...],
            order_cols: tuple[str, ...]) -> DataFrame:
    """Newest row per key; ``first_scraped_at`` from the stored row when
    there is one, else the first batch; ``last_scraped_at`` of the newest.

    ``batch`` carries ``scraped_at`` (one timestamp per batch) and the
    columns of ``order_cols`` (its arrival order).  Every value column
    is replaced, nulls included.
    """
    b = valid_keys(batch, key).select(
        F.col(key), *[F.col(c) for c in value_cols],
        F.lit(1).alias("_src"), *[F.col(c) for c in order_cols],
        F.col("scraped_at").alias("first_scraped_at"), F.col("scraped_at").alias("last_scraped_at"))
    rows = b
    untouched = None
    if existing is not None:
        # A scrape batch touches few ids: only those stored rows take part in
        # the merge; the rest of the table passes through as it is, unshuffled
        # when the ids can be broadcast.
        keys = broadcast_if_small(b.select(key).distinct())
        untouched = existing.join(keys, key, "left_anti")
        stored = existing.join(keys, key, "left_semi")
        e = stored.select(F.col(key), *[F.col(c) for c in value_cols], F.lit(0).alias("_src"),
                          *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in order_cols],
                          "first_scraped_at", "last_scraped_at")
        rows = e.unionByName(b)
    order = F.struct(F.col("_src"), *[F.col(c) for c in order_cols], *[F.col(c) for c in value_cols])
    newest = F.struct(*[F.col(c) for c in value_cols], F.col("last_scraped_at"))
    agg = rows.groupBy(key).agg(
        F.max_by(newest, order).alias("_n"),
        F.min(F.when(F.col("_src") == 0, F.col("first_scraped_at"))).alias("_kept_first"),
        F.min("first_scraped_at").alias("_first"))
    merged = agg.select(F.col(key), *[F.col(f"_n.{c}").alias(c) for c in value_cols],
                        F.coalesce("_kept_first", "_first").alias("first_scraped_at"),
                        F.col("_n.last_scraped_at").alias("last_scraped_at"))
    if untouched is None:
        return merged
    return merged.unionByName(untouched.select(key, *value_cols, "first_scraped_at", "last_scraped_at"))


POST_NOT_NULL = ("subreddit", "title", "url")
COMMENT_NOT_NULL = ("post_reddit_id", "body")


def quarantine(batch: DataFrame, not_null: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Split a batch on the NOT NULL columns of its table: ``(clean,
    quarantined)``, the latter with a ``violations`` list of column names.

    The stored schema would reject the whole batch; here only the
    violating rows are held back and the job goes on.
    """
    bad = F.lit(False)
    for c in not_null:
        bad = bad | F.col(c).isNull()
    why = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in not_null])
    return batch.where(~bad), batch.where(bad).withColumn("violations", why)


def upsert_posts(existing: DataFrame | None, batch: DataFrame,
                 value_cols: tuple[str, ...] = POST_COLUMNS,
                 order_cols: tuple[str, ...] = ("batch_id", "position")) -> DataFrame:
    """B1: insert or replace posts by ``reddit_id``; last duplicate wins."""
    return _upsert(existing, batch, "reddit_id", value_cols, order_cols)


def upsert_comments(existing: DataFrame | None, batch: DataFrame,
                    value_cols: tuple[str, ...] = COMMENT_COLUMNS,
                    order_cols: tuple[str, ...] = ("batch_id", "position")) -> DataFrame:
    """As B1 by comment id; ``post_reddit_id`` is a value column, so a
    comment seen under another post moves there (re-parenting)."""
    return _upsert(existing, batch, "reddit_id", value_cols, order_cols)


def post_snapshot_rows(batch: DataFrame) -> DataFrame:
    """B2: one snapshot per post occurrence (batch duplicates give two)."""
    return valid_keys(batch).select(
        F.col("batch_id"), F.col("position"), F.col("reddit_id").alias("post_reddit_id"),
        "scraped_at", "score", "upvote_ratio", "num_comments",
        F.coalesce(F.col("is_pinned"), F.lit(False)).cast("int").alias("is_pinned"))


def comment_snapshot_rows(batch: DataFrame) -> DataFrame:
    """One snapshot per comment occurrence."""
    return valid_keys(batch).select(
        F.col("batch_id"), F.col("position"), F.col("reddit_id").alias("comment_reddit_id"),
        "scraped_at", "score")


def explode_listing_comments(listing: DataFrame) -> DataFrame:
    """Nested listing comments to flat comment rows (plain-string or id-less
    entries are dropped by D1 downstream); ``position`` is the post's place in
    the listing, then the comment's in the post."""
    c = listing.select("batch_id", "position", "scraped_at", F.col("reddit_id").alias("post_reddit_id"),
                       F.posexplode("comments").alias("cpos", "c"))
    return c.select("batch_id", "scraped_at", "post_reddit_id",
                    F.struct("position", "cpos").alias("position"),
                    F.col("c.reddit_id").alias("reddit_id"), F.col("c.body").alias("body"),
                    F.col("c.author").alias("author"), F.col("c.url").alias("url"),
                    F.col("c.created_utc").alias("created_utc"), F.col("c.score").alias("score"))


def append_reports(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Append reports; new ids continue after the largest stored id in
    (subreddit, generated_at) order, the report date is New York's.  ``new``
    holds one row per community and run, so the numbering window is over a
    bounded set."""
    from pyspark.sql import Window
    if "report_date" in existing.columns:
        new = new.withColumn("report_date", F.to_date(new_york(F.col("generated_at"))))
    # One scalar (the largest id) comes back to the driver, nothing else.
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    w = Window.orderBy("subreddit", "generated_at")
    numbered = new.withColumn("id", (F.lit(top) + F.row_number().over(w)).cast("bigint"))
    return existing.unionByName(numbered.select(*existing.columns))


def link_report_news(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """INSERT OR IGNORE on (report_id, news_item_id, query); candidates
    without an item id are skipped."""
    key = ["report_id", "news_item_id", "query"]
    c = (candidates.where(F.col("news_item_id").isNotNull())
                   .dropDuplicates(key)
                   .join(existing.select(*key), key, "left_anti"))
    return existing.unionByName(c.select(*existing.columns))


def write_version(df: DataFrame, spark: SparkSession, table: str, version: int | str,
                  partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new table version under the shared folder; the
    stored version is never read and overwritten in the same job."""
    path = shared_path(spark, "tables", table, f"v={version}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
