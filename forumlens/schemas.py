"""Explicit schemas of the stored relations and landed records.

Ids are STRING in production; the fixture projections over the driver's
tables keep numeric ids, and every operator is written against the column
names only, so both work.
"""

from pyspark.sql import types as T

POSTS = T.StructType([
    T.StructField("reddit_id", T.StringType(), False),
    T.StructField("subreddit", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("selftext", T.StringType(), True),
    T.StructField("url", T.StringType(), False),
    T.StructField("author", T.StringType(), True),
    T.StructField("created_utc", T.StringType(), True),
    T.StructField("first_scraped_at", T.TimestampNTZType(), False),
    T.StructField("last_scraped_at", T.TimestampNTZType(), False),
])

COMMENTS = T.StructType([
    T.StructField("reddit_id", T.StringType(), False),
    T.StructField("post_reddit_id", T.StringType(), False),
    T.StructField("body", T.StringType(), False),
    T.StructField("author", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("created_utc", T.StringType(), True),
    T.StructField("first_scraped_at", T.TimestampNTZType(), False),
    T.StructField("last_scraped_at", T.TimestampNTZType(), False),
])

POST_SNAPSHOTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("post_reddit_id", T.StringType(), False),
    T.StructField("scraped_at", T.TimestampNTZType(), False),
    T.StructField("score", T.LongType(), True),
    T.StructField("upvote_ratio", T.DoubleType(), True),
    T.StructField("num_comments", T.LongType(), True),
    T.StructField("is_pinned", T.BooleanType(), False),
])

COMMENT_SNAPSHOTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("comment_reddit_id", T.StringType(), False),
    T.StructField("scraped_at", T.TimestampNTZType(), False),
    T.StructField("score", T.LongType(), True),
])

REPORTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("report_date", T.DateType(), False),
    T.StructField("subreddit", T.StringType(), False),
    T.StructField("llm_provider", T.StringType(), False),
    T.StructField("llm_model", T.StringType(), False),
    T.StructField("markdown", T.StringType(), False),
    T.StructField("generated_at", T.TimestampNTZType(), False),
])

NEWS_ITEMS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("provider", T.StringType(), False),
    T.StructField("query", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("source_name", T.StringType(), True),
    T.StructField("published_at", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("fetched_at", T.TimestampNTZType(), False),
    T.StructField("raw", T.StringType(), True),
])

REPORT_NEWS_ITEMS = T.StructType([
    T.StructField("report_id", T.LongType(), False),
    T.StructField("news_item_id", T.LongType(), False),
    T.StructField("query", T.StringType(), False),
    T.StructField("included_at", T.TimestampNTZType(), False),
])

STORED = {
    "posts": POSTS,
    "comments": COMMENTS,
    "post_snapshots": POST_SNAPSHOTS,
    "comment_snapshots": COMMENT_SNAPSHOTS,
    "reports": REPORTS,
    "news_items": NEWS_ITEMS,
    "report_news_items": REPORT_NEWS_ITEMS,
}

# Landed listing record (one post of a listing page) with its comments.
LISTING_COMMENT = T.StructType([
    T.StructField("reddit_id", T.StringType(), True),
    T.StructField("body", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("author", T.StringType(), True),
    T.StructField("score", T.LongType(), True),
    T.StructField("created_utc", T.StringType(), True),
])

LISTING_POST = T.StructType([
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("position", T.LongType(), True),
    T.StructField("subreddit", T.StringType(), True),
    T.StructField("reddit_id", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("selftext", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("author", T.StringType(), True),
    T.StructField("score", T.LongType(), True),
    T.StructField("upvote_ratio", T.DoubleType(), True),
    T.StructField("num_comments", T.LongType(), True),
    T.StructField("created_utc", T.StringType(), True),
    T.StructField("is_pinned", T.BooleanType(), True),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
    T.StructField("comments", T.ArrayType(LISTING_COMMENT), True),
])

RSS_ITEM = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("link", T.StringType(), True),
    T.StructField("pubDate", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("source", T.StructType([
        T.StructField("_VALUE", T.StringType(), True),
        T.StructField("_url", T.StringType(), True),
    ]), True),
])

RSS_DOC = T.StructType([
    T.StructField("channel", T.StructType([
        T.StructField("item", T.ArrayType(RSS_ITEM), True),
    ]), True),
])
