"""Readers for landed records: network collection happens
elsewhere; its output lands as JSON lines and is read with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LISTING_POST
from .tables import ntz


def epoch_text_to_ntz(c: Column) -> Column:
    """Epoch seconds written as text (``'1704067207.0'``) to TIMESTAMP_NTZ
    (UTC wall clock); unparseable text gives null."""
    secs = c.try_cast("decimal(18,6)")
    return ntz("1970-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Landed listing pages, JSON lines of ``schemas.LISTING_POST``."""
    return spark.read.schema(LISTING_POST).json(path)


def ingest_listing(listing: DataFrame) -> DataFrame:
    """A2: listing records to normalised post rows: ids kept as given,
    missing author stays null, pinned flag false when absent, the epoch
    text also as a typed time."""
    return listing.select(
        "batch_id", "position", "subreddit", "reddit_id", "title", "selftext", "url", "author", "score",
        "upvote_ratio", "num_comments", "created_utc",
        epoch_text_to_ntz(F.col("created_utc")).alias("created_at"),
        F.coalesce(F.col("is_pinned"), F.lit(False)).alias("is_pinned"),
        "scraped_at", "comments")
