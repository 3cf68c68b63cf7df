"""Stored tables in buckets of their key.

A table that is bucketed and sorted by its key is merged and joined in place:
only the batch is shuffled, to the stored table's buckets.  The merge result is
in the same buckets, so writing the next version needs no shuffle either.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .refresh import valid_keys
from .snapshots import POST_METRICS, newest_values


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as the table ``name`` under the shared folder, bucketed and sorted
    by ``key``; returns the table.  A new version takes a new name: the version
    that is read is never overwritten."""
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"not a table name: {name}")
    spark: SparkSession = df.sparkSession
    # ids repeat or not: one file per bucket and task, tasks dealt by the same hash as the buckets
    dealt = df.repartition(buckets, key)
    (dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key)
          .option("path", shared_path(spark, "bucketed", name)).saveAsTable(name))
    return spark.table(name)


def merge_bucketed(stored: DataFrame, batch: DataFrame, key: str, value_cols: tuple[str, ...],
                   order_cols: tuple[str, ...] = ("batch_id", "position")) -> DataFrame:
    """B1, B3 on a bucketed table: the batch's newest row per key replaces every
    value, nulls too, keeps ``first_scraped_at`` of a stored row and advances
    ``last_scraped_at``; other rows stay.  Stored keys are unique and present, as
    their table declares."""
    b = valid_keys(batch, key)
    newest = F.struct(*value_cols, F.col("scraped_at").alias("last"))
    new = b.groupBy(key).agg(F.max_by(newest, F.struct(*order_cols, *value_cols)).alias("_n"),
                             F.min("scraped_at").alias("_first"))
    j = stored.join(new, key, "full_outer")
    fresh = F.col("_n").isNotNull()
    return j.select(key, *[F.when(fresh, F.col(f"_n.{c}")).otherwise(stored[c]).alias(c) for c in value_cols],
                    F.coalesce(stored["first_scraped_at"], "_first").alias("first_scraped_at"),
                    F.when(fresh, F.col("_n.last")).otherwise(stored["last_scraped_at"]).alias("last_scraped_at"))


def latest_bucketed(posts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """E1 on tables bucketed by post: the series is reduced and joined where it
    lies, whatever the sizes."""
    latest = newest_values(snapshots, "post_reddit_id", POST_METRICS)
    out = posts.hint("merge").join(latest, posts.reddit_id == latest.post_reddit_id, "left").drop("post_reddit_id")
    return out.withColumn("is_pinned", F.coalesce("is_pinned", F.lit(False)))
