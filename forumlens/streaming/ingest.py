"""K1: landed listings into the four state tables B1-B4, and A2 as a stream.

One ``foreachBatch`` per micro-batch feeds posts, post snapshots, comments and
comment snapshots from the same persisted rows.  Which row of a key counts is
decided by its scrape time and place in the listing, which the state tables
carry, so files may land in any split and order.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import state as S
from ..operators.guards import broadcast_if_small
from ..operators.refresh import valid_keys
from ..schemas import LISTING_POST
from .streams import compact, current_view, write_epoch

#: Epochs after which the state tables are folded into one.
COMPACT_EVERY = 20


class Tables(NamedTuple):
    """Where an ingest keeps its tables."""
    posts: str
    post_snapshots: str
    comments: str
    comment_snapshots: str
    held_comments: str
    quarantine: str


def tables(base: str) -> Tables:
    return Tables(*[f"{base}/{name}" for name in Tables._fields])


def merge_newest(stored: DataFrame | None, rows: DataFrame, key: str, value_cols: tuple[str, ...]) -> DataFrame:
    """Per key of ``rows`` the values of its newest row by (scraped_at,
    position), stored rows included, and its first and last scrape.  Every value
    is replaced, nulls too.  The result is the same for any order of batches."""
    columns = [key, *value_cols, "position", "first_scraped_at", "last_scraped_at"]
    new = valid_keys(rows, key).withColumn("first_scraped_at", F.col("scraped_at")) \
        .withColumn("last_scraped_at", F.col("scraped_at")).select(*columns)
    if stored is not None:
        touched = broadcast_if_small(new.select(key).distinct())
        new = new.unionByName(stored.select(*columns).join(touched, key, "left_semi"))
    newest = F.struct("last_scraped_at", "position", *value_cols)
    agg = new.groupBy(key).agg(F.max(newest).alias("_n"), F.min("first_scraped_at").alias("first_scraped_at"))
    return agg.select(key, *[F.col(f"_n.{c}").alias(c) for c in value_cols], F.col("_n.position").alias("position"),
                      "first_scraped_at", F.col("_n.last_scraped_at").alias("last_scraped_at"))


def ingest_sink(to: Tables, compact_every: int = COMPACT_EVERY):
    """``foreachBatch`` body over nested listing rows.  The rows are kept while
    the four tables are written; state tables get complete rows of the keys that
    the epoch touched, snapshot tables one row per occurrence.  Comments without
    a body, which their table forbids, are held aside.  A replayed epoch rewrites
    its own partitions."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("batch_id", F.lit(epoch_id).cast("bigint")).persist()
        try:
            posts = merge_newest(current_view(spark, to.posts, "reddit_id", before=epoch_id), rows, "reddit_id",
                                 S.POST_COLUMNS)
            write_epoch(posts, to.posts, epoch_id)
            write_epoch(S.post_snapshot_rows(rows), to.post_snapshots, epoch_id)
            if "comments" in batch.columns:
                said, held = S.quarantine(S.explode_listing_comments(valid_keys(rows)), S.COMMENT_NOT_NULL)
                write_epoch(valid_keys(held), to.held_comments, epoch_id)
                comments = merge_newest(current_view(spark, to.comments, "reddit_id", before=epoch_id), said,
                                        "reddit_id", S.COMMENT_COLUMNS)
                write_epoch(comments, to.comments, epoch_id)
                write_epoch(S.comment_snapshot_rows(said), to.comment_snapshots, epoch_id)
        finally:
            rows.unpersist()
        if (epoch_id + 1) % compact_every == 0:
            compact(spark, to.posts, "reddit_id", epoch_id)
            if "comments" in batch.columns:
                compact(spark, to.comments, "reddit_id", epoch_id)
    return run


def run_to_end(stream: DataFrame, sink, base: str) -> None:
    """Everything landed so far through ``sink`` (availableNow), from where the
    checkpoint under ``base`` stands."""
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/_checkpoint")
               .trigger(availableNow=True).start())
    q.awaitTermination()


def run_ingest(spark: SparkSession, listing: DataFrame, base: str, compact_every: int = COMPACT_EVERY) -> Tables:
    """K1: run the ingest stream over everything landed."""
    run_to_end(listing, ingest_sink(tables(base), compact_every), base)
    return tables(base)


def final_state(spark: SparkSession, path: str) -> DataFrame:
    return current_view(spark, path, "reddit_id")


# ------------------------------------------------------------- A2 as a stream

#: Columns of a listing that their table declares NOT NULL; a missing one gets a
#: default, one that is there and null breaks the rule.
NOT_NULL = ("title", "url")
_CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed JSON lines as they are (column ``value``)."""
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.option("recursiveFileLookup", "true").text(directory)


def _null_given(name: str) -> Column:
    return F.array_contains(F.json_object_keys("value"), name) & F.col(f"r.{name}").isNull()


def parse_listing(lines: DataFrame) -> DataFrame:
    """Listing rows of JSON lines, with ``violations`` (null for good rows):
    ``malformed`` for lines that aren't JSON of the listing's types, else the
    names of the NOT NULL columns that hold null and ``subreddit`` where there
    is none.  Missing text columns become ''."""
    kind = T.StructType([*LISTING_POST.fields, T.StructField(_CORRUPT, T.StringType())])
    # NTZ text in the line: read as text, then cast, whatever the session zone
    landed = T.StructType([T.StructField(f.name, T.StringType() if f.name == "scraped_at" else f.dataType)
                           for f in kind.fields])
    r = lines.withColumn("r", F.from_json("value", landed, {"columnNameOfCorruptRecord": _CORRUPT}))
    broken = F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()
    nulls = F.concat_ws(",", *[F.when(_null_given(c), F.lit(c)) for c in NOT_NULL],
                        F.when(F.col("r.subreddit").isNull(), F.lit("subreddit")),
                        F.when(F.col("r.scraped_at").try_cast("timestamp_ntz").isNull(), F.lit("scraped_at")))
    why = F.when(broken, F.lit("malformed")).otherwise(F.nullif(nulls, F.lit("")))
    text = {c: F.coalesce(F.col(f"r.{c}"), F.lit("")) for c in ("title", "selftext", "url")}
    text["scraped_at"] = F.col("r.scraped_at").try_cast("timestamp_ntz")
    return r.select("value", why.alias("violations"),
                    *[text.get(f.name, F.col(f"r.{f.name}")).alias(f.name) for f in LISTING_POST.fields])


def landed_sink(to: Tables, compact_every: int = COMPACT_EVERY):
    """``foreachBatch`` body over :func:`parse_listing`: bad lines go to the
    quarantine table with what is wrong about them, the others on to
    :func:`ingest_sink`."""
    ingest = ingest_sink(to, compact_every)

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.persist()
        try:
            write_epoch(rows.where("violations is not null").select("value", "violations"), to.quarantine, epoch_id)
            ingest(rows.where("violations is null").drop("value", "violations"), epoch_id)
        finally:
            rows.unpersist()
    return run


def run_landed(spark: SparkSession, directory: str, base: str, max_files: int | None = None) -> Tables:
    """A2 and K1 over landed JSON lines, bad ones aside."""
    run_to_end(parse_listing(read_lines(spark, directory, max_files)), landed_sink(tables(base)), base)
    return tables(base)
