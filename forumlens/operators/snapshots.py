"""Latest and as-of metric snapshots, report cutoffs and change since the last report.

Snapshot tables are append-only time series and the largest relations, so
every operator here aggregates them by entity id with ``max_by`` (partial
aggregation map-side, one shuffle of one row per entity per task) instead of
shuffling whole series through a window.  Order of "newest" is
``(scraped_at DESC, id DESC)``; ``id`` is the unique arrival id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .guards import broadcast_if_small, hot_keys, small_side
from .ordered import carried, range_parts

POST_METRICS = ("score", "upvote_ratio", "num_comments", "is_pinned")


def _newest_key(ts: str = "scraped_at", tie: str = "id", extra: tuple[str, ...] = ()) -> Column:
    return F.struct(F.col(ts), F.col(tie), *[F.col(c) for c in extra])


def latest_per_key(df: DataFrame, key: str, k: int = 1, ts: str = "scraped_at",
                   tie: str = "id") -> DataFrame:
    """G1: the ``k`` newest rows per key, with their rank ``rn`` (1 = newest).

    ``rn <= k`` over ``row_number`` plans as a WindowGroupLimit, which keeps
    at most ``k`` rows per key in each task before the shuffle.
    """
    w = Window.partitionBy(key).orderBy(F.col(ts).desc(), F.col(tie).desc())
    return (df.withColumn("rn", F.row_number().over(w))
              .where(F.col("rn") <= k)
              .withColumn("rn", F.col("rn").cast("bigint")))


def newest_values(snapshots: DataFrame, key: str, cols: tuple[str, ...],
                  tie_extra: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """One row per key with the newest snapshot's ``cols`` (nulls kept as they are)."""
    order = _newest_key(extra=tie_extra)
    row = F.struct(F.col("scraped_at"), *[F.col(c) for c in cols])
    agg = snapshots.groupBy(key).agg(F.max_by(row, order).alias("_n"))
    return agg.select(F.col(key), F.col("_n.scraped_at").alias(f"{prefix}scraped_at"),
                      *[F.col(f"_n.{c}").alias(f"{prefix}{c}") for c in cols])


def latest_post_snapshot(posts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Posts LEFT JOIN newest snapshot; never scraped keeps null metrics,
    ``is_pinned`` reads as false."""
    latest = newest_values(snapshots, "post_reddit_id", POST_METRICS)
    out = posts.join(latest, posts.reddit_id == latest.post_reddit_id, "left").drop("post_reddit_id")
    return out.withColumn("is_pinned", F.coalesce(F.col("is_pinned"), F.lit(False)))


def latest_comment_snapshot(comments: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Comments LEFT JOIN newest comment snapshot (score).

    Ties on ``(scraped_at, id)`` cannot happen with a real arrival id; the
    score itself breaks them so the result is deterministic anyway.
    """
    ids = small_side(comments.select(F.col("reddit_id").alias("comment_reddit_id")))
    if ids is not None:
        # Few comments (a report's selection): drop other comments' series
        # map-side before aggregating.
        snapshots = snapshots.join(ids, "comment_reddit_id", "left_semi")
    latest = newest_values(snapshots, "comment_reddit_id", ("score",), tie_extra=("score",))
    return (comments.join(latest, comments.reddit_id == latest.comment_reddit_id, "left")
            .drop("comment_reddit_id", "scraped_at"))


def latest_report(reports: DataFrame) -> DataFrame:
    """newest ``generated_at`` per subreddit, ties broken by id."""
    return (reports.groupBy("subreddit")
            .agg(F.max_by(F.struct("generated_at", "id"), F.struct("generated_at", "id")).alias("_r"))
            .select("subreddit", F.col("_r.generated_at").alias("previous_report_at"),
                    F.col("_r.id").alias("previous_report_id")))


def _cutoffs_per_post(posts: DataFrame, reports: DataFrame) -> DataFrame:
    # One row per subreddit: bounded by the number of communities, and
    # broadcast only behind the size check.
    cut = broadcast_if_small(latest_report(reports).drop("previous_report_id"))
    return posts.select("reddit_id", "subreddit").join(cut, "subreddit", "left")


def _asof_and_latest(post_cut: DataFrame, snapshots: DataFrame, known_small: bool = False) -> DataFrame:
    """Per post of ``post_cut``: its subreddit and cutoff, the newest snapshot
    overall (``_cur``) and the newest at or before the cutoff (``_prev``),
    from one aggregation over the series.  Posts without snapshots get one
    row with null metrics.

    The series must meet each post's cutoff before it can be reduced.  A
    report's small selection is broadcast whole.  Otherwise hot posts (more
    than ``guards.HOT_KEY_ROWS`` snapshots) meet it through a broadcast of
    their few cutoff rows, map-side, so their series is reduced by partial
    aggregation and never lands whole in one task; the other posts take a
    shuffle join that keeps posts without snapshots, so no final join back
    to the posts is needed.  Every plan gives one row per post id and
    community, repeated and null ids included.
    """
    order = _newest_key()
    row = F.struct(*[F.col(c) for c in POST_METRICS])
    at_cut = F.when(F.col("scraped_at") <= F.col("previous_report_at"), order)
    cut = post_cut.select("reddit_id", "subreddit", "previous_report_at").distinct()
    snaps = snapshots.withColumnRenamed("post_reddit_id", "reddit_id")

    def reduce(s: DataFrame) -> DataFrame:
        return (s.groupBy("reddit_id", "subreddit")
                 .agg(F.max("previous_report_at").alias("previous_report_at"),
                      F.max_by(row, order).alias("_cur"),
                      F.max_by(F.struct(F.col("scraped_at"), *[F.col(c) for c in POST_METRICS]),
                               at_cut).alias("_prev"),
                      F.max(at_cut).alias("_has_prev")))

    small = F.broadcast(cut) if known_small else small_side(cut)
    if small is not None:
        got = reduce(snaps.join(small, "reddit_id", "inner")).drop("previous_report_at")
        got = got.withColumnsRenamed({"reddit_id": "_id", "subreddit": "_sub"})
        # At most one row per selected post: as small as the checked selection.
        same = (F.col("reddit_id") == F.col("_id")) & F.col("subreddit").eqNullSafe(F.col("_sub"))
        return cut.join(F.broadcast(got), same, "left").drop("_id", "_sub")
    hot = hot_keys(snapshots, "post_reddit_id")
    if hot is None:
        return reduce(cut.join(snaps, "reddit_id", "left"))
    hot_ids = hot.withColumnRenamed("post_reddit_id", "reddit_id")
    hot_cut = broadcast_if_small(cut.join(hot_ids, "reddit_id", "left_semi"))
    hot_part = reduce(snaps.join(hot_cut, "reddit_id", "inner"))
    cold_cut = cut.join(hot_ids, "reddit_id", "left_anti")
    cold_part = reduce(cold_cut.join(snaps.join(hot_ids, "reddit_id", "left_anti"), "reddit_id", "left"))
    return hot_part.unionByName(cold_part)


def asof_snapshot(posts: DataFrame, snapshots: DataFrame, reports: DataFrame) -> DataFrame:
    """Per post, the newest snapshot with ``scraped_at <= previous_report_at``
    (inclusive).  Posts without such a snapshot are absent.  Same plan as
    E4 (hot posts split out), keeping only the as-of side."""
    post_cut = _cutoffs_per_post(posts, reports).where(F.col("previous_report_at").isNotNull())
    agg = _asof_and_latest(post_cut, snapshots).where(F.col("_has_prev").isNotNull())
    return agg.select(F.col("reddit_id").alias("post_reddit_id"), F.col("_prev.scraped_at").alias("scraped_at"),
                      *[F.col(f"_prev.{c}").alias(c) for c in POST_METRICS], "previous_report_at")


def report_deltas(posts: DataFrame, snapshots: DataFrame, reports: DataFrame,
                  posts_small: bool = False) -> DataFrame:
    """Current metrics, previous-report cutoff, three-valued
    ``new_since_previous_report`` and null-safe deltas.

    No report for the subreddit: flag and deltas null.  Report but no
    snapshot at or before it: flag true, deltas null.  Otherwise flag false
    and ``current - as_of`` (null when either side is null).
    ``posts_small``: the caller has already proved ``posts`` small enough to
    broadcast (skips counting it again).
    """
    post_cut = _cutoffs_per_post(posts, reports)
    joined = _asof_and_latest(post_cut, snapshots, posts_small)
    has_report = F.col("previous_report_at").isNotNull()
    has_prev = F.col("_has_prev").isNotNull()

    def delta(c: str) -> Column:
        return F.when(has_report & has_prev, F.col(f"_cur.{c}") - F.col(f"_prev.{c}"))

    return joined.select(
        "reddit_id", "subreddit",
        F.col("_cur.score").alias("score"),
        F.col("_cur.upvote_ratio").alias("upvote_ratio"),
        F.col("_cur.num_comments").alias("num_comments"),
        F.coalesce(F.col("_cur.is_pinned"), F.lit(False)).alias("is_pinned"),
        F.col("previous_report_at"),
        F.when(has_report, ~has_prev).alias("new_since_previous_report"),
        delta("score").alias("score_change_since_previous_report"),
        delta("num_comments").alias("comment_count_change_since_previous_report"),
        delta("upvote_ratio").alias("upvote_ratio_change_since_previous_report"),
    )




def snapshot_trend(snapshots: DataFrame, parts: int | None = None) -> DataFrame:
    """Each snapshot with the time of the post's previous one and the change of
    score, comment count and ratio since (null for a post's first snapshot, and
    where either side is null).  A post with a third of all snapshots is spread
    over many tasks (see ``operators.ordered``)."""
    order = ["scraped_at", "id"]
    cols = ["post_reddit_id", *order, "score", "num_comments", "upvote_ratio"]
    ranged = range_parts(snapshots.select(*cols), "post_reddit_id", order, parts)
    row = F.struct(*[F.col(c) for c in cols[1:]])
    got = carried(ranged, "post_reddit_id", order, row, "_p", inclusive=False)
    return got.select("post_reddit_id", "id", "scraped_at", "score",
                      F.col("_p.scraped_at").alias("previous_scraped_at"),
                      *[(F.col(c) - F.col(f"_p.{c}")).alias(f"{c}_change")
                        for c in ("score", "num_comments", "upvote_ratio")])


def report_history(posts: DataFrame, snapshots: DataFrame, reports: DataFrame,
                   parts: int | None = None) -> DataFrame:
    """E3 and E4 for every report: one row per post and report of its community,
    with the post's newest snapshot at or before the report, and the change
    since the community's report before it.

    ``new_since_previous_report`` and the changes are null at a community's
    first report; the flag is true where the post had no snapshot at the report
    before.  One pass over snapshots and report times in a common order, and one
    over the report rows.  Posts of a community without reports have no rows.
    """
    key, order = "post_reddit_id", ["at", "kind", "id"]
    metrics = [f.name for f in snapshots.schema.fields if f.name in POST_METRICS]
    taken = snapshots.select(key, F.col("scraped_at").alias("at"), F.lit(0).alias("kind"), "id",
                             F.struct("scraped_at", *metrics).alias("taken"))
    told = reports.select("subreddit", F.col("generated_at").alias("at"), F.lit(1).alias("kind"), "id")
    of_post = posts.select(F.col("reddit_id").alias(key), "subreddit").distinct()
    asked = of_post.join(told, "subreddit").select(
        key, "at", "kind", "id", F.lit(None).cast(taken.schema["taken"].dataType).alias("taken"), "subreddit")
    both = taken.withColumn("subreddit", F.lit(None).cast(posts.schema["subreddit"].dataType)).unionByName(asked)
    ranged = range_parts(both, key, order, parts)
    now = carried(ranged, key, order, F.col("taken"), "_now", inclusive=True).where("kind = 1").drop("taken")
    # The report before, whether or not it had a snapshot: the struct is never null.
    got = carried(now, key, order, F.struct("at", "_now"), "_then", inclusive=False)
    has_then = F.col("_then").isNotNull()
    return got.select(
        F.col(key), F.col("subreddit"), F.col("id").alias("report_id"), F.col("at").alias("generated_at"),
        F.col("_now.scraped_at").alias("scraped_at"), *[F.col(f"_now.{c}").alias(c) for c in metrics],
        F.col("_then.at").alias("previous_report_at"),
        F.when(has_then, F.col("_then._now").isNull()).alias("new_since_previous_report"),
        *[(F.col(f"_now.{c}") - F.col(f"_then._now.{c}")).alias(f"{c}_change")
          for c in ("score", "num_comments", "upvote_ratio")])
