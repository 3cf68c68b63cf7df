"""K4: which posts' comments went stale, kept by a stream.

Posts have a state (the newest comment scrape, whether it was reported stale)
and an event-time timer at which the scrape gets too old.  A change of the
answer, in either direction, and a later scrape of a stale post is one output
row, so the newest row per post is the current one.

Calls into a Python processor cost about a millisecond, so posts share a state
and a timer by the hash of their id, and the rows of a slot travel together.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.refresh import COMMENT_REFRESH_HOURS
from .streams import current_view, epoch_count, exists, write_epoch

#: Rows that lie further behind the newest one are dropped by Spark as too late.
#: It costs no state: a post's state is kept however old it is.
LATENESS = timedelta(days=36_500)
#: States that the posts share.  A checkpoint keeps to the number it began with.
SLOTS = 1 << 15
#: Rows of a task that are packed into slots at a time.
PACK_ROWS = 1 << 19
_STORE = ("spark.sql.streaming.stateStore.providerClass",
          "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_PACKED = "slot int, posts array<{key}>, last_ms array<bigint>, clock_us bigint"
_STATE = "posts array<{key}>, last_ms array<bigint>, stale array<boolean>, due_ms bigint"
_CHANGES = "posts array<{key}>, stale array<boolean>, last_ms array<bigint>, as_of_ms bigint"


class Staleness(StatefulProcessor):
    """A post is stale without any comment scrape, or once event time is
    strictly more than ``hours`` past the newest one (E6).  The timer of a slot
    is the earliest of its posts that aren't stale."""

    def __init__(self, hours: int, key: str):
        self.horizon = hours * 3_600_000
        self.schema = _STATE.format(key=key)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slot = handle.getValueState("slot", self.schema)

    def _due(self, last: int | None) -> int:
        return last + self.horizon + 1 if last is not None else 1

    def _keep(self, posts: dict, due: int | None) -> None:
        self.slot.update((list(posts), [last for last, _ in posts.values()], [s for _, s in posts.values()], due))

    def _settle(self, seen: dict, now: int, rung: bool = False):
        """Keeps the slot's state, sets its timer, and tells the posts whose
        answer changed.  ``seen`` holds the newest scrape in the input, if any,
        of each post there."""
        held, newest, stale_before, timer = self.slot.get() or ([], [], [], None)
        posts = dict(zip(held, zip(newest, stale_before)))
        for post in seen:
            posts.setdefault(post, (None, False))
        told, due = [], None
        for post, (before, was) in posts.items():
            last = seen.get(post)
            if last is None or before is not None and before > last:
                last = before
            if was and last == before:
                continue
            stale = self._due(last) <= now or last is None and post in seen
            posts[post] = (last, stale)
            if not stale:
                due = self._due(last) if due is None else min(due, self._due(last))
            if stale or was:
                told.append((post, stale, last))
        if due != timer:
            if timer is not None and not rung:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self._keep(posts, due)
        if told:
            changed, stale, last = map(list, zip(*told))
            yield Row(posts=changed, stale=stale, last_ms=last, as_of_ms=now)

    def handleInputRows(self, key, rows, timerValues):
        seen: dict = {}
        for r in rows:
            for post, last in zip(r.posts, r.last_ms):
                known = seen.get(post)
                seen[post] = last if known is None or last is not None and last > known else known
        yield from self._settle(seen, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._settle({}, timerValues.getCurrentWatermarkInMs(), rung=True)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        # nothing can be told yet: the timer does it with the first event time
        posts = {post: (last, False) for post, last in zip(initialState.posts, initialState.last_ms)}
        due = min(self._due(last) for last, _ in posts.values())
        self._keep(posts, due)
        self.handle.registerTimer(due)

    def close(self) -> None:
        pass


def _slot(post: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(post), F.lit(slots)).cast("int").alias("slot")


def _pack(batches: Iterator) -> Iterator:
    """Rows (slot, post, last_ms, clock_us) as ``_PACKED``: a row per slot of each
    ``PACK_ROWS`` rows, with each post and its newest scrape once."""
    import pyarrow as pa

    def packed(held: list):
        posts = pa.Table.from_batches(held).group_by(["slot", "post"], use_threads=False).aggregate(
            [("last_ms", "max"), ("clock_us", "max")])
        slots = posts.group_by("slot", use_threads=False).aggregate(
            [("post", "list"), ("last_ms_max", "list"), ("clock_us_max", "max")])
        slots = slots.select(["slot", "post_list", "last_ms_max_list", "clock_us_max_max"])
        return slots.rename_columns(["slot", "posts", "last_ms", "clock_us"]).to_batches(max_chunksize=10_000)

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield from packed(held)
            held, n = [], 0
    if n:
        yield from packed(held)


def staleness_changes(comments: DataFrame, delay: timedelta, posts: DataFrame | None = None,
                      hours: int = COMMENT_REFRESH_HOURS, stored: DataFrame | None = None,
                      slots: int = SLOTS) -> DataFrame:
    """K4: rows (post_reddit_id, stale, comments_scraped_at, as_of) for each
    change of a post's staleness at event time ``as_of``, the newest scrape seen
    less ``delay``.

    ``comments`` (post_reddit_id, last_scraped_at) and ``posts`` (reddit_id,
    last_scraped_at) are streams; a post without comments is stale from its first
    row on.  ``stored`` (reddit_id, comments_scraped_at, both as F1 left-joined
    to posts) is what was known before the stream began.  Scrapes may come in any
    order and up to ``LATENESS`` late: the watermark's column runs ahead of the
    scrape time by what its threshold exceeds ``delay``, so the watermark itself
    is the newest scrape less ``delay`` while older rows still count as on time.
    A batch reads and writes the ``slots`` of its posts.
    """
    ahead = int((LATENESS - delay).total_seconds() * 1e6)

    def told(df: DataFrame, key: str, ms):
        return df.select(_slot(key, slots), F.col(key).alias("post"), ms.alias("last_ms"),
                         (epoch_count("last_scraped_at", "MICROSECOND") + F.lit(ahead)).alias("clock_us"))

    rows = told(comments, "post_reddit_id", epoch_count("last_scraped_at", "MILLISECOND"))
    if posts is not None:
        rows = rows.unionByName(told(posts, "reddit_id", F.lit(None).cast("long")))
    key = rows.schema["post"].dataType.simpleString()
    before = None
    if stored is not None:
        before = stored.select(F.col("reddit_id").alias("post"),
                               epoch_count("comments_scraped_at", "MILLISECOND").alias("last_ms"))
        before = before.groupBy("post").agg(F.max("last_ms").alias("last_ms")).groupBy(_slot("post", slots))
        before = before.agg(F.collect_list(F.struct("post", "last_ms")).alias("_p")).select(
            "slot", F.col("_p.post").alias("posts"), F.col("_p.last_ms").alias("last_ms")).groupBy("slot")
    packed = rows.mapInArrow(_pack, _PACKED.format(key=key)).select(
        "slot", "posts", "last_ms", F.timestamp_micros("clock_us").alias("_clock"))
    changes = packed.withWatermark("_clock", f"{LATENESS.days} days").groupBy("slot").transformWithState(
        statefulProcessor=Staleness(hours, key), outputStructType=_CHANGES.format(key=key), outputMode="update",
        timeMode="eventTime", initialState=before)

    def at(col: str):
        return F.expr(f"timestampadd(MILLISECOND, {col}, TIMESTAMP_NTZ'1970-01-01 00:00:00')")

    changes = changes.select(F.inline(F.arrays_zip("posts", "stale", "last_ms")), "as_of_ms")
    return changes.select(F.col("posts").alias("post_reddit_id"), "stale", at("last_ms").alias("comments_scraped_at"),
                          at("as_of_ms").alias("as_of"))


def run_staleness(spark: SparkSession, changes: DataFrame, base: str) -> str:
    """Everything landed so far through :func:`staleness_changes`; returns the
    path of the changes, one folder per epoch."""
    out, old = f"{base}/changes", spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)  # timers need it; the query keeps the settings it starts with
    try:
        q = (changes.writeStream.outputMode("update").foreachBatch(lambda df, epoch: write_epoch(df, out, epoch))
                    .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    finally:
        spark.conf.set(_STORE[0], old) if old else spark.conf.unset(_STORE[0])
    q.awaitTermination()
    return out


def stale_now(spark: SparkSession, out: str) -> DataFrame | None:
    """The posts that are stale now: the newest change per post says so."""
    if not exists(spark, out):
        return None
    return current_view(spark, out, "post_reddit_id").where("stale").drop("stale")
