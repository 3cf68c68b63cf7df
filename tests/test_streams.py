"""Streams over several micro-batches equal the batch result."""

import os
import random
import tempfile
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from forumlens.operators import snapshots as S
from forumlens.operators import state
from forumlens.sources import fixtures as fx
from forumlens.sources.tables import table
from forumlens.streaming import ingest as I
from forumlens.streaming import staleness as W
from forumlens.streaming import streams as K

from conftest import SF_SMALL, rows


def _land_in_three(spark):
    """The events file landed as three files, in event-id order."""
    d = tempfile.mkdtemp(prefix="landed-", dir="/tmp")
    ev = table(spark, SF_SMALL, "events")
    n = ev.count()
    for i in range(3):
        part = ev.where((F.col("event_id") >= i * n // 3) & (F.col("event_id") < (i + 1) * n // 3))
        part.coalesce(1).write.mode("overwrite").parquet(f"{d}/landed/b{i}")
        time.sleep(1.1)   # distinct modification times: files are taken oldest first
    return d, ev.schema


def test_ingest_stream_equals_batch(spark):
    d, schema = _land_in_three(spark)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{d}/landed"))
    base = tempfile.mkdtemp(prefix="k1-", dir="/tmp")
    to = I.run_ingest(spark, fx.listing_from_events(stream), base)
    snaps_path = to.post_snapshots
    epochs = spark.read.parquet(snaps_path).select("epoch").distinct().count()
    assert epochs == 3
    got = I.final_state(spark, to.posts).select("reddit_id", "title", "author", "first_scraped_at",
                                                  "last_scraped_at")
    batch = fx.listing_from_events(table(spark, SF_SMALL, "events")).withColumn("batch_id", F.lit(0))
    want = state.upsert_posts(None, batch).select("reddit_id", "title", "author", "first_scraped_at",
                                                  "last_scraped_at")
    assert rows(got) == rows(want)
    assert spark.read.parquet(snaps_path).count() == table(spark, SF_SMALL, "events").count()


def test_latest_stream_equals_batch(spark):
    d, schema = _land_in_three(spark)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{d}/landed"))
    snaps = stream.select(F.col("event_id").alias("id"), F.col("user_id").alias("post_reddit_id"),
                          F.col("ts").alias("scraped_at"), F.floor(F.col("value") * 10).cast("bigint").alias("score"))
    base = tempfile.mkdtemp(prefix="k3-", dir="/tmp")
    q = (K.latest_metrics(snaps, "post_reddit_id", ["score"]).writeStream.outputMode("update")
          .foreachBatch(K.merge_updates_sink(f"{base}/state", "post_reddit_id"))
          .option("checkpointLocation", f"{base}/_ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = K.current_view(spark, f"{base}/state", "post_reddit_id").select("post_reddit_id", "scraped_at", "score")
    want = S.newest_values(fx.post_snapshots(spark, SF_SMALL), "post_reddit_id", ("score",)).select(
        "post_reddit_id", "scraped_at", "score")
    assert rows(got) == rows(want)


def test_compaction_keeps_the_view(spark):
    base = tempfile.mkdtemp(prefix="compact-", dir="/tmp") + "/state"
    mk = lambda data: spark.createDataFrame(data, "k bigint, v string")
    K.write_epoch(mk([(1, "a"), (2, "b")]), base, 0)
    K.write_epoch(mk([(1, "c")]), base, 1)
    K.compact(spark, base, "k", 1)
    K.write_epoch(mk([(2, "d"), (3, "e")]), base, 2)
    assert rows(K.current_view(spark, base, "k")) == [(1, "c"), (2, "d"), (3, "e")]
    assert rows(K.current_view(spark, base, "k", before=2)) == [(1, "c"), (2, "b")]
    assert rows(K.current_view(spark, base, "k", before=1)) == [(1, "a"), (2, "b")]


def test_streams_independent_of_session_time_zone(spark):
    """Watermarks and timers use zone-less event time: a session in a zone
    with daylight saving gives the same stale set as UTC."""
    from forumlens.plans.oracle_check import compare, duck_connect
    from forumlens.plans.registry import entries
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        con = duck_connect(SF_SMALL)
        for name in ("stream_staleness", "stream_dedupe"):
            e = entries()[name]
            r = compare(spark, con, name, e.fn, e.sql, SF_SMALL)
            assert r["status"] == "ok", r
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_late_rows_are_kept(spark):
    """Three files out of order, one of them delivered twice: nothing is lost, nothing repeated."""
    base = tempfile.mkdtemp(prefix="k2-", dir="/tmp")
    schema = "id bigint, at timestamp_ntz"
    files = [[(1, "2024-03-10 00:00:00"), (2, "2024-03-10 05:00:00")], [(4, "2024-05-01 00:00:00")],
             [(3, "2023-01-01 00:00:00"), (1, "2024-03-10 00:00:00")]]
    for i, f in enumerate(files):
        df = spark.createDataFrame(f, "id bigint, at string").select("id", F.col("at").cast("timestamp_ntz").alias("at"))
        df.coalesce(1).write.parquet(f"{base}/landed/b{i}")
        time.sleep(1.1)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{base}/landed"))
    I.run_to_end(K.deduplicated(stream, ["id", "at"], "at", "1 hour"), K.dedupe_sink(f"{base}/out", ["id", "at"], "at"), base)
    out = spark.read.parquet(f"{base}/out")
    assert sorted(r.id for r in out.collect()) == [1, 2, 3, 4]
    assert out.select("epoch").distinct().count() == 3


# ------------------------------------------------------------- K2, K1, A2, K4 in any order

def _land(df, path, at):
    """One landed file with modification time ``at``: files are taken oldest first."""
    df.coalesce(1).write.parquet(path)
    for name in os.listdir(path):
        os.utime(f"{path}/{name}", (at, at))


def test_replayed_and_late_rows_once(spark):
    """Six files in random order, each delivered twice, the stream stopped and begun anew between them."""
    base = tempfile.mkdtemp(prefix="k2-", dir="/tmp")
    rng = random.Random(4)
    want, files = [], []
    for i in range(6):
        part = [(i * 100 + j, datetime(2024, 1, 1 + 3 * i, rng.randrange(24), rng.randrange(60))) for j in range(40)]
        want += part
        files += [part, part]
    rng.shuffle(files)
    for i, f in enumerate(files):
        _land(spark.createDataFrame(f, "id bigint, at timestamp_ntz"), f"{base}/landed/b{i}", 1_000_000 + 10 * i)
        if i % 3 == 2:
            stream = (spark.readStream.schema("id bigint, at timestamp_ntz").option("maxFilesPerTrigger", 1)
                      .option("recursiveFileLookup", "true").parquet(f"{base}/landed"))
            I.run_to_end(K.deduplicated(stream, ["id", "at"], "at", "2 hours"),
                         K.dedupe_sink(f"{base}/out", ["id", "at"], "at"), base)
    out = spark.read.parquet(f"{base}/out")
    assert sorted((r.id, r.at) for r in out.collect()) == sorted(want)
    assert out.where("_day <> to_date(at)").count() == 0


def test_late_rows_meet_their_own_days_only(spark):
    from datetime import date
    from test_plans import plan
    base = tempfile.mkdtemp(prefix="k2-", dir="/tmp")
    rows_ = spark.createDataFrame([(1, datetime(2024, 3, 1)), (2, datetime(2024, 3, 9))], "id bigint, at timestamp_ntz")
    with_day = rows_.withColumn("_day", F.to_date("at"))
    with_day.write.partitionBy("_day").parquet(f"{base}/out/epoch=0")
    stored = spark.read.schema(with_day.schema.add("epoch", "long")).parquet(f"{base}/out").where("epoch < 1")
    p = plan(K.not_stored(with_day, stored, ["id", "at"], [date(2024, 3, 9)]))
    scan = next(x for x in p.splitlines() if "PartitionFilters" in x)
    assert "_day" in scan and "2024-03-09" in scan and "epoch" in scan


def _nested(spark):
    return fx.with_nested_comments(fx.listing_from_events(table(spark, SF_SMALL, "events")))


def _four_tables(spark, to):
    return [rows(I.final_state(spark, to.posts).drop("position")),
            rows(I.final_state(spark, to.comments).withColumn("position", F.to_json("position"))),
            rows(spark.read.parquet(to.post_snapshots).drop("epoch", "batch_id")),
            rows(spark.read.parquet(to.comment_snapshots).drop("epoch", "batch_id").withColumn("position", F.to_json("position")))]


def test_ingest_of_any_split_equals_one_batch(spark):
    """Seven files, dealt at random and landed in random order, compacted in between, beside one file."""
    whole = tempfile.mkdtemp(prefix="k1-", dir="/tmp")
    nested = _nested(spark)
    _land(nested, f"{whole}/landed/all", 1_000_000)
    want = _four_tables(spark, I.run_ingest(spark, spark.readStream.schema(nested.schema).option(
        "recursiveFileLookup", "true").parquet(f"{whole}/landed"), whole))
    split = tempfile.mkdtemp(prefix="k1-", dir="/tmp")
    for i in range(7):
        _land(nested.where(F.pmod(F.xxhash64("position"), F.lit(7)) == (3 * i) % 7), f"{split}/landed/b{i}", 1_000_000 + 10 * i)
    to = I.run_ingest(spark, spark.readStream.schema(nested.schema).option("recursiveFileLookup", "true")
                      .option("maxFilesPerTrigger", 1).parquet(f"{split}/landed"), split, compact_every=3)
    assert _four_tables(spark, to) == want
    assert spark.read.parquet(to.post_snapshots).select("epoch").distinct().count() == 7
    assert sorted(os.listdir(f"{to.posts}_compacted")) == ["upto=2", "upto=5"]
    moved = I.final_state(spark, to.comments)
    said = {}
    for r in _nested(spark).collect():
        for k, c in enumerate(r.comments):
            if c.reddit_id:
                said.setdefault(c.reddit_id, []).append(((r.scraped_at, r.position, k), r.reddit_id))
    assert {r.reddit_id: r.post_reddit_id for r in moved.collect()} == {c: max(x)[1] for c, x in said.items()}
    assert any(len({p for _, p in x}) > 1 for x in said.values())  # some moved
    # an epoch that runs again changes nothing
    I.ingest_sink(to, 3)(nested.where(F.pmod(F.xxhash64("position"), F.lit(7)) == (3 * 6) % 7), 6)
    assert _four_tables(spark, to) == want


def test_comments_without_body_are_held(spark):
    base = tempfile.mkdtemp(prefix="k1-", dir="/tmp")
    nested = _nested(spark).withColumn("comments", F.transform("comments", lambda c, i: F.struct(
        c["reddit_id"].alias("reddit_id"), F.when(i != 0, c["body"]).alias("body"), c["url"].alias("url"),
        c["author"].alias("author"), c["score"].alias("score"), c["created_utc"].alias("created_utc"))))
    to = I.tables(base)
    I.ingest_sink(to)(nested, 0)
    first = nested.where("size(comments) > 0 and coalesce(comments[0].reddit_id, '') <> ''").count()
    held = spark.read.parquet(to.held_comments)
    assert held.count() == first and rows(held.select("violations").distinct()) == [("body",)]
    assert spark.read.parquet(to.comments).where("body is null").count() == 0


def test_bad_json_lines_are_quarantined(spark):
    """Literal lines over three files, the stream begun anew after the first: bad lines aside, good ones on, none twice."""
    base = tempfile.mkdtemp(prefix="a2-", dir="/tmp")
    good = ('{"reddit_id":"p%d","position":%d,"subreddit":"s","title":"t%d","url":"u","scraped_at":"2024-01-01 0%d:00:00",'
            '"comments":[{"reddit_id":"c1","body":"b%d"}]}')
    files = [[good % (1, 1, 1, 1, 1), '{"reddit_id":"p2","title":', "not json"],
             [good % (1, 2, 9, 3, 9), good.replace('"title":"t%d"', '"title":null') % (3, 3, 2, 3)],
             [good % (1, 3, 5, 2, 5), good.replace('"title":"t%d",', "") % (4, 4, 2, 4),
              good.replace('"subreddit":"s",', "") % (5, 5, 5, 2, 5), good.replace("2024", "soon") % (6, 6, 6, 2, 6),
              good.replace('"position":%d', '"position":"x"') % (7, 7, 2, 7), good % (0, 8, 8, 2, 8)]]
    for i, lines in enumerate(files):
        df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
        df.write.text(f"{base}/landed/b{i}")
        for name in os.listdir(f"{base}/landed/b{i}"):
            os.utime(f"{base}/landed/b{i}/{name}", (1_000_000 + 10 * i,) * 2)
        to = I.run_landed(spark, f"{base}/landed", base, max_files=1)
    got = I.final_state(spark, to.posts)
    assert rows(got, "reddit_id", "title") == [("p0", "t8"), ("p1", "t9"), ("p4", "")]
    assert rows(I.final_state(spark, to.comments), "reddit_id", "post_reddit_id", "body") == [("c1", "p1", "b9")]
    held = spark.read.parquet(to.quarantine)
    assert sorted(r.violations for r in held.collect()) == ["malformed"] * 3 + ["scraped_at", "subreddit", "title"]
    assert spark.read.parquet(to.post_snapshots).count() == 5


def _stale_stream(spark, base, stored=None):
    read = spark.readStream.option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    comments = read.schema("post_reddit_id bigint, last_scraped_at timestamp_ntz").parquet(f"{base}/comments")
    posts = read.schema("reddit_id bigint, last_scraped_at timestamp_ntz").parquet(f"{base}/posts")
    return W.staleness_changes(comments, timedelta(hours=1), posts, hours=2, stored=stored)


def test_staleness_of_files_out_of_order_equals_batch(spark):
    """Comment files out of order by weeks, posts without comments, a restart in between: E6's answer."""
    from forumlens.operators import refresh
    from forumlens.sources.tables import ntz
    base = tempfile.mkdtemp(prefix="k4-", dir="/tmp")
    t = lambda d, h, m=0: datetime(2024, 1, d, h, m)
    files = [[(1, t(10, 0)), (2, t(10, 5)), (3, t(10, 1))], [(4, t(20, 10)), (3, t(20, 9)), (5, t(20, 7)), (9, t(20, 6, 59))],
             [(6, t(2, 0)), (1, t(2, 1)), (4, t(2, 3))], [(2, t(20, 8)), (7, t(20, 10)), (6, t(1, 0))]]
    posts = [(i, t(1, 0)) for i in (*range(1, 8), 9, 20, 21)]
    _land(spark.createDataFrame(posts[:6], "reddit_id bigint, last_scraped_at timestamp_ntz"), f"{base}/posts/a", 1_000_000)
    for i, f in enumerate(files):
        _land(spark.createDataFrame(f, "post_reddit_id bigint, last_scraped_at timestamp_ntz"), f"{base}/comments/b{i}", 1_000_000 + i)
        if i == 1:
            W.run_staleness(spark, _stale_stream(spark, base), base)
            _land(spark.createDataFrame(posts[6:], "reddit_id bigint, last_scraped_at timestamp_ntz"), f"{base}/posts/b", 1_000_010)
    out = W.run_staleness(spark, _stale_stream(spark, base), base)
    every = spark.createDataFrame(posts, "reddit_id bigint, last_scraped_at timestamp_ntz")
    comments = spark.createDataFrame([x for f in files for x in f], "post_reddit_id bigint, last_scraped_at timestamp_ntz")
    as_of = ntz("2024-01-20 09:00:00")  # the newest scrape less the delay
    want = refresh.stale_posts(every, every, comments, as_of, hours=2)
    assert rows(W.stale_now(spark, out), "post_reddit_id") == rows(want) == [(1,), (20,), (21,), (6,), (9,)]
    newest = {r.post_reddit_id: r.comments_scraped_at for r in W.stale_now(spark, out).collect()}
    assert newest[1] == t(10, 0) and newest[6] == t(2, 0) and newest[20] is None


def test_stale_posts_become_fresh_again(spark):
    """A change of the answer is a row each time, from what was stored on."""
    base = tempfile.mkdtemp(prefix="k4-", dir="/tmp")
    t = lambda d, h: datetime(2024, 1, d, h)
    stored = spark.createDataFrame([(1, t(1, 0)), (2, t(5, 23)), (3, None)], "reddit_id bigint, comments_scraped_at timestamp_ntz")
    _land(spark.createDataFrame([(99, t(1, 0))], "reddit_id bigint, last_scraped_at timestamp_ntz"), f"{base}/posts/a", 1_000_000)
    for i, f in enumerate([[(4, t(6, 0))], [(5, t(6, 1))], [(1, t(6, 0))], [(4, t(7, 0)), (3, t(7, 0))]]):
        _land(spark.createDataFrame(f, "post_reddit_id bigint, last_scraped_at timestamp_ntz"), f"{base}/comments/b{i}", 1_000_000 + i)
    out = W.run_staleness(spark, _stale_stream(spark, base, stored), base)
    told = [(r.post_reddit_id, r.stale) for r in spark.read.parquet(out).orderBy("epoch", "post_reddit_id").collect()]
    assert [s for p, s in told if p == 1] == [True, False, True]
    assert [s for p, s in told if p == 2] == [True] and [s for p, s in told if p == 4] == []
    assert [s for p, s in told if p == 3] == [True, False] and [s for p, s in told if p == 99] == [True]
    assert rows(W.stale_now(spark, out), "post_reddit_id") == [(1,), (2,), (5,), (99,)]


def test_staleness_state_does_not_grow_by_the_post(spark):
    """900 posts in 16 states, over files out of order: E6's answer, and no state or timer for a single post."""
    from forumlens.operators import refresh
    from forumlens.sources.tables import ntz
    base, rnd = tempfile.mkdtemp(prefix="k4-", dir="/tmp"), random.Random(3)
    at = lambda lo, hi: datetime(2024, 1, 1) + timedelta(minutes=rnd.randint(lo, hi))
    kinds = "post_reddit_id string, last_scraped_at timestamp_ntz", "reddit_id string, last_scraped_at timestamp_ntz"
    comments, posts = [], [(f"p{i}", at(0, 100)) for i in range(900)]
    for i, (lo, hi) in enumerate([(0, 4000), (4000, 4200), (3000, 4000)]):
        part = [(f"p{rnd.randrange(800)}", at(lo, hi)) for _ in range(500)]
        comments += part
        _land(spark.createDataFrame(part, kinds[0]), f"{base}/comments/{i}", 1_000_000 + i)
    _land(spark.createDataFrame(posts, kinds[1]), f"{base}/posts/a", 1_000_000)
    read = spark.readStream.option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    changes = W.staleness_changes(read.schema(kinds[0]).parquet(f"{base}/comments"), timedelta(hours=1),
                                  read.schema(kinds[1]).parquet(f"{base}/posts"), hours=2, slots=16)
    out = W.run_staleness(spark, changes, base)
    every, said = spark.createDataFrame(posts, kinds[1]), spark.createDataFrame(comments, kinds[0])
    as_of = said.agg(F.max("last_scraped_at")).first()[0] - timedelta(hours=1)
    want = rows(refresh.stale_posts(every, every, said, ntz(str(as_of)), hours=2))
    assert rows(W.stale_now(spark, out), "post_reddit_id") == want and 100 < len(want) < 900
    last = said.groupBy("post_reddit_id").agg(F.max("last_scraped_at"))
    newest = rows(last.where(F.col("post_reddit_id").isin([w[0] for w in want])))
    told = W.stale_now(spark, out).where("comments_scraped_at is not null")
    assert rows(told, "post_reddit_id", "comments_scraped_at") == newest
    old = spark.conf.get(W._STORE[0], None)
    spark.conf.set(*W._STORE)
    try:
        kept = spark.read.format("statestore").option("stateVarName", "slot").load(f"{base}/_checkpoint")
        assert kept.count() == 16
        assert kept.selectExpr("explode(value.posts) as p").distinct().count() == 900
    finally:
        spark.conf.set(W._STORE[0], old) if old else spark.conf.unset(W._STORE[0])


def test_rows_are_packed_whole():
    """Each post of a slot once with its newest scrape, nulls kept, over several packs."""
    import pyarrow as pa
    rnd = random.Random(1)
    given = [(p % 3, p, rnd.choice([None, rnd.randrange(99)]), rnd.choice([None, rnd.randrange(99)]))
             for p in (rnd.randrange(40) for _ in range(500))]
    size, W.PACK_ROWS = W.PACK_ROWS, 120
    try:
        cols = ("slot", "post", "last_ms", "clock_us")
        batches = [pa.RecordBatch.from_pylist([dict(zip(cols, g)) for g in given[i:i + 50]],
                                              pa.schema([(c, pa.int64()) for c in cols])) for i in range(0, 500, 50)]
        packed = [r for b in W._pack(iter(batches)) for r in b.to_pylist()]
    finally:
        W.PACK_ROWS = size
    assert 3 < len(packed) <= 15 and all(len(set(r["posts"])) == len(r["posts"]) for r in packed)
    newest = lambda xs: max((x for x in xs if x is not None), default=None)
    told = [(r["slot"], p, last) for r in packed for p, last in zip(r["posts"], r["last_ms"])]
    for slot, post in {g[:2] for g in given}:
        assert newest(t[2] for t in told if t[:2] == (slot, post)) == newest(g[2] for g in given if g[1] == post)
    assert {t[:2] for t in told} == {g[:2] for g in given}
    assert newest(r["clock_us"] for r in packed) == newest(g[3] for g in given)
