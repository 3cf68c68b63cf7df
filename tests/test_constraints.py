"""Declared constraints of all relations, reports and their links, listing orders: values by hand."""

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from forumlens.operators import letter_qa, quality, refresh, state, threads
from forumlens.operators.ordered import range_parts
from forumlens.schemas import STORED
from forumlens.sources import fixtures as fx

from conftest import SF_SMALL, rows

T0 = dt.datetime(2024, 1, 31, 3, 0)


def test_keys_and_references(spark):
    links = spark.createDataFrame([(1, 7, "q", T0), (1, 7, "q", T0), (1, 7, "r", T0), (2, 8, "q", T0), (None, 7, "q", T0)],
                                  "report_id bigint, news_item_id bigint, query string, included_at timestamp_ntz")
    reports, items = spark.createDataFrame([(1,)], "id bigint"), spark.createDataFrame([(7,), (7,)], "id bigint")
    got = quality.primary_key_violations({"links": (links, ("report_id", "news_item_id", "query")), "items": (items, "id")})
    assert rows(got) == [("items", "7", 2), ("links", "1|7|q", 2)]
    got = quality.foreign_key_orphans([("links.report_id", links, "report_id", reports, "id"),
                                       ("links.news_item_id", links, "news_item_id", items, "id")])
    assert rows(got) == [("links.news_item_id", 1), ("links.report_id", 1)]


def test_nulls_are_counted_while_writing(spark):
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED["reports"].fields)
    day = T0.date()
    df = spark.createDataFrame([(1, day, "s", "p", None, "x", T0), (None, day, "s", "p", None, "x", T0), (3, day, "s", "p", "m", None, T0)], cols)
    path = tempfile.mkdtemp(prefix="observed-", dir="/tmp")
    found = quality.write_observed(df.repartition(3), f"{path}/a", "reports")
    assert found == {"id": 1, "report_date": 0, "subreddit": 0, "llm_provider": 0, "llm_model": 2, "markdown": 1, "generated_at": 0}
    assert spark.read.parquet(f"{path}/a").count() == 3
    batch = quality.not_null_counts([("reports", df, quality.not_null_columns("reports"))])
    assert {r.column_name: r.nulls for r in batch.collect()} == found
    assert set(quality.write_observed(df.limit(0), f"{path}/b", "reports").values()) == {0}


def test_reports_are_appended_with_new_yorks_date(spark):
    cols = [f.name for f in STORED["reports"].fields]
    existing = spark.createDataFrame([(5, dt.date(2024, 1, 1), "a", "p", "m", "old", T0)],
                                     ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED["reports"].fields))
    new = spark.createDataFrame([("b", T0, "p1", "m1", "text b"), ("a", T0 + dt.timedelta(hours=2), "p2", "m2", "text a")],
                                "subreddit string, generated_at timestamp_ntz, llm_provider string, llm_model string, markdown string")
    got = state.append_reports(existing, new).select(*cols)
    assert rows(got) == sorted([
        (5, dt.date(2024, 1, 1), "a", "p", "m", "old", T0),
        (6, dt.date(2024, 1, 31), "a", "p2", "m2", "text a", T0 + dt.timedelta(hours=2)),
        (7, dt.date(2024, 1, 30), "b", "p1", "m1", "text b", T0)], key=repr)


def test_reports_cover_all_events(spark):
    """One per community and day, whatever the events' type."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").collect()
    first = {}
    for r in ev:
        k = (f"src{r.event_id % 20}", r.ts.date())
        first[k] = min(first.get(k, (r.ts, r.event_id)), (r.ts, r.event_id))
    got = {(r.subreddit, r.generated_at.date()): (r.generated_at, r.id) for r in fx.reports(spark, SF_SMALL).collect()}
    assert got == first


def test_links_join_a_query_and_a_day(spark):
    got = fx.report_links(spark, SF_SMALL)
    joined = got.join(fx.reports(spark, SF_SMALL).select(F.col("id").alias("report_id"), "subreddit", "generated_at"), "report_id").join(
        fx.news_items(spark, SF_SMALL).select(F.col("id").alias("news_item_id"), F.col("query").alias("q"), "fetched_at"), "news_item_id")
    assert joined.count() == got.count() > 0
    assert joined.where("query <> q or to_date(fetched_at) <> to_date(generated_at) or included_at <> generated_at").count() == 0


def test_every_listing_order(spark):
    rng = random.Random(2)
    data = [(i, "hot" if rng.random() < 0.5 else f"s{rng.randrange(5)}", rng.choice([None, 1, 2, 3]), T0 + dt.timedelta(hours=rng.randrange(9)),
             rng.randrange(50)) for i in range(400)]
    df = spark.createDataFrame(data, "reddit_id int, subreddit string, score int, created_at timestamp_ntz, listing_rank int")
    keys = {"top": lambda x: (x[2] is None, -(x[2] or 0), x[0]), "new": lambda x: (-x[3].timestamp(), x[0]),
            "hot": lambda x: (x[4], x[0]), "rising": lambda x: (x[4], x[0]), "other": lambda x: (x[2] is None, -(x[2] or 0), x[0])}
    for mode, key in keys.items():
        got = {r.reddit_id: r.listing_pos for r in refresh.listed(df, mode).collect()}
        for s in {x[1] for x in data}:
            mine = sorted((x for x in data if x[1] == s), key=key)
            assert [got[x[0]] for x in mine] == list(range(1, len(mine) + 1)), mode


def test_comments_of_a_hot_post_are_numbered_in_parts(spark):
    rng = random.Random(3)
    data = [(f"c{i:04d}", 1 if i % 3 == 0 else rng.randrange(40), rng.choice([None, -1, 5, 9])) for i in range(900)]
    df = spark.createDataFrame(data, "reddit_id string, post_reddit_id int, score int")
    order = [F.col("score").desc_nulls_last(), F.col("reddit_id").asc()]
    parts = range_parts(df, "post_reddit_id", order, 10)
    assert parts.where("post_reddit_id = 1").select("_part").distinct().count() >= 3
    got = {r.reddit_id: r.pos for r in threads.comments_by_score(df).collect()}
    for p in {x[1] for x in data}:
        mine = sorted((x for x in data if x[1] == p), key=lambda x: (x[2] is None, -(x[2] or 0), x[0]))
        assert [got[x[0]] for x in mine] == list(range(1, len(mine) + 1))


def test_letter_patterns_by_hand(spark):
    """Entries and links of odd lines: the SQL's patterns are its own, these values are neither's."""
    md = ("**To:** all\n**Date:** x\n**AAPL/TSLA:** up [a b](http://x/1) and [c](http://x/(2))\n**[GME]:**  gap\n"
          "** X:** spaced\n**No label** text\n**A*B:** star\n**[HALF:** open\n**END:**\n x **IN:** not first")
    df = spark.createDataFrame([("s", dt.date(2026, 1, 1), md)], "subreddit string, letter_date date, markdown string")
    entries = letter_qa.letter_entries(df)
    assert [(r.ticker, r.body) for r in entries.orderBy("entry_pos").collect()] == [
        ("AAPL/TSLA", "up [a b](http://x/1) and [c](http://x/(2))"), ("GME", "gap"), ("X", "spaced"), ("HALF", "open"), ("END", "")]
    assert rows(letter_qa.entry_links(entries), "text", "url") == [("a b", "http://x/1"), ("c", "http://x/(2")]
    assert rows(letter_qa.ticker_mentions(entries), "ticker") == [("AAPL",), ("END",), ("GME",), ("HALF",), ("TSLA",), ("X",)]
    df = spark.createDataFrame([("ABC a AB_C AB, (XYZ) ABCDEF A é QQ", 2), ("AB", None)], "text string, score int")
    assert rows(letter_qa.weighted_themes(df)) == [("AB", 2, 2), ("ABC", 2, 1), ("QQ", 2, 1), ("XYZ", 2, 1)]
