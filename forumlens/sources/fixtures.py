"""Projections of the driver's tables onto the digest relations.

The test data has no forum tables, so each relation is derived from a
driver table (see FIXTURES.md).  Every projection reads the whole source
table: no id ranges, row caps or prefixes.  ``plans/oracle_views.py`` holds
the same projections as DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import ntz, table

DEFAULT_SCRAPE = "2024-01-01 00:00:00"


def post_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("post_reddit_id"),
        F.col("ts").alias("scraped_at"),
        F.floor(F.col("value") * 10).cast("bigint").alias("score"),
        F.round(F.col("value") / 100.0, 4).alias("upvote_ratio"),
        (F.col("event_id") % 97).alias("num_comments"),
        (F.col("event_type") == "signup").alias("is_pinned"),
    )


def posts(spark: SparkSession, sf: str, with_text: bool = True) -> DataFrame:
    d = table(spark, sf, "documents")
    seen = (table(spark, sf, "events").groupBy("user_id")
            .agg(F.min("ts").alias("f"), F.max("ts").alias("l")))
    discussion = F.concat(F.lit("https://www.reddit.com/r/"), d.source, F.lit("/comments/"),
                          d.doc_id.cast("string"), F.lit("/"))
    # The first line is the title, the rest the body: each word is in one of them.
    title = F.substring_index(d.text, "\n", 1)
    cols = [
        d.doc_id.alias("reddit_id"),
        d.source.alias("subreddit"),
        title.alias("title"),
    ]
    if with_text:
        cols.append(F.substr(d.text, F.length(title) + 2).alias("selftext"))
    cols += [
        F.when(d.doc_id % 3 == 0, discussion)
         .otherwise(F.concat(F.lit("https://"), d.source, F.lit(".example.com/p/"),
                             d.doc_id.cast("string"))).alias("url"),
        d.lang.alias("author"),
        F.coalesce(F.col("f"), ntz(DEFAULT_SCRAPE)).alias("first_scraped_at"),
        F.coalesce(F.col("l"), ntz(DEFAULT_SCRAPE)).alias("last_scraped_at"),
    ]
    # No hint: Spark broadcasts ``seen`` only when its size estimate (an
    # upper bound: the events scan) is under the broadcast threshold.
    return d.join(seen, d.doc_id == seen.user_id, "left").select(*cols)


def comments(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    rid = F.concat(c.conv_id.cast("string"), F.lit("_"), c.turn.cast("string"))
    return c.select(
        rid.alias("reddit_id"),
        c.conv_id.alias("post_reddit_id"),
        c.turn,
        c.text.alias("body"),
        c.role.alias("author"),
        F.concat(F.lit("/r/c/comments/"), c.conv_id.cast("string"), F.lit("/x/"), rid,
                 F.lit("/")).alias("permalink"),
        (ntz(DEFAULT_SCRAPE) + F.make_dt_interval(F.lit(0), c.turn.cast("int"))).alias("last_scraped_at"),
        ntz(DEFAULT_SCRAPE).alias("first_scraped_at"),
    )


def comment_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        (li.l_orderkey * 10 + li.l_linenumber).alias("id"),
        F.concat(li.l_orderkey.cast("string"), F.lit("_"),
                 (li.l_linenumber - 1).cast("string")).alias("comment_reddit_id"),
        li.l_shipdate.alias("scraped_at"),
        (li.l_quantity.cast("bigint") - 10).alias("score"),
    )


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """A report per community and day, at the community's first event of the day."""
    from ..functions.text import new_york
    e = table(spark, sf, "events").select(
        F.concat(F.lit("src"), (F.col("event_id") % 20).cast("string")).alias("subreddit"),
        F.to_date("ts").alias("day"), "event_id", "ts", "props")
    first = e.groupBy("subreddit", "day").agg(F.min(F.struct("ts", "event_id", "props")).alias("f"))
    key = F.col("f.event_id")
    return first.select(key.alias("id"), "subreddit", F.col("f.ts").alias("generated_at"),
                        F.to_date(new_york(F.col("f.ts"))).alias("report_date"),
                        F.concat(F.lit("p"), (key % 3).cast("string")).alias("llm_provider"),
                        F.concat(F.lit("m"), (key % 5).cast("string")).alias("llm_model"),
                        F.concat(F.lit("**Subject:** "), F.col("f.props")).alias("markdown"))


def report_links(spark: SparkSession, sf: str) -> DataFrame:
    """News that a report may cite: the items that its community's query found
    on the day of the report."""
    number = F.substr("subreddit", F.lit(4)).cast("int")
    query = F.element_at(F.array(*[F.lit(x) for x in ("en", "de", "fr", "es")]), number % 4 + 1)
    r = reports(spark, sf).select(F.col("id").alias("report_id"), query.alias("query"),
                                  F.to_date("generated_at").alias("day"), F.col("generated_at").alias("included_at"))
    n = news_items(spark, sf).select(F.col("id").alias("news_item_id"), "query", F.to_date("fetched_at").alias("day"))
    return r.join(n, ["query", "day"]).select("report_id", "news_item_id", "query", "included_at")


def news_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Each community's list of news queries in order (``qpos``): the languages
    of its documents, plain and in two variants that find nothing, the most
    frequent first."""
    from pyspark.sql import Window
    d = table(spark, sf, "documents")
    k = d.doc_id % 3
    name = F.when(k == 0, d.lang).otherwise(F.concat(d.lang, F.lit("-"), k.cast("string")))
    n = d.select(d.source.alias("subreddit"), name.alias("query")).groupBy("subreddit", "query").count()
    w = Window.partitionBy("subreddit").orderBy(F.desc("count"), "query")
    return n.select("subreddit", "query", F.row_number().over(w).cast("bigint").alias("qpos"))


def volume_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Large comment table: lineitem (post = order)."""
    li = table(spark, sf, "lineitem")
    return li.select(li.l_orderkey.alias("post_reddit_id"), li.l_linenumber.alias("line"),
                     li.l_partkey, li.l_suppkey,
                     li.l_shipdate.alias("last_scraped_at"),
                     li.l_quantity.cast("bigint").alias("score"))


def listing_batch_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of an incoming listing: the distinct customer keys of orders."""
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("reddit_id")).distinct()


# ---------------------------------------------------------------- news

def _page_news_base(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.news_text import clean_text
    p = table(spark, sf, "pages")
    at = ntz(DEFAULT_SCRAPE) + F.make_dt_interval(F.lit(0), p.page_id.cast("int"))
    stamp = F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss")
    k = p.page_id % 5
    article = F.regexp_extract(p.html, r"(?s)<article>(.*)</article>", 1)  # its markup comes as an item's description
    pub = (F.when(k == 0, F.concat(stamp, F.lit(" GMT")))
            .when(k == 1, F.concat(stamp, F.lit(" -0400")))
            .when(k == 2, stamp)
            .when(k == 3, F.concat(stamp, F.lit(" EST")))
            .when(p.page_id % 10 == 4, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.lit("soon")))
    return p.select(
        p.page_id.alias("id"),
        F.lit("google_news").alias("provider"),
        F.regexp_extract(p.url, r"^https?://[^/]+/([a-z]+)/", 1).alias("query"),
        clean_text(F.regexp_extract(p.html, r"(?s)<title>(.*?)</title>", 1)).alias("title"),
        p.url.alias("url"),
        F.regexp_extract(p.url, r"^https?://([^/?#]+)", 1).alias("source_name"),
        pub.alias("published_raw"),
        article.alias("article"),
        clean_text(article).alias("summary"),
        (ntz(DEFAULT_SCRAPE) + F.make_dt_interval(F.lit(0), F.lit(0), p.page_id.cast("int"))).alias("fetched_at"),
        p.html.alias("raw"),
    )


def news_items(spark: SparkSession, sf: str) -> DataFrame:
    """News items from pages; every fifth page was fetched a second time a
    day later under a new id (duplicates for UNIQUE(provider, query, url))."""
    base = _page_news_base(spark, sf)
    again = (base.where(F.col("id") % 5 == 0)
                 .withColumn("fetched_at", F.col("fetched_at") + F.make_dt_interval(F.lit(1)))
                 .withColumn("id", F.col("id") + 1000000000))
    return base.unionByName(again)


def rss_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Landed RSS payloads: one feed per (query, block of ten page ids).
    Every seventh page lost its title on the way."""
    from ..functions.news_text import xml_escape
    b = _page_news_base(spark, sf)
    title = F.when(F.col("id") % 7 == 0, F.lit("")).otherwise(F.col("title"))
    item = F.concat(
        F.lit("<item><title>"), xml_escape(title), F.lit("</title><link>"), xml_escape(F.col("url")),
        F.lit("</link><pubDate>"), xml_escape(F.col("published_raw")), F.lit("</pubDate><description>"),
        xml_escape(F.col("article")), F.lit("</description><source url=\""), xml_escape(F.col("url")),
        F.lit("\">"), xml_escape(F.col("source_name")), F.lit("</source></item>"))
    feeds = (b.select("query", F.floor(F.col("id") / 10).alias("bucket"), "id", item.alias("item"))
              .groupBy("query", "bucket")
              .agg(F.array_sort(F.collect_list(F.struct("id", "item"))).alias("_i")))
    return feeds.select("query", "bucket", F.concat(
        F.lit("<rss version=\"2.0\"><channel>"), F.array_join(F.transform("_i", lambda x: x["item"]), ""),
        F.lit("</channel></rss>")).alias("xml"))


# ---------------------------------------------------------------- letters

#: Orders whose text one task holds at a time, about 25 MB.
ORDERS_A_TASK = 100_000


def letter_entries_source(spark: SparkSession, sf: str) -> DataFrame:
    """The orders a letter covers: all of a (segment, day), largest first.

    Dealt by letter into a number of parts that follows the orders: an order's
    text is many times its row, so shuffle sizes tell too little of it."""
    from pyspark.sql import Window
    o = table(spark, sf, "orders")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), o.count() // ORDERS_A_TASK + 1)
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey).select(
        F.lower("c_mktsegment").alias("subreddit"), F.to_date("o_orderdate").alias("letter_date"),
        "o_orderkey", "o_custkey", "c_name", "o_orderstatus", "o_orderpriority", "o_totalprice")
    j = j.repartition(parts, "subreddit", "letter_date")
    w = Window.partitionBy("subreddit", "letter_date").orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey"))
    return j.withColumn("rank", F.row_number().over(w).cast("bigint"))


def _entry_text() -> "F.Column":
    key = F.col("o_orderkey").cast("string")
    post = F.concat(F.lit("https://www.reddit.com/r/"), F.col("subreddit"), F.lit("/comments/"), key,
                    F.lit("/order_"), key, F.lit("/"))
    label = F.concat(F.upper(F.regexp_replace("o_orderpriority", "^[0-9]+-", "")), F.lit("/"),
                     F.when(F.col("o_orderstatus") == "F", F.lit("FILLED"))
                      .when(F.col("o_orderstatus") == "O", F.lit("OPEN")).otherwise(F.lit("PARTIAL")))
    head = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("**["), label, F.lit("]:** "))) \
            .otherwise(F.concat(F.lit("**"), label, F.lit(":** ")))
    price = F.floor("o_totalprice").cast("bigint").cast("string")
    linked = F.concat(F.lit("Order ["), key, F.lit("]("), post, F.lit(") from ["), F.col("c_name"), F.lit("]("),
                      post, F.lit("c"), F.col("o_custkey").cast("string"), F.lit("/) totals "), price, F.lit("."))
    plain = F.concat(F.lit("Order "), key, F.lit(" totals "), price, F.lit(" with no source."))
    tail = (F.when(F.col("o_orderstatus") == "F",
                   F.concat(F.lit(" See [news](https://news.google.com/rss/articles/"), key, F.lit(")!")))
             .when(F.col("o_orderstatus") == "P",
                   F.concat(F.lit(" Filing: [filing](https://example.com/filings/"), key, F.lit(")."))))
    return F.concat(head, F.when(F.col("o_orderkey") % 11 == 0, plain)
                    .otherwise(F.concat(linked, F.coalesce(tail, F.lit("")))))


def letters(spark: SparkSession, sf: str) -> DataFrame:
    """One Markdown letter per (segment, day): header block, greeting, one
    ``**LABEL:**`` entry per order.  Some days vary the layout: no
    subject (day 20), a heading (day 7), a trailing ``Link:`` line (day 13),
    date with or without time (odd/even day), none (day 17)."""
    e = letter_entries_source(spark, sf).select("subreddit", "letter_date", "rank",
                                                          _entry_text().alias("entry"))
    g = (e.groupBy("subreddit", "letter_date")
          .agg(F.array_sort(F.collect_list(F.struct("rank", "entry"))).alias("_e")))
    d = F.col("letter_date")
    day = F.dayofmonth(d)
    date_txt = F.when(day == 17, F.lit("soon")).when(day % 2 == 1, F.concat(F.date_format(d, "MMMM dd, yyyy"), F.lit(" at 07:00 PM EDT"))) \
                .otherwise(F.date_format(d, "MMMM dd, yyyy"))
    subject = F.when(day == 20, F.lit("")).otherwise(
        F.concat(F.lit("**Subject:** Orders of "), F.date_format(d, "yyyy-MM-dd"), F.lit("\n")))
    md = F.concat(
        F.lit("**To:** Investors\n**Date:** "), date_txt, F.lit("\n"), subject,
        F.lit("\nDear investors,\n\n"),
        F.when(day == 7, F.lit("## Notes\n\n")).otherwise(F.lit("")),
        F.array_join(F.transform("_e", lambda x: x["entry"]), "\n\n"),
        F.when(day == 13, F.lit("\n\nLink:")).otherwise(F.lit("")),
        F.lit("\n"))
    return g.select("subreddit", "letter_date",
                    F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(".md")).alias("file_name"),
                    md.alias("markdown"))


# ---------------------------------------------------------------- landed listings

def listing_from_events(events: DataFrame) -> DataFrame:
    """Listing observations derived from events (batch or stream): one per
    event, scraped in hourly batches, ``position`` = event id."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    return events.select(
        F.col("event_id").alias("position"), hour.alias("scraped_at"),
        F.col("user_id").alias("reddit_id"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("subreddit"),
        F.concat(F.lit("post "), F.col("user_id").cast("string"), F.lit(" "), F.col("event_type")).alias("title"),
        F.col("props").alias("selftext"),
        F.concat(F.lit("https://example.com/"), F.col("user_id").cast("string")).alias("url"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), (F.col("event_id") % 7).cast("string"))).alias("author"),
        F.lit(None).cast("string").alias("created_utc"),
        F.floor(F.col("value") * 10).cast("bigint").alias("score"),
        F.round(F.col("value") / 100.0, 4).alias("upvote_ratio"),
        (F.col("event_id") % 97).alias("num_comments"),
        (F.col("event_type") == "signup").alias("is_pinned"))


def with_nested_comments(listing: DataFrame) -> DataFrame:
    """Listing rows with none to three nested comments each.  Two posts share a
    pool of comment ids, so comments move between posts; some have no id."""
    one = F.col("position")

    def comment(i):
        key = F.concat(F.lit("c"), (F.floor(F.col("reddit_id") / 2) * 10 + (one + i) % 10).cast("string"))
        return F.struct(
            F.when((one + i) % 11 == 0, F.lit("")).when((one + i) % 13 != 0, key).alias("reddit_id"),
            F.concat(F.lit("note "), i.cast("string"), F.lit(" "), F.col("selftext")).alias("body"),
            F.concat(F.col("url"), F.lit("#"), i.cast("string")).alias("url"),
            F.col("author").alias("author"), (F.col("score") - i).alias("score"),
            F.lit(None).cast("string").alias("created_utc"))

    numbers = F.filter(F.sequence(F.lit(0).cast("bigint"), one % 4), lambda i: i > 0)
    return listing.withColumn("comments", F.transform(numbers, comment))


def landed_lines(listing: DataFrame) -> DataFrame:
    """Nested listing rows as JSON lines, one column ``value``: every 50th line
    is cut, every 53rd holds a null title, every 59th no title at all, every 61st
    no community."""
    k, cols = F.col("position"), [c for c in listing.columns if c not in ("title", "subreddit")]
    rest = F.to_json(F.struct(*cols))
    title = F.when(k % 53 == 5, F.lit('"title":null,')).when(k % 59 == 5, F.lit("")).otherwise(
        F.concat(F.lit('"title":"'), F.col("title"), F.lit('",')))
    community = F.when(k % 61 == 5, F.lit("")).otherwise(F.concat(F.lit('"subreddit":"'), F.col("subreddit"), F.lit('",')))
    line = F.concat(F.lit("{"), title, community, F.substr(rest, F.lit(2)))
    return listing.select(F.when(k % 50 == 7, F.substr(line, F.lit(1), F.lit(40))).otherwise(line).alias("value"))
