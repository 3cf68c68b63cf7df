"""External news: RSS payloads to items, per-query caps, the news context
text, and search queries from a model response (SURVEY A4, F6, G5, L5, D8,
J16).  Network fetching is not done here: payloads are landed data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import news_text as N
from ..functions import text as T
from ..schemas import RSS_DOC

ITEMS_PER_QUERY = 3
MAX_QUERIES = 8


def ingest_rss(payloads: DataFrame, key: list[str], xml: str = "xml",
               per_query: int = ITEMS_PER_QUERY) -> DataFrame:
    """A4: RSS payload rows to news item rows.

    Items without title or link are dropped **before** the per-payload cap
    of ``per_query``; ``item_pos`` keeps feed order and ``raw`` the item's
    XML text.  XML decoding removes one escape level, ``clean_text`` the
    second.
    """
    parsed = payloads.select(*key, F.from_xml(F.col(xml), RSS_DOC, {"rowTag": "rss"}).alias("_d"),
                             F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<item\b[^>]*/>|<item\b.*?</item>"), 0).alias("_raw"))
    items = parsed.select(*key, "_raw", F.posexplode("_d.channel.item").alias("item_pos", "it"))
    cleaned = items.select(
        *key, F.col("item_pos").cast("bigint").alias("item_pos"),
        F.try_element_at("_raw", F.col("item_pos") + 1).alias("raw"),
        N.clean_text(F.col("it.title")).alias("title"),
        N.clean_text(F.col("it.link")).alias("url"),
        N.clean_text(F.col("it.source._VALUE")).alias("source_name"),
        N.parse_rfc822(F.col("it.pubDate")).alias("published_at"),
        N.clean_text(F.col("it.description")).alias("summary"))
    kept = cleaned.where((F.col("title") != "") & (F.col("url") != ""))
    w = Window.partitionBy(*key).orderBy("item_pos")
    return (kept.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_query).drop("_rn")
                .withColumn("provider", F.lit(N.NEWS_PROVIDER)))


def cap_per_query(queries: DataFrame, items: DataFrame, group: list[str], item_order: Column,
                  per_query: int = ITEMS_PER_QUERY, max_queries: int = MAX_QUERIES) -> DataFrame:
    """The first ``max_queries`` queries of each group's list (``qpos``),
    with the first ``per_query`` items of each.

    The list is cut before queries without items vanish, so those count; a
    query that is listed twice has its items twice.  ``qrank``/``irank`` are
    1-based.  Both caps are row_number limits, so a query with millions of items
    moves only ``per_query`` rows per task.
    """
    wi = Window.partitionBy("query").orderBy(item_order)
    capped = items.withColumn("irank", F.row_number().over(wi)).where(F.col("irank") <= per_query)
    wq = Window.partitionBy(*group).orderBy("qpos")
    listed = queries.withColumn("qrank", F.row_number().over(wq)).where(F.col("qrank") <= max_queries)
    return (listed.select(*group, "query", F.col("qrank").cast("bigint").alias("qrank"))
                  .join(capped.withColumn("irank", F.col("irank").cast("bigint")), "query"))


def _item_block() -> Column:
    def opt(label: str, c: str) -> Column:
        return F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(label), F.col(c)))
    return F.concat_ws("\n", F.concat(F.lit(N.ITEM_TITLE), F.coalesce("title", F.lit(""))),
                       opt(N.ITEM_SOURCE, "source_name"), opt(N.ITEM_PUBLISHED, "published_at"),
                       opt(N.ITEM_SUMMARY, "summary"),
                       F.concat(F.lit(N.ITEM_URL), F.coalesce("url", F.lit(""))))


def news_context(capped: DataFrame, group: list[str]) -> DataFrame:
    """``External News Context:`` and one block per query with items, in
    query order; queries without items are absent.  Groups without any
    item get no row (the reference's empty string)."""
    per_query = (capped.groupBy(*group, "query", "qrank")
                 .agg(F.array_sort(F.collect_list(F.struct("irank", _item_block().alias("b")))).alias("_i"))
                 .select(*group, "qrank",
                         F.concat(F.col("query"), F.lit(":\n"),
                                  F.array_join(F.transform("_i", lambda x: x["b"]), "\n")).alias("qb")))
    return (per_query.groupBy(*group)
            .agg(F.array_sort(F.collect_list(F.struct("qrank", "qb"))).alias("_q"))
            .select(*group, F.concat(F.lit(N.NEWS_CONTEXT_HEADER + "\n"),
                                     F.array_join(F.transform("_q", lambda x: x["qb"]), "\n"),
                                     F.lit("\n")).alias("news_context")))


def response_lines(responses: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """Lines of a model response (after stripping the whole text), with
    their raw and cleaned (J16) forms."""
    lines = responses.select(*key, F.posexplode(F.split(T.py_strip(F.coalesce(F.col(text), F.lit(""))), "\n"))
                             .alias("line_pos", "line"))
    return lines.select(*key, F.col("line_pos").cast("bigint").alias("line_pos"), "line",
                        T.query_line_clean(F.col("line")).alias("clean"))


def extract_queries(responses: DataFrame, key: list[str], text: str = "text",
                    max_queries: int = MAX_QUERIES) -> DataFrame:
    """Cleaned (J16), filtered (D8) search queries, the first
    ``max_queries`` per response, no de-duplication."""
    kept = response_lines(responses, key, text).where(T.query_line_keep(F.col("clean")))
    w = Window.partitionBy(*key).orderBy("line_pos")
    return (kept.withColumn("qpos", F.row_number().over(w)).where(F.col("qpos") <= max_queries)
                .select(*key, F.col("qpos").cast("bigint").alias("qpos"), F.col("clean").alias("query")))
