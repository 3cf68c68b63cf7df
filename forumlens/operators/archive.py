"""The letter archive: files in and out, pages, navigation, catalog, feed
(SURVEY A5, B7, B8, F4, G3, H3, H4, L3, L4).

Windows are partitioned by community and hold dates, never texts: an archive
holds at most one letter per community and day, so a partition's dates are few,
however long the letters are.
"""

from __future__ import annotations

from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import letters as L
from ..sources.files import file_system, put

RSS_LENGTH = 10
DEFAULT_BASE_URL = "https://example.org/letters"   # site address is a parameter

# Page templates, placeholders filled in this order.
INNER_TEMPLATE = "<nav>{{NAV_TOP}}</nav>\n<article>{{LETTER_CONTENT}}</article>\n{{NAV_BOTTOM}}"
BASE_TEMPLATE = ("<!DOCTYPE html>\n<html><head><title>r/{{SUBREDDIT}} {{DATE_YMD}}</title></head>\n"
                 "<body><h1>{{DATE_FULL}}</h1>\n{{CONTENT}}\n</body></html>")
INNER_ORDER = ("{{NAV_TOP}}", "{{LETTER_CONTENT}}", "{{NAV_BOTTOM}}")
BASE_ORDER = ("{{SUBREDDIT}}", "{{DATE_YMD}}", "{{DATE_FULL}}", "{{CONTENT}}")


def ingest_letters(spark: SparkSession, path: str, layout: str = "flat") -> DataFrame:
    """A5: letters from Markdown files, byte for byte, one per file.

    ``flat``: ``<path>/*.md``, no community (null).  ``partitioned``: the
    ``subreddit=<s>/<date>.md`` layout of :func:`write_letter_files`.  Files
    whose stem doesn't parse as a date are skipped.
    """
    schema = "value string, subreddit string" if layout == "partitioned" else "value string"
    df = spark.read.schema(schema).text(path, wholetext=True, pathGlobFilter="*.md")
    community = F.col("subreddit") if layout == "partitioned" else F.lit(None).cast("string")
    named = df.select(community.alias("subreddit"), F.col("_metadata.file_name").alias("file_name"),
                      F.col("value").alias("markdown"))
    dated = named.withColumn("letter_date", L.file_date(F.col("file_name"))).where(F.col("letter_date").isNotNull())
    return dated.select("subreddit", "letter_date", "file_name", "markdown")


def write_letter_files(letters: DataFrame, path: str) -> int:
    """Markdown export: ``subreddit=<s>/<date>.md``, for publishing and for A5;
    the number of files.

    Tasks write the files themselves: Spark's text writer would add a newline
    to each, and takes a folder per file.  Tiny files are slow on any file
    system; the archive itself is kept as a table (:func:`write_letters`).
    """
    def write(batches):
        store, base = file_system(path)
        made = set()
        for batch in batches:
            for row in batch.to_pylist():
                name = "__HIVE_DEFAULT_PARTITION__" if row["subreddit"] is None else quote(row["subreddit"], safe="")
                folder = f"{base}/subreddit={name}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                put(store, f"{folder}/{row['file']}", (row["markdown"] or "").encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    file = F.concat(F.date_format("letter_date", "yyyy-MM-dd"), F.lit(".md"))
    done = letters.select("subreddit", file.alias("file"), "markdown").mapInArrow(write, "n long")
    return done.agg(F.sum("n")).first()[0] or 0


def write_letters(letters: DataFrame, path: str) -> None:
    """The letter archive as a table, one row per (community, day) with
    its file name and Markdown, partitioned by community."""
    # No repartition by community: a community with a third of all letters
    # would be one task.  Rows stay spread as they are (by community and
    # day); sorting within each task keeps one open file per community.
    (letters.select("subreddit", "letter_date", "file_name", "markdown")
            .sortWithinPartitions("subreddit", "letter_date")
            .write.mode("overwrite").partitionBy("subreddit").parquet(path))


def letter_nav(letters: DataFrame) -> DataFrame:
    """Previous / next letter of the same community (null at the ends).

    The window runs over the letters' dates; the letters stay where they are and
    meet their links by community and day, so no community's texts are in one
    task.  Plain equality keeps letters that are dealt by these keys in place; the
    days of letters without a community are one row each and come by broadcast."""
    w = Window.partitionBy("subreddit").orderBy("letter_date")
    url = F.concat(F.date_format("letter_date", "yyyy-MM-dd"), F.lit(".html"))
    dates = letters.select("subreddit", "letter_date").distinct().withColumn("url", url)
    links = dates.select(F.col("subreddit").alias("_s"), F.col("letter_date").alias("_d"), F.struct(
        "url", F.lag("url").over(w).alias("prev_url"), F.lead("url").over(w).alias("next_url")).alias("_links"))
    none = links.where("_s is null").select(F.col("_d").alias("_day"), F.col("_links").alias("_none"))
    same = (letters["subreddit"] == links["_s"]) & (letters["letter_date"] == links["_d"])
    met = letters.join(links, same, "left")
    met = met.join(F.broadcast(none), letters["subreddit"].isNull() & (letters["letter_date"] == none["_day"]), "left")
    return met.select(*[letters[c] for c in letters.columns],
                      *[F.coalesce(f"_links.{c}", f"_none.{c}").alias(c) for c in ("url", "prev_url", "next_url")])


def _nav_html(prev_url: str, next_url: str) -> F.Column:
    def link(c: str, label: str) -> F.Column:
        return F.when(F.col(c).isNotNull(), F.concat(F.lit('<a href="'), F.col(c), F.lit(f'">{label}</a>'))) \
                .otherwise(F.lit(f'<span class="off">{label}</span>'))
    return F.concat_ws(" | ", link(prev_url, "Previous"), F.lit('<a href="catalog.html">Catalog</a>'),
                       link(next_url, "Next"))


def letter_pages(letters: DataFrame) -> DataFrame:
    """L4: one page per letter: url, title (J11), display date (J13), HTML
    content (L3), navigation (G3) and the filled page (J14)."""
    return filled_pages(letter_nav(letters))


def filled_pages(n: DataFrame) -> DataFrame:
    """L4 over letters that carry their navigation (url, prev_url, next_url)."""
    content = L.render_markdown(F.col("markdown"))
    inner = L.fill_template(F.lit(INNER_TEMPLATE), list(zip(INNER_ORDER, [
        _nav_html("prev_url", "next_url"), F.col("content_html"), F.lit("")])))
    page = L.fill_template(F.lit(BASE_TEMPLATE), list(zip(BASE_ORDER, [
        F.col("subreddit"), F.date_format("letter_date", "yyyy-MM-dd"), F.col("display_date"), inner])))
    return (n.select("subreddit", "letter_date", "url", "prev_url", "next_url",
                     L.letter_title(F.col("markdown")).alias("title"),
                     L.format_date(F.col("letter_date")).alias("display_date"),
                     content.alias("content_html"))
             .withColumn("page_html", page))


def write_pages(pages: DataFrame, path: str, months_only: bool = False) -> None:
    """The pages table, partitioned by month (community is a column);
    ``months_only`` replaces the months of ``pages`` and leaves others alone.

    Rows are dealt by month and community: a month of all communities may be
    large, one community's is 31 pages at most, and each makes one file.  Sorting
    within each task keeps one open file per month."""
    width = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (pages.withColumn("month", F.date_format("letter_date", "yyyy-MM"))
          .repartition(width, "month", "subreddit")
          .sortWithinPartitions("month", "subreddit", "letter_date")
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if months_only else "static")
          .partitionBy("month").parquet(path))


# ---------------------------------------------------------------- adding letters to an archive

_LETTER = ("subreddit", "letter_date", "file_name", "markdown")
_STORED = "subreddit string, letter_date date, file_name string, markdown string, month string, run long"


def _stored_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(path)


def _newest(letters: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """A letter per community and day, that of the latest run."""
    rest = [c for c in cols if c not in ("subreddit", "letter_date")]
    row = F.struct(*rest) if rest else F.struct("run")
    agg = letters.groupBy("subreddit", "letter_date").agg(F.max_by(row, F.col("run")).alias("_r"))
    return agg.select("subreddit", "letter_date", *[F.col(f"_r.{c}").alias(c) for c in rest])


def add_letters(new: DataFrame, letters_path: str, pages_path: str, run: int) -> list[str]:
    """Letters of one run into the archive; returns the months whose
    pages were written.

    Letters lie by month and run, pages by month.  A letter changes its own
    page, and the links of the letter before and the one after it: only the
    months of those three are written anew, by dynamic partition overwrite, and
    only their letters are read; the links come from the letters' dates.  A run
    that is repeated rewrites its own rows and pages; a later run's letter
    replaces an earlier one of its community and day.
    """
    spark = new.sparkSession
    dated = new.select(*_LETTER, F.date_format("letter_date", "yyyy-MM").alias("month"), F.lit(run).cast("long").alias("run"))
    (dated.sortWithinPartitions("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("month", "run").parquet(letters_path))
    stored = _stored_letters(spark, letters_path)
    dates = letter_nav(_newest(stored, ("subreddit", "letter_date"))).withColumn(
        "month", F.date_format("letter_date", "yyyy-MM"))
    fresh = stored.where(F.col("run") == run).select("subreddit", "letter_date").distinct().withColumn("fresh", F.lit(True))
    by_date = Window.partitionBy("subreddit").orderBy("letter_date")
    near = dates.join(fresh, ["subreddit", "letter_date"], "left").withColumn(
        "near", F.coalesce("fresh", F.lag("fresh").over(by_date), F.lead("fresh").over(by_date)))
    months = sorted(r[0] for r in near.where("near").select("month").distinct().collect())  # three per letter at most
    if months:
        texts = _newest(stored.where(F.col("month").isin(*months)), _LETTER)
        pages = filled_pages(texts.join(dates.where(F.col("month").isin(*months)), ["subreddit", "letter_date"]))
        write_pages(pages, pages_path, months_only=True)
    return months


# ---------------------------------------------------------------- documents of the site

RSS_TEMPLATE = ('<?xml version="1.0" encoding="UTF-8" ?>\n<rss version="2.0">\n<channel>\n<title>{{TITLE}}</title>\n'
                "<link>{{LINK}}</link>\n<description>{{DESCRIPTION}}</description>\n<language>en-us</language>\n"
                "{{ITEMS}}\n</channel>\n</rss>")
REDIRECT_TEMPLATE = ('<!DOCTYPE html>\n<html><head><meta http-equiv="refresh" content="0; url={{URL}}" /></head>\n'
                     '<body><a href="{{URL}}">{{URL}}</a></body></html>')


def rss_documents(pages: DataFrame, base_url: str = DEFAULT_BASE_URL, n: int = RSS_LENGTH,
                  escape_title: bool = False) -> DataFrame:
    """H4 as a document per community: the feed's items, newest first, in the
    feed's template."""
    item = F.concat(F.lit("<item><title>"), F.col("title"), F.lit("</title><link>"), F.col("link"), F.lit("</link><guid>"),
                    F.col("guid"), F.lit("</guid><pubDate>"), F.col("pub_date"),
                    F.lit("</pubDate><description><![CDATA["),
                    F.replace("description", F.lit("]]>"), F.lit("]]]]><![CDATA[>")), F.lit("]]></description></item>"))
    items = (rss_feed(pages, base_url, n, escape_title).groupBy("subreddit")
             .agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("i")))).alias("_i")))
    text = L.fill_template(F.lit(RSS_TEMPLATE), [
        ("{{TITLE}}", F.concat(F.lit("Letters of r/"), "subreddit")), ("{{LINK}}", F.lit(base_url)),
        ("{{DESCRIPTION}}", F.concat(F.lit("Daily letters from r/"), "subreddit")),
        ("{{ITEMS}}", F.array_join(F.transform("_i", lambda x: x["i"]), "\n"))])
    return items.select("subreddit", F.lit("rss.xml").alias("file_name"), text.alias("document"))


def catalog_documents(pages: DataFrame) -> DataFrame:
    """F4 as a document per community: a heading per month, newest first, and
    below it a line per letter.  It holds a line per letter of one community,
    at most one a day."""
    line = F.concat(F.lit("<li>"), F.col("display_date"), F.lit(' <a href="'), F.col("url"), F.lit('">'), F.col("title"),
                    F.lit("</a></li>"))
    m = pages.withColumn("month_key", F.date_format("letter_date", "yyyy-MM"))
    months = (m.groupBy("subreddit", "month_key")
               .agg(F.sort_array(F.collect_list(F.struct("letter_date", line.alias("l"))), asc=False).alias("_l"),
                    F.min("letter_date").alias("_d")))
    block = F.concat(F.lit("<h2>"), F.date_format("_d", "MMMM yyyy"), F.lit("</h2>\n<ul>"),
                     F.array_join(F.transform("_l", lambda x: x["l"]), ""), F.lit("</ul>"))
    return (months.groupBy("subreddit")
                  .agg(F.sort_array(F.collect_list(F.struct("month_key", block.alias("b"))), asc=False).alias("_m"))
                  .select("subreddit", F.lit("catalog.html").alias("file_name"),
                          F.array_join(F.transform("_m", lambda x: x["b"]), "\n").alias("document")))


def redirect_documents(pages: DataFrame) -> DataFrame:
    """H3 as a document per community: a page that leads to the newest letter."""
    text = L.fill_template(F.lit(REDIRECT_TEMPLATE), [("{{URL}}", F.col("url"))])
    return latest_letter(pages).select("subreddit", F.lit("index.html").alias("file_name"), text.alias("document"))


def site_documents(pages: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """Feed, catalog and redirect of every community, one row each."""
    return rss_documents(pages, base_url).unionByName(catalog_documents(pages)).unionByName(redirect_documents(pages))


def month_catalog(pages: DataFrame) -> DataFrame:
    """letters grouped by month, newest first within the month;
    ``month_label`` like ``August 2026``."""
    m = pages.withColumn("month_key", F.date_format("letter_date", "yyyy-MM"))
    item = F.concat_ws("|", F.col("display_date"), F.col("url"), F.col("title"))
    return (m.groupBy("subreddit", "month_key")
             .agg(F.sort_array(F.collect_list(F.struct("letter_date", item.alias("i"))), asc=False).alias("_l"),
                  F.min("letter_date").alias("_d"))
             .select("subreddit", "month_key", F.date_format("_d", "MMMM yyyy").alias("month_label"),
                     F.size("_l").cast("bigint").alias("n_letters"),
                     F.array_join(F.transform("_l", lambda x: x["i"]), "\n").alias("items")))


def latest_letter(pages: DataFrame) -> DataFrame:
    """H3: newest letter per community (the redirect target)."""
    return pages.groupBy("subreddit").agg(F.max("letter_date").alias("letter_date"),
                                          F.max_by("url", "letter_date").alias("url"))


def rss_feed(pages: DataFrame, base_url: str = DEFAULT_BASE_URL, n: int = RSS_LENGTH,
             escape_title: bool = False) -> DataFrame:
    """H4: the ``n`` newest letters per community as feed items; dates print
    as ``Fri, 21 Aug 2026 00:00:00 +0000``.  Titles go out as they are by
    default, as the reference does; ``escape_title`` XML-escapes them."""
    w = Window.partitionBy("subreddit").orderBy(F.col("letter_date").desc())
    link = F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("url"))
    title = F.col("title")
    if escape_title:
        title = F.replace(F.replace(F.replace(title, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                          F.lit(">"), F.lit("&gt;"))
    return (pages.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                 .select("subreddit", F.col("rank").cast("bigint").alias("rank"), title.alias("title"),
                         link.alias("link"), link.alias("guid"),
                         F.concat(F.date_format("letter_date", "EEE, dd MMM yyyy"), F.lit(" 00:00:00 +0000"))
                          .alias("pub_date"),
                         F.col("content_html").alias("description")))
