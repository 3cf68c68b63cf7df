"""Letter analytics over the archive.

The reference asks a model to follow these rules; over an archive they are
ordinary column expressions and aggregations.  All groupings are per
letter (bounded by its entries) or per ticker token (partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import letters as L

MIN_ENTRIES, MAX_ENTRIES = 8, 12
MAX_SENTENCES = 3
SENTENCE_END = r"[.!?]+(\s|$)"      # our sentence rule: end punctuation before space or end
TICKER_TOKEN = r"^[A-Z]{2,5}$"      # our theme heuristic: 2-5 capital letters
# The same tokens found in one pass: 2-5 capitals not touching [A-Za-z0-9_].
TICKER_SCAN = r"(?<![A-Za-z0-9_])[A-Z]{2,5}(?![A-Za-z0-9_])"


def letter_entries(letters: DataFrame) -> DataFrame:
    """M1: ``**LABEL:** body`` / ``**[LABEL]:** body`` lines of each letter,
    header lines (To, Date, Subject) excluded; ``entry_pos`` is 0-based.

    Each line is parsed once into (label, body); a non-empty label means
    the line is an entry."""
    parsed = F.transform(L.entry_lines(F.col("markdown")), lambda l: F.struct(
        F.regexp_extract(l, L.ENTRY_RE, 2).alias("label"), F.regexp_extract(l, L.ENTRY_RE, 4).alias("body")))
    kept = F.filter(parsed, lambda x: (x["label"] != "") & ~x["label"].isin(*L.HEADER_LABELS))
    e = letters.select("subreddit", "letter_date", F.posexplode(kept).alias("entry_pos", "x"))
    return e.select("subreddit", "letter_date", F.col("entry_pos").cast("bigint").alias("entry_pos"),
                    F.trim(F.col("x.label")).alias("ticker"), F.col("x.body").alias("body"))


def ticker_mentions(entries: DataFrame) -> DataFrame:
    """M2: combined labels split on ``/``; mentions per (community, day,
    ticker) with the day's rank (most mentioned first, then name)."""
    t = entries.select("subreddit", "letter_date",
                       F.explode(F.split("ticker", "/")).alias("t")).select(
        "subreddit", "letter_date", F.trim("t").alias("ticker")).where(F.col("ticker") != "")
    from pyspark.sql import Window
    c = t.groupBy("subreddit", "letter_date", "ticker").agg(F.count(F.lit(1)).alias("mentions"))
    w = Window.partitionBy("subreddit", "letter_date").orderBy(F.col("mentions").desc(), F.col("ticker"))
    return c.withColumn("rank", F.row_number().over(w).cast("bigint"))


def entry_links(entries: DataFrame) -> DataFrame:
    """M3: Markdown links of each entry: text, URL, kind."""
    z = entries.select("subreddit", "letter_date", "entry_pos",
                       F.arrays_zip(F.regexp_extract_all("body", F.lit(L.LINK_RE), 1).alias("text"),
                                    F.regexp_extract_all("body", F.lit(L.LINK_RE), 2).alias("url")).alias("_l"))
    e = z.select("subreddit", "letter_date", "entry_pos", F.posexplode("_l").alias("link_pos", "l"))
    return e.select("subreddit", "letter_date", "entry_pos", F.col("link_pos").cast("bigint").alias("link_pos"),
                    F.col("l.text").alias("text"), F.col("l.url").alias("url"),
                    L.link_kind(F.col("l.url")).alias("kind"))


def sentence_count(body: Column) -> Column:
    text = F.regexp_replace(body, L.LINK_RE, "$1")
    return F.size(F.regexp_extract_all(text, F.lit(SENTENCE_END), 0)).cast("bigint")


def letter_qa(letters: DataFrame) -> DataFrame:
    """M4: per letter: entry count in 8-12, every entry with a link and at
    most three sentences, no heading, header block present, no trailing
    ``Link:`` line."""
    e = letter_entries(letters)
    per = (e.select("subreddit", "letter_date",
                    (F.size(F.regexp_extract_all("body", F.lit(L.LINK_RE), 0)) > 0).alias("linked"),
                    sentence_count(F.col("body")).alias("sentences"))
            .groupBy("subreddit", "letter_date")
            .agg(F.count(F.lit(1)).alias("n_entries"),
                 F.count_if(~F.col("linked")).alias("entries_without_link"),
                 F.max("sentences").alias("max_sentences")))
    md = F.col("markdown")
    last_line = F.element_at(F.filter(F.split(md, "\n"), lambda x: F.trim(x) != ""), -1)
    base = letters.select(
        "subreddit", "letter_date",
        md.rlike(r"(?m)^#{1,6} ").alias("has_heading"),
        (md.rlike(r"(?m)^\*\*To:\*\*") & md.rlike(r"(?m)^\*\*Date:\*\*") & md.rlike(r"(?m)^\*\*Subject:\*\*"))
        .alias("header_ok"),
        F.coalesce(last_line.startswith("Link:"), F.lit(False)).alias("trailing_link_line"))
    j = base.join(per, ["subreddit", "letter_date"], "left").select(
        "subreddit", "letter_date",
        F.coalesce("n_entries", F.lit(0)).cast("bigint").alias("n_entries"),
        F.coalesce("entries_without_link", F.lit(0)).cast("bigint").alias("entries_without_link"),
        F.coalesce("max_sentences", F.lit(0)).cast("bigint").alias("max_sentences"),
        "has_heading", "header_ok", "trailing_link_line")
    ok = (F.col("n_entries").between(MIN_ENTRIES, MAX_ENTRIES) & (F.col("entries_without_link") == 0)
          & (F.col("max_sentences") <= MAX_SENTENCES) & ~F.col("has_heading") & F.col("header_ok")
          & ~F.col("trailing_link_line"))
    return j.withColumn("passes", ok)


def weighted_themes(texts: DataFrame) -> DataFrame:
    """M5: score-weighted ticker-like tokens over (text, score) rows.

    Tokens are runs of ASCII letters, digits and ``_``; a token of 2-5
    capitals counts.  Heuristic of ours: the reference leaves this to a
    model.  One regex pass per text finds exactly those tokens.
    """
    toks = texts.select(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TICKER_SCAN), 0).alias("_t"),
                        "score")
    ex = toks.select(F.explode("_t").alias("token"), F.coalesce("score", F.lit(0)).alias("score"))
    return ex.groupBy("token").agg(F.sum("score").cast("bigint").alias("weighted_score"),
                                   F.count(F.lit(1)).alias("mentions"))


def link_grounding(links: DataFrame, sources: DataFrame) -> DataFrame:
    """Letter links whose URL is not among the source URLs (anti join)."""
    # distinct: a URL repeated many times collapses map-side (partial
    # aggregation) instead of landing in one task on the anti join's right.
    s = sources.select(F.col("url").alias("_u")).distinct()
    return links.join(s, links.url == s._u, "left_anti")
