"""Edge rows for news (J9, J10, A4, F6, L5) and the archive."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from forumlens.functions import letters as L
from forumlens.functions import news_text as N
from forumlens.operators import archive, letter_qa, news
from forumlens.sources import fixtures as fx

from conftest import SF_SMALL, rows


def _col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_text_cases(spark):
    got = _col(spark, ["&lt;i&gt;x&lt;/i&gt;", "<b>A</b> &amp; B", "&amp;lt;", None, " &nbsp;x&nbsp; "], N.clean_text)
    assert got == ["<i>x</i>", "A & B", "&lt;", "", "x"]


def test_clean_text_decodes_all_entities(spark):
    table = [
        ("&copy; 2024 &middot; x", "\u00a9 2024 \u00b7 x"), ("<p>&eacute;t&eacute;</p>", "\u00e9t\u00e9"),
        ("&#8212;dash", "\u2014dash"), ("&#8217;s &rsquo;s &mdash; &#039;q&#039;", "\u2019s \u2019s \u2014 'q'"),
        ("&#x1F600; &#X41;&#65", "\U0001f600 AA"), ("&amp;amp; &amp;lt;", "&amp; &lt;"), ("AT&T &c. a & b &", "AT&T &c. a & b &"),
        ("&notit; &ampx &unknown; &notin;", "\u00acit; &x &unknown; \u2209"), ("&#128; &#0; &#xD800; &#1; &#9999999999;", "\u20ac \ufffd \ufffd  \ufffd"),
        ("&NotEqualTilde;", "\u2242\u0338"), ("&#;&#x;", "&#;&#x;"), ("line\none &lt;b&gt;", "line\none <b>")]
    assert _col(spark, [x for x, _ in table], N.clean_text) == [y for _, y in table]


def test_parse_rfc822_cases(spark):
    got = _col(spark, ["Fri, 21 Aug 2026 19:00:00 -0400", "Fri, 21 Aug 2026 19:00:00", "soon",
                       "Sat, 22 Aug 2026 01:02:03 GMT", "2026-08-21T19:00:00", None, "21 aug 2026 19:00 EST"],
               N.parse_rfc822)
    assert got == ["2026-08-21T23:00:00+00:00", "2026-08-21T19:00:00+00:00", "soon",
                   "2026-08-22T01:02:03+00:00", "2026-08-21T19:00:00", None, "2026-08-22T00:00:00+00:00"]


def test_parse_rfc822_other_forms(spark):
    table = [
        ("Friday, 21 Aug 2026 19:00:00 +0000 (UTC)", "2026-08-21T19:00:00+00:00"), ("21 August 26 19:00 Z", "2026-08-21T19:00:00+00:00"),
        ("Fri, 21 Aug 70 19:00:00 GMT", "1970-08-21T19:00:00+00:00"), ("2026-08-21", "2026-08-21T00:00:00"),
        ("2026-08-21T19:00:05.678", "2026-08-21T19:00:05"), ("2026-08-21T19:00:05Z", "2026-08-21T19:00:05+00:00"),
        ("2026-08-21 19:00:05+0200", "2026-08-21T19:00:05+02:00"), ("2024-13-45T00:00", "2024-13-45T00:00"),
        ("Fri, 32 Aug 2026 19:00:00 GMT", "Fri, 32 Aug 2026 19:00:00 GMT"), ("", None)]
    assert _col(spark, [x for x, _ in table], N.parse_rfc822) == [y for _, y in table]


def test_ingest_rss_drops_before_cap(spark):
    xml = ("<rss><channel>"
           "<item><title></title><link>l0</link></item>"
           "<item><title>A &amp;amp; B</title><link>l1</link><source url='s'>Src</source></item>"
           "<item><title>t2</title><link>l2</link></item>"
           "<item><title>t3</title></item>"
           "<item><title>t4</title><link>l4</link></item>"
           "<item><title>t5</title><link>l5</link></item>"
           "</channel></rss>")
    df = spark.createDataFrame([("q", xml)], "query string, xml string")
    out = news.ingest_rss(df, ["query"])
    got = rows(out, "item_pos", "title", "url", "source_name")
    assert got == [(1, "A & B", "l1", "Src"), (2, "t2", "l2", ""), (4, "t4", "l4", "")]
    raw = {r["item_pos"]: r["raw"] for r in out.collect()}
    assert raw[2] == "<item><title>t2</title><link>l2</link></item>"


def test_news_context_text(spark):
    items = spark.createDataFrame([
        ("p", "fed", 1, "T1", "S", "2026-01-01T00:00:00+00:00", "", "u1"),
        ("p", "fed", 2, "T2", "", None, "sum", "u2"),
        ("p", "oil", 3, "T3", None, None, None, "u3"),
    ], "provider string, query string, id bigint, title string, source_name string, published_at string, "
       "summary string, url string")
    items = items.drop("provider")
    queries = spark.createDataFrame([("p", "fed", 1), ("p", "nothing", 2), ("p", "oil", 3)], "provider string, query string, qpos int")
    capped = news.cap_per_query(queries, items, ["provider"], F.col("id"))
    text = news.news_context(capped, ["provider"]).first()["news_context"]
    assert text == ("External News Context:\nfed:\n- Title: T1\n  Source: S\n  Published: 2026-01-01T00:00:00+00:00\n"
                    "  URL: u1\n- Title: T2\n  Summary: sum\n  URL: u2\noil:\n- Title: T3\n  URL: u3\n")
    assert news.news_context(capped.where("false"), ["provider"]).count() == 0


def test_extract_queries(spark):
    df = spark.createDataFrame([(1, "Here are queries:\n- crude oil prices\n\"Fed\"\n" + "\n".join(f"q{i}" for i in range(10)))],
                               "k bigint, text string")
    got = [r["query"] for r in news.extract_queries(df, ["k"]).orderBy("qpos").collect()]
    assert got == ["crude oil prices", "Fed"] + [f"q{i}" for i in range(6)]


def test_letter_title_cases(spark):
    got = _col(spark, ["no subject here", "**Subject:**\nNext line\n", "x\n**Subject:**  Hello  \n**Subject:** 2"],
               L.letter_title)
    assert got == ["Market Summary", "Next line", "Hello"]


def test_ingest_letters_flat_files(spark):
    d = tempfile.mkdtemp(prefix="letters-", dir="/tmp")
    for name, body in [("2026-1-5.md", "**Subject:** A\n"), ("2026-01-06.md", "B\n"), ("notes.md", "skip"),
                       ("2026-02-30.md", "bad date")]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(body)
    got = rows(archive.ingest_letters(spark, d), "file_name", "letter_date", "markdown")
    assert got == [("2026-01-06.md", dt.date(2026, 1, 6), "B\n"), ("2026-1-5.md", dt.date(2026, 1, 5), "**Subject:** A\n")]


def test_letter_files_round_trip(spark):
    d = tempfile.mkdtemp(prefix="export-", dir="/tmp")
    letters = spark.createDataFrame([("s", dt.date(2026, 1, 5), "2026-01-05.md", "A\n\nB\n"),
                                     ("s", dt.date(2026, 1, 6), "2026-01-06.md", "C\n")],
                                    "subreddit string, letter_date date, file_name string, markdown string")
    archive.write_letter_files(letters, d + "/x")
    back = archive.ingest_letters(spark, d + "/x", layout="partitioned")
    assert rows(back) == rows(letters)


def test_nav_ends_and_render(spark):
    letters = spark.createDataFrame([("s", dt.date(2026, 1, d), f"**Subject:** T{d}\n\n**A:** see [x](http://u) *now*")
                                     for d in (1, 2, 3)],
                                    "subreddit string, letter_date date, markdown string")
    pages = {r["letter_date"].day: r for r in archive.letter_pages(letters).collect()}
    assert pages[1]["prev_url"] is None and pages[3]["next_url"] is None and pages[2]["prev_url"] == "2026-01-01.html"
    assert pages[1]["content_html"] == ('<p><strong>Subject:</strong> T1</p>\n'
                                        '<p><strong>A:</strong> see <a href="http://u">x</a> <em>now</em></p>')
    assert pages[1]["title"] == "T1"


def test_letter_qa_rules(spark):
    entry = "**X:** One. Two [l](https://www.reddit.com/r/a/comments/1/s/c2/)."
    md = "**To:** A\n**Date:** B\n**Subject:** C\n\n" + "\n\n".join([entry] * 8)
    bad = md + "\n\n**Y:** no link. a. b. c.\n\nLink:"
    df = spark.createDataFrame([("s", dt.date(2026, 1, 1), md), ("s", dt.date(2026, 1, 2), bad)],
                               "subreddit string, letter_date date, markdown string")
    out = {r["letter_date"].day: r for r in letter_qa.letter_qa(df).collect()}
    assert out[1]["passes"] and out[1]["n_entries"] == 8 and out[1]["max_sentences"] == 2
    assert not out[2]["passes"] and out[2]["entries_without_link"] == 1 and out[2]["trailing_link_line"]
    links = letter_qa.entry_links(letter_qa.letter_entries(df)).select("kind").distinct().collect()
    assert [r[0] for r in links] == ["comment"]


def test_rss_title_escape_option(spark):
    pages = spark.createDataFrame([("s", dt.date(2026, 1, 1), "a.html", "A & <B>", "<p>x</p>")],
                                  "subreddit string, letter_date date, url string, title string, content_html string")
    assert archive.rss_feed(pages).first()["title"] == "A & <B>"
    assert archive.rss_feed(pages, escape_title=True).first()["title"] == "A &amp; &lt;B&gt;"
    assert archive.rss_feed(pages).first()["pub_date"] == "Thu, 01 Jan 2026 00:00:00 +0000"


def test_letter_files_keep_their_ends(spark):
    path = tempfile.mkdtemp(prefix="letters-", dir="/tmp") + "/md"
    texts = {"2024-01-01": "a", "2024-01-02": "a\n", "2024-01-03": "a\n\n", "2024-01-04": "\n", "2024-01-05": "b\r\n"}
    df = spark.createDataFrame([("s", dt.date.fromisoformat(d), t) for d, t in texts.items()],
                               "subreddit string, letter_date date, markdown string")
    archive.write_letter_files(df, path)
    got = archive.ingest_letters(spark, path, layout="partitioned").collect()
    assert {r.letter_date.isoformat(): r.markdown for r in got} == texts


def test_bare_marks_are_escaped(spark):
    got = _col(spark, ["S&P up 1 < 2", "A &amp; <b>B</b>", "[a](http://x/?a=1&b=2)"], L.render_markdown)
    assert got == ["<p>S&amp;P up 1 &lt; 2</p>", "<p>A &amp; <b>B</b></p>", '<p><a href="http://x/?a=1&amp;b=2">a</a></p>']


def test_date_line_needs_a_clock_time(spark):
    lines = ["**Date:** August 21, 2026 at 13:45 PM EDT", "**Date:** August 21, 2026 at 07:60 PM EDT",
             "**Date:** August 21, 2026 at 7:45 PM EDT"]
    df = spark.createDataFrame([(x,) for x in lines], "x string").select(L.letter_date_parts(F.col("x"))[1])
    assert [r[0] for r in df.collect()] == [None, None, "August 21, 2026 at 07:45 PM EDT"]


def test_empty_item_in_a_feed(spark):
    xml = "<rss><channel><item/><item><title>t</title><link>l</link></item></channel></rss>"
    out = news.ingest_rss(spark.createDataFrame([("q", xml)], "query string, xml string"), ["query"]).collect()
    assert [(r.title, r.url, r.raw) for r in out] == [("t", "l", "<item><title>t</title><link>l</link></item>")]


def test_list_is_cut_before_empty_queries_go(spark):
    """Eight queries count, whether or not they find anything; a query listed twice has its items twice."""
    items = spark.createDataFrame([(q, i) for q in ("a", "z") for i in range(5)], "query string, id int")
    names = ["z", "e1", "e2", "z", "e3", "e4", "e5", "e6", "a"]
    queries = spark.createDataFrame([("g", q, 10 * k) for k, q in enumerate(names)] + [("h", "a", 1)],
                                    "g string, query string, qpos int")
    got = news.cap_per_query(queries, items, ["g"], F.col("id"))
    assert rows(got, "g", "query", "qrank", "id", "irank") == sorted(
        [("g", "z", q, i, i + 1) for q in (1, 4) for i in range(3)] + [("h", "a", 1, i, i + 1) for i in range(3)], key=repr)


def test_whole_page_is_cleaned(spark):
    page = "<title>A &amp;\nB</title><article><h1>T</h1><p>one<br>\ntwo &lt;x&gt;<p>three</article><footer>no</footer>"
    sf = tempfile.mkdtemp(prefix="pages-", dir="/tmp")
    spark.createDataFrame([(5, "https://h.example/en/5", page)], "page_id bigint, url string, html string").write.parquet(f"{sf}/pages.parquet")
    from forumlens.plans.registry import all_queries
    assert rows(all_queries()["clean_text"](spark, sf)) == [(5, "A &\nB", "Tone\ntwo <x>three")]
    got = all_queries()["ingest_rss"](spark, sf).first()
    assert (got.title, got.summary) == ("A &\nB", "Tone\ntwo <x>three")


def test_date_line_falls_back_to_the_run(spark):
    from forumlens.sources.tables import ntz
    lines = ["no line", "**Date:** soon", "**Date:** August 21, 2026", "**Date:** August 21, 2026 at 7:45 PM EDT"]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    got = df.select(*L.letter_date_line(F.col("x"), ntz("2024-01-31 00:05:00"))).collect()
    day, run = dt.date(2026, 8, 21), (dt.date(2024, 1, 30), "January 30, 2024 at 07:05 PM EST")
    assert [tuple(r) for r in got] == [run, run, (day, "August 21, 2026"), (day, "August 21, 2026 at 07:45 PM EDT")]


def test_new_york_times(spark):
    from forumlens.functions import text as T
    cases = {"2024-03-10 06:59:00": "March 10, 2024 at 01:59 AM EST", "2024-03-10 07:00:00": "March 10, 2024 at 03:00 AM EDT",
             "2024-11-03 05:30:00": "November 03, 2024 at 01:30 AM EDT", "2024-11-03 06:30:00": "November 03, 2024 at 01:30 AM EST",
             "2024-07-04 04:00:00": "July 04, 2024 at 12:00 AM EDT", "2024-07-04 16:00:00": "July 04, 2024 at 12:00 PM EDT"}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(x,) for x in cases], "x string").select(F.col("x").cast("timestamp_ntz").alias("x"))
            assert [r[0] for r in df.select(T.new_york_text(F.col("x"))).collect()] == list(cases.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_template_is_filled_in_one_pass(spark):
    from forumlens.functions import text as T
    from forumlens.operators import threads
    ctx = spark.createDataFrame([("s", "text with {date}, {draft} and {{x}}"), ("t", None)], "subreddit string, content string")
    writer = threads.prompt_dataset(ctx, "{{{model_name}}} {date}: {content} {{content}}", "m {content}", F.lit("now {draft}"))
    assert rows(writer) == [("s", "{m {content}} now {draft}: text with {date}, {draft} and {{x}} {content}"),
                            ("t", "{m {content}} now {draft}:  {content}")]
    drafts = spark.createDataFrame([("s", "a {content} b")], "subreddit string, draft string")
    assert rows(threads.editor_prompts(ctx, drafts, "{draft}|{content}|{model_name}", "m")) == [
        ("s", "a {content} b|text with {date}, {draft} and {{x}}|m")]
    values = {"a": F.lit("x")}
    for template in ("{b}", "{a!r}", "{a:>5}", "{", "}"):
        with pytest.raises(ValueError):
            T.fill_format(template, values)
    assert "{a} {{b}}".format(a="x") == spark.range(1).select(T.fill_format("{a} {{b}}", values)).first()[0]


def test_news_goes_below_the_posts(spark):
    from forumlens.operators import threads
    ctx = spark.createDataFrame([("s", "posts"), ("t", "more")], "subreddit string, content string")
    found = spark.createDataFrame([("s", "News:\n")], "subreddit string, news_context string")
    assert rows(threads.with_news(ctx, found), "subreddit", "content") == [("s", "posts\nNews:\n"), ("t", "more")]


def _letters(spark, days):
    return spark.createDataFrame([(c, dt.date.fromisoformat(d), f"{d}.md", f"**Subject:** {t}\n\nText {d}") for c, d, t in days],
                                 "subreddit string, letter_date date, file_name string, markdown string")


def _files(path):
    return {f"{os.path.basename(d)}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(path)
            for n in names if n.endswith(".parquet")}


def test_letters_added_one_by_one_equal_one_build(spark):
    """Single additions in any order, a repeated run and a corrected letter; months that no link leads to keep their files."""
    base = tempfile.mkdtemp(prefix="archive-", dir="/tmp")
    days = [("s", "2026-01-30", "a"), ("s", "2026-03-02", "c"), ("t", "2026-02-10", "x"), ("s", "2026-02-01", "b"),
            ("s", "2026-05-05", "e"), ("s", "2026-04-09", "d"), ("s", "2026-03-02", "c again"), ("t", "2025-12-31", "w")]
    touched = []
    for run, day in enumerate(days):
        before = _files(f"{base}/pages")
        months = archive.add_letters(_letters(spark, [day]), f"{base}/letters", f"{base}/pages", run)
        after = _files(f"{base}/pages")
        for name, at in before.items():
            if name.split("/")[0].split("=")[1] not in months:
                assert after.get(name) == at
        touched.append(months)
        if run == 4:
            assert archive.add_letters(_letters(spark, [day]), f"{base}/letters", f"{base}/pages", run) == months
    assert touched[3] == ["2026-01", "2026-02", "2026-03"] and touched[5] == ["2026-03", "2026-04", "2026-05"]
    assert touched[4] == ["2026-03", "2026-05"] and touched[7] == ["2025-12", "2026-02"]
    final = {(c, d): t for c, d, t in days}
    want = archive.letter_pages(_letters(spark, [(c, d, t) for (c, d), t in final.items()]))
    got = spark.read.parquet(f"{base}/pages").drop("month")
    assert rows(got, *want.columns) == rows(want)
    assert archive.add_letters(_letters(spark, []), f"{base}/letters", f"{base}/pages", 99) == []


def test_site_documents_by_hand(spark):
    pages = archive.letter_pages(_letters(spark, [("s", "2026-01-30", "A"), ("s", "2026-02-01", "B"), ("s", "2026-02-03", "C")]))
    docs = {r.file_name: r.document for r in archive.site_documents(pages, "http://x").collect()}
    assert docs["catalog.html"] == (
        '<h2>February 2026</h2>\n<ul><li>February 03, 2026 <a href="2026-02-03.html">C</a></li>'
        '<li>February 01, 2026 <a href="2026-02-01.html">B</a></li></ul>\n'
        '<h2>January 2026</h2>\n<ul><li>January 30, 2026 <a href="2026-01-30.html">A</a></li></ul>')
    assert '<a href="2026-02-03.html">2026-02-03.html</a>' in docs["index.html"]
    import xml.etree.ElementTree as ET
    feed = ET.fromstring(docs["rss.xml"].encode())
    assert [i.findtext("title") for i in feed.iter("item")] == ["C", "B", "A"]
    assert feed.findtext("channel/item/link") == "http://x/2026-02-03.html"
    assert feed.findtext("channel/item/description").startswith("<p><strong>Subject:</strong> C")


def test_nav_windows_hold_dates_only(spark):
    """No community's texts meet in one task, also for letters without a community."""
    from test_plans import plan
    days = [("s", "2026-01-30", "A"), ("s", "2026-02-01", "B"), ("t", "2026-01-31", "C"), (None, "2026-01-01", "D"),
            (None, "2026-01-03", "E")]
    nav = archive.letter_nav(_letters(spark, days))
    assert [(r.markdown[13], r.prev_url, r.url, r.next_url) for r in nav.orderBy("markdown").collect()] == [
        ("A", None, "2026-01-30.html", "2026-02-01.html"), ("B", "2026-01-30.html", "2026-02-01.html", None),
        ("C", None, "2026-01-31.html", None), ("D", None, "2026-01-01.html", "2026-01-03.html"),
        ("E", "2026-01-01.html", "2026-01-03.html", None)]
    windows = [x for x in plan(archive.letter_pages(fx.letters(spark, SF_SMALL))).split("\n\n") if ") Window" in x]
    assert any("lag(url" in x for x in windows)
    assert not any("lag(url" in x and "markdown" in x for x in windows)


def test_letters_are_dealt_by_their_orders(spark, monkeypatch):
    """More orders, more parts: a task's texts stay as large as they are."""
    n = fx.letters(spark, SF_SMALL).rdd.getNumPartitions()
    monkeypatch.setattr(fx, "ORDERS_A_TASK", 100)
    cut = fx.letters(spark, SF_SMALL)
    assert cut.rdd.getNumPartitions() > 2 * n
    monkeypatch.undo()
    assert rows(cut) == rows(fx.letters(spark, SF_SMALL))


def test_letter_pages_query_fills_its_pages(spark, monkeypatch):
    """The query's rows hold the filled page, also of a text with placeholders and of a letter without a community."""
    from forumlens.plans.archive_queries import q_letter_pages
    days = [("s", "2026-01-30", "A {{NAV_BOTTOM}}{{CONTENT}}"), ("s", "2026-02-01", "B"), (None, "2026-02-01", "C")]
    monkeypatch.setattr(fx, "letters", lambda spark, sf: _letters(spark, days))
    got = {(r.subreddit, r.letter_date.day): r.page_html for r in q_letter_pages(spark, "").collect()}

    def page(community, day, date, previous, following, subject):
        return (f"<!DOCTYPE html>\n<html><head><title>r/{community} {day}</title></head>\n<body><h1>{date}</h1>\n"
                f'<nav>{previous} | <a href="catalog.html">Catalog</a> | {following}</nav>\n'
                f"<article><p><strong>Subject:</strong> {subject}</p>\n<p>Text {day}</p></article>\n\n</body></html>")
    no_previous, no_next = '<span class="off">Previous</span>', '<span class="off">Next</span>'
    assert got == {
        ("s", 30): page("s", "2026-01-30", "January 30, 2026", no_previous, '<a href="2026-02-01.html">Next</a>', "A {{CONTENT}}"),
        ("s", 1): page("s", "2026-02-01", "February 01, 2026", '<a href="2026-01-30.html">Previous</a>', no_next, "B"),
        (None, 1): page("", "2026-02-01", "February 01, 2026", no_previous, no_next, "C")}
