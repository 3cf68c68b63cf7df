"""Column expressions for digest text.  All JVM-side (no Python UDF).

Fixed values that must equal the reference's output format are grouped at
the top.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (formats and defaults of the digest text) ---------------
MAX_BODY_WORDS = 220
COMMENTS_PER_POST = 12
DEFAULT_SUBREDDIT = "wallstreetbets"
DISCUSSION_URL_PREFIX = "https://www.reddit.com/r/"
COMMENT_HOST = "https://www.reddit.com"
SKIP_COMMENT_PREFIXES = ("[deleted]", "[removed]")
QUERY_LINE_SKIP_PREFIXES = ("Here", "Based", "Post", "Example", "Extract")
DEFAULT_LETTER_TITLE = "Market Summary"
# Context text, in the order it appears in a post block.
POST_HEADER_PREFIX = "--- Post "
PINNED_MARK = "[PINNED] "
POST_HEADER_SUFFIX = " ---"
LABEL_DISCUSSION_URL = "Post Discussion URL: "
LABEL_EXTERNAL_URL = "Post External URL: "
LABEL_AUTHOR = "Author: u/"
LABEL_SCORE = "Score: "
LABEL_RATIO = "Upvote Ratio: "
LABEL_COMMENT_COUNT = "Reddit Comment Count: "
LABEL_NEW = "New Since Previous Report: "
LABEL_SCORE_DELTA = "Score Change Since Previous Report"
LABEL_COMMENT_DELTA = "Comment Count Change Since Previous Report"
LABEL_RATIO_DELTA = "Upvote Ratio Change Since Previous Report"
LABEL_BODY = "Post Body: "
LABEL_TOP_COMMENTS = "Top Comments:"
COMMENT_BULLET = "- "
COMMENT_SCORE_OPEN = "[score "
COMMENT_AUTHOR_PREFIX = "u/"
COMMENT_SOURCE_OPEN = " (Source: "
HEADLINE_NO_SCORE = "None"
# ---------------------------------------------------------------------------

# Whitespace as Python's str.split()/str.strip() see it (str.isspace):
# Java's (?U)\s misses \x1c-\x1f, RE2's \s misses NBSP and the Unicode
# spaces, so both engines get this explicit class.
WS_CLASS = (r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace at both ends)."""
    return F.regexp_replace(c, f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def words(c: Column) -> Column:
    """Python ``str.split()``: array of non-empty whitespace-separated words."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{WS_CLASS}+"), lambda w: w != "")


def clip_text(c: Column, max_words: int = MAX_BODY_WORDS) -> Column:
    """Whitespace-normalise; more than ``max_words`` words gives the
    first ``max_words`` and ``...``."""
    w = words(c)
    return F.when(F.size(w) <= max_words, F.array_join(w, " ")) \
            .otherwise(F.concat(F.array_join(F.slice(w, 1, max_words), " "), F.lit("...")))


def is_blank(c: Column) -> Column:
    return F.size(words(c)) == 0


def bind(c: Column, use) -> Column:
    """``use(c)`` with ``c`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(c), use), 1)


def new_york(ts: Column) -> Column:
    """A zone-less UTC time as New York's wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), ts)


def new_york_text(ts: Column) -> Column:
    """``January 30, 2026 at 07:05 PM EST`` of a zone-less UTC time,
    whatever the session zone."""
    def text(local: Column) -> Column:
        hour = F.pmod(F.hour(local) + 11, F.lit(12)) + 1
        return F.concat(
            F.date_format(F.to_date(local), "MMMM dd, yyyy"), F.lit(" at "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":"),
            F.lpad(F.minute(local).cast("string"), 2, "0"), F.when(F.hour(local) < 12, " AM ").otherwise(" PM "),
            F.when(local == ts - F.make_dt_interval(F.lit(0), F.lit(5)), "EST").otherwise("EDT"))
    return bind(new_york(ts), text)


def fill_format(template: str, values: dict[str, Column]) -> Column:
    """L1: the template with its ``{name}`` fields filled, ``{{`` and ``}}`` as
    braces, in one pass: braces inside a value stay as they are.  A null value
    is empty; a field without a value is an error."""
    parts = []
    for text, name, spec, conversion in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            if spec or conversion or name not in values:
                raise ValueError(f"no value for the field {{{name}}}" if name not in values
                                 else f"the field {{{name}}} has a format of its own")
            parts.append(F.coalesce(values[name], F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def py_float_str(c: Column) -> Column:
    """Python ``str(float)`` for a DOUBLE column.

    Spark prints 1.0E-4 where Python prints 0.0001, and 1.0E-5 where Python
    prints 1e-05; both switch to exponents at different magnitudes.  Equal
    to Python below 1e16.  In exponent form the text is the shortest that
    reads back as the same double; in rare half-way cases its last digit
    can differ from Python's, which picks the candidate closest to the
    exact binary value.
    """
    return bind(c, _float_str)


def _float_str(c: Column) -> Column:
    s = c.cast("string")
    exp = F.regexp_extract(s, r"^(-?[0-9.]+)E(-?[0-9]+)$", 2).cast("int")
    # positional form of a Spark exponent string, from the decimal text
    plain = F.regexp_replace(F.regexp_replace(s.cast("decimal(38,20)").cast("string"), "0+$", ""),
                             r"\.$", ".0")
    # Exponent form: the shortest '%.ke' text that reads back as the same
    # double (Python's repr rule); Spark's own text may carry extra digits.
    sci = F.coalesce(*[F.when(F.format_string(f"%.{k}e", c).cast("double") == c, F.format_string(f"%.{k}e", c))
                       for k in range(17)])
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(F.isnan(c), F.lit("nan"))
             .when(c == float("inf"), F.lit("inf"))
             .when(c == float("-inf"), F.lit("-inf"))
             .when(~s.contains("E"), s)
             .when((exp >= -4) & (exp < 16), plain)
             .otherwise(sci))


def round4(c: Column) -> Column:
    """Python ``round(x, 4)`` for a DOUBLE: half-way cases go by the exact
    binary value, which ``bround`` (it rounds the printed decimal) does not see.

    20,000 x is odd at a half-way case.  When the rounded product is odd, the
    product's exact rounding error says on which side of it x lies.
    """
    return bind(c, _round4)


def _round4(c: Column) -> Column:
    p = c * 20000.0
    spread = c * 134217729.0  # 2**27 + 1: splits x into halves whose products are exact
    high = spread - (spread - c)
    error = (high * 20000.0 - p) + (c - high) * 20000.0
    half = p / 2.0
    units = (F.when((F.abs(p % 2.0) == 1.0) & (error > 0), F.ceil(half).cast("double"))
              .when((F.abs(p % 2.0) == 1.0) & (error < 0), F.floor(half).cast("double"))
              .otherwise(F.rint(half)))
    return F.when(F.abs(c) < 1e11, units / 10000.0).otherwise(c)


def round4_str(c: Column) -> Column:
    """Python ``str(round(x, 4))`` for a DOUBLE; keeps a negative zero."""
    return bind(round4(c), lambda r: F.when((r == 0) & (c < 0), F.lit("-0.0")).otherwise(_float_str(r)))


def delta_text(c: Column, is_float: bool) -> Column:
    """J3 value part: null stays null; ``+`` only when the (rounded) value is > 0."""
    if is_float:
        def text(r: Column) -> Column:
            return F.concat(F.when(r > 0, "+").otherwise(""), F.when((r == 0) & (c < 0), "-0.0").otherwise(_float_str(r)))
        return F.when(c.isNull(), F.lit(None)).otherwise(bind(round4(c), text))
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.concat(F.when(c > 0, F.lit("+")).otherwise(F.lit("")), c.cast("string")))


def delta_line(label: str, c: Column, is_float: bool) -> Column:
    """``label: +N`` or null (no line) when the delta is null."""
    return F.concat(F.lit(f"{label}: "), delta_text(c, is_float))


def discussion_url(reddit_id: Column, subreddit: Column, url: Column,
                   default_subreddit: str = DEFAULT_SUBREDDIT) -> Column:
    """Discussion URL from the id; no id gives the post's own url."""
    rid = reddit_id.cast("string")
    sub = F.coalesce(F.nullif(subreddit, F.lit("")), F.lit(default_subreddit))
    return F.when(F.coalesce(rid, F.lit("")) != "",
                  F.concat(F.lit(DISCUSSION_URL_PREFIX), sub, F.lit("/comments/"), rid, F.lit("/"))) \
            .otherwise(F.coalesce(url, F.lit("")))


def external_url(url: Column, discussion: Column) -> Column:
    """The post's url when set and different from the discussion url."""
    return F.when((F.coalesce(url, F.lit("")) != "") & (url != discussion), url)


def comment_permalink(permalink: Column) -> Column:
    """Absolute comment url from a relative permalink."""
    return F.concat(F.lit(COMMENT_HOST), permalink)


def _truthy(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) != ""


def post_metadata(reddit_id: Column, subreddit: Column, url: Column, author: Column,
                  score: Column, upvote_ratio: Column, num_comments: Column,
                  previous_report_at: Column, new_flag: Column, score_delta: Column,
                  comments_delta: Column, ratio_delta: Column) -> Column:
    """Metadata lines of one post, each ending in a newline."""
    disc = discussion_url(reddit_id, subreddit, url)
    has_prev = previous_report_at.isNotNull()
    lines = [
        F.concat(F.lit(LABEL_DISCUSSION_URL), disc),
        F.concat(F.lit(LABEL_EXTERNAL_URL), external_url(url, disc)),
        F.when(_truthy(author), F.concat(F.lit(LABEL_AUTHOR), author)),
        F.concat(F.lit(LABEL_SCORE), score.cast("string")),
        F.concat(F.lit(LABEL_RATIO), py_float_str(upvote_ratio)),
        F.concat(F.lit(LABEL_COMMENT_COUNT), num_comments.cast("string")),
        F.when(has_prev, F.concat(F.lit(LABEL_NEW),
                                  F.when(F.coalesce(new_flag, F.lit(False)), F.lit("yes"))
                                   .otherwise(F.lit("no")))),
        F.when(has_prev, delta_line(LABEL_SCORE_DELTA, score_delta, False)),
        F.when(has_prev, delta_line(LABEL_COMMENT_DELTA, comments_delta, False)),
        F.when(has_prev, delta_line(LABEL_RATIO_DELTA, ratio_delta, True)),
    ]
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))


def comment_line(score: Column, author: Column, body: Column, url: Column) -> Column:
    """``- [score N] u/author: body (Source: url)`` plus newline."""
    return F.concat(
        F.lit(COMMENT_BULLET),
        F.coalesce(F.concat(F.lit(COMMENT_SCORE_OPEN), score.cast("string"), F.lit("] ")), F.lit("")),
        F.when(_truthy(author), F.concat(F.lit(COMMENT_AUTHOR_PREFIX), author, F.lit(": "))).otherwise(F.lit("")),
        clip_text(body),
        F.when(_truthy(url), F.concat(F.lit(COMMENT_SOURCE_OPEN), url, F.lit(")"))).otherwise(F.lit("")),
        F.lit("\n"),
    )


def reportable_comment(body: Column) -> Column:
    """Trimmed body non-empty and not starting with a removal marker."""
    t = py_strip(F.coalesce(body, F.lit("")))
    cond = t != ""
    for p in SKIP_COMMENT_PREFIXES:
        cond = cond & ~t.startswith(p)
    return cond


def post_header(i: Column, is_pinned: Column, title: Column) -> Column:
    return F.concat(F.lit(POST_HEADER_PREFIX), i.cast("string"), F.lit(": "),
                    F.when(F.coalesce(is_pinned, F.lit(False)), F.lit(PINNED_MARK)).otherwise(F.lit("")),
                    F.coalesce(title, F.lit("")), F.lit(POST_HEADER_SUFFIX + "\n"))


def post_block(i: Column, is_pinned: Column, title: Column, metadata: Column,
               selftext: Column, comment_lines: Column) -> Column:
    """Header, metadata, body if non-blank, top comments if any, blank line.

    ``comment_lines`` is the already ordered, already capped text of the
    comment lines ('' when none).
    """
    body = F.when(~is_blank(selftext), F.concat(F.lit(LABEL_BODY), clip_text(selftext), F.lit("\n"))) \
            .otherwise(F.lit(""))
    comments = F.when(F.coalesce(comment_lines, F.lit("")) != "",
                      F.concat(F.lit(LABEL_TOP_COMMENTS + "\n"), comment_lines)).otherwise(F.lit(""))
    return F.concat(post_header(i, is_pinned, title), metadata, body, comments, F.lit("\n"))


def headline_line(score: Column, title: Column) -> Column:
    """``[score N] title``; a missing score prints ``None``."""
    return F.concat(F.lit(COMMENT_SCORE_OPEN), F.coalesce(score.cast("string"), F.lit(HEADLINE_NO_SCORE)), F.lit("] "),
                    F.coalesce(title, F.lit("")))


def query_line_clean(line: Column) -> Column:
    """Strip, then '"', then '*', then '-', then whitespace, in that order."""
    s = py_strip(line)
    s = F.regexp_replace(s, r'^"+|"+$', "")
    s = F.regexp_replace(s, r"^\*+|\*+$", "")
    s = F.regexp_replace(s, r"^-+|-+$", "")
    return py_strip(s)


def query_line_keep(clean: Column) -> Column:
    """Non-empty and not starting with a preamble word (case-sensitive)."""
    cond = clean != ""
    for p in QUERY_LINE_SKIP_PREFIXES:
        cond = cond & ~clean.startswith(p)
    return cond


def utc_iso(ts: Column) -> Column:
    """ISO-8601 UTC text with seconds, as the reference stores times."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def shifted_cutoff(as_of: Column, hours: int) -> Column:
    """``as_of - hours`` (comment refresh cutoff)."""
    return as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
