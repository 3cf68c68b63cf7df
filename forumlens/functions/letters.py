"""Column expressions over letter Markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import DEFAULT_LETTER_TITLE, WS_CLASS, new_york, new_york_text, py_strip

# ---- fixed values ----------------------------------------------------------
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December")
HEADER_LABELS = ("To", "Date", "Subject")
# ---------------------------------------------------------------------------

# (?d): only \n ends a line for '.', as in Python's re.
SUBJECT_RE = r"(?d)\*\*Subject:\*\*" + WS_CLASS + r"*(.*)"
DATE_RE = r"(?d)\*\*Date:\*\*" + WS_CLASS + r"*(.+)"
DATE_VALUE_RE = r"^([A-Za-z]+) ([0-9]{1,2}), ([0-9]{4})(?: at (0?[1-9]|1[0-2]):([0-5][0-9]) ([AP]M) ([A-Za-z]+))?$"
ENTRY_RE = r"^\*\*(\[?)([^*\]\n]+?)(\]?):\*\*" + WS_CLASS + r"*(.*)$"
LINK_RE = r"\[([^\]]+)\]\(([^)\s]+)\)"
BLOCK_SPLIT = r"\n([ \t]*\n)+"


def letter_title(md: Column) -> Column:
    """First ``**Subject:**`` value, stripped; else the default title."""
    return F.when(md.rlike(SUBJECT_RE), py_strip(F.regexp_extract(md, SUBJECT_RE, 1))) \
            .otherwise(F.lit(DEFAULT_LETTER_TITLE))


def letter_date_parts(md: Column) -> tuple[Column, Column]:
    """``(date, display text)`` from the ``**Date:**`` line.

    With time (``Month dd, yyyy at hh:mm AM ZONE``) the text is re-printed
    in that layout; date only keeps the extracted text.  No line or no
    parse gives nulls (the caller supplies the run date).  The zone name is
    kept as written.
    """
    raw = F.when(md.rlike(DATE_RE), py_strip(F.regexp_extract(md, DATE_RE, 1)))
    g = lambda i: F.regexp_extract(raw, DATE_VALUE_RE, i)
    ok = raw.rlike(DATE_VALUE_RE)
    month = F.array_position(F.array(*[F.lit(m.upper()) for m in MONTH_NAMES]), F.upper(g(1))).cast("int")
    date = F.when(ok, F.try_make_timestamp_ntz(g(3).cast("int"), month, g(2).cast("int"),
                                               F.lit(0), F.lit(0), F.lit(0)).cast("date"))
    with_time = g(4) != ""
    full = F.concat(F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.greatest(month, F.lit(1))),
                    F.lit(" "), F.lpad(g(2), 2, "0"), F.lit(", "), g(3), F.lit(" at "), F.lpad(g(4), 2, "0"),
                    F.lit(":"), g(5), F.lit(" "), g(6), F.lit(" "), g(7))
    text = F.when(date.isNull(), F.lit(None)).when(with_time, full).otherwise(raw)
    return date, text


def letter_date_line(md: Column, run_at: Column) -> tuple[Column, Column]:
    """J12 with its fallback: ``(date, display text)`` of the letter, or of the
    run (a zone-less UTC time, in New York) where the letter has no date line
    that parses."""
    date, text = letter_date_parts(md)
    return F.coalesce(date, F.to_date(new_york(run_at))), F.coalesce(text, new_york_text(run_at))


def file_date(file_name: Column) -> Column:
    """Date from a ``YYYY-M-D.md`` stem (non-padded parts accepted);
    other names give null."""
    stem = F.regexp_extract(file_name, r"^(.*?)(\.[^.]*)?$", 1)
    m = F.regexp_extract(stem, r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$", 0) != ""
    parts = F.split(stem, "-")
    return F.when(m, F.try_make_timestamp_ntz(parts[0].cast("int"), parts[1].cast("int"), parts[2].cast("int"),
                                              F.lit(0), F.lit(0), F.lit(0)).cast("date"))


def format_date(d: Column) -> Column:
    """``January 30, 2026``."""
    return F.date_format(d, "MMMM dd, yyyy")


def fill_template(template: Column, pairs: list[tuple[str, Column]]) -> Column:
    """Literal placeholder replacement in the given order."""
    out = template
    for placeholder, value in pairs:
        out = F.replace(out, F.lit(placeholder), F.coalesce(value, F.lit("")))
    return out


def _inline(b: Column) -> Column:
    # a bare & or < is text; entities and tags pass through
    s = F.regexp_replace(b, r"&(?!#?[0-9A-Za-z]+;)", "&amp;")
    s = F.regexp_replace(s, r"<(?![A-Za-z/!])", "&lt;")
    s = F.regexp_replace(s, LINK_RE, '<a href="$2">$1</a>')
    s = F.regexp_replace(s, r"\*\*([^*]+)\*\*", "<strong>$1</strong>")
    return F.regexp_replace(s, r"\*([^*]+)\*", "<em>$1</em>")


def render_markdown(md: Column) -> Column:
    """L3: the Markdown subset of the archive to HTML.

    Blocks are separated by blank lines.  A block starting with 1-6 ``#``
    and a space is a heading; any other block is a paragraph whose line
    breaks become ``<br />``.  Inline: links, then bold, then italic.  Raw
    HTML passes through.  General Markdown is not covered.
    """
    text = F.replace(F.coalesce(md, F.lit("")), F.lit("\r\n"), F.lit("\n"))
    blocks = F.filter(F.split(text, BLOCK_SPLIT), lambda b: F.trim(b) != "")

    def render(b: Column) -> Column:
        b = F.regexp_replace(b, r"^\n+|\n+$", "")
        hashes = F.regexp_extract(b, r"^(#{1,6}) ", 1)
        level = F.length(hashes).cast("string")
        heading = F.concat(F.lit("<h"), level, F.lit(">"),
                           _inline(F.trim(F.regexp_replace(b, r"^#{1,6} ", ""))), F.lit("</h"), level, F.lit(">"))
        para = F.concat(F.lit("<p>"), F.replace(_inline(b), F.lit("\n"), F.lit("<br />\n")), F.lit("</p>"))
        return F.when(hashes != "", heading).otherwise(para)

    return F.array_join(F.transform(blocks, render), "\n")


def entry_lines(md: Column) -> Column:
    """Non-empty lines of a letter (M1 input)."""
    return F.split(F.coalesce(md, F.lit("")), "\n+")


def link_kind(url: Column) -> Column:
    """M3: comment / post / news / external, from the URL shape."""
    reddit = url.rlike(r"^https?://(www\.|old\.)?reddit\.com/")
    return (F.when(reddit & url.rlike(r"/comments/[^/]+/[^/]+/[^/]+/?$"), F.lit("comment"))
             .when(reddit & url.rlike(r"/comments/[^/]+(/[^/]+)?/?$"), F.lit("post"))
             .when(url.rlike(r"^https?://news\.google\.com/"), F.lit("news"))
             .otherwise(F.lit("external")))
