"""Column expressions for news items: cleaning, dates, search URLs."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

# ---- fixed values ----------------------------------------------------------
NEWS_PROVIDER = "google_news"
NEWS_SEARCH_URL = "https://news.google.com/rss/search?"
NEWS_LOCALE = (("hl", "en-US"), ("gl", "US"), ("ceid", "US:en"))
# RFC 822 zone names with their offsets in minutes (as the e-mail date parser knows them).
ZONES = (("UT", 0), ("UTC", 0), ("GMT", 0), ("Z", 0), ("AST", -240), ("ADT", -180),
         ("EST", -300), ("EDT", -240), ("CST", -360), ("CDT", -300), ("MST", -420),
         ("MDT", -360), ("PST", -480), ("PDT", -420))
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
MONTHS_LONG = ("January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December")
# News context text, in the order it appears.
NEWS_CONTEXT_HEADER = "External News Context:"
ITEM_TITLE = "- Title: "
ITEM_SOURCE = "  Source: "
ITEM_PUBLISHED = "  Published: "
ITEM_SUMMARY = "  Summary: "
ITEM_URL = "  URL: "
# ---------------------------------------------------------------------------

TAG = r"<[^>]+>"

# Entity names with their text, the standard library's HTML5 table as one string
# literal (a foldable map), the everyday names first: a map is searched in order.
_OFTEN = ("amp;", "quot;", "lt;", "gt;", "nbsp;", "apos;")
_NAMED = "\x02".join(f"{n}\x01{html5[n]}" for n in (*_OFTEN, *(n for n in html5 if n not in _OFTEN)))
# Old names also count without a semicolon, the longest that fits.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
# Numbers 128-159 mean the characters of Windows code page 1252, where it has them.
_CP1252 = "\x02".join(f"{n}\x01{bytes([n]).decode('cp1252', 'replace').replace(chr(0xFFFD), chr(n))}"
                      for n in range(128, 160))
_PIECE = r"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]{0,31};?|[^&]+|&"


def _lookup(table: str, key: Column) -> Column:
    return F.try_element_at(F.str_to_map(F.lit(table), F.lit("\x02"), F.lit("\x01")), key)


def _numbered(piece: Column) -> Column:
    """The character of a numeric reference, by the HTML5 rules for bad ones."""
    digits = F.regexp_extract(piece, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    digits = F.when(digits == "", "0").otherwise(digits)
    number = F.when(piece.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
    n = F.when(F.length(number) <= 9, number.try_cast("int")).otherwise(F.lit(0x110000))
    nothing = n.between(0x1, 0x8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (
        F.pmod(n, F.lit(0x10000)) >= 0xFFFE)
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd")
             .when(n.between(128, 159), _lookup(_CP1252, n.cast("string")))
             .when(nothing, "").otherwise(char))


def _named(piece: Column) -> Column:
    name = F.substr(piece, F.lit(2))
    bare = F.regexp_extract(name, f"^({_BARE})", 1)
    cut = F.concat(_lookup(_NAMED, bare), F.substr(name, F.length(bare) + 1))
    return F.coalesce(_lookup(_NAMED, name), F.when(bare != "", cut), piece)


def unescape(c: Column) -> Column:
    """HTML5 entities decoded, once, from left to right."""
    def piece(x: Column) -> Column:
        return F.when(x.startswith("&#") & (F.length(x) > 2), _numbered(x)).when(
            x.startswith("&") & (F.length(x) > 1), _named(x)).otherwise(x)
    pieces = F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0))
    return F.when(c.contains("&"), F.array_join(F.transform(pieces, piece), "")).otherwise(c)


def clean_text(c: Column) -> Column:
    """Drop tags, then decode entities, then strip; null gives ''.
    Tags revealed by decoding stay."""
    return py_strip(unescape(F.regexp_replace(F.coalesce(c, F.lit("")), TAG, "")))


_RFC = (r"^\s*(?:[A-Za-z]+,\s*)?(\d{1,2})\s+([A-Za-z]+)\s+(\d{4}|\d{2})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?"
        r"(?:\s+([+-]\d{4}|[A-Za-z]+))?(?:\s*\([^)]*\))?\s*$")
_ISO = (r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?(?:(Z)|([+-]\d{2}):?(\d{2}))?)?$")


def _iso(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def parse_rfc822(c: Column) -> Column:
    """RFC 822 date text to UTC ISO seconds (``...+00:00``).

    No zone means UTC, a year of two digits lies in 1969-2068, a comment at
    the end is skipped.  Text that is not RFC 822 but a valid ISO date or time
    is re-printed with seconds and the zone that it states; anything else is
    kept as it is.  Built from regex groups, so the result does not depend on the
    session time zone.
    """
    g = lambda i: F.regexp_extract(c, _RFC, i)
    names = [F.array_position(F.array(*[F.lit(m.upper()) for m in ms]), F.upper(g(2))) for ms in (MONTHS, MONTHS_LONG)]
    month = F.greatest(*names)
    year = g(3).cast("int") + F.when(F.length(g(3)) == 4, 0).when(g(3).cast("int") > 68, 1900).otherwise(2000)
    sec = F.when(g(6) == "", F.lit(0)).otherwise(g(6).cast("int"))
    local = F.try_make_timestamp_ntz(year, month.cast("int"), g(1).cast("int"),
                                     g(4).cast("int"), g(5).cast("int"), sec)
    zone = g(7)
    num = F.regexp_extract(zone, r"^([+-])(\d{2})(\d{2})$", 0) != ""
    sign = F.when(F.substring(zone, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    num_min = sign * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int"))
    named = F.lit(0)
    for name, off in reversed(ZONES):
        named = F.when(F.upper(zone) == name, F.lit(off)).otherwise(named)
    offset = F.when(num, num_min).otherwise(named)
    utc = local - F.make_dt_interval(F.lit(0), F.lit(0), offset.cast("int"))
    rfc_ok = (F.regexp_extract(c, _RFC, 0) != "") & local.isNotNull()
    gi = lambda i: F.regexp_extract(c, _ISO, i)
    part = lambda i: F.when(gi(i) == "", "00").otherwise(gi(i))
    stated = F.try_make_timestamp_ntz(*[part(i).cast("int") for i in range(1, 7)])
    iso_ok = (F.regexp_extract(c, _ISO, 0) != "") & stated.isNotNull()
    zone_txt = F.when(gi(7) == "Z", "+00:00").when(gi(8) != "", F.concat(gi(8), F.lit(":"), gi(9))).otherwise("")
    iso_txt = F.concat(gi(1), F.lit("-"), gi(2), F.lit("-"), gi(3), F.lit("T"), part(4), F.lit(":"), part(5),
                       F.lit(":"), part(6), zone_txt)
    return (F.when(F.coalesce(c, F.lit("")) == "", F.lit(None).cast("string"))
             .when(rfc_ok, _iso(utc))
             .when(iso_ok, iso_txt)
             .otherwise(c))


def news_search_url(query: Column) -> Column:
    """Search URL with q, hl, gl, ceid query-string encoded (space as
    '+', as form encoding does)."""
    def enc(x: Column) -> Column:
        return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    parts = [F.concat(F.lit("q="), enc(query))]
    parts += [F.concat(F.lit(f"{k}="), enc(F.lit(v))) for k, v in NEWS_LOCALE]
    return F.concat(F.lit(NEWS_SEARCH_URL), F.concat_ws("&", *parts))


def xml_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))
