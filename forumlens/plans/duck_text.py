"""DuckDB SQL snippets mirroring ``functions/text.py`` for the oracles.

Only for oracle text; the Spark side never uses these.
"""

from __future__ import annotations

from ..functions import text as T
from ..functions.text import MAX_BODY_WORDS, WS_CLASS


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


def words(e: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({e}, ''), '{WS_CLASS}+'), lambda w: w <> '')"


def clip(e: str, n: int = MAX_BODY_WORDS) -> str:
    w = words(e)
    return (f"(case when len({w}) <= {n} then array_to_string({w}, ' ') "
            f"else array_to_string(({w})[1:{n}], ' ') || '...' end)")


def is_blank(e: str) -> str:
    return f"(len({words(e)}) = 0)"


def float4(e: str) -> str:
    """Python str() of a double holding at most four decimals."""
    t = f"rtrim(cast(cast(round({e}, 4) as decimal(38,4)) as varchar), '0')"
    return f"(case when {t} like '%.' then {t} || '0' else {t} end)"


def round4(e: str) -> str:
    return f"(case when round({e}, 4) = 0 and {e} < 0 then '-0.0' else {float4(e)} end)"


def delta(label: str, e: str, is_float: bool) -> str:
    if is_float:
        v = f"(case when round({e}, 4) > 0 then '+' else '' end) || {round4(e)}"
    else:
        v = f"(case when {e} > 0 then '+' else '' end) || cast({e} as varchar)"
    return f"(case when {e} is null then null else '{label}: ' || {v} end)"


def new_york(e: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {e}))"


def new_york_text(e: str) -> str:
    return (f"(strftime({new_york(e)}, '%B %d, %Y at %I:%M %p') || "
            f"case when {new_york(e)} = {e} - interval 5 hour then ' EST' else ' EDT' end)")


def truthy(e: str) -> str:
    return f"(coalesce(cast({e} as varchar), '') <> '')"


def discussion_url(rid: str, sub: str, url: str) -> str:
    return (f"(case when coalesce(cast({rid} as varchar), '') <> '' then 'https://www.reddit.com/r/' || "
            f"coalesce(nullif({sub}, ''), 'wallstreetbets') || '/comments/' || cast({rid} as varchar) || '/' "
            f"else coalesce({url}, '') end)")


def external_url(url: str, disc: str) -> str:
    return f"(case when coalesce({url}, '') <> '' and {url} <> {disc} then {url} end)"


def post_metadata(p: str = "") -> str:
    """Metadata text over columns (optionally prefixed ``p``) named as in E4."""
    disc = discussion_url(f"{p}reddit_id", f"{p}subreddit", f"{p}url")
    has_prev = f"{p}previous_report_at is not null"
    lines = [
        f"'{T.LABEL_DISCUSSION_URL}' || {disc}",
        f"'{T.LABEL_EXTERNAL_URL}' || {external_url(f'{p}url', disc)}",
        f"case when {truthy(f'{p}author')} then '{T.LABEL_AUTHOR}' || {p}author end",
        f"'{T.LABEL_SCORE}' || cast({p}score as varchar)",
        f"'{T.LABEL_RATIO}' || {float4(f'{p}upvote_ratio')}",
        f"'{T.LABEL_COMMENT_COUNT}' || cast({p}num_comments as varchar)",
        f"case when {has_prev} then '{T.LABEL_NEW}' || "
        f"case when coalesce({p}new_since_previous_report, false) then 'yes' else 'no' end end",
        f"case when {has_prev} then {delta(T.LABEL_SCORE_DELTA, f'{p}score_change_since_previous_report', False)} end",
        f"case when {has_prev} then {delta(T.LABEL_COMMENT_DELTA, f'{p}comment_count_change_since_previous_report', False)} end",
        f"case when {has_prev} then {delta(T.LABEL_RATIO_DELTA, f'{p}upvote_ratio_change_since_previous_report', True)} end",
    ]
    return "(concat_ws(chr(10), " + ", ".join(lines) + ") || chr(10))"


def comment_line(score: str, author: str, body: str, url: str) -> str:
    return (f"('{T.COMMENT_BULLET}' || coalesce('{T.COMMENT_SCORE_OPEN}' || cast({score} as varchar) || '] ', '') || "
            f"(case when {truthy(author)} then '{T.COMMENT_AUTHOR_PREFIX}' || {author} || ': ' else '' end) || {clip(body)} || "
            f"(case when {truthy(url)} then '{T.COMMENT_SOURCE_OPEN}' || {url} || ')' else '' end) || chr(10))")


def reportable(body: str) -> str:
    t = strip(f"coalesce({body}, '')")
    return f"({t} <> '' and not starts_with({t}, '[deleted]') and not starts_with({t}, '[removed]'))"


def post_block(i: str, pinned: str, title: str, meta: str, selftext: str, lines: str) -> str:
    return (f"('{T.POST_HEADER_PREFIX}' || cast({i} as varchar) || ': ' || "
            f"(case when coalesce({pinned}, false) then '{T.PINNED_MARK}' else '' end) || coalesce({title}, '') || "
            f"'{T.POST_HEADER_SUFFIX}' || chr(10) || "
            f"{meta} || (case when not {is_blank(selftext)} then '{T.LABEL_BODY}' || {clip(selftext)} || chr(10) else '' end) || "
            f"(case when coalesce({lines}, '') <> '' then '{T.LABEL_TOP_COMMENTS}' || chr(10) || {lines} else '' end) || chr(10))")


def query_clean(e: str) -> str:
    s = strip(e)
    s = f"regexp_replace({s}, '^\"+|\"+$', '', 'g')"
    s = f"regexp_replace({s}, '^\\*+|\\*+$', '', 'g')"
    s = f"regexp_replace({s}, '^-+|-+$', '', 'g')"
    return strip(s)


def query_keep(e: str) -> str:
    parts = [f"not starts_with({e}, '{p}')" for p in ("Here", "Based", "Post", "Example", "Extract")]
    return f"({e} <> '' and " + " and ".join(parts) + ")"


_ENT_SQL = (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"), ("&#x27;", "''''"),
            ("&apos;", "''''"), ("&nbsp;", "chr(160)"), ("&middot;", "chr(183)"), ("&copy;", "chr(169)"))


def clean_text(e: str) -> str:
    s = f"regexp_replace(coalesce({e}, ''), '<[^>]+>', '', 'g')"
    for ent, ch in _ENT_SQL:
        s = f"replace({s}, '{ent}', {ch})"
    return strip(f"regexp_replace({s}, '&amp;?', '&', 'g')")


def rfc822(c: str) -> str:
    from ..functions.news_text import MONTHS, ZONES
    _RFC = (r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?"
            r"(?:\s+([+-]\d{4}|[A-Za-z]+))?\s*$")
    _ISO = r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2})(?::(\d{2}))?$"
    g = lambda i: f"regexp_extract({c}, '{_RFC}', {i})"
    months = "[" + ", ".join(f"'{m.upper()}'" for m in MONTHS) + "]"
    month = f"list_position({months}, upper({g(2)}))"
    sec = f"(case when {g(6)} = '' then 0 else try_cast({g(6)} as bigint) end)"
    local = (f"make_timestamp(try_cast({g(3)} as bigint), {month}, try_cast({g(1)} as bigint), "
             f"try_cast({g(4)} as bigint), try_cast({g(5)} as bigint), cast({sec} as double))")
    zone = g(7)
    named = "(case " + " ".join(f"when upper({zone}) = '{n}' then {o}" for n, o in ZONES) + " else 0 end)"
    off = (f"(case when regexp_matches({zone}, '^[+-][0-9]{{4}}$') then "
           f"(case when substr({zone}, 1, 1) = '-' then -1 else 1 end) * "
           f"(cast(substr({zone}, 2, 2) as bigint) * 60 + cast(substr({zone}, 4, 2) as bigint)) else {named} end)")
    utc = f"({local} - to_minutes({off}))"
    gi = lambda i: f"regexp_extract({c}, '{_ISO}', {i})"
    iso = (f"{gi(1)} || '-' || {gi(2)} || '-' || {gi(3)} || 'T' || {gi(4)} || ':' || {gi(5)} || ':' || "
           f"(case when {gi(6)} = '' then '00' else {gi(6)} end)")
    return (f"(case when coalesce({c}, '') = '' then null "
            f"when regexp_matches({c}, '{_RFC}') and {local} is not null "
            f"then strftime({utc}, '%Y-%m-%dT%H:%M:%S') || '+00:00' "
            f"when regexp_matches({c}, '{_ISO}') then {iso} else {c} end)")


def _re(p: str) -> str:
    """A Java pattern for RE2: drop the (?d) flag (RE2's '.' already stops at \\n only)."""
    return p.replace("(?d)", "")


def letter_title(md: str) -> str:
    from ..functions.letters import SUBJECT_RE
    r = _re(SUBJECT_RE)
    return f"(case when regexp_matches({md}, '{r}') then {strip(f'regexp_extract({md}, {chr(39)}{r}{chr(39)}, 1)')} else 'Market Summary' end)"


def _inline(s: str) -> str:
    from ..functions.letters import LINK_RE
    s = f"regexp_replace({s}, '{LINK_RE}', '<a href=\"\\2\">\\1</a>', 'g')"
    s = f"regexp_replace({s}, '\\*\\*([^*]+)\\*\\*', '<strong>\\1</strong>', 'g')"
    return f"regexp_replace({s}, '\\*([^*]+)\\*', '<em>\\1</em>', 'g')"


def render_markdown(md: str) -> str:
    from ..functions.letters import BLOCK_SPLIT
    b2 = "regexp_replace(b, '^\\n+|\\n+$', '', 'g')"
    hashes = f"regexp_extract({b2}, '^(#{{1,6}}) ', 1)"
    lvl = f"cast(length({hashes}) as varchar)"
    heading = (f"'<h' || {lvl} || '>' || {_inline(f'trim(regexp_replace({b2}, {chr(39)}^#{{1,6}} {chr(39)}, {chr(39)}{chr(39)}))')}"
               f" || '</h' || {lvl} || '>'")
    para = f"'<p>' || replace({_inline(b2)}, chr(10), '<br />' || chr(10)) || '</p>'"
    render = f"(case when {hashes} <> '' then {heading} else {para} end)"
    blocks = (f"list_filter(regexp_split_to_array(replace(coalesce({md}, ''), chr(13) || chr(10), chr(10)), "
              f"'{BLOCK_SPLIT}'), lambda b: trim(b) <> '')")
    return f"array_to_string(list_transform({blocks}, lambda b: {render}), chr(10))"
