"""Personal data by anchor expansion.

One Aho-Corasick pass per text finds anchors: at-signs, plus signs, digits,
``://`` and identifier cues.  A parser of the anchor's kind expands it to its
boundaries, left and right, and validates what it holds.  Within a kind, spans
don't overlap and the leftmost wins; what fails validation is not tried again.
Secrets and logins run to their delimiter, however long they are.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forumlens.llm import common as C

BASE = ("email", "ip", "card", "phone")
#: Kinds in the order in which spans with one start are listed.
KINDS = (*BASE, "iban", "ssn", "account", "secret", "login")

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_GLUE = r"[ \t]{0,3}(?:(?:no|nr|number|is|id)\b\.?)?[ \t]{0,3}[:=#]?[ \t]{0,3}"
_IBAN = re.compile(_GLUE + r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(_GLUE + r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(_GLUE + r"([0-9](?:-?[0-9]){5,16})(?![0-9-])")
_SECRET_GLUE = re.compile(r"[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"']?")
_SECRET = re.compile(r"[^\s\"'<>,;]{8,}")
_KEY = re.compile(r"[0-9A-Z]{16}(?![0-9A-Za-z])")
_SCHEME = frozenset(string.ascii_letters + string.digits + "+.-")
_LOGIN = re.compile(r"[^\s/@\"'<>]++@[A-Za-z0-9.-]+")

#: Characters of an IBAN by country (the registry's fixed lengths), without spaces.
IBAN_SIZE = {
    code: int(size) for size, codes in {
        "15": "NO", "16": "BE", "18": "DK FI FK FO GL NL SD", "19": "MK SI", "20": "AT BA EE KZ LT LU MN XK",
        "21": "CH HR LI LV", "22": "BG BH CR DE GB GE IE ME RS VA", "23": "AE GI IL IQ OM SO TL",
        "24": "AD CZ ES MD PK RO SA SE SK TN VG", "25": "LY PT ST", "26": "IS TR", "27": "BI DJ FR GR IT MC MR SM",
        "28": "AL AZ BY CY DO GT HN HU LB NI PL SV", "29": "BR EG PS QA UA", "30": "JO KW MU YE",
        "31": "MT SC", "32": "LC", "33": "RU"}.items() for code in codes.split()}

#: Identifier cues and the kind of what follows them.
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account",
        "password": "secret", "passwd": "secret", "secret": "secret", "token": "secret",
        "api_key": "secret", "apikey": "secret", "api-key": "secret"}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark in ("@", "+", "://", "AKIA", *string.digits):
        found.add_word(mark, (mark if mark not in string.digits else "0", len(mark)))
    for cue, kind in CUES.items():
        for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
            found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


ANCHORS = _automaton()


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban_end(text: str, start: int, end: int) -> int | None:
    """Where the IBAN at ``start`` ends: at the country's length, for other
    countries the last end of a word up to ``end``, if the checksum holds there."""
    size = IBAN_SIZE.get(text[start:start + 2])
    while end > start:
        t = text[start:end].replace(" ", "")
        if len(t) < (size or 15):
            return None
        whole = not text[end - 1].isspace() and not re.match("[A-Za-z0-9]", text[end:end + 1])
        if whole and len(t) == (size or len(t)) and int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1:
            return end
        end -= 1
    return None


def _addresses(text: str, at: int) -> tuple[int, list[tuple[int, int]]]:
    """The end of the dotted numbers from ``at``, and each four of them in turn."""
    run = _DOTTED.match(text, at)
    spans, parts, start = [], run.group().split("."), at
    for k in range(0, len(parts) - 3, 4):
        four = parts[k:k + 4]
        end = start + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
            spans.append((start, end))
        start = end + 1
    return run.end(), spans


def find_spans(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of all personal data, in code points, in no order."""
    email_end = dotted_end = grouped_end = plain_end = 0
    last = dict.fromkeys(KINDS, 0)
    for end, (mark, size) in ANCHORS.iter(text):
        at = end - size + 1
        if mark == "0":
            if at >= dotted_end:
                dotted_end, spans = _addresses(text, at)
                for a, b in spans:
                    yield a, b, "ip"
            if at >= grouped_end:
                run = _GROUPED.match(text, at)
                grouped_end = run.end()
                if grouped_end - at <= 37:
                    digits = run.group().replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and _luhn(digits):
                        yield at, grouped_end, "card"
        elif mark == "@":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (host := _DOMAIN.match(text, at + 1)):
                email_end = host.end()
                yield start, email_end, "email"
        elif mark == "+":
            if (m := _PHONE.match(text, at)) and 9 <= sum(c in string.digits for c in m.group()) <= 15:
                yield at, m.end(), "phone"
        elif mark == "://":
            start = at
            while start > last["login"] and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and (m := _LOGIN.match(text, end + 1)):
                last["login"] = m.end()
                yield start, m.end(), "login"
        elif mark == "AKIA":
            if at >= last["secret"] and not text[at - 1:at].isalnum() and (m := _KEY.match(text, end + 1)):
                last["secret"] = m.end()
                yield at, m.end(), "secret"
        elif mark == "secret":
            # a run is read once: what starts inside one of before shares its end
            if (glue := _SECRET_GLUE.match(text, end + 1)) and glue.end() >= max(last[mark], plain_end):
                if not (m := _SECRET.match(text, glue.end())):
                    continue
                if not re.search("[0-9]", m.group()):
                    plain_end = m.end()
                    continue
                last[mark] = m.end()
                yield m.start(), m.end(), mark
        else:
            rule = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[mark]
            if (m := rule.match(text, end + 1)) and m.start(1) >= last[mark]:
                stop = _iban_end(text, m.start(1), m.end(1)) if mark == "iban" else m.end(1)
                if stop is None:
                    continue
                last[mark] = stop
                yield m.start(1), stop, mark


def _scan(text_at: int):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    order = {k: i for i, k in enumerate(KINDS)}

    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column(text_at):
                spans = find_spans(text.as_py() or "")
                found.append([{"kind": k, "start": a, "end": b}
                              for a, b, k in sorted(spans, key=lambda s: (s[0], order[s[2]], s[1]))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)],
                                             [*batch.schema.names, "made"])
    return run


def find_personal_data(docs: DataFrame, text_col: str = "text", result: str = "personal_data") -> DataFrame:
    """``docs`` with an array column ``result`` of (kind, start, end), by start
    and then kind: code points of the whole text, end exclusive.

    Null and empty texts have no spans; equal texts have equal spans; other
    columns stay; an empty table stays empty.  If ``docs`` has a column ``result``
    the new one gets underscores.
    """
    kind = T.ArrayType(T.StructType.fromDDL("kind string, start long, end long"))
    return C.add_in_arrow(docs, _scan(docs.columns.index(text_col)), C.free_name(docs, result), kind)
