"""Dates near phrases of a notice: words and numbers are read as pieces, not by patterns of whole notations."""

from __future__ import annotations

import datetime as dt
import re
import unicodedata

from .timestamps import MONTHS

# Phrases of a last-time-buy date, word by word; between words stand blanks, dashes or nothing.
PHRASES = (
    ("last", "time", "buy"),
    ("last", "time", "to", "buy"),
    ("last", "order"),
    ("last", "order", "date"),
    ("last", "buy"),
    ("lifetime", "buy"),
    ("life", "time", "buy"),
    ("ltb",),
)
#: A date qualifies if it begins so many characters after a phrase or ends so many before it.
AFTER, BEFORE = 120, 80
#: Characters shown around a date, and before it; dates reported for one text.
CONTEXT, GOVERNING, MOST = 80, 48, 8

_ENGLISH = {name: m for m, names in MONTHS.items() for name in (names.split()[0], names.split()[0][:3])} | {"sept": 9}
_DASHES = "‐‑‒–—―−"
_PIECE = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]+")


def folded(text: str) -> str:
    """The text with every dash a hyphen, every white space a blank and compatible characters plain; no position moves."""

    def one(c: str) -> str:
        if c.isspace():
            return " "
        if c in _DASHES:
            return "-"
        plain = unicodedata.normalize("NFKC", c)
        return plain if len(plain) == 1 else c

    return text if text.isascii() and not re.search(r"[\t-\r]", text) else "".join(map(one, text))


def _kind(piece: str) -> str:
    """What a piece may be of a date: d and dd for one and two digits, y for four, M for a month's name."""
    if piece.isdigit():
        return {1: "d", 2: "dd", 4: "y"}.get(len(piece), "?")
    return "M" if piece.lower() in _ENGLISH else "?"


def _joint(piece: str) -> str:
    """What stands between two pieces, in short: a blank, a comma, a dot and blank, a dash or a slash."""
    s = piece.strip(" ")
    return {"": " ", ",": "," if piece[0] == "," else "?", ".": ". " if piece != "." and piece[0] == "." else "?", ".,": "., " if piece.startswith(".,") else "?"}.get(s, piece)


def _notation(kinds: tuple[str, ...], joints: tuple[str, ...]) -> tuple[int, str] | None:
    """(rank, order of year, month and day) of three pieces; of notations that overlap the lower rank holds."""
    a, b, c = kinds
    after_month = {" ": True, ". ": True, ",": True, "., ": True}
    if a in ("d", "dd") and b == "M" and c == "y" and joints[0] == " " and after_month.get(joints[1]):
        return 0, "dmy"
    if a == "M" and b in ("d", "dd") and c == "y" and joints[0] in (" ", ". ") and joints[1] in (" ", ","):
        return 1, "mdy"
    if a in ("d", "dd") and b == "M" and c in ("y", "dd") and joints == ("-", "-"):
        return 2, "dmy"
    if a in ("d", "dd") and b in ("d", "dd") and c == "y" and joints == ("/", "/"):
        return 3, "mdy"
    if a == "y" and b == c == "dd" and joints in (("-", "-"), ("/", "/")):
        return 4 if joints[0] == "-" else 5, "ymd"
    return None


def date_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, ISO date) of the dates in a folded text; all-number dates with slashes are read month first.

    A notation of lower rank claims its span; impossible dates claim nothing. A date that goes on in
    letters or digits is none.
    """
    pieces = [(m.start(), m.end(), m[0]) for m in _PIECE.finditer(text)]
    found = []
    for i in range(len(pieces) - 4):
        (start, _, a), (_, _, s), (_, _, b), (_, _, t), (_, end, c) = pieces[i : i + 5]
        if s[0].isascii() and s[0].isalnum() or t[0].isascii() and t[0].isalnum():
            continue
        if start and (text[start - 1].isalnum() or text[start - 1] == "_") or end < len(text) and (text[end].isalnum() or text[end] == "_"):
            continue
        n = _notation((_kind(a), _kind(b), _kind(c)), (_joint(s), _joint(t)))
        if n is None:
            continue
        part = dict(zip(n[1], (a, b, c)))
        month = int(part["m"]) if part["m"].isdigit() else _ENGLISH[part["m"].lower()]
        year = int(part["y"]) + (2000 if len(part["y"]) == 2 else 0)
        try:
            found.append((n[0], start, end, dt.date(year, month, int(part["d"])).isoformat()))
        except ValueError:
            continue
    out: list[tuple[int, int, str]] = []
    for _, start, end, iso in sorted(found):
        if not any(start < b and a < end for a, b, _ in out):
            out.append((start, end, iso))
    return sorted(out)


def phrase_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of every phrase in a folded text, overlapping ones too, by start and then in the order of PHRASES."""
    at = [i for i, c in enumerate(text) if c not in " -"]
    run = "".join(text[i] for i in at).lower()
    word = lambda i: 0 <= i < len(text) and (text[i].isalnum() or text[i] == "_")
    out = []
    for rank, words in enumerate(PHRASES):
        phrase = "".join(words)
        k = run.find(phrase) if len(run) == len(at) else -1
        while k >= 0:
            start, end = at[k], at[k + len(phrase) - 1] + 1
            if not word(start - 1) and not word(end):
                out.append((start, rank, end))
            k = run.find(phrase, k + 1)
    return [(start, end) for start, _, end in sorted(out)]


def dated_phrases(text: str) -> list[tuple[str, str, str, str, str]]:
    """(iso, source, phrase, governing, snippet) of dates near a phrase, by position, each date once, at most MOST.

    The source and the nearest phrase are given as printed; what precedes the date and the snippet around
    it with single blanks, dots where the snippet was cut.
    """
    plain = folded(text)
    phrases = phrase_spans(plain)
    out, seen = [], set()
    for a, b, iso in date_spans(plain) if phrases else []:
        gaps = [(a - y if a >= y else x - b, k) for k, (x, y) in enumerate(phrases) if 0 <= a - y <= AFTER or 0 <= x - b <= BEFORE]
        if not gaps or iso in seen:
            continue
        seen.add(iso)
        x, y = phrases[min(gaps)[1]]
        lo, hi = a - CONTEXT, b + CONTEXT
        snippet = " ".join(text[max(0, lo) : hi].split())
        out.append((iso, text[a:b], text[x:y], " ".join(text[max(0, a - GOVERNING) : a].split()), ("..." if lo > 0 else "") + snippet + ("..." if hi < len(text) else "")))
    return out[:MOST]
