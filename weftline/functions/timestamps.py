"""Normalisation of dates and times typed in many notations and zones.

A value is tokenised once: words become coded tokens (month, meridiem, zone, ...) and the digits left
over give a shape mask such as ``9999-99-99T99:99`` or ``99 M 9999``. Each distinct mask is mapped to a
parser once per worker; the values of one mask are then converted together with numpy. Local times go
to UTC through transition tables built from the installed zone database, whose version is reported by
``zone_database_version``.

Result per value: ``YYYY-MM-DD`` for a date without time, ``YYYY-MM-DDTHH:MM:SS.ffffffZ`` for an
instant, NULL where the value states no valid date (null, blank, placeholder, impossible date, a
period such as a quarter, a local time whose zone is not known).
"""

from __future__ import annotations

import datetime as dt
import functools
import re
import unicodedata
import zoneinfo

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Month names and abbreviations in English, German, French and Spanish (accents removed).
MONTHS = {
    1: "january jan januar janvier janv enero ene",
    2: "february feb februar fevrier fevr febrero",
    3: "march mar marz maerz mars marzo",
    4: "april apr avril avr abril abr",
    5: "may mai mayo",
    6: "june jun juni juin junio",
    7: "july jul juli juillet juil julio",
    8: "august aug aout agosto ago",
    9: "september sep sept septembre septiembre setiembre",
    10: "october oct oktober okt octobre octubre",
    11: "november nov novembre noviembre",
    12: "december dec dezember dez decembre diciembre dic",
}
# Weekday names, English, German, French and Spanish.
WEEKDAYS = (
    "monday mon tuesday tue tues wednesday wed thursday thu thur thurs friday fri saturday sat sunday sun "
    "montag dienstag mittwoch donnerstag freitag samstag sonntag "
    "lundi mardi mercredi jeudi vendredi samedi dimanche lunes martes miercoles jueves viernes sabado domingo"
)
# Zone abbreviations (North American, European, Japanese) in minutes east of UTC.
ZONES = {
    "utc": 0, "gmt": 0, "z": 0, "ut": 0,
    "nst": -210, "ndt": -150, "ast": -240, "adt": -180, "est": -300, "edt": -240, "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600, "hdt": -540,
    "wet": 0, "west": 60, "bst": 60, "ist": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120,
    "eet": 120, "eest": 180, "msk": 180, "jst": 540,
}
WORDS = {w: f"M{m:02d}" for m, names in MONTHS.items() for w in names.split()}
WORDS |= {w: "D" for w in WEEKDAYS.split()}
WORDS |= {w: "Z%+05d" % (abs(o) // 60 * 100 + abs(o) % 60) if o >= 0 else "Z-%04d" % (abs(o) // 60 * 100 + abs(o) % 60) for w, o in ZONES.items()}
WORDS |= {"am": "P0", "pm": "P1", "t": "T", "w": "W", "de": "", "del": "", "of": "", "the": "", "st": "", "nd": "", "rd": "", "th": "", "er": "", "at": "", "um": "", "uhr": "", "h": "h"}

_TOKEN = re.compile(r"[^\W\d_]+")
_TIME = r"(?P<hh>\d{1,2}):(?P<mi>\d{2})(?::(?P<ss>\d{2})(?:[.,](?P<fr>\d{1,9}))?)?(?: ?P(?P<pm>[01]))?(?: ?(?P<zone>Z(?:[+-]\d{4})?|[+-]\d{2}:?\d{2}|[+-]\d{2}))?"
_DATE = {
    "ymd": r"(?P<y>\d{4})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})",
    "mdy": r"(?P<m>\d{1,2})/(?P<d>\d{1,2})/(?P<y>\d{4}|\d{2})",
    "dmy": r"(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?P<y>\d{4}|\d{2})",
    "dMy": r"(?P<d>\d{1,2})[ .,-]*M(?P<m>\d{2})[ .,-]*(?P<y>\d{4}|\d{2})",
    "Mdy": r"M(?P<m>\d{2})[ .,-]*(?P<d>\d{1,2})[ .,]+(?P<y>\d{4})",
    "yMd": r"(?P<y>\d{4})[ .,-]*M(?P<m>\d{2})[ .,-]*(?P<d>\d{1,2})",
    "ord": r"(?P<y>\d{4})-(?P<doy>\d{3})",
    "week": r"(?P<y>\d{4})-?W(?P<w>\d{2})-?(?P<wd>\d)",
    "basic": r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})",
}
#: Tried in this order against a mask (digits all 9): the shapes differ, so at most one date form fits.
PARSERS = [(kind, re.compile(rf"(?:D[ .,]*)?{date}(?:(?:[ T,]+| ?T){_TIME})?(?: ?Z\+0000)?")) for kind, date in _DATE.items()]
PARSERS += [
    ("basic", re.compile(r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})T(?P<hh>\d{2})(?P<mi>\d{2})(?:(?P<ss>\d{2})(?:[.,](?P<fr>\d{1,9}))?)?(?P<zone>Z(?:[+-]\d{4})?|[+-]\d{2}:?\d{2})?")),
    ("epoch", re.compile(r"(?P<s>\d{10})(?P<ms>\d{3})?(?P<us>\d{3})?")),
]
DAY_US = 86_400_000_000


def tokenise(value: str) -> str:
    """The value with words replaced by coded tokens and white space reduced to single spaces."""
    s = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))

    def code(m: re.Match) -> str:
        return WORDS.get(m[0].lower(), "X")

    s = re.sub(r"(?i)\b([ap])\.\s?m\.?(?=\W|$)", r"\1m", s)
    s = re.sub(r"\s+", " ", _TOKEN.sub(code, s)).strip()
    return re.sub(r" ?, ?(?=\d{4}\b)|(?<=M\d\d)\. ", " ", s)


def mask(coded: str) -> str:
    """The shape of a tokenised value: every digit that is no part of a word's code becomes 9."""
    return re.sub(r"M\d\d|Z[+-]\d{4}|P\d|\d", lambda m: "9" if m[0].isdigit() else re.sub(r"\d", "9", m[0]), coded)


@functools.lru_cache(maxsize=100_000)
def parser_of(shape: str) -> tuple[str, re.Pattern] | None:
    """The parser of a mask, found once per distinct mask."""
    probe = shape.replace("P9", "P0")
    if "X" in probe:
        return None
    return next(((kind, p) for kind, p in PARSERS if p.fullmatch(probe)), None)


def zone_database_version() -> str:
    """The version of the zone database the transition tables come from."""
    try:
        import tzdata

        return f"tzdata {tzdata.IANA_VERSION}"
    except ImportError:
        for root in zoneinfo.TZPATH:
            try:
                with open(f"{root}/tzdata.zi") as f:
                    return f.readline().strip("# \n")
            except OSError:
                continue
    return "system"


@functools.lru_cache(maxsize=1024)
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(wall-clock thresholds, offsets) of a zone in seconds, or None for an unknown zone.

    A wall time below threshold i (and not below i-1) has offset i. Thresholds lie at the later of the
    two wall readings of a change: a reading that occurs twice keeps the offset before the change (the
    earlier instant) and a skipped reading does too (it moves forward by the gap).
    """
    try:
        z = zoneinfo.ZoneInfo(zone)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        return None
    utc = dt.timezone.utc
    off = lambda t: int(dt.datetime.fromtimestamp(t, utc).astimezone(z).utcoffset().total_seconds())
    lo, end, step = -2_208_988_800, 4_102_444_800, 12 * 86_400
    walls, offs, last = [], [off(lo)], off(lo)
    for t in range(lo + step, end, step):
        if (now := off(t)) != last:
            a, b = t - step, t
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (mid, b) if off(mid) == last else (a, mid)
            now = off(b)
            walls.append(b + max(last, now))
            offs.append(now)
            last = now
    return np.array(walls, dtype=np.int64), np.array(offs, dtype=np.int64)


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 in the Gregorian calendar."""
    y = y - (m <= 2)
    era = y // 400
    yoe = y - era * 400
    doy = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146_097 + yoe * 365 + yoe // 4 - yoe // 100 + doy - 719_468


def _leap(y: np.ndarray) -> np.ndarray:
    return (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))


def _number(s: pd.Series, default: int = 0) -> np.ndarray:
    return pd.to_numeric(s.where(s.notna() & (s != ""), str(default))).to_numpy(dtype=np.int64)


def _iso_days(days: np.ndarray) -> np.ndarray:
    return np.datetime_as_string(days.astype("datetime64[D]"), unit="D").astype(object)


def _convert(kind: str, pattern: re.Pattern, coded: pd.Series, zone: pd.Series) -> np.ndarray:
    """The normal forms of values that share one mask."""
    f = coded.str.extract(pattern)
    out = np.full(len(coded), None, dtype=object)
    if kind == "epoch":
        us = _number(f["s"]) * 1_000_000 + _number(f["ms"]) * 1000 + _number(f["us"])
        return np.array([x + "Z" for x in np.datetime_as_string(us.astype("datetime64[us]"), unit="us")], dtype=object)
    y = _number(f["y"])
    y = np.where(f["y"].str.len() == 2, y + 2000, y)
    ok = y >= 1
    if kind == "ord":
        doy = _number(f["doy"])
        ok &= (doy >= 1) & (doy <= 365 + _leap(y))
        days = _days(y, np.ones_like(y), np.ones_like(y)) + doy - 1
    elif kind == "week":
        w, wd = _number(f["w"]), _number(f["wd"])
        jan4 = _days(y, np.ones_like(y), np.full_like(y, 4))
        monday = jan4 - (jan4 + 3) % 7
        nxt = _days(y + 1, np.ones_like(y), np.full_like(y, 4))
        weeks = (nxt - (nxt + 3) % 7 - monday) // 7
        ok &= (w >= 1) & (w <= weeks) & (wd >= 1) & (wd <= 7)
        days = monday + (w - 1) * 7 + wd - 1
    else:
        m, d = _number(f["m"]), _number(f["d"])
        ok &= (m >= 1) & (m <= 12)
        mm = np.clip(m, 1, 12)
        length = np.array([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[mm - 1] + ((mm == 2) & _leap(y))
        ok &= (d >= 1) & (d <= length)
        days = _days(y, mm, d)
    has_time = f["hh"].notna().to_numpy() if "hh" in f else np.zeros(len(f), dtype=bool)
    day_only = ok & ~has_time
    if day_only.any():
        out[day_only] = _iso_days(days[day_only])
    timed = ok & has_time
    if not timed.any():
        return out
    hh, mi, ss = _number(f["hh"]), _number(f["mi"]), _number(f["ss"])
    if "pm" in f:
        half = f["pm"].notna().to_numpy()
        timed &= ~half | ((hh >= 1) & (hh <= 12))
        hh = np.where(half, hh % 12 + 12 * (f["pm"] == "1").to_numpy(), hh)
    us = _number(f["fr"].fillna("").str.slice(0, 6).str.ljust(6, "0"))
    timed &= (hh < 24) & (mi < 60) & (ss < 60)
    wall = days * 86_400 + hh * 3600 + mi * 60 + ss
    shift = np.zeros(len(f), dtype=np.int64)
    mark = f["zone"].fillna("")
    fixed = (mark != "").to_numpy()
    if fixed.any():
        digits = mark.str.replace(r"[Z:+-]", "", regex=True).str.ljust(4, "0")
        n = _number(digits.where(mark != "", "0"))
        minutes = n // 100 * 60 + n % 100
        timed &= ~fixed | ((minutes <= 14 * 60) & (n % 100 < 60))
        shift = np.where(mark.str.contains("-", regex=False), -minutes, minutes) * 60
    local = timed & ~fixed
    if local.any():
        zones = zone.to_numpy(dtype=object)
        for name in {z for z in zones[local] if isinstance(z, str)}:
            rows = local & (zones == name)
            if (table := transitions(name)) is None:
                timed &= ~rows
            else:
                shift[rows] = table[1][np.searchsorted(table[0], wall[rows], side="right")]
        timed &= ~local | np.array([isinstance(z, str) for z in zones])
    micros = (wall - shift) * 1_000_000 + us
    out[timed] = [x + "Z" for x in np.datetime_as_string(micros[timed].astype("datetime64[us]"), unit="us")]
    return out


def normalise(values: pd.Series, zones: pd.Series) -> pd.Series:
    """The normal form of each value, by the zone of its row where it states none itself."""
    out = np.full(len(values), None, dtype=object)
    codes, uniques = pd.factorize(values, use_na_sentinel=True)
    coded = np.array([tokenise(u) for u in uniques], dtype=object)
    shapes = np.array([mask(c) for c in coded], dtype=object)
    row_shape = np.where(codes >= 0, pd.factorize(shapes)[0][codes] if len(shapes) else -1, -1)
    for k in np.unique(row_shape[row_shape >= 0]):
        rows = np.flatnonzero(row_shape == k)
        texts = coded[codes[rows]]
        if (found := parser_of(mask(texts[0]))) is not None:
            out[rows] = _convert(*found, pd.Series(texts), zones.iloc[rows].reset_index(drop=True))
    return pd.Series(out, index=values.index)


@F.pandas_udf(T.StringType())
def _normal_udf(values: pd.Series, zones: pd.Series) -> pd.Series:
    return normalise(values, zones)


def normal_timestamp(value: Column, zone: Column) -> Column:
    """``value`` in normal form; ``zone`` is the IANA zone of values that state a time without zone."""
    return _normal_udf(value, zone)
