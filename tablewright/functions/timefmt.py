"""Timestamp helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import col

# PostgreSQL format tokens and their Spark datetime patterns.
# HH24 maps to HH (0-23); Spark's kk (1-24) gives NULL for hour 00.
PG_TOKENS = {
    "YYYY": "yyyy",
    "YY": "yy",
    "MM": "MM",
    "DD": "dd",
    "HH24": "HH",
    "HH12": "hh",
    "HH": "hh",
    "MI": "mm",
    "SS": "ss",
    "MS": "SSS",
    "US": "SSSSSS",
    "AM": "a",
    "PM": "a",
}
_PG_RE = re.compile("|".join(sorted(PG_TOKENS, key=len, reverse=True)))


def pg_format(fmt: str) -> str:
    """Translate a PostgreSQL format string token by token (longest token
    first, one pass), so 'MI' never touches 'MM' and literal text is kept."""
    out, last = [], 0
    for m in _PG_RE.finditer(fmt):
        lit = fmt[last:m.start()]
        out.append(_quote_literal(lit))
        out.append(PG_TOKENS[m.group(0)])
        last = m.end()
    out.append(_quote_literal(fmt[last:]))
    return "".join(out)


def _quote_literal(s: str) -> str:
    if not s:
        return ""
    if re.search(r"[A-Za-z]", s):
        return "'" + s.replace("'", "''") + "'"
    return s


def parse_ts(c, pg_fmt: str, ntz: bool = True) -> Column:
    """Parse text with a PostgreSQL format; text that does not match gives
    NULL.  Returns timestamp_ntz by default (wall-clock value)."""
    ts = F.try_to_timestamp(col(c), F.lit(pg_format(pg_fmt)))
    return ts.cast("timestamp_ntz") if ntz else ts


def format_ts(c, pg_fmt: str) -> Column:
    return F.date_format(col(c), pg_format(pg_fmt))


def shift_seconds(c, seconds: int, ntz: bool = True) -> Column:
    """Timestamp plus whole seconds with the sub-second part dropped (what
    ``from_unixtime(unix_timestamp(ts) + s)`` gives), type kept."""
    shifted = F.timestamp_add("SECOND", F.lit(seconds), F.date_trunc("second", col(c)))
    return shifted.cast("timestamp_ntz" if ntz else "timestamp")
