"""Scalar Column helpers: URL tails, long-form dates, surrogate keys, change tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the modelled warehouse's SQL:
#   date guard pattern:   ^\s*[A-Za-z]+ \d{1,2}, \d{4}\s*$
#   date text format:     Month D, YYYY (full month name, day without padding)
#   URL id pattern:       [^/]+$   (regex tail);  split on '/' and take the last part
#   surrogate key:        md5(coalesce(id,'') || '|' || coalesce(updated_at::text,''))
LONG_DATE_PATTERN = r"^\s*[A-Za-z]+ \d{1,2}, \d{4}\s*$"
LONG_DATE_FORMAT = "MMMM d, yyyy"
URL_TAIL_PATTERN = r"[^/]+$"
KEY_SEPARATOR = "|"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_tail_split(url) -> Column:
    """Last '/'-separated part: trailing slash -> '', no slash -> whole string."""
    return F.split_part(_col(url), F.lit("/"), F.lit(-1))


def url_tail_regex(url) -> Column:
    """Trailing run of non-slash characters; NULL when the URL ends in '/' or is NULL."""
    return F.regexp_substr(_col(url), F.lit(URL_TAIL_PATTERN))


def parse_long_date(text) -> Column:
    """'November 21, 1998' -> DATE; anything not matching the guard, or not a real
    calendar date, -> NULL (never raises under ANSI mode)."""
    t = _col(text)
    return F.when(
        t.rlike(LONG_DATE_PATTERN),
        F.try_to_date(F.trim(t), LONG_DATE_FORMAT),
    )


def surrogate_key(*cols) -> Column:
    """md5 over the text of each column (NULL as ''), joined by '|'."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def changed(left_cols, right_cols) -> Column:
    """Null-safe 'IS DISTINCT FROM' over column pairs, OR-ed."""
    tests = [~_col(a).eqNullSafe(_col(b)) for a, b in zip(left_cols, right_cols)]
    return reduce(lambda x, y: x | y, tests, F.lit(False))
