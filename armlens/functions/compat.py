"""Column functions whose NULL / empty-string behaviour must follow the
experiment SQL, where Spark's same-named built-ins differ (SURVEY §2.8).

All of them are plain Catalyst expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def capture_or_null(s, pattern: str, group: int = 1) -> Column:
    """SC-4: the capture group of the first match, NULL when nothing matches.

    Spark's ``regexp_extract`` returns '' on no match and ``regexp_substr``
    returns the whole match, so neither is usable alone."""
    s = _c(s)
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, group))


def match_or_null(s, pattern: str) -> Column:
    """SC-5: the whole first match, NULL when nothing matches."""
    s = _c(s)
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, 0))


def if_else(cond: Column, yes, no) -> Column:
    """SC-8: ``IF(cond, yes, no)``; a NULL condition takes the ``no`` branch."""
    return F.when(cond, yes).otherwise(no)


def safe_divide(num, den) -> Column:
    """SC-14: NULL instead of an error on a zero divisor."""
    return F.try_divide(_c(num), _c(den))


def calendar_day_diff(later, earlier) -> Column:
    """SC-11: number of calendar-day boundaries between two instants
    (23:50 -> 00:10 next day is 1), not elapsed 24 h periods."""
    return F.datediff(F.to_date(_c(later)), F.to_date(_c(earlier)))


def weekday_name(d) -> Column:
    """SC-13: English weekday name ('Monday') of a date or timestamp."""
    return F.date_format(F.to_date(_c(d)), "EEEE")


def try_double(c) -> Column:
    """PRJ-10: numeric re-typing that yields NULL for a value that does not
    parse instead of failing the job under ANSI mode."""
    return _c(c).try_cast("double")
