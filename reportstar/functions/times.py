"""Timestamps, durations and calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportstar.functions.text import _col, capture, strip

# The text formats of the reports.
STAMP_PATTERN = (
    r"^#([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})\s+([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})\z"
)
DURATION_PATTERN = (
    r"(?U)(?:([0-9]+)[\s\x1c-\x1f]*h[\s\x1c-\x1f]*)?([0-9]+)[\s\x1c-\x1f]*min"
)
HOURS_PATTERN = r"(?U)([0-9]+)[\s\x1c-\x1f]*h"
MINUTES_PATTERN = r"(?U)([0-9]+)[\s\x1c-\x1f]*min"

# Minutes per unit and the spellings taken for it.
UNITS = (
    (1440.0, "days|day|d"),
    (60.0, "hours|hour|hr|h"),
    (1.0, "minutes|minute|min|m"),
    (1.0 / 60.0, "seconds|second|sec|s"),
)
_AMOUNT = r"[0-9]+(?:\.[0-9]+)?"


def parse_datetime(c: Column | str, trim: bool = True) -> Column:
    """``23.03.2026 03:23:54`` to TIMESTAMP_NTZ; no time zone is ever applied.

    One-digit fields are accepted. The text is rearranged and cast, since the only
    parser with a pattern works in the session's time zone. The leading mark makes text
    that does not match, and so stays as it is, fail the cast.
    """
    marked = F.concat(F.lit("#"), strip(c) if trim else _col(c))
    return F.regexp_replace(marked, STAMP_PATTERN, "$3-$2-$1 $4:$5:$6").try_cast("timestamp_ntz")


def _part(c: Column, pattern: str, group: int) -> Column:
    return capture(c, pattern, group).try_cast("int")


def parse_duration(c: Column | str) -> Column:
    """First ``[h h] m min`` in the text as whole minutes; NULL without one."""
    s = _col(c)
    # A missing hour leaves the zero that is put before it.
    hours = F.concat(F.lit("0"), F.regexp_extract(s, DURATION_PATTERN, 1)).try_cast("int")
    minutes = _part(s, DURATION_PATTERN, 2)
    return (hours.cast("bigint") * 60 + minutes).try_cast("int")


def parse_duration_lenient(c: Column | str) -> Column:
    """Hours and minutes looked for separately, a missing part counts 0."""
    s = _col(c)
    hours = F.coalesce(_part(s, HOURS_PATTERN, 1), F.lit(0)).cast("bigint")
    minutes = F.coalesce(_part(s, MINUTES_PATTERN, 1), F.lit(0))
    return F.when(s.isNotNull(), (hours * 60 + minutes).try_cast("int"))


def parse_timedelta_minutes(c: Column | str) -> Column:
    """Sum of ``<number> <unit>`` parts (days to seconds) as fractional minutes."""
    s = strip(c)
    units = "|".join(names for _, names in UNITS)
    whole = rf"^(?:\s*{_AMOUNT}\s*(?:{units}))+$"
    total = F.lit(0.0)
    for minutes, names in UNITS:
        found = F.regexp_extract_all(s, F.lit(rf"({_AMOUNT})\s*(?:{names})(?![a-z])"), F.lit(1))
        total = total + F.aggregate(
            found, F.lit(0.0), lambda acc, x: acc + F.coalesce(x.try_cast("double"), F.lit(0.0))
        ) * F.lit(minutes)
    return F.when(s.rlike(whole), total)


def day(c: Column | str) -> Column:
    return _col(c).cast("date")


def week_ending(c: Column | str) -> Column:
    """The Sunday that ends the week of a date; a Sunday is its own label."""
    return F.next_day(F.date_sub(_col(c), 1), "SUN")
