"""Hour arithmetic on TIMESTAMP_NTZ.

`date_trunc` and `timestampdiff` go through the session time zone and would
bend hours around clock changes. Dates and intervals do not, so everything here
is built from those.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = "INTERVAL '1' HOUR"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(ts: Column | str) -> Column:
    """The hour a timestamp falls in, as TIMESTAMP_NTZ."""
    ts = as_column(ts).cast("timestamp_ntz")
    return ts.cast("date").cast("timestamp_ntz") + F.hour(ts) * F.expr(HOUR)


def hour_literal(at: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal on a full hour."""
    at = parse(at)
    if at != at.replace(minute=0, second=0, microsecond=0):
        raise ValueError(f"{at} is not on a full hour")
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def parse(at: datetime | str) -> datetime:
    return datetime.fromisoformat(at) if isinstance(at, str) else at


def hours_between(start: datetime | str, end: datetime | str) -> int:
    """Whole hours in [start, end)."""
    return int((parse(end) - parse(start)).total_seconds() // 3600)


def add_hours(hour: Column | str, n: Column | int) -> Column:
    return as_column(hour) + (F.lit(n) if isinstance(n, int) else n) * F.expr(HOUR)


def hour_offset(hour: Column | str, start: datetime | str) -> Column:
    """Whole hours from `start` to `hour`; an INT, negative before `start`."""
    gap = as_column(hour) - hour_literal(start)
    return F.call_function("div", gap, F.expr(HOUR)).cast("int")


def iso_weekday(hour: Column | str) -> Column:
    """Weekday of the reporting table: 1 = Monday .. 7 = Sunday."""
    return F.weekday(as_column(hour)) + F.lit(1)


def weekday(hour: Column | str) -> Column:
    """Weekday of the model: 0 = Monday .. 6 = Sunday."""
    return F.weekday(as_column(hour))


def parse_hour(text: Column | str) -> Column:
    """Hour stamps written as text; anything but zeros after the hour is an error."""
    trimmed = F.trim(as_column(text))
    rest = F.substring(trimmed, 14, 100)
    hour = F.to_timestamp_ntz(F.substring(trimmed, 1, 13), F.lit("yyyy-MM-dd HH"))
    odd = F.raise_error(F.concat(F.lit("not a full hour: "), trimmed)).cast("timestamp_ntz")
    full = rest.rlike(r"^(:00(:00([.]0+)?)?)?Z?$") | trimmed.isNull()
    return F.when(full, hour).otherwise(odd)


def months_before(as_of: date | None, n: int = 4) -> list[tuple[int, int]]:
    """(year, month) of the `n` whole months before `as_of`, oldest first."""
    as_of = as_of or date.today()
    last = as_of.year * 12 + as_of.month - 1
    return [(m // 12, m % 12 + 1) for m in range(last - n, last)]
