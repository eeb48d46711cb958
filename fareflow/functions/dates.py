"""Calendar and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

OFFSET_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
LOCAL_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_safe(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text -> date, NULL on malformed input even under ANSI mode."""
    return F.try_to_date(_c(c), fmt)


def day_number(c: ColumnOrName) -> Column:
    """Days since 1970-01-01; the ordering value for day-range frames."""
    return F.unix_date(_c(c).cast("date"))


def lead_time(dep: ColumnOrName, search: ColumnOrName) -> Column:
    """Days from search to departure (J16); negative when departure is earlier."""
    return F.datediff(_c(dep), _c(search))


def return_date(dep: ColumnOrName, stay: ColumnOrName) -> Column:
    """Departure + stay (J15); NULL stay gives NULL."""
    return F.date_add(_c(dep), _c(stay))


def weekday_name(c: ColumnOrName) -> Column:
    """Full English weekday name, e.g. ``Monday`` (J18); looked up, as a
    formatter takes far longer a row."""
    return F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(_c(c)))


def weekday_monday0(c: ColumnOrName) -> Column:
    """Weekday number with Monday = 0."""
    return F.weekday(_c(c))


def iso_week(c: ColumnOrName) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(_c(c))


def week_of_year_monday(c: ColumnOrName) -> Column:
    """Week of year with Monday as first day, days before the first Monday
    are week 0 (the ``%W`` convention, J22)."""
    c = _c(c)
    return F.floor((F.dayofyear(c) + 6 - F.weekday(c)) / 7).cast("int")


def week_of_year_simple(c: ColumnOrName) -> Column:
    """``(day_of_year - 1) div 7 + 1`` (J22, second form)."""
    return (F.floor((F.dayofyear(_c(c)) - 1) / 7) + 1).cast("int")


def month_key(c: ColumnOrName) -> Column:
    """Partition key ``yyyyMM`` (J20); calendar year, not week-year."""
    return F.date_format(_c(c), "yyyyMM")


def year_month(c: ColumnOrName) -> Column:
    """``yyyy-MM`` label."""
    return F.date_format(_c(c), "yyyy-MM")


def time_group(hour: ColumnOrName) -> Column:
    """Time-of-day bucket from an hour."""
    h = _c(hour)
    return (F.when(h < 5, "early morning").when(h < 12, "morning")
            .when(h < 18, "afternoon").when(h.isNotNull(), "evening"))


def offset_instant(text: ColumnOrName) -> Column:
    """``2017-04-09T07:15:00.000+08:00`` -> the instant it denotes."""
    return F.try_to_timestamp(_c(text), F.lit(OFFSET_TS_FORMAT))


def offset_local(text: ColumnOrName) -> Column:
    """Wall-clock part (first 23 chars) as ``TIMESTAMP_NTZ`` (J8/J26); null
    for malformed text."""
    return F.try_to_timestamp(F.substring(_c(text), 1, 23), F.lit(LOCAL_TS_FORMAT)).cast("timestamp_ntz")


def offset_text(text: ColumnOrName) -> Column:
    """The ``+hh:mm`` tail."""
    return F.regexp_extract(_c(text), r"([+-][0-9]{2}:[0-9]{2})$", 1)


def elapsed_minutes(start: ColumnOrName, end: ColumnOrName, wall_clock: bool = False) -> Column:
    """Minutes between two offset timestamps (J3).  Default: true elapsed
    time between instants; ``wall_clock=True`` compares local clock times
    (what a parser that ignores the offset would return)."""
    if wall_clock:
        a, b = offset_local(start), offset_local(end)
        return (F.unix_timestamp(b.cast("timestamp")) - F.unix_timestamp(a.cast("timestamp"))) / 60
    return (F.unix_seconds(offset_instant(end)) - F.unix_seconds(offset_instant(start))) / 60


def shift_from_utc(ts: ColumnOrName, zone: str) -> Column:
    """UTC instant -> wall clock in ``zone`` (J27); use region ids such as
    ``Australia/Sydney`` (abbreviations like AEST are not valid ids)."""
    return F.from_utc_timestamp(_c(ts), zone)
