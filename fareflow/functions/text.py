"""Text parsing expressions on quote fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int_or_null(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("int")


def duration_hours(text: ColumnOrName) -> Column:
    """Hour part of ``11h25m`` (J4); NULL when there is no ``h`` part."""
    return _int_or_null(F.regexp_extract(_c(text), r"^\s*([0-9]+)h", 1))


def duration_minute_part(text: ColumnOrName) -> Column:
    return _int_or_null(F.regexp_extract(_c(text), r"h\s*([0-9]+)m\s*$", 1))


def duration_minutes(text: ColumnOrName) -> Column:
    """``11h25m`` -> 685 (J1/J28).  Both parts are required: ``25m`` or
    ``11h`` give NULL, as splitting on ``h`` and ``m`` does."""
    return duration_hours(text) * 60 + duration_minute_part(text)


def minutes_from_parts(hours: ColumnOrName, minutes_text: ColumnOrName) -> Column:
    """NULL-safe ``h*60 + int(m[:-1])`` on pre-split parts."""
    m = _c(minutes_text)
    return _int_or_null(_c(hours).cast("string")) * 60 + _int_or_null(
        F.regexp_extract(m, r"^([0-9]+)m$", 1))


def stop_list(text: ColumnOrName) -> Column:
    """``SIN:2h10m;KUL:1h5m`` -> array<struct<loc, duration, minutes>> for any
    number of stops (J6); empty text gives an empty array, NULL stays NULL."""
    parts = F.filter(F.split(_c(text), ";"), lambda s: s != "")
    return F.transform(parts, lambda s: F.struct(
        F.substring_index(s, ":", 1).alias("loc"),
        F.element_at(F.split(s, ":"), -1).alias("duration"),
        duration_minutes(F.element_at(F.split(s, ":"), -1)).alias("minutes")))


def stop_minutes(text: ColumnOrName, i: int) -> Column:
    """Minutes of stop ``i`` (from 0) of a stop list, as ``stop_list`` gives
    them; compiled, where its lambdas are interpreted."""
    stop = F.get(F.array_remove(F.split(_c(text), ";"), ""), i)
    return duration_minutes(F.substring_index(stop, ":", -1))


def stop_durations(text: ColumnOrName) -> Column:
    """Per-stop duration text with ``h`` widened to ``h:`` (J7): ``2h:10m``."""
    parts = F.filter(F.split(_c(text), ";"), lambda s: s != "")
    return F.transform(parts, lambda s: F.replace(
        F.element_at(F.split(s, ":"), -1), F.lit("h"), F.lit("h:")))


def to_bool(text: ColumnOrName) -> Column:
    """Case-insensitive ``'true'`` -> True, anything else False."""
    return F.coalesce(F.lower(_c(text)) == "true", F.lit(False))


def currency_to_number(text: ColumnOrName) -> Column:
    """Strip currency signs and separators, then parse."""
    return F.regexp_replace(_c(text), r"[$,£€A-Za-z ]", "").try_cast("double")


def stay_days(trip: ColumnOrName, stay: ColumnOrName) -> Column:
    """One-way (``trip = '1'``) quotes have no stay."""
    return F.when(_c(trip) == "1", F.lit(None).cast("int")).otherwise(
        _c(stay).cast("string").try_cast("int"))


def tickets_left_module(c: ColumnOrName) -> Column:
    """ETL rule (J31): exactly 0 -> 99 (plenty); NULL and negatives kept."""
    c = _c(c)
    return F.when(c == 0, F.lit(99)).otherwise(c)


def tickets_left_model(c: ColumnOrName, sentinel: int = 99) -> Column:
    """Modelling rule (J31): anything not > 0, NULL included -> sentinel."""
    c = _c(c)
    return F.when(c > 0, c).otherwise(F.lit(sentinel))


def tickets_group(c: ColumnOrName) -> Column:
    """Text group (J32): ``'0'`` -> ``'plenty'``, other values unchanged."""
    c = _c(c).cast("string")
    return F.when(c == "0", F.lit("plenty")).otherwise(c)


def clamp(c: ColumnOrName, lo, hi) -> Column:
    """Clamp into [lo, hi]."""
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def text_not_null(c: ColumnOrName) -> Column:
    """Predicate for text-encoded NULLs (D8): drops ``'null'`` and NULL."""
    return F.nullif(_c(c), F.lit("null")).isNotNull()
