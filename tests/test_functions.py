"""Unit fixtures for scalar expressions, nested plucks and labels."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareflow.functions import dates as D
from fareflow.functions import nested as N
from fareflow.functions import text as T


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_duration_minutes_edge_cases(spark):
    rows = [("11h25m",), ("25m",), ("11h",), ("0h5m",), (None,), ("",), (" 2h 3m ",), ("abc",)]
    assert _one(spark, T.duration_minutes("s"), rows, "s string") == [685, None, None, 5, None, None, 123, None]


def test_minutes_from_parts(spark):
    rows = [("11", "25m"), (None, "25m"), ("2", None), ("x", "5m")]
    assert _one(spark, T.minutes_from_parts("h", "m"), rows, "h string, m string") == [685, None, None, None]


def test_stop_list_any_number_of_stops(spark):
    rows = [("SIN:2h10m;KUL:1h5m;BKK:0h45m",), ("",), (None,)]
    out = _one(spark, T.stop_list("s"), rows, "s string")
    assert [(s.loc, s.minutes) for s in out[0]] == [("SIN", 130), ("KUL", 65), ("BKK", 45)]
    assert out[1] == [] and out[2] is None
    assert _one(spark, T.stop_durations("s"), rows[:1], "s string")[0] == ["2h:10m", "1h:5m", "0h:45m"]


def test_ticket_rules_differ_on_null_and_negative(spark):
    rows = [(0,), (None,), (-1,), (5,)]
    assert _one(spark, T.tickets_left_module("t"), rows, "t int") == [99, None, -1, 5]
    assert _one(spark, T.tickets_left_model("t"), rows, "t int") == [99, 99, 99, 5]
    assert _one(spark, T.tickets_group("t"), rows, "t int") == ["plenty", None, "-1", "5"]


def test_stay_days_one_way_is_null(spark):
    rows = [("1", "7"), ("2", "7"), ("2", "x")]
    assert _one(spark, T.stay_days("trip", "s"), rows, "trip string, s string") == [None, 7, None]


def test_to_bool_and_text_null(spark):
    rows = [("TRUE",), ("false",), (None,), ("yes",)]
    assert _one(spark, T.to_bool("s"), rows, "s string") == [True, False, False, False]
    assert _one(spark, T.text_not_null("s"), [("null",), (None,), ("3",)], "s string") == [False, False, True]


def test_pluck_null_contract(spark):
    schema = "a array<struct<x:struct<y:string>>>"
    rows = [([{"x": {"y": "p"}}, None, {"x": None}],), (None,), ([],)]
    assert _one(spark, N.pluck("a", "x", "y"), rows, schema) == [["p", None, None], None, []]
    assert _one(spark, N.item("a", 5), rows, schema) == [None, None, None]


def test_time_group_and_offsets(spark):
    assert _one(spark, D.time_group("h"), [(0,), (5,), (12,), (18,), (None,)], "h int") == \
        ["early morning", "morning", "afternoon", "evening", None]
    rows = [("2017-04-09T07:15:00.000+08:00", "2017-04-09T09:15:00.000+10:00")]
    sch = "a string, b string"
    assert _one(spark, D.elapsed_minutes("a", "b"), rows, sch) == [0.0]
    assert _one(spark, D.elapsed_minutes("a", "b", wall_clock=True), rows, sch) == [120.0]
    assert _one(spark, D.offset_local("a"), rows, sch) == [dt.datetime(2017, 4, 9, 7, 15)]


@settings(max_examples=40, deadline=None)
@given(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)))
def test_week_numbers_match_python(spark, d):
    got = spark.createDataFrame([(d,)], "d date").select(
        D.week_of_year_monday("d"), D.iso_week("d"), D.weekday_monday0("d"), D.month_key("d")).first()
    assert tuple(got) == (int(d.strftime("%W")), d.isocalendar()[1], d.weekday(), d.strftime("%Y%m"))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 99), st.integers(0, 59), st.booleans(), st.booleans())
def test_duration_matches_split_semantics(spark, h, m, with_h, with_m):
    text = (f"{h}h" if with_h else "") + (f"{m}m" if with_m else "")
    expected = h * 60 + m if (with_h and with_m) else None
    assert _one(spark, T.duration_minutes("s"), [(text,)], "s string") == [expected]
