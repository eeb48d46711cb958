"""Composite feature tables and reports (L1, L3, L5, L6, L9) and reuse
helpers (N1, N2)."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions import dates as D
from fareflow.functions import text as T
from fareflow.operators.asof import with_previous_next
from fareflow.operators.explore import exact_avg
from fareflow.operators.labels import week_of_month, with_drop_label
from fareflow.session import giving_up_shuffles, stage_path


#: Early itinerary key (L1): the parts that the first label looked ahead on.
EARLY_KEY = ("fromCity", "toCity", "trip", "stayDays", "depDate", "airlineName", "departureTime", "stopInfo",
             "durationText")


def itinerary_features(q: DataFrame) -> DataFrame:
    """The part of L1 that every quote of an itinerary shares: local times and
    groups, duration and stop minutes, weekday / week."""
    loc = D.offset_local("departureTime")
    out = q.withColumns({
        "depLocal": loc,
        "depTimeGroup": D.time_group(F.hour(loc)),
        "durationMinutes": T.duration_minutes("durationText"),
        "stop1Minutes": T.stop_minutes("stopInfo", 0),
        "stop2Minutes": T.stop_minutes("stopInfo", 1),
        "depWeekday": D.weekday_monday0("depDate"),
        "depWeek": D.iso_week("depDate"),
    })
    return out.withColumns({
        "arrTimeGroup": D.time_group(F.hour(F.timestamp_add("MINUTE", F.col("durationMinutes"), F.col("depLocal")))),
        "stopMinutes": F.coalesce(F.col("stop1Minutes") + F.col("stop2Minutes"), F.lit(0)),
    })


def build_price_features(q: DataFrame, holidays: DataFrame, key: Sequence[str] = EARLY_KEY,
                         threshold: float = 5.0, per_day: bool = False, derived: bool = False) -> DataFrame:
    """Early feature table (L1): local times and groups, duration and stop
    minutes, weekday / week, lead time, days to the holidays around (999 when
    none ahead) and the unbounded-horizon drop label of the same itinerary, in
    one plan (``per_day``: see ``with_future_min``).  ``derived``: ``q`` has its
    ``itinerary_features`` already, as before it is quoted again."""
    out = (q if derived else itinerary_features(q)).withColumns({
        "leadTime": D.lead_time("depDate", "searchDate"),
        "fewTicketsLeft": F.col("ticketsLeft") != 0,
    })
    out = with_previous_next(out, "depDate", holidays, "Date", "holiday")
    out = out.withColumn("days_to_next_holiday", F.coalesce("days_to_next_holiday", F.lit(999)))
    out = with_drop_label(out.filter(F.col("price") > 0), list(key), None, threshold, per_day=per_day)
    return out.withColumn("priceDrop", F.col("price") - F.col("futureMinPrice"))


def heatmap_table(q: DataFrame) -> DataFrame:
    """Calendar heat-map input (L5): mean price per departure city, trip
    type, airline, year-month, week of month (Monday weeks) and weekday label."""
    d = q.withColumns({"ym": D.year_month("depDate"), "week": D.week_of_year_monday("depDate"),
                       "weekdayLabel": F.date_format("depDate", "E")})
    d = week_of_month(d, "week", "ym")
    return d.groupBy("fromCity", "trip", "airlineName", "ym", "monthWeek", "weekdayLabel").agg(
        F.round(exact_avg("price"), 0).alias("avgPrice"), F.count(F.lit(1)).alias("n"))


def weekday_hour_table(q: DataFrame) -> DataFrame:
    """Mean price by destination, airline, weekday and departure hour."""
    loc = D.offset_local("departureTime")
    return q.groupBy("toCity", "airlineName", F.date_format("depDate", "E").alias("weekdayLabel"),
                     F.date_format(loc, "HH").alias("hour")).agg(
        F.round(exact_avg("price"), 0).alias("avgPrice"))


@contextlib.contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache only around a block that uses ``df`` more than once."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder and read it
    back (N2): cuts lineage, survives executor loss, reusable across jobs.  The
    shuffle files behind it go when it is written."""
    path = stage_path(df.sparkSession, name)
    with giving_up_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
