"""Modelling table (L2/L3): label + calendar + leg features per quote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions import dates as D
from fareflow.functions import text as T
from fareflow.operators.labels import route_key, with_drop_label

ROUTE_KEY_PARTS = ("fromCity", "toCity", "stayDays", "depDate",
                   "timeline1_departureTime_time", "timeline2_departureTime_time",
                   "timeline1_carrier_airlineCode", "timeline2_carrier_airlineCode")

MODEL_COLUMNS = [
    "price", "priceWillDrop", "futureMinPrice", "saving", "fromCity", "toCity",
    "searchDate", "routeCombKey", "leadTime", "leg1_stops", "leg2_stops",
    "leg1_noOfTicketsLeft", "leg2_noOfTicketsLeft",
    "leg1_carrierSummary_airlineName", "leg2_carrierSummary_airlineName",
    "leg1_departureTime_hour", "leg2_departureTime_hour",
    "depWeekOfYear", "depDayOfWeek", "retWeekOfYear", "retDayOfWeek", "searchDayOfWeek",
    "leg1_cabinClass_0", "leg1_cabinClass_1", "leg1_cabinClass_2",
    "leg2_cabinClass_0", "leg2_cabinClass_1", "leg2_cabinClass_2", "trip",
]


def build_model_table(src: DataFrame, key: Sequence[str] = ("routeCombKey",),
                      lookahead_days: int | None = 19, threshold: float = 20.0,
                      cutoff: str | None = None, with_dates: bool = False, per_day: bool = False) -> DataFrame:
    """The label looks ahead on the same itinerary (``routeCombKey``); for a
    coarse ``key`` such as the city pair set ``per_day``.  29 columns (L2); ``with_dates=True`` adds ``depDate``/``retDate`` (L3,
    31 columns).  ``cutoff`` keeps searches up to that date but is applied
    after the label, so labels still see later quotes."""
    df = src.filter(F.col("price") > 0).withColumn("routeCombKey", route_key(*ROUTE_KEY_PARTS))
    df = with_drop_label(df, key, lookahead_days, threshold, per_day=per_day)
    ret = D.to_date_safe("leg2_departureTime_date", "dd/MM/yyyy")
    feats = {
        "leadTime": D.lead_time("depDate", "searchDate"),
        "depWeekOfYear": D.iso_week("depDate"),
        "depDayOfWeek": D.weekday_name("depDate"),
        "retWeekOfYear": D.iso_week(ret),
        "retDayOfWeek": D.weekday_name(ret),
        "searchDayOfWeek": D.weekday_name("searchDate"),
        "leg1_noOfTicketsLeft": T.tickets_left_model("leg1_carrierSummary_noOfTicketsLeft"),
        "leg2_noOfTicketsLeft": T.tickets_left_model("leg2_carrierSummary_noOfTicketsLeft"),
        "retDate": ret,
    }
    for leg in (1, 2):
        for i in range(3):
            feats[f"leg{leg}_cabinClass_{i}"] = F.get(F.col(f"timeline{leg}_carrier_cabinClass"), i)
    out = df.withColumns(feats)
    cols = list(MODEL_COLUMNS)
    if with_dates:
        cols[7:7] = ["depDate", "retDate"]
    out = out.select(*cols)
    if cutoff is not None:
        out = out.filter(F.col("searchDate") <= F.lit(cutoff).cast("date"))
    return out
