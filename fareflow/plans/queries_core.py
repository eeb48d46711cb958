"""Catalog entries: quote view, labels, model table (G, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.operators import labels as L
from fareflow.plans.catalog import register
from fareflow.plans.model_table import ROUTE_KEY_PARTS, build_model_table
from fareflow.plans.quote_view import model_source, quote_view
from fareflow.plans.reports import materialize

SQL_KEY = """concat_ws('-', fromCity, toCity, CAST(stayDays AS VARCHAR), CAST(depDate AS VARCHAR),
    timeline1_departureTime_time, timeline2_departureTime_time,
    timeline1_carrier_airlineCode, timeline2_carrier_airlineCode)"""

SQL_MODEL_TABLE = """
WITH lab AS (
  SELECT *,
    min(price) OVER (PARTITION BY routeCombKey ORDER BY (searchDate - DATE '1970-01-01')
                     RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) AS futureMinPrice,
    CAST(strptime(leg2_departureTime_date, '%d/%m/%Y') AS DATE) AS ret
  FROM (SELECT *, {key} AS routeCombKey FROM m WHERE price > 0))
SELECT price, CAST(price - futureMinPrice > 20 AS INTEGER) AS priceWillDrop, futureMinPrice,
  greatest(price - futureMinPrice, 0.0) AS saving, fromCity, toCity, searchDate, routeCombKey,
  CAST(depDate - searchDate AS INTEGER) AS leadTime, leg1_stops, leg2_stops,
  CASE WHEN leg1_carrierSummary_noOfTicketsLeft > 0 THEN leg1_carrierSummary_noOfTicketsLeft ELSE 99 END
    AS leg1_noOfTicketsLeft,
  CASE WHEN leg2_carrierSummary_noOfTicketsLeft > 0 THEN leg2_carrierSummary_noOfTicketsLeft ELSE 99 END
    AS leg2_noOfTicketsLeft,
  leg1_carrierSummary_airlineName, leg2_carrierSummary_airlineName,
  leg1_departureTime_hour, leg2_departureTime_hour,
  CAST(week(depDate) AS INTEGER) AS depWeekOfYear, dayname(depDate) AS depDayOfWeek,
  CAST(week(ret) AS INTEGER) AS retWeekOfYear, dayname(ret) AS retDayOfWeek,
  dayname(searchDate) AS searchDayOfWeek,
  timeline1_carrier_cabinClass[1] AS leg1_cabinClass_0,
  timeline1_carrier_cabinClass[2] AS leg1_cabinClass_1,
  timeline1_carrier_cabinClass[3] AS leg1_cabinClass_2,
  timeline2_carrier_cabinClass[1] AS leg2_cabinClass_0,
  timeline2_carrier_cabinClass[2] AS leg2_cabinClass_1,
  timeline2_carrier_cabinClass[3] AS leg2_cabinClass_2,
  trip
FROM lab
""".replace("{key}", SQL_KEY)


def model_table_q(spark, sf_dir):
    return build_model_table(model_source(quote_view(spark, sf_dir)))


register("L2_model_table", SQL_MODEL_TABLE)(model_table_q)


@register("L2_model_table_city_pair",
          SQL_MODEL_TABLE.replace("PARTITION BY routeCombKey", "PARTITION BY fromCity, toCity"))
def l2_city_pair(spark, sf_dir):
    return build_model_table(model_source(quote_view(spark, sf_dir)), ("fromCity", "toCity"), per_day=True)


@register("G3_future_min_itinerary", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, quoteNo, searchDate, price,
  min(price) OVER (PARTITION BY {SQL_KEY} ORDER BY (searchDate - DATE '1970-01-01')
                   RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) AS futureMinPrice
FROM m""")
def g3_itinerary(spark, sf_dir):
    m = model_source(quote_view(spark, sf_dir)).withColumn("routeCombKey", L.route_key(*ROUTE_KEY_PARTS))
    m = m.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quoteNo", "searchDate", "price",
                 "routeCombKey")
    return L.with_future_min(m, ["routeCombKey"], per_day=False).drop("routeCombKey")


@register("Q_quote_view", "SELECT * FROM q")
def q_view(spark, sf_dir):
    return quote_view(spark, sf_dir)


@register("G3_future_min_19d", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fromCity, toCity, searchDate, price,
  min(price) OVER (PARTITION BY fromCity, toCity ORDER BY (searchDate - DATE '1970-01-01')
                   RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) AS futureMinPrice
FROM q""")
def g3(spark, sf_dir):
    q = quote_view(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "fromCity", "toCity", "searchDate", "price")
    return L.with_future_min(q, ["fromCity", "toCity"], "searchDate", "price", 19)


@register("G2_future_min_unbounded", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, toCity, airlineName, searchDate, price,
  min(price) OVER (PARTITION BY toCity, airlineName ORDER BY searchDate
                   RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS futureMinPrice
FROM q""")
def g2(spark, sf_dir):
    q = quote_view(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "toCity", "airlineName", "searchDate", "price")
    return L.with_future_min(q, ["toCity", "airlineName"], "searchDate", "price", None)


@register("G5_G6_label_7d_threshold5", """
WITH f AS (
  SELECT fromCity, toCity, cabin, searchDate, price,
    min(price) OVER (PARTITION BY fromCity, toCity, cabin ORDER BY (searchDate - DATE '1970-01-01')
                     RANGE BETWEEN CURRENT ROW AND 7 FOLLOWING) AS fm
  FROM q WHERE price > 0)
SELECT fromCity, toCity, cabin, searchDate,
  count(*) AS n, CAST(sum(CAST(price - fm > 5 AS INTEGER)) AS BIGINT) AS drops,
  CAST(sum(CAST(greatest(price - fm, 0.0) AS DECIMAL(18,2))) AS DOUBLE) AS totalSaving
FROM f GROUP BY fromCity, toCity, cabin, searchDate""")
def g5g6(spark, sf_dir):
    q = quote_view(spark, sf_dir).filter(F.col("price") > 0)
    lab = L.with_drop_label(q, ["fromCity", "toCity", "cabin"], 7, 5.0)
    return (lab.groupBy("fromCity", "toCity", "cabin", "searchDate")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("priceWillDrop").cast("long").alias("drops"),
                 F.sum(F.col("saving").cast("decimal(18,2)")).cast("double").alias("totalSaving")))


@register("G1_route_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  concat_ws('-', fromCity, toCity, CAST(stayDays AS VARCHAR), CAST(depDate AS VARCHAR),
    timeline1_departureTime_time, timeline2_departureTime_time,
    timeline1_carrier_airlineCode, timeline2_carrier_airlineCode) AS routeCombKey,
  concat_ws('-', fromCity, toCity, coalesce(CAST(stayDays AS VARCHAR), '~'),
    coalesce(timeline2_carrier_airlineCode, '~')) AS safeKey
FROM m""")
def g1(spark, sf_dir):
    m = model_source(quote_view(spark, sf_dir))
    return m.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    L.route_key(*ROUTE_KEY_PARTS).alias("routeCombKey"),
                    L.route_key("fromCity", "toCity", "stayDays", "timeline2_carrier_airlineCode",
                                null_token="~").alias("safeKey"))


@register("E5_group_min_join_back", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fromCity, airlineName, price,
  min(price) OVER (PARTITION BY fromCity, airlineName) AS minPrice,
  price - min(price) OVER (PARTITION BY fromCity, airlineName) AS diffToMin
FROM q""")
def e5(spark, sf_dir):
    q = quote_view(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "fromCity", "airlineName", "price")
    return L.with_group_min(q, ["fromCity", "airlineName"], "price")


def _g4(spark, sf_dir, rows):
    q = quote_view(spark, sf_dir).filter(F.col("price") > 0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "fromCity", "toCity", "searchDate", "price")
    q = materialize(q, "future-min-quotes")  # bounds and ranges read it
    order = ["searchDate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return L.with_future_min_rows(q, ["fromCity", "toCity"], order, "price", rows)


_G4_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fromCity, toCity, searchDate, price,
  min(price) OVER (PARTITION BY fromCity, toCity ORDER BY searchDate, l_orderkey, l_linenumber, l_partkey,
                   l_suppkey ROWS BETWEEN CURRENT ROW AND {n} FOLLOWING) AS futureMinPrice
FROM q WHERE price > 0"""


@register("G4_rows_frame_19x86400", _G4_SQL.format(n=19 * 86400))
def g4_wide(spark, sf_dir):
    return _g4(spark, sf_dir, 19 * 86400)


@register("G4_rows_frame_5", _G4_SQL.format(n=5))
def g4_narrow(spark, sf_dir):
    return _g4(spark, sf_dir, 5)
