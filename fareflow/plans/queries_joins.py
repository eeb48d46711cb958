"""Catalog entries: joins, holidays and as-of."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.operators import asof as A
from fareflow.operators import explore as X
from fareflow.operators import holidays as H
from fareflow.operators import joins as J
from fareflow.plans.catalog import add_cte, register
from fareflow.plans.quote_view import quote_view
from fareflow.sources.tables import load_table

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
COUNTRIES = ["africa", "america", "asia", "europe", "middle_east"]

add_cte("cal", H.DERIVED_CALENDAR_SQL)
add_cte("hol", "SELECT DISTINCT Date AS h FROM cal WHERE Country = 'asia' AND HolidayType = 'National holiday'")


def _q(spark, sf_dir):
    return quote_view(spark, sf_dir)


def _asia(spark, sf_dir):
    cal = H.derived_calendar(spark, sf_dir)
    return cal.filter((F.col("Country") == "asia") & (F.col("HolidayType") == "National holiday"))


@register("A6_F8_calendar", "SELECT * FROM cal")
def calendar_q(spark, sf_dir):
    return H.derived_calendar(spark, sf_dir)


@register("E1_left_join_holiday", f"""
SELECT {SQL_IDS}, depDate, HolidayName FROM q LEFT JOIN (
  SELECT Date, HolidayName FROM cal WHERE Country = 'asia' AND HolidayType = 'National holiday') c
ON q.depDate = c.Date""")
def e1(spark, sf_dir):
    q = _q(spark, sf_dir).select(*IDS, "depDate")
    cal = _asia(spark, sf_dir).select("Date", "HolidayName")
    return J.star_join(q, [J.Dim(cal, ["depDate"], ["Date"], bounded=True)])


def _pivot_sql(prefix):
    cols = ", ".join(f"min(CASE WHEN Country = '{c}' THEN HolidayName END) AS {prefix}{c}" for c in COUNTRIES)
    return (f"SELECT Date, {cols} FROM cal WHERE HolidayType IN "
            "('Common Local holidays', 'National holiday', 'National Holiday') GROUP BY Date")


@register("F8_L4_holiday_pivot", _pivot_sql("depHoliday_"))
def f8h(spark, sf_dir):
    return H.holiday_pivot(H.derived_calendar(spark, sf_dir), COUNTRIES)


@register("E2_L4_role_playing_holidays", f"""
WITH dep AS ({_pivot_sql('depHoliday_')}), ret AS ({_pivot_sql('retHoliday_')})
SELECT {SQL_IDS}, depDate, retDate, {', '.join('depHoliday_' + c for c in COUNTRIES)},
  {', '.join('retHoliday_' + c for c in COUNTRIES)}
FROM q LEFT JOIN dep ON q.depDate = dep.Date LEFT JOIN ret ON q.retDate = ret.Date""")
def e2(spark, sf_dir):
    q = _q(spark, sf_dir).select(*IDS, "depDate", "retDate")
    return H.with_holidays(q, H.derived_calendar(spark, sf_dir), COUNTRIES)


@register("E3_E4_star_join", """
SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate, c_name, cn.n_name AS custNation,
  s_name, sn.n_name AS suppNation, p_brand, r_name AS custRegion
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN region ON cn.n_regionkey = r_regionkey""")
def e3(spark, sf_dir):
    t = lambda n: load_table(spark, sf_dir, n)
    fact = t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    out = J.star_join(fact, [
        J.Dim(t("orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["l_orderkey"], ["o_orderkey"]),
        J.Dim(t("customer").select("c_custkey", "c_name", "c_nationkey"), ["o_custkey"], ["c_custkey"]),
        J.Dim(nation, ["c_nationkey"], ["n_nationkey"],
              {"n_name": "custNation", "n_regionkey": "custRegionKey"}, bounded=True),
        J.Dim(t("supplier").select("s_suppkey", "s_name", "s_nationkey"), ["l_suppkey"], ["s_suppkey"]),
        J.Dim(nation, ["s_nationkey"], ["n_nationkey"], {"n_name": "suppNation"}, bounded=True),
        J.Dim(t("part").select("p_partkey", "p_brand"), ["l_partkey"], ["p_partkey"]),
        J.Dim(t("region").select("r_regionkey", "r_name"), ["custRegionKey"], ["r_regionkey"],
              {"r_name": "custRegion"}, bounded=True),
    ])
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_name",
                      "custNation", "s_name", "suppNation", "p_brand", "custRegion")


@register("E6_E7_E8_asof_holidays", f"""
SELECT {SQL_IDS}, depDate,
  CASE WHEN depDate = (SELECT min(h) FROM hol) THEN depDate
       ELSE (SELECT max(h) FROM hol WHERE h < depDate) END AS last_holiday,
  (SELECT min(h) FROM hol WHERE h >= depDate) AS next_holiday,
  CAST((CASE WHEN depDate = (SELECT min(h) FROM hol) THEN depDate
        ELSE (SELECT max(h) FROM hol WHERE h < depDate) END) - depDate AS INTEGER) AS days_to_last_holiday,
  CAST((SELECT min(h) FROM hol WHERE h >= depDate) - depDate AS INTEGER) AS days_to_next_holiday
FROM q""")
def e6(spark, sf_dir):
    q = _q(spark, sf_dir).select(*IDS, "depDate")
    return A.with_previous_next(q, "depDate", _asia(spark, sf_dir), "Date", "holiday")


add_cte("moments", """
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS who, date_trunc('hour', ts) AS hour, value
FROM events WHERE event_type <> 'purchase' AND event_type <> 'error'""")
add_cte("facts", """
SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS who, date_trunc('hour', ts) AS hour, event_type,
  max(value) AS value
FROM events WHERE event_type = 'purchase' OR event_type = 'error' GROUP BY ALL""")


@register("E6_E7_asof_keyed", """
SELECT m.event_id, m.who, m.hour, a.hour AS before, a.value AS valueBefore, b.hour AS after, b.value AS valueAfter
FROM moments m
ASOF LEFT JOIN (SELECT * FROM facts WHERE event_type = 'purchase') a ON m.who = a.who AND m.hour >= a.hour
ASOF LEFT JOIN (SELECT * FROM facts WHERE event_type = 'error') b ON m.who = b.who AND m.hour < b.hour""")
def asof_keyed(spark, sf_dir):
    """Last purchase up to an event's hour and first error after it, per user;
    a third of all events has one user, and hours tie."""
    ev = load_table(spark, sf_dir, "events").withColumns({
        "who": F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")).cast("long"),
        "hour": F.date_trunc("hour", "ts").cast("timestamp_ntz")})
    rest = ev.where(~F.col("event_type").isin("purchase", "error")).select("event_id", "who", "hour")
    facts = {t: ev.where(F.col("event_type") == t).select("who", "hour", "value") for t in ("purchase", "error")}
    out = A.asof_join(rest, facts["purchase"], ["who"], "hour", "hour", {"hour": "before", "value": "valueBefore"},
                      prefer=[-F.col("value")])
    return A.asof_join(out, facts["error"], ["who"], "hour", "hour", {"hour": "after", "value": "valueAfter"},
                       "forward", exact=False, prefer=[-F.col("value")])


@register("E8_holidays_of_each_country", f"""
WITH h AS (SELECT DISTINCT Country, Date AS d FROM cal WHERE HolidayType = 'National holiday'),
c AS (SELECT {SQL_IDS}, price, depDate, lower(replace(r_name, ' ', '_')) AS Country
      FROM q JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT {SQL_IDS}, price, c.depDate, c.Country, a.d AS lastHoliday, b.d AS nextHoliday,
  CAST(a.d - c.depDate AS INTEGER) AS daysToLast, CAST(b.d - c.depDate AS INTEGER) AS daysToNext
FROM c ASOF LEFT JOIN h a ON c.Country = a.Country AND c.depDate > a.d
ASOF LEFT JOIN h b ON c.Country = b.Country AND c.depDate <= b.d""")
def holidays_of_each_country(spark, sf_dir):
    """Distance to the last and next holiday of the destination's own country,
    a calendar for each, instead of one list for all."""
    nation, region = (load_table(spark, sf_dir, t) for t in ("nation", "region"))
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))).alias("Country"))
    q = _q(spark, sf_dir).join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(*IDS, "price", "depDate", "Country")
    cal = H.derived_calendar(spark, sf_dir).where("HolidayType = 'National holiday'").select("Country", "Date")
    out = A.asof_join(q, cal, ["Country"], "depDate", "Date", {"Date": "lastHoliday"}, exact=False)
    out = A.asof_join(out, cal, ["Country"], "depDate", "Date", {"Date": "nextHoliday"}, "forward")
    return out.withColumns({"daysToLast": F.datediff("lastHoliday", "depDate"),
                            "daysToNext": F.datediff("nextHoliday", "depDate")})


@register("E10_full_outer_series", """
WITH a AS (SELECT airlineName, searchDate, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS oneWay
           FROM q WHERE trip = '1' GROUP BY 1, 2),
     b AS (SELECT airlineName, searchDate, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS return
           FROM q WHERE trip = '2' GROUP BY 1, 2)
SELECT coalesce(a.airlineName, b.airlineName) AS airlineName, coalesce(a.searchDate, b.searchDate) AS searchDate,
  oneWay, return
FROM a FULL OUTER JOIN b ON a.airlineName = b.airlineName AND a.searchDate = b.searchDate""")
def e10(spark, sf_dir):
    def series(trip, name):
        return _q(spark, sf_dir).filter(F.col("trip") == trip).groupBy("airlineName", "searchDate") \
            .agg(X.exact_avg("price").alias(name))
    return series("1", "oneWay").join(series("2", "return"), ["airlineName", "searchDate"], "full_outer")


@register("E11_dictionary_lookup", f"""
WITH mp AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT fromCity AS v FROM q WHERE s_nationkey < 20))
SELECT {SQL_IDS}, fromCity, code AS fromCity_code FROM q LEFT JOIN mp ON q.fromCity = mp.v""")
def e11(spark, sf_dir):
    from fareflow.ml.encode import alphabetical_index
    q = _q(spark, sf_dir)
    mapping = alphabetical_index(q.filter(F.col("s_nationkey") < 20), "fromCity")
    return J.lookup_codes(q.select(*IDS, "fromCity"), mapping, "fromCity")


@register("E13_L7_price_movement", """
WITH a AS (SELECT airlineName, depHour, depMinute, avg(price) AS before FROM q
           WHERE searchDate = DATE '1997-03-08' GROUP BY ALL),
     b AS (SELECT airlineName, depHour, depMinute, avg(price) AS after FROM q
           WHERE searchDate = DATE '1997-03-14' GROUP BY ALL)
SELECT airlineName, depHour, depMinute, before, after, after - before AS change
FROM a FULL OUTER JOIN b USING (airlineName, depHour, depMinute)""")
def e13(spark, sf_dir):
    return J.movement(_q(spark, sf_dir), "searchDate", "1997-03-08", "1997-03-14",
                      ["airlineName", "depHour", "depMinute"])
