"""Catalog entries for scalar expressions (J1-J37) over the quote view."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.functions import dates as D
from fareflow.functions import text as T
from fareflow.plans.catalog import register
from fareflow.plans.quote_view import model_source, quote_view
from fareflow.sources.tables import load_table

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _q(spark, sf_dir):
    return quote_view(spark, sf_dir)


@register("J1_duration_minutes", f"""
SELECT {SQL_IDS}, durationText,
  TRY_CAST(NULLIF(regexp_extract(durationText, '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
  + TRY_CAST(NULLIF(regexp_extract(durationText, 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER)
  AS durationMinutes
FROM q""")
def j1(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, "durationText",
                                    T.duration_minutes("durationText").alias("durationMinutes"))


@register("J2_minutes_from_parts", f"""
SELECT {SQL_IDS}, split_part(durationText, 'h', 1) AS h, split_part(durationText, 'h', 2) AS m,
  TRY_CAST(NULLIF(split_part(durationText, 'h', 1), '') AS INTEGER) * 60
  + TRY_CAST(NULLIF(regexp_extract(split_part(durationText, 'h', 2), '^([0-9]+)m$', 1), '') AS INTEGER)
  AS minutes
FROM q""")
def j2(spark, sf_dir):
    q = _q(spark, sf_dir).select(*IDS, F.split_part("durationText", F.lit("h"), F.lit(1)).alias("h"),
                                 F.split_part("durationText", F.lit("h"), F.lit(2)).alias("m"))
    return q.withColumn("minutes", T.minutes_from_parts("h", "m"))


@register("J3_elapsed_minutes", f"""
SELECT {SQL_IDS}, departureTime,
  (epoch(strptime(departureTime, '%Y-%m-%dT%H:%M:%S.%g%z'))
   - epoch(strptime(CAST(searchDate AS VARCHAR) || 'T00:00:00.000+00:00', '%Y-%m-%dT%H:%M:%S.%g%z'))) / 60
  AS elapsedMinutes,
  (epoch(strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g'))
   - epoch(CAST(searchDate AS TIMESTAMP))) / 60 AS wallClockMinutes
FROM q""")
def j3(spark, sf_dir):
    q = _q(spark, sf_dir)
    start = F.concat(F.col("searchDate").cast("string"), F.lit("T00:00:00.000+00:00"))
    return q.select(*IDS, "departureTime",
                    D.elapsed_minutes(start, "departureTime").alias("elapsedMinutes"),
                    D.elapsed_minutes(start, "departureTime", wall_clock=True).alias("wallClockMinutes"))


@register("J4_hour_regex", f"""
SELECT {SQL_IDS}, regexp_extract(durationText, '([0-9]+)h', 1) AS hourText,
  TRY_CAST(NULLIF(regexp_extract(durationText, '^\\s*([0-9]+)h', 1), '') AS INTEGER) AS hours
FROM q""")
def j4(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, F.regexp_extract("durationText", r"([0-9]+)h", 1).alias("hourText"),
                                    T.duration_hours("durationText").alias("hours"))


@register("J5_regex_capture", f"""
SELECT {SQL_IDS}, regexp_extract(CAST(depDate AS VARCHAR), '(\\d+)-(\\d+)', 1) AS yearText,
  regexp_extract(CAST(depDate AS VARCHAR), '(\\d+)-(\\d+)', 2) AS monthText,
  regexp_extract(departureTime, '([+-][0-9]{{2}}:[0-9]{{2}})$', 1) AS offsetText
FROM q""")
def j5(spark, sf_dir):
    q = _q(spark, sf_dir)
    d = F.col("depDate").cast("string")
    return q.select(*IDS, F.regexp_extract(d, r"(\d+)-(\d+)", 1).alias("yearText"),
                    F.regexp_extract(d, r"(\d+)-(\d+)", 2).alias("monthText"),
                    D.offset_text("departureTime").alias("offsetText"))


@register("J6_stop_list", f"""
WITH s AS (
  SELECT {SQL_IDS}, list_filter(string_split(stopInfo, ';'), lambda x: x <> '') AS parts FROM q),
e AS (SELECT {SQL_IDS}, unnest(range(len(parts))) AS pos, unnest(parts) AS part FROM s)
SELECT {SQL_IDS}, CAST(pos AS INTEGER) AS pos, split_part(part, ':', 1) AS loc,
  string_split(part, ':')[-1] AS duration,
  TRY_CAST(NULLIF(regexp_extract(string_split(part, ':')[-1], '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
  + TRY_CAST(NULLIF(regexp_extract(string_split(part, ':')[-1], 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER)
  AS minutes
FROM e""")
def j6(spark, sf_dir):
    q = _q(spark, sf_dir).select(*IDS, T.stop_list("stopInfo").alias("stops"))
    return q.select(*IDS, F.posexplode("stops").alias("pos", "s")).select(
        *IDS, "pos", "s.loc", "s.duration", "s.minutes")


@register("J7_stop_durations", f"""
SELECT {SQL_IDS}, stopInfo,
  list_transform(list_filter(string_split(stopInfo, ';'), lambda x: x <> ''),
                 lambda s: replace(string_split(s, ':')[-1], 'h', 'h:')) AS stopDurations
FROM q""")
def j7(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, "stopInfo", T.stop_durations("stopInfo").alias("stopDurations"))


@register("J8_J26_offset_times", f"""
SELECT {SQL_IDS}, substr(departureTime, 1, 23) AS localText,
  strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g') AS depLocal,
  CAST(epoch(strptime(departureTime, '%Y-%m-%dT%H:%M:%S.%g%z')) AS BIGINT) AS depEpoch
FROM q""")
def j8(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, F.substring("departureTime", 1, 23).alias("localText"),
                                    D.offset_local("departureTime").alias("depLocal"),
                                    F.unix_seconds(D.offset_instant("departureTime")).alias("depEpoch"))


@register("J9_concat", f"""
SELECT {SQL_IDS}, airlineCode || '-' || CAST(stayDays AS VARCHAR) AS codeStay,
  concat_ws('-', fromCity, CAST(stayDays AS VARCHAR), toCity) AS route
FROM q""")
def j9(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, F.concat("airlineCode", F.lit("-"), "stayDays").alias("codeStay"),
                                    F.concat_ws("-", "fromCity", "stayDays", "toCity").alias("route"))


@register("J10_J11_trim_bool", f"""
SELECT {SQL_IDS}, trim('  ' || cabin || ' ') AS cabinTrim,
  coalesce(lower(CASE l_linenumber % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' ELSE 'True' END) = 'true', false)
  AS flag
FROM q""")
def j10(spark, sf_dir):
    q = _q(spark, sf_dir)
    txt = F.when(F.col("l_linenumber") % 3 == 0, "TRUE").when(F.col("l_linenumber") % 3 == 1, "false") \
        .otherwise("True")
    return q.select(*IDS, F.trim(F.concat(F.lit("  "), "cabin", F.lit(" "))).alias("cabinTrim"),
                    T.to_bool(txt).alias("flag"))


@register("J12_currency_text", f"""
SELECT {SQL_IDS}, price,
  TRY_CAST(regexp_replace('AU$' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR), '[$,£€A-Za-z ]', '', 'g')
           AS DOUBLE) AS parsed
FROM q""")
def j12(spark, sf_dir):
    q = _q(spark, sf_dir)
    txt = F.concat(F.lit("AU$"), F.col("price").cast("decimal(18,2)").cast("string"))
    return q.select(*IDS, "price", T.currency_to_number(txt).alias("parsed"))


@register("J13_empty_to_unknown", f"""
SELECT {SQL_IDS}, CASE WHEN stopInfo = '' THEN 'unknown' ELSE stopInfo END AS stopInfo FROM q""")
def j13(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, "stopInfo").na.replace("", "unknown", subset=["stopInfo"])


@register("J14_J21_text_to_date", f"""
SELECT {SQL_IDS},
  TRY_CAST(CAST(depDate AS VARCHAR) || CASE WHEN l_linenumber = 4 THEN 'x' ELSE '' END AS DATE) AS parsed,
  CAST(strptime(strftime(depDate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsedDmy
FROM q""")
def j14(spark, sf_dir):
    q = _q(spark, sf_dir)
    txt = F.concat(F.col("depDate").cast("string"), F.when(F.col("l_linenumber") == 4, "x").otherwise(""))
    return q.select(*IDS, D.to_date_safe(txt).alias("parsed"),
                    D.to_date_safe(F.date_format("depDate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsedDmy"))


@register("J15_J16_return_lead", f"""
SELECT {SQL_IDS}, CAST(depDate + stayDays AS DATE) AS retDate,
  CAST(depDate - searchDate AS INTEGER) AS leadTime FROM q""")
def j15(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, D.return_date("depDate", "stayDays").alias("retDate"),
                                    D.lead_time("depDate", "searchDate").alias("leadTime"))


@register("J17_calendar_parts", f"""
SELECT {SQL_IDS}, CAST(year(depDate) AS INTEGER) AS y, CAST(month(depDate) AS INTEGER) AS mo,
  CAST(day(depDate) AS INTEGER) AS d, CAST(dayofyear(depDate) AS INTEGER) AS doy,
  CAST(week(depDate) AS INTEGER) AS isoWeek,
  CAST(hour(strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g')) AS INTEGER) AS hh,
  CAST(minute(strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g')) AS INTEGER) AS mi
FROM q""")
def j17(spark, sf_dir):
    q = _q(spark, sf_dir)
    loc = D.offset_local("departureTime")
    return q.select(*IDS, F.year("depDate").alias("y"), F.month("depDate").alias("mo"),
                    F.dayofmonth("depDate").alias("d"), F.dayofyear("depDate").alias("doy"),
                    D.iso_week("depDate").alias("isoWeek"), F.hour(loc).alias("hh"),
                    F.minute(loc).alias("mi"))


@register("J18_J19_weekday", f"""
SELECT {SQL_IDS}, dayname(depDate) AS dayName, CAST(isodow(depDate) - 1 AS INTEGER) AS weekdayMon0,
  CAST(week(searchDate) AS INTEGER) AS searchWeek FROM q""")
def j18(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, D.weekday_name("depDate").alias("dayName"),
                                    D.weekday_monday0("depDate").alias("weekdayMon0"),
                                    D.iso_week("searchDate").alias("searchWeek"))


@register("J20_J23_month_labels", f"""
SELECT {SQL_IDS}, strftime(searchDate, '%Y%m') AS searchMonth, strftime(depDate, '%Y-%m') AS ym,
  strftime(depDate, '%b') AS monthAbbr, strftime(depDate, '%a') AS dayAbbr FROM q""")
def j20(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, D.month_key("searchDate").alias("searchMonth"),
                                    D.year_month("depDate").alias("ym"),
                                    F.date_format("depDate", "MMM").alias("monthAbbr"),
                                    F.date_format("depDate", "E").alias("dayAbbr"))


@register("J22_week_numbers", f"""
SELECT {SQL_IDS}, CAST(strftime(depDate, '%W') AS INTEGER) AS weekMonday,
  CAST((dayofyear(depDate) - 1) // 7 + 1 AS INTEGER) AS weekSimple FROM q""")
def j22(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, D.week_of_year_monday("depDate").alias("weekMonday"),
                                    D.week_of_year_simple("depDate").alias("weekSimple"))


@register("J24_J25_time_of_day", f"""
WITH t AS (SELECT {SQL_IDS}, strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g') AS loc FROM q)
SELECT {SQL_IDS}, strftime(loc, '%H:%M') AS hhmm, strftime(loc, '%H') AS hh,
  CASE WHEN hour(loc) < 5 THEN 'early morning' WHEN hour(loc) < 12 THEN 'morning'
       WHEN hour(loc) < 18 THEN 'afternoon' ELSE 'evening' END AS timeGroup
FROM t""")
def j24(spark, sf_dir):
    q = _q(spark, sf_dir).select(*IDS, D.offset_local("departureTime").alias("loc"))
    return q.select(*IDS, F.date_format("loc", "HH:mm").alias("hhmm"), F.date_format("loc", "HH").alias("hh"),
                    D.time_group(F.hour("loc")).alias("timeGroup"))


@register("J27_utc_to_zone", f"""
SELECT {SQL_IDS},
  (strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g') AT TIME ZONE 'UTC')
    AT TIME ZONE 'Australia/Sydney' AS sydney
FROM q""")
def j27(spark, sf_dir):
    q = _q(spark, sf_dir)
    return q.select(*IDS, D.shift_from_utc(D.offset_local("departureTime").cast("timestamp"),
                                           "Australia/Sydney").cast("timestamp_ntz").alias("sydney"))


@register("J29_epoch", f"""
SELECT {SQL_IDS}, CAST(depDate - DATE '1970-01-01' AS INTEGER) AS depDay,
  CAST(epoch(CAST(searchDate AS TIMESTAMP)) AS BIGINT) AS searchEpoch,
  make_timestamp(CAST(epoch(CAST(searchDate AS TIMESTAMP)) AS BIGINT) * 1000000) AS searchTs
FROM q""")
def j29(spark, sf_dir):
    q = _q(spark, sf_dir)
    secs = F.unix_timestamp(F.col("searchDate").cast("timestamp"))
    return q.select(*IDS, D.day_number("depDate").alias("depDay"), secs.alias("searchEpoch"),
                    F.timestamp_millis(secs * 1000).cast("timestamp_ntz").alias("searchTs"))


@register("J30_J31_J32_sentinels", f"""
WITH t AS (
  SELECT {SQL_IDS}, trip, CAST(CASE WHEN l_linenumber = 3 THEN 'x' ELSE CAST(l_partkey % 30 AS VARCHAR) END AS VARCHAR) AS stayText,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN -1 ELSE ticketsLeft END AS tl
  FROM q)
SELECT {SQL_IDS}, CASE WHEN trip = '1' THEN NULL ELSE TRY_CAST(stayText AS INTEGER) END AS stayDays,
  CASE WHEN tl = 0 THEN 99 ELSE tl END AS ticketsModule,
  CASE WHEN tl > 0 THEN tl ELSE 99 END AS ticketsModel,
  CASE WHEN CAST(tl AS VARCHAR) = '0' THEN 'plenty' ELSE CAST(tl AS VARCHAR) END AS ticketsGroup,
  CAST(tl <> 0 AS BOOLEAN) AS fewTickets
FROM t""")
def j30(spark, sf_dir):
    q = _q(spark, sf_dir)
    ln = F.col("l_linenumber")
    stay_text = F.when(ln == 3, F.lit("x")).otherwise((F.col("l_partkey") % 30).cast("string"))
    tl = F.when(ln == 7, F.lit(None)).when(ln == 6, F.lit(-1)).otherwise(F.col("ticketsLeft"))
    q = q.select(*IDS, "trip", stay_text.alias("stayText"), tl.alias("tl"))
    return q.select(*IDS, T.stay_days("trip", "stayText").alias("stayDays"),
                    T.tickets_left_module("tl").alias("ticketsModule"),
                    T.tickets_left_model("tl").alias("ticketsModel"),
                    T.tickets_group("tl").alias("ticketsGroup"),
                    (F.col("tl") != 0).alias("fewTickets"))


@register("J33_J36_arith_clamp", f"""
SELECT {SQL_IDS}, greatest(price - 50000.0, 0.0) AS over50k, round(price, 0) AS priceRounded,
  CAST(price > 50000 AS INTEGER) AS expensive,
  least(greatest(CAST(depDate - searchDate AS INTEGER), 0), 366) AS leadClamped,
  CASE WHEN CAST(depDate - searchDate AS INTEGER) < 0 THEN 0 ELSE 1 END AS leadNonNegative
FROM q""")
def j33(spark, sf_dir):
    q = _q(spark, sf_dir)
    lead = D.lead_time("depDate", "searchDate")
    return q.select(*IDS, F.greatest(F.col("price") - 50000.0, F.lit(0.0)).alias("over50k"),
                    F.round("price", 0).alias("priceRounded"),
                    (F.col("price") > 50000).cast("int").alias("expensive"),
                    T.clamp(lead, 0, 366).alias("leadClamped"),
                    F.when(lead < 0, 0).otherwise(1).alias("leadNonNegative"))


@register("J34_J35_null_fill_drop", f"""
SELECT {SQL_IDS}, coalesce(stayDays, 0) AS stayDays, coalesce(leg2_carrierSummary_airlineName, 'none')
  AS leg2_carrierSummary_airlineName, leg2_stops
FROM m WHERE leg2_stops IS NOT NULL OR l_linenumber % 2 = 0""")
def j34(spark, sf_dir):
    m = model_source(quote_view(spark, sf_dir)).select(
        *IDS, "stayDays", "leg2_carrierSummary_airlineName", "leg2_stops")
    kept = m.filter(F.col("l_linenumber") % 2 == 0).unionByName(
        m.filter(F.col("l_linenumber") % 2 != 0).na.drop(subset=["leg2_stops"]))
    return kept.na.fill({"stayDays": 0, "leg2_carrierSummary_airlineName": "none"})


@register("J37_json_fields", """
SELECT event_id, json_extract_string(props, '$.k') AS kText,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""")
def j37(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events").select("event_id", "props")
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("kText"),
                     F.from_json("props", "k int").getField("k").alias("k"))
