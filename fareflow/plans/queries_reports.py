"""Catalog entries: composite feature tables and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.operators.holidays import derived_calendar
from fareflow.plans import reports as RP
from fareflow.plans.catalog import register
from fareflow.plans.model_table import build_model_table
from fareflow.plans.queries_core import SQL_MODEL_TABLE
from fareflow.plans.queries_nested import TRUNCATED, mixed_lines
from fareflow.plans.quote_view import model_source, quote_view, requoted
from fareflow.plans.reports import materialize
from fareflow.session import stage_path
from fareflow.sources.archives import dealt_archives, write_archives, write_bytes
from fareflow.streaming.load import load_archives, load_lines, loaded_quarantine, loaded_rows

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

SQL_L3 = (SQL_MODEL_TABLE.replace("19 FOLLOWING", "7 FOLLOWING")
          .replace("fromCity, toCity, searchDate, routeCombKey,",
                   "fromCity, toCity, searchDate, depDate, ret AS retDate, routeCombKey,"))


@register("L3_model_table_7d_with_dates", SQL_L3)
def l3(spark, sf_dir):
    return build_model_table(model_source(quote_view(spark, sf_dir)), lookahead_days=7, with_dates=True)


@register("L2_cutoff_after_label", SQL_MODEL_TABLE.rstrip() + "\nWHERE searchDate <= DATE '1998-06-23'")
def l2_cutoff(spark, sf_dir):
    return build_model_table(model_source(quote_view(spark, sf_dir)), cutoff="1998-06-23")


@register("L1_price_features", f"""
WITH f AS (
  SELECT rq.*,
    strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g') AS depLocal,
    list_filter(string_split(stopInfo, ';'), lambda x: x <> '') AS parts
  FROM rq WHERE price > 0),
g AS (SELECT *,
    TRY_CAST(NULLIF(regexp_extract(durationText, '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
      + TRY_CAST(NULLIF(regexp_extract(durationText, 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER) AS minutes,
  TRY_CAST(NULLIF(regexp_extract(string_split(parts[1], ':')[-1], '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
    + TRY_CAST(NULLIF(regexp_extract(string_split(parts[1], ':')[-1], 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER)
    AS stop1Minutes,
  TRY_CAST(NULLIF(regexp_extract(string_split(parts[2], ':')[-1], '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
    + TRY_CAST(NULLIF(regexp_extract(string_split(parts[2], ':')[-1], 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER)
    AS stop2Minutes
  FROM f)
SELECT {SQL_IDS}, quoteNo, price, fromCity, toCity, trip, stayDays, airlineName, stops, depLocal,
  ticketsLeft <> 0 AS fewTicketsLeft,
  CASE WHEN hour(depLocal + to_minutes(minutes)) < 5 THEN 'early morning'
       WHEN hour(depLocal + to_minutes(minutes)) < 12 THEN 'morning'
       WHEN hour(depLocal + to_minutes(minutes)) < 18 THEN 'afternoon'
       WHEN minutes IS NOT NULL THEN 'evening' END AS arrTimeGroup,
  coalesce(stop1Minutes + stop2Minutes, 0) AS stopMinutes,
  CAST((CASE WHEN depDate = (SELECT min(h) FROM hol) THEN depDate
        ELSE (SELECT max(h) FROM hol WHERE h < depDate) END) - depDate AS INTEGER) AS days_to_last_holiday,
  price - min(price) OVER itinerary AS priceDrop,
  CASE WHEN hour(depLocal) < 5 THEN 'early morning' WHEN hour(depLocal) < 12 THEN 'morning'
       WHEN hour(depLocal) < 18 THEN 'afternoon' ELSE 'evening' END AS depTimeGroup,
  TRY_CAST(NULLIF(regexp_extract(durationText, '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
    + TRY_CAST(NULLIF(regexp_extract(durationText, 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER) AS durationMinutes,
  stop1Minutes, stop2Minutes,
  CAST(isodow(depDate) - 1 AS INTEGER) AS depWeekday, CAST(week(depDate) AS INTEGER) AS depWeek,
  CAST(depDate - searchDate AS INTEGER) AS leadTime,
  coalesce(CAST((SELECT min(h) FROM hol WHERE h >= depDate) - depDate AS INTEGER), 999) AS days_to_next_holiday,
  CAST(price - min(price) OVER itinerary > 5 AS INTEGER) AS priceWillDrop
FROM g WINDOW itinerary AS (PARTITION BY {", ".join(RP.EARLY_KEY)} ORDER BY searchDate
                            RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def l1(spark, sf_dir):
    cal = derived_calendar(spark, sf_dir)
    hol = cal.filter((F.col("Country") == "asia") & (F.col("HolidayType") == "National holiday"))
    quotes = requoted(RP.itinerary_features(quote_view(spark, sf_dir)))
    out = RP.build_price_features(quotes, hol, derived=True)
    return out.select(*IDS, "quoteNo", "price", "fromCity", "toCity", "trip", "stayDays", "airlineName", "stops",
                      "depLocal", "fewTicketsLeft", "arrTimeGroup", "stopMinutes", "days_to_last_holiday", "priceDrop",
                      "depTimeGroup", "durationMinutes", "stop1Minutes", "stop2Minutes",
                      "depWeekday", "depWeek", "leadTime", "days_to_next_holiday", "priceWillDrop")


@register("L5_G7_J22_J23_heatmap", """
WITH d AS (SELECT fromCity, trip, airlineName, price, strftime(depDate, '%Y-%m') AS ym,
                  CAST(strftime(depDate, '%W') AS INTEGER) AS week, strftime(depDate, '%a') AS weekdayLabel
           FROM q),
w AS (SELECT *, 1 + week - min(week) OVER (PARTITION BY ym) AS monthWeek FROM d)
SELECT fromCity, trip, airlineName, ym, CAST(monthWeek AS INTEGER) AS monthWeek, weekdayLabel,
  round(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price), 0) AS avgPrice, count(*) AS n
FROM w GROUP BY 1, 2, 3, 4, 5, 6""")
def l5(spark, sf_dir):
    return RP.heatmap_table(quote_view(spark, sf_dir))


@register("L6_weekday_hour", """
SELECT toCity, airlineName, strftime(depDate, '%a') AS weekdayLabel,
  strftime(strptime(substr(departureTime, 1, 23), '%Y-%m-%dT%H:%M:%S.%g'), '%H') AS hour,
  round(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price), 0) AS avgPrice
FROM q GROUP BY 1, 2, 3, 4""")
def l6(spark, sf_dir):
    return RP.weekday_hour_table(quote_view(spark, sf_dir))


@register("L9_load_audit", f"""
SELECT (SELECT count(*) FROM docs10) AS v1_0,
  (SELECT count(*) FROM q WHERE l_linenumber % 3 = 1) AS v1_1a,
  (SELECT count(*) FROM q WHERE l_linenumber % 3 = 2 AND NOT ({TRUNCATED})) AS v1_1b,
  (SELECT count(*) FROM docs10 WHERE l_orderkey % 97 = 0) AS nullHeaders,
  (SELECT count(*) FROM q WHERE {TRUNCATED}) AS quarantined,
  (SELECT count(*) FROM canon) AS rows,
  (SELECT count(*) FROM canon WHERE price IS NULL OR price <= 0) AS withoutPrice, 0::BIGINT AS withoutDate,
  (SELECT count(*) - count(DISTINCT (generation, l_orderkey, searchDate)) FROM canon) AS duplicateKeys""")
def l9(spark, sf_dir):
    """What the load observed; the written table is not read for it."""
    audit = load_lines(mixed_lines(quote_view(spark, sf_dir)), stage_path(spark, "audited"), "value",
                       keys=["task_id", "searchDate"])
    return spark.createDataFrame([audit])


@register("P2_A11_A12_archive_load", f"""
SELECT generation, fromCity, count(*) AS n, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  count(DISTINCT airlineName) AS airlines, NULL AS reason FROM canon GROUP BY 1, 2
UNION ALL SELECT 'corrupt', NULL, count(*), NULL, 0, NULL FROM q WHERE {TRUNCATED}
UNION ALL SELECT 'corrupt', NULL, 1, NULL, 0, 'BadZipFile' """)
def archive_load(spark, sf_dir):
    """Archives of one airline each (more than one where it has many lines), some members in a folder of their own, and
    one that is no archive; two arrivals, then a run that finds nothing."""
    src, dst = stage_path(spark, "archives"), stage_path(spark, "archive-table")
    state, audit = stage_path(spark, "archive-ckpt"), stage_path(spark, "archive-audit")
    folder = F.when(F.xxhash64("value") % 2 == 0, "final_results/").otherwise("")
    lines = materialize(mixed_lines(quote_view(spark, sf_dir)), "archive-lines").select(
        F.concat(F.lit("quotes_"), F.coalesce(F.regexp_replace("airline", "[^A-Za-z0-9]", "_"), F.lit("none"))).alias("airline"),
        F.concat(folder, F.lit("part"), F.pmod(F.xxhash64("value"), F.lit(3)).cast("string"), F.lit(".txt"))
        .alias("member"), F.col("value").alias("line"))
    lines, archives = dealt_archives(lines, "airline")
    early = F.pmod(F.xxhash64("archive"), F.lit(2)) == 0
    load = lambda: load_archives(spark, src, dst, state, audit, max_files=max(8, archives // 4), partition_by=("generation",))
    write_archives(lines.where(early), src).count()
    write_bytes(f"{src}/quotes_broken.zip", b"PK but no archive")
    load()
    write_archives(lines.where(~early), src).count()
    if not load() or load():
        raise AssertionError("a second arrival is loaded once")
    table = loaded_rows(spark, dst).groupBy("generation", "fromCity").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.count_distinct("airlineName").alias("airlines"), F.lit(None).cast("string").alias("reason"))
    bad = loaded_quarantine(spark, dst).groupBy(F.split_part("error", F.lit(":"), F.lit(1)).alias("reason")).count()
    return table.unionByName(bad.select(
        F.lit("corrupt").alias("generation"), F.lit(None).cast("string").alias("fromCity"), F.col("count").alias("n"),
        F.lit(None).cast("double").alias("revenue"), F.lit(0).cast("long").alias("airlines"), "reason"))
