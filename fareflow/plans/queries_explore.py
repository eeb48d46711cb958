"""Catalog entries: filters (D), aggregations (F), sort/limit/sampling (H),
set operations (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.functions import text as T
from fareflow.operators import explore as X
from fareflow.operators import splits as S
from fareflow.plans.catalog import register
from fareflow.plans.queries_core import SQL_KEY
from fareflow.plans.quote_view import model_source, quote_view

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ZPRICE_SQL = "CASE WHEN ticketsLeft = 0 THEN 0.0 ELSE price END"


def _q(spark, sf_dir):
    return quote_view(spark, sf_dir)


def _zprice():
    return F.when(F.col("ticketsLeft") == 0, F.lit(0.0)).otherwise(F.col("price"))


# ---- D: filters -----------------------------------------------------------

@register("D1_positive_price", f"""
SELECT {SQL_IDS}, {ZPRICE_SQL} AS price FROM q WHERE {ZPRICE_SQL} > 0""")
def d1(spark, sf_dir):
    return _q(spark, sf_dir).select(*IDS, _zprice().alias("price")).filter(F.col("price") > 0)


@register("D2_zero_price_share", f"""
SELECT fromCity, avg(CASE WHEN {ZPRICE_SQL} <= 0 THEN 1 ELSE 0 END) AS zeroShare,
  count(*) AS n FROM q GROUP BY fromCity""")
def d2(spark, sf_dir):
    return (_q(spark, sf_dir).withColumn("price", _zprice()).groupBy("fromCity")
            .agg(X.zero_share("price").alias("zeroShare"), F.count(F.lit(1)).alias("n")))


@register("D3_D5_conjunction_isin", f"""
SELECT {SQL_IDS}, fromCity, toCity, airlineName, price FROM q
WHERE trip = '1' AND cabin = 'PROMO' AND airlineName IN ('Brand#1', 'Brand#5', 'Brand#9')
  AND price >= 20000 AND fromCity <> toCity""")
def d3(spark, sf_dir):
    q = _q(spark, sf_dir)
    return q.filter((F.col("trip") == "1") & (F.col("cabin") == "PROMO")
                    & F.col("airlineName").isin("Brand#1", "Brand#5", "Brand#9")
                    & (F.col("price") >= 20000) & (F.col("fromCity") != F.col("toCity"))) \
        .select(*IDS, "fromCity", "toCity", "airlineName", "price")


@register("D4_date_range", f"""
SELECT {SQL_IDS}, searchDate, depDate FROM q
WHERE searchDate BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' AND depDate <= DATE '1996-06-30'""")
def d4(spark, sf_dir):
    q = _q(spark, sf_dir)
    return q.filter(F.col("searchDate").between(F.lit("1996-01-01").cast("date"), F.lit("1996-03-31").cast("date"))
                    & (F.col("depDate") <= F.lit("1996-06-30").cast("date"))) \
        .select(*IDS, "searchDate", "depDate")


MODEL_SOURCE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quoteNo", "price", "fromCity", "toCity", "searchDate",
    "depDate", "stayDays", "trip", "cabin", "leg1_stops", "leg2_stops", "leg1_carrierSummary_noOfTicketsLeft",
    "leg2_carrierSummary_noOfTicketsLeft", "leg1_carrierSummary_airlineName", "leg2_carrierSummary_airlineName",
    "leg1_departureTime_hour", "leg2_departureTime_hour", "leg2_departureTime_date", "timeline1_departureTime_time",
    "timeline2_departureTime_time", "timeline1_carrier_airlineCode", "timeline2_carrier_airlineCode",
    "timeline1_carrier_cabinClass", "timeline2_carrier_cabinClass"]


@register("D6_null_counts", "UNPIVOT (SELECT " + ", ".join(
    f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in MODEL_SOURCE_COLUMNS)
    + ' FROM m) ON COLUMNS(*) INTO NAME "column" VALUE nulls')
def d6(spark, sf_dir):
    return X.null_counts(model_source(quote_view(spark, sf_dir)))


@register("D7_matched_semi", f"""
SELECT {SQL_IDS}, fromCity FROM q
WHERE fromCity IN (SELECT n_name FROM nation WHERE n_regionkey IN (0, 1))""")
def d7a(spark, sf_dir):
    from fareflow.operators.joins import split_matched
    from fareflow.sources.tables import load_table
    dim = load_table(spark, sf_dir, "nation").filter(F.col("n_regionkey").isin(0, 1)) \
        .select(F.col("n_name").alias("fromCity"))
    matched, _ = split_matched(_q(spark, sf_dir).select(*IDS, "fromCity"), dim, ["fromCity"])
    return matched


@register("D7_unmatched_anti", f"""
SELECT {SQL_IDS}, fromCity FROM q
WHERE fromCity NOT IN (SELECT n_name FROM nation WHERE n_regionkey IN (0, 1))""")
def d7b(spark, sf_dir):
    from fareflow.operators.joins import split_matched
    from fareflow.sources.tables import load_table
    dim = load_table(spark, sf_dir, "nation").filter(F.col("n_regionkey").isin(0, 1)) \
        .select(F.col("n_name").alias("fromCity"))
    _, unmatched = split_matched(_q(spark, sf_dir).select(*IDS, "fromCity"), dim, ["fromCity"])
    return unmatched


@register("D8_text_null", f"""
SELECT {SQL_IDS}, stayText FROM (
  SELECT {SQL_IDS}, CASE WHEN l_linenumber = 5 THEN NULL WHEN stayDays IS NULL THEN 'null'
                         ELSE CAST(stayDays AS VARCHAR) END AS stayText FROM q)
WHERE NULLIF(stayText, 'null') IS NOT NULL""")
def d8(spark, sf_dir):
    q = _q(spark, sf_dir)
    txt = F.when(F.col("l_linenumber") == 5, F.lit(None).cast("string")) \
        .when(F.col("stayDays").isNull(), "null").otherwise(F.col("stayDays").cast("string"))
    return q.select(*IDS, txt.alias("stayText")).filter(T.text_not_null("stayText"))


@register("D9_reject_pattern", """
SELECT regexp_matches(durationText, '^[0-9]+h[0-9]+m$') AS wellFormed, count(*) AS n
FROM q GROUP BY 1""")
def d9(spark, sf_dir):
    q = _q(spark, sf_dir)
    return q.groupBy(F.col("durationText").rlike(r"^[0-9]+h[0-9]+m$").alias("wellFormed")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("D10_having", """
SELECT airlineName, cabin, count(*) AS n FROM q GROUP BY airlineName, cabin HAVING count(*) > 400""")
def d10(spark, sf_dir):
    return (X.group_count(_q(spark, sf_dir), ["airlineName", "cabin"], "n")
            .filter(F.col("n") > 400))


# ---- F: aggregations ------------------------------------------------------

@register("F1_counts", """
SELECT count(*) AS n, count(stayDays) AS withStay, count(DISTINCT l_orderkey) AS searches FROM q""")
def f1(spark, sf_dir):
    return _q(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.count("stayDays").alias("withStay"),
                                 F.countDistinct("l_orderkey").alias("searches"))


@register("F2_L8_route_inventory", """
SELECT fromCity, toCity, trip, count(*) AS count FROM q GROUP BY fromCity, toCity, trip""")
def f2(spark, sf_dir):
    return X.group_count(_q(spark, sf_dir), ["fromCity", "toCity", "trip"]) \
        .orderBy("fromCity", "toCity", "trip")


@register("F3_group_by_struct", """
SELECT k.trip AS trip, k.stops AS stops, isNullKey, n FROM (
  SELECT CASE WHEN trip = '2' THEN {'trip': trip, 'stops': stops} END AS k,
         (CASE WHEN trip = '2' THEN 1 END) IS NULL AS isNullKey, count(*) AS n
  FROM q GROUP BY 1, 2)""")
def f3(spark, sf_dir):
    q = _q(spark, sf_dir)
    k = F.when(F.col("trip") == "2", F.struct("trip", "stops"))
    g = q.groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("k.trip").alias("trip"), F.col("k.stops").alias("stops"),
                    F.col("k").isNull().alias("isNullKey"), "n")


@register("F4_count_max", """
SELECT fromCity, count(stayDays) AS nStay, max(price) AS maxPrice FROM q GROUP BY fromCity""")
def f4(spark, sf_dir):
    return _q(spark, sf_dir).groupBy("fromCity").agg(F.count("stayDays").alias("nStay"),
                                                      F.max("price").alias("maxPrice"))


@register("F5_count_own_groups", """
SELECT leg2_stops, count(leg2_stops) AS count_leg2_stops FROM m GROUP BY leg2_stops""")
def f5(spark, sf_dir):
    m = model_source(quote_view(spark, sf_dir))
    return X.count_in_own_groups(m, "leg2_stops").orderBy(F.desc("count_leg2_stops"))


@register("F6_avg_by_date", """
SELECT searchDate, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avgPrice
FROM q GROUP BY searchDate""")
def f6(spark, sf_dir):
    return _q(spark, sf_dir).groupBy("searchDate").agg(X.exact_avg("price").alias("avgPrice"))


@register("F6_avg_by_array_key", """
SELECT timeline1_carrier_cabinClass, count(*) AS n,
  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avgPrice
FROM m GROUP BY timeline1_carrier_cabinClass""")
def f6b(spark, sf_dir):
    m = model_source(quote_view(spark, sf_dir))
    return m.groupBy("timeline1_carrier_cabinClass").agg(F.count(F.lit(1)).alias("n"),
                                                         X.exact_avg("price").alias("avgPrice"))


@register("F7_group_stats", """
WITH s AS (
  SELECT trip, cabin, count(price) AS n,
    CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS sx,
    CAST(sum(CAST(price AS DECIMAL(18,2)) * CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS sxx,
    min(price) AS minPrice, max(price) AS maxPrice
  FROM q GROUP BY trip, cabin)
SELECT trip, cabin, sx / n AS meanPrice,
  CASE WHEN n > 1 THEN sqrt(greatest((sxx - sx * sx / n) / (n - 1), 0.0)) END AS stdPrice,
  minPrice, maxPrice
FROM s""")
def f7(spark, sf_dir):
    return _q(spark, sf_dir).groupBy("trip", "cabin").agg(
        X.exact_avg("price").alias("meanPrice"), X.exact_stddev("price").alias("stdPrice"),
        F.min("price").alias("minPrice"), F.max("price").alias("maxPrice"))


@register("F8_pivot_min", """
SELECT CAST(year(searchDate) AS INTEGER) AS y,
  min(CASE WHEN cabin = 'ECONOMY' THEN price END) AS ECONOMY,
  min(CASE WHEN cabin = 'LARGE' THEN price END) AS LARGE,
  min(CASE WHEN cabin = 'MEDIUM' THEN price END) AS MEDIUM,
  min(CASE WHEN cabin = 'PROMO' THEN price END) AS PROMO,
  min(CASE WHEN cabin = 'SMALL' THEN price END) AS SMALL,
  min(CASE WHEN cabin = 'STANDARD' THEN price END) AS STANDARD,
  min(CASE WHEN cabin IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD') THEN NULL ELSE price END) AS other
FROM q GROUP BY 1""")
def f8(spark, sf_dir):
    q = _q(spark, sf_dir).withColumn("y", F.year("searchDate"))
    return X.pivot_first(q, ["y"], "cabin", "price",
                         ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])


@register("F9_crosstab_long", """
SELECT trip, cabin, count(*) AS count FROM q GROUP BY trip, cabin""")
def f9(spark, sf_dir):
    return X.crosstab_long(_q(spark, sf_dir), "trip", "cabin")


@register("F10_cube", """
SELECT trip, stops, ticketsLeft, count(*) AS count, CAST(grouping(trip, stops, ticketsLeft) AS INTEGER) AS gid
FROM q GROUP BY CUBE (trip, stops, ticketsLeft)""")
def f10(spark, sf_dir):
    return X.cube_counts(_q(spark, sf_dir), ["trip", "stops", "ticketsLeft"])


@register("F11_date_bounds", """
SELECT min(depDate) AS minDep, max(depDate) AS maxDep, min(searchDate) AS minSearch,
  max(searchDate) AS maxSearch FROM q""")
def f11(spark, sf_dir):
    return _q(spark, sf_dir).agg(F.min("depDate").alias("minDep"), F.max("depDate").alias("maxDep"),
                                 F.min("searchDate").alias("minSearch"), F.max("searchDate").alias("maxSearch"))


@register("F12_describe_long", """
WITH s AS (
  SELECT count(price) AS n, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS sx,
    CAST(sum(CAST(price AS DECIMAL(18,2)) * CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS sxx,
    min(price) AS mn, max(price) AS mx FROM q)
SELECT 'price' AS "column", n AS count, sx / n AS mean,
  CASE WHEN n > 1 THEN sqrt(greatest((sxx - sx * sx / n) / (n - 1), 0.0)) END AS stddev,
  CAST(mn AS VARCHAR) AS min, CAST(mx AS VARCHAR) AS max FROM s
UNION ALL
SELECT 'fromCity', count(fromCity), NULL, NULL, min(fromCity), max(fromCity) FROM q""")
def f12(spark, sf_dir):
    return X.describe_long(_q(spark, sf_dir), ["price", "fromCity"], numeric=["price"])


@register("F13_frequent_exact", """
WITH c AS (SELECT airlineName, count(*) AS count FROM q GROUP BY airlineName),
     t AS (SELECT count(*) AS n FROM q)
SELECT airlineName, count, count / n AS share FROM c, t WHERE count >= 0.041 * n""")
def f13(spark, sf_dir):
    return X.frequent_exact(_q(spark, sf_dir), "airlineName", 0.041)


@register("F14_distinct_ordered", """
SELECT DISTINCT fromCity, trip FROM q""")
def f14(spark, sf_dir):
    return _q(spark, sf_dir).select("fromCity", "trip").distinct().orderBy("fromCity", "trip")


@register("F15_duplicates", """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM q)) AS distinctRows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM q)) AS duplicates FROM q""")
def f15(spark, sf_dir):
    return X.duplicate_report(_q(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@register("F16_filtered_group_mean", """
SELECT airlineName, depDate,
  round(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price), 0) AS avgPrice
FROM q WHERE trip = '2' AND stayDays BETWEEN 5 AND 20 GROUP BY airlineName, depDate""")
def f16(spark, sf_dir):
    q = _q(spark, sf_dir).filter((F.col("trip") == "2") & F.col("stayDays").between(5, 20))
    return q.groupBy("airlineName", "depDate").agg(F.round(X.exact_avg("price"), 0).alias("avgPrice"))


@register("F17_label_ratio", f"""
WITH f AS (
  SELECT trip, stayDays, CAST(floor((depDate - searchDate) / 30) AS INTEGER) AS leadBand, price,
    min(price) OVER (PARTITION BY {SQL_KEY} ORDER BY (searchDate - DATE '1970-01-01')
                     RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) AS fm
  FROM m WHERE price > 0)
SELECT trip, stayDays, leadBand, avg(CAST(price - fm > 20 AS INTEGER)) AS dropRatio, count(*) AS n
FROM f GROUP BY trip, stayDays, leadBand""")
def f17(spark, sf_dir):
    from fareflow.operators.labels import route_key, with_drop_label
    from fareflow.plans.model_table import ROUTE_KEY_PARTS
    m = model_source(quote_view(spark, sf_dir)).filter(F.col("price") > 0)
    m = m.select("trip", "stayDays", "depDate", "searchDate", "price", route_key(*ROUTE_KEY_PARTS).alias("key"))
    lab = with_drop_label(m, ["key"], 19, 20.0, per_day=False)
    lab = lab.withColumn("leadBand", F.floor(F.datediff("depDate", "searchDate") / 30).cast("int"))
    return lab.groupBy("trip", "stayDays", "leadBand").agg(F.avg("priceWillDrop").alias("dropRatio"),
                                                          F.count(F.lit(1)).alias("n"))


BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@register("F18_series_by_airline", "SELECT fromCity, searchDate, " + ", ".join(
    f"CAST(sum(CASE WHEN airlineName = '{b}' THEN CAST(price AS DECIMAL(18,2)) END) AS DOUBLE) "
    f"/ count(CASE WHEN airlineName = '{b}' THEN price END) AS \"{b}\"" for b in BRANDS)
    + ", CAST(sum(CASE WHEN airlineName IN ({0}) THEN NULL ELSE CAST(price AS DECIMAL(18,2)) END) AS DOUBLE) "
      "/ count(CASE WHEN airlineName IN ({0}) THEN NULL ELSE price END) AS other".format(", ".join(f"'{b}'" for b in BRANDS))
    + " FROM q GROUP BY fromCity, searchDate")
def f18(spark, sf_dir):
    q = _q(spark, sf_dir).withColumn("airlineName", X.pivot_values("airlineName", BRANDS))
    return q.groupBy("fromCity", "searchDate").pivot("airlineName", [*BRANDS, "other"]).agg(X.exact_avg("price"))


# ---- H: sort, limit, sampling --------------------------------------------

@register("H1_H2_H3_top_k", f"""
SELECT {SQL_IDS}, fromCity, price FROM q
ORDER BY price DESC, fromCity ASC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25""")
def h3(spark, sf_dir):
    return (_q(spark, sf_dir).select(*IDS, "fromCity", "price")
            .orderBy(F.desc("price"), F.asc_nulls_first("fromCity"), *IDS).limit(25))


@register("H5_key_sample", f"""
SELECT {SQL_IDS}, price FROM q WHERE ((l_orderkey * 7919 + l_linenumber) % 10000) < 1500""")
def h5(spark, sf_dir):
    b = F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber"), F.lit(10000))
    return S.hash_sample(_q(spark, sf_dir).select(*IDS, "price"), 0.15, bucket_expr=b)


@register("H7_key_split", f"""
SELECT {SQL_IDS}, CASE WHEN ((l_orderkey * 7919 + l_linenumber) % 10000) < 6000 THEN 0
  WHEN ((l_orderkey * 7919 + l_linenumber) % 10000) < 8000 THEN 1 ELSE 2 END AS split FROM q""")
def h7(spark, sf_dir):
    b = F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber"), F.lit(10000))
    return S.hash_split(_q(spark, sf_dir).select(*IDS), [0.6, 0.2, 0.2], bucket_expr=b)


@register("H8_time_split", f"""
SELECT {SQL_IDS}, CASE WHEN searchDate < DATE '1999-06-20' THEN 'train' ELSE 'test' END AS split FROM q""")
def h8(spark, sf_dir):
    return S.time_split(_q(spark, sf_dir).select(*IDS, "searchDate"), "searchDate", "1999-06-20") \
        .drop("searchDate")


# ---- I: set operations ----------------------------------------------------

@register("I1_bag_union", f"""
SELECT {SQL_IDS}, trip, price FROM q WHERE trip = '1'
UNION ALL SELECT {SQL_IDS}, trip, price FROM q WHERE trip = '2'
UNION ALL SELECT {SQL_IDS}, trip, price FROM q WHERE trip = '2' AND price > 90000""")
def i1(spark, sf_dir):
    q = _q(spark, sf_dir).select(*IDS, "trip", "price")
    return (q.filter(F.col("trip") == "1").unionByName(q.filter(F.col("trip") == "2"))
            .unionByName(q.filter((F.col("trip") == "2") & (F.col("price") > 90000))))


@register("I3_dataset_equality", """
WITH c AS (SELECT
  (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber, price FROM q EXCEPT ALL
     SELECT l_orderkey, l_linenumber, price FROM q WHERE ticketsLeft <> 3)) AS onlyLeft,
  (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber, price FROM q WHERE ticketsLeft <> 3 EXCEPT ALL
     SELECT l_orderkey, l_linenumber, price FROM q)) AS onlyRight)
SELECT onlyLeft, onlyRight, onlyLeft = 0 AND onlyRight = 0 AS equal FROM c""")
def i3(spark, sf_dir):
    q = _q(spark, sf_dir)
    a = q.select("l_orderkey", "l_linenumber", "price")
    b = q.filter(F.col("ticketsLeft") != 3).select("l_orderkey", "l_linenumber", "price")
    return X.datasets_equal(a, b)
