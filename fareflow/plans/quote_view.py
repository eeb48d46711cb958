"""Derived quote view ``Q`` and the flat modelling source over the driver's
TPC-H-like tables.

One quote row per lineitem: supplier nation = departure city, customer
nation = destination city, part brand = airline, part type = cabin,
extended price = fare, order date = search date, ship date = departure.
The same definitions are written once in SQL (``QUOTE_SQL`` /
``MODEL_SOURCE_SQL``) for the DuckDB oracle; a test keeps both equal.

Scale notes: lineitem -> orders is the one big-big join (sort-merge on the
order key); customers meet the orders before it, a quarter of the rows and
few columns, instead of the joined quotes.  part / supplier / customer grow
with the data, so they are left to Spark's size-checked broadcast decision
(AQE); ``nation`` has a fixed 25 rows and is broadcast explicitly.  Every scan selects only the
columns used, so ``ReadSchema`` is pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.sources.tables import load_table


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def quote_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: load_table(spark, sf_dir, n)
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_quantity", "l_extendedprice", "l_discount",
                              "l_linestatus", "l_returnflag", "l_shipdate")
    o = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                           "o_orderdate", "o_orderpriority")
    p = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size")
    s = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nat = t("nation").select("n_nationkey", "n_name")
    ns = F.broadcast(nat.select(F.col("n_nationkey").alias("s_nationkey"),
                                F.col("n_name").alias("fromCity")))
    nc = F.broadcast(nat.select(F.col("n_nationkey").alias("c_nationkey"),
                                F.col("n_name").alias("toCity")))
    # what a shuffle carries: narrow orders to their customers, line items to their parts and suppliers; the orders
    # come last, so that quotes are dealt by order, as grouping by order needs them
    quoted = o.join(c, "o_custkey").drop("o_custkey")
    j = (li.join(p, "l_partkey").join(s, "l_suppkey").join(quoted, "l_orderkey")
         .join(ns, "s_nationkey").join(nc, "c_nationkey"))

    ln, pk, sk, size = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("p_size")
    one_way = F.col("l_linestatus") == "F"
    dur_h = size % 20
    dur_m = (ln * 13) % 60
    dep_hour = (size + ln * 5) % 24
    dep_min = (pk % 12) * 5
    stops = (ln - 1) % 3
    off_h = F.col("s_nationkey") % 12
    sign = F.when(F.col("s_nationkey") % 3 == 0, F.lit("-")).otherwise(F.lit("+"))
    dep_date = F.to_date("l_shipdate")
    code1 = F.concat(F.lit("P"), _s(pk % 97))
    dur1 = F.concat(_s(ln % 4), F.lit("h"), _s((pk % 6) * 10), F.lit("m"))
    code2 = F.concat(F.lit("S"), _s(sk % 89))
    dur2 = F.concat(_s(pk % 3), F.lit("h"), _s((sk % 12) * 5), F.lit("m"))
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "s_nationkey", "c_nationkey", "fromCity", "toCity",
        F.col("p_brand").alias("airlineName"),
        F.concat(F.lit("A"), F.substring("p_brand", 7, 10)).alias("airlineCode"),
        F.col("p_type").alias("cabin"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("returnFlag"),
        F.col("o_orderpriority").alias("priority"),
        F.to_date("o_orderdate").alias("searchDate"),
        dep_date.alias("depDate"),
        F.when(one_way, F.lit("1")).otherwise(F.lit("2")).alias("trip"),
        F.when(~one_way, size).alias("stayDays"),
        F.date_add(dep_date, F.when(~one_way, size)).alias("retDate"),
        stops.alias("stops"),
        (F.col("l_quantity").cast("int") % 10).alias("ticketsLeft"),
        dep_hour.alias("depHour"),
        dep_min.alias("depMinute"),
        F.when(ln == 7, F.concat(_s(dur_h), F.lit("h")))
         .when(dur_h == 0, F.concat(_s(dur_m), F.lit("m")))
         .otherwise(F.concat(_s(dur_h), F.lit("h"), _s(dur_m), F.lit("m"))).alias("durationText"),
        F.concat(_s(dep_date), F.lit("T"), _pad2(dep_hour), F.lit(":"), _pad2(dep_min),
                 F.lit(":00.000"), sign, _pad2(off_h), F.lit(":00")).alias("departureTime"),
        F.when(stops == 0, F.lit(""))
         .when(stops == 1, F.concat(code1, F.lit(":"), dur1))
         .otherwise(F.concat(code1, F.lit(":"), dur1, F.lit(";"), code2, F.lit(":"), dur2))
         .alias("stopInfo"),
    )


def requoted(q: DataFrame) -> DataFrame:
    """Every itinerary of ``Q`` quoted twice: as it is (``quoteNo`` 0) and 5 to
    24 days before (``quoteNo`` 1) at a price up to 45 higher or lower, so that
    itineraries repeat over search dates as they do in scraped quotes."""
    n = F.col("quoteNo")
    pk = F.col("l_partkey")
    return q.withColumn("quoteNo", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns({
        "price": F.col("price") + ((pk + 5) % 7 - 3) * 15 * n,
        "searchDate": F.date_sub(F.col("searchDate"), (n * (5 + pk % 20)).cast("int"))})


def model_source(q: DataFrame) -> DataFrame:
    """Flat modelling source (prefix-flattened leg/timeline names) from ``Q``,
    with re-quoted itineraries; what both quotes share is derived before they part."""
    rt = F.col("trip") == "2"
    leg2_stops = F.when(rt, F.col("l_linenumber") % 2)
    hour2 = (F.col("depHour") + 7) % 24
    flat = q.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "price", "fromCity", "toCity", "searchDate", "depDate", "stayDays", "trip", "cabin",
        F.col("stops").alias("leg1_stops"),
        leg2_stops.alias("leg2_stops"),
        F.col("ticketsLeft").alias("leg1_carrierSummary_noOfTicketsLeft"),
        F.when(rt, (F.col("ticketsLeft") + F.col("l_linenumber")) % 10)
         .alias("leg2_carrierSummary_noOfTicketsLeft"),
        F.col("airlineName").alias("leg1_carrierSummary_airlineName"),
        F.when(rt, F.col("airlineName")).alias("leg2_carrierSummary_airlineName"),
        F.col("depHour").alias("leg1_departureTime_hour"),
        F.when(rt, hour2).alias("leg2_departureTime_hour"),
        F.when(rt, F.date_format("retDate", "dd/MM/yyyy")).alias("leg2_departureTime_date"),
        F.concat(_pad2(F.col("depHour")), F.lit(":"), _pad2(F.col("depMinute")))
         .alias("timeline1_departureTime_time"),
        F.when(rt, F.concat(_pad2(hour2), F.lit(":"), _pad2(F.col("depMinute"))))
         .alias("timeline2_departureTime_time"),
        F.col("airlineCode").alias("timeline1_carrier_airlineCode"),
        F.when(rt, F.col("airlineCode")).alias("timeline2_carrier_airlineCode"),
        F.slice(F.array("cabin", F.lit("ECONOMY"), F.lit("BUSINESS")), 1, F.col("stops") + 1)
         .alias("timeline1_carrier_cabinClass"),
        F.when(rt, F.slice(F.array("cabin", F.lit("PREMIUM")), 1, leg2_stops + 1))
         .alias("timeline2_carrier_cabinClass"),
    )
    quotes = requoted(flat)
    ids = flat.columns[:4]
    return quotes.select(*ids, "quoteNo", *flat.columns[4:])


# ---- the same view for the DuckDB oracle ---------------------------------

QUOTE_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_nationkey, c_nationkey,
  ns.n_name AS fromCity, nc.n_name AS toCity,
  p_brand AS airlineName, 'A' || substr(p_brand, 7, 10) AS airlineCode,
  p_type AS cabin, l_extendedprice AS price, l_quantity AS quantity,
  l_discount AS discount, l_returnflag AS returnFlag, o_orderpriority AS priority,
  CAST(o_orderdate AS DATE) AS searchDate, CAST(l_shipdate AS DATE) AS depDate,
  CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END AS trip,
  CASE WHEN l_linestatus <> 'F' THEN p_size END AS stayDays,
  CAST(CAST(l_shipdate AS DATE) + CASE WHEN l_linestatus <> 'F' THEN p_size END AS DATE) AS retDate,
  (l_linenumber - 1) % 3 AS stops,
  CAST(l_quantity AS INTEGER) % 10 AS ticketsLeft,
  (p_size + l_linenumber * 5) % 24 AS depHour,
  CAST((l_partkey % 12) * 5 AS BIGINT) AS depMinute,
  CASE WHEN l_linenumber = 7 THEN CAST(p_size % 20 AS VARCHAR) || 'h'
       WHEN p_size % 20 = 0 THEN CAST((l_linenumber * 13) % 60 AS VARCHAR) || 'm'
       ELSE CAST(p_size % 20 AS VARCHAR) || 'h' || CAST((l_linenumber * 13) % 60 AS VARCHAR) || 'm'
  END AS durationText,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'T'
    || lpad(CAST((p_size + l_linenumber * 5) % 24 AS VARCHAR), 2, '0') || ':'
    || lpad(CAST((l_partkey % 12) * 5 AS VARCHAR), 2, '0') || ':00.000'
    || CASE WHEN s_nationkey % 3 = 0 THEN '-' ELSE '+' END
    || lpad(CAST(s_nationkey % 12 AS VARCHAR), 2, '0') || ':00' AS departureTime,
  CASE WHEN (l_linenumber - 1) % 3 = 0 THEN ''
       WHEN (l_linenumber - 1) % 3 = 1 THEN 'P' || CAST(l_partkey % 97 AS VARCHAR) || ':'
            || CAST(l_linenumber % 4 AS VARCHAR) || 'h' || CAST((l_partkey % 6) * 10 AS VARCHAR) || 'm'
       ELSE 'P' || CAST(l_partkey % 97 AS VARCHAR) || ':'
            || CAST(l_linenumber % 4 AS VARCHAR) || 'h' || CAST((l_partkey % 6) * 10 AS VARCHAR) || 'm'
            || ';S' || CAST(l_suppkey % 89 AS VARCHAR) || ':'
            || CAST(l_partkey % 3 AS VARCHAR) || 'h' || CAST((l_suppkey % 12) * 5 AS VARCHAR) || 'm'
  END AS stopInfo
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ns ON s_nationkey = ns.n_nationkey
JOIN nation nc ON c_nationkey = nc.n_nationkey
"""

REQUOTED_SQL = """
SELECT q.* REPLACE (price + ((l_partkey + 5) % 7 - 3) * 15 * quoteNo AS price,
  CAST(searchDate - CAST(quoteNo * (5 + l_partkey % 20) AS INTEGER) AS DATE) AS searchDate), quoteNo
FROM q, (SELECT unnest([0, 1]) AS quoteNo)
"""

MODEL_SOURCE_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, quoteNo, price, fromCity, toCity,
  searchDate, depDate, stayDays, trip, cabin,
  stops AS leg1_stops,
  CASE WHEN trip = '2' THEN l_linenumber % 2 END AS leg2_stops,
  ticketsLeft AS leg1_carrierSummary_noOfTicketsLeft,
  CASE WHEN trip = '2' THEN (ticketsLeft + l_linenumber) % 10 END AS leg2_carrierSummary_noOfTicketsLeft,
  airlineName AS leg1_carrierSummary_airlineName,
  CASE WHEN trip = '2' THEN airlineName END AS leg2_carrierSummary_airlineName,
  depHour AS leg1_departureTime_hour,
  CASE WHEN trip = '2' THEN (depHour + 7) % 24 END AS leg2_departureTime_hour,
  CASE WHEN trip = '2' THEN strftime(retDate, '%d/%m/%Y') END AS leg2_departureTime_date,
  lpad(CAST(depHour AS VARCHAR), 2, '0') || ':' || lpad(CAST(depMinute AS VARCHAR), 2, '0')
    AS timeline1_departureTime_time,
  CASE WHEN trip = '2' THEN lpad(CAST((depHour + 7) % 24 AS VARCHAR), 2, '0') || ':'
    || lpad(CAST(depMinute AS VARCHAR), 2, '0') END AS timeline2_departureTime_time,
  airlineCode AS timeline1_carrier_airlineCode,
  CASE WHEN trip = '2' THEN airlineCode END AS timeline2_carrier_airlineCode,
  list_slice([cabin, 'ECONOMY', 'BUSINESS'], 1, stops + 1) AS timeline1_carrier_cabinClass,
  CASE WHEN trip = '2' THEN list_slice([cabin, 'PREMIUM'], 1, l_linenumber % 2 + 1) END
    AS timeline2_carrier_cabinClass
FROM rq
"""
