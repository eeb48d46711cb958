"""Catalog entries: nested documents -> canonical flat table (C1-C17,
C5/I2, A2).  Documents are derived from the quote view and pass through a
JSON text round trip; the oracle states the flattened values in closed
form over the same view."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.operators import normalize as N
from fareflow.plans import documents as DOC
from fareflow.plans.catalog import add_cte, register
from fareflow.plans.quote_view import quote_view
from fareflow.schemas import V1_0_DOC, V1_1A_DOC, V1_1B_DOC

FMT = "'%Y-%m-%dT%H:%M:%S.%g'"
FMTZ = "'%Y-%m-%dT%H:%M:%S.%g%z'"


def _off(k: str) -> str:
    return (f"(CASE WHEN {k} % 3 = 0 THEN '-' ELSE '+' END) || lpad(CAST({k} % 12 AS VARCHAR), 2, '0') || ':00'")


add_cte("docq", f"""
SELECT *,
  coalesce(TRY_CAST(NULLIF(regexp_extract(durationText, '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
    + TRY_CAST(NULLIF(regexp_extract(durationText, 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER), 90) AS dur,
  departureTime AS dep1,
  strftime(strptime(substr(departureTime, 1, 23), {FMT})
    + to_minutes(coalesce(TRY_CAST(NULLIF(regexp_extract(durationText, '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
    + TRY_CAST(NULLIF(regexp_extract(durationText, 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER), 90)), {FMT})
    || {_off('c_nationkey')} AS arr1,
  CASE WHEN trip = '2' THEN CAST(retDate AS VARCHAR) || 'T' || lpad(CAST((depHour + 7) % 24 AS VARCHAR), 2, '0')
    || ':' || lpad(CAST(depMinute AS VARCHAR), 2, '0') || ':00.000' || {_off('c_nationkey')} END AS dep2
FROM q""")

add_cte("docq2", f"""
SELECT *, CASE WHEN trip = '2' THEN strftime(strptime(substr(dep2, 1, 23), {FMT}) + to_minutes(dur + 30), {FMT})
    || {_off('s_nationkey')} END AS arr2,
  stops AS n1, l_linenumber % 2 AS n2,
  list_filter(string_split(stopInfo, ';'), lambda x: x <> '') AS parts
FROM docq""")

NULLSEG = "stops = 2 AND i = 1 AND l_partkey % 5 = 0"

def _segments(n: int) -> dict[str, str]:
    """SQL of the 18 segment columns of leg ``n`` (C16): one list item for each segment i."""
    last, dep, arr = ("n1", "D", "R") if n == 1 else ("n2", "E", "T")
    frm, to = ("fromCity", "toCity") if n == 1 else ("toCity", "fromCity")
    side = {
        "departure": (f"CASE WHEN i = 0 THEN {frm} ELSE 'HUB' || CAST(i AS VARCHAR) END",
                      f"'{dep}' || CAST(l_partkey % 50 + i AS VARCHAR)"),
        "arrival": (f"CASE WHEN i = {last} THEN {to} ELSE 'HUB' || CAST(i + 1 AS VARCHAR) END",
                    f"'{arr}' || CAST(l_suppkey % 50 + i AS VARCHAR)")}
    item = {}
    for which, (city, code) in side.items():
        item |= {f"{which}Airport_cityState": f"({city}) || ', ST'", f"{which}Airport_city": city,
                 f"{which}Airport_code": code, f"{which}Airport_localName": f"lower({city})",
                 f"{which}Airport_longName": f"({city}) || ' Intl'", f"{which}Airport_name": f"'Airport ' || {code}",
                 f"{which}Time": f"{which[:3]}{n}"}
    item |= {"distance": "CAST(1000 + 100 * i + l_partkey % 500 AS VARCHAR) || ' km'",
             "plane": "CASE WHEN (l_partkey + i) % 4 = 0 THEN '' ELSE 'B7' || CAST((l_partkey + i) % 9 AS VARCHAR) END",
             "brandedFareName": "cabin", "type": "CASE WHEN i = 0 THEN 'DIRECT' ELSE 'CONNECT' END"}
    whole = "list_transform(range(n1 + 1), lambda i: CASE WHEN " + NULLSEG + " THEN NULL ELSE {} END)" if n == 1 \
        else "CASE WHEN trip = '2' THEN list_transform(range(n2 + 1), lambda i: {}) END"
    return {f"timeline_{k}{'' if n == 1 else '_leg2'}": whole.format(v) for k, v in item.items()}


def _leg(n: int) -> dict[str, str]:
    """SQL of the other columns of leg ``n``; those of leg 2 are NULL one-way."""
    last, dep, arr = ("n1", "D", "R") if n == 1 else ("n2", "E", "T")
    left = "ticketsLeft" if n == 1 else "(ticketsLeft + l_linenumber) % 10"
    cols = {
        "departureTime": f"dep{n}", "arrivalTime": f"arr{n}", "airlineName": "airlineName",
        "duration_m": f"(epoch(strptime(arr{n}, {FMTZ})) - epoch(strptime(dep{n}, {FMTZ}))) / 60",
        "stops": f"CAST({last} AS TINYINT)",
        "stop_airport": "list_transform(parts, lambda s: split_part(s, ':', 1))" if n == 1
        else "CASE WHEN n2 = 0 THEN []::VARCHAR[] ELSE ['S' || CAST(l_suppkey % 89 AS VARCHAR)] END",
        "stop_duration": "list_transform(parts, lambda s: split_part(s, ':', 2))" if n == 1
        else "CASE WHEN n2 = 0 THEN []::VARCHAR[] ELSE ['1h5m'] END",
        "noOfTicketsLeft": f"CAST(CASE WHEN {left} = 0 THEN 99 ELSE {left} END AS TINYINT)",
        "airline_codes": f"CASE WHEN {last} > 0 THEN [airlineCode, airlineCode || 'X'] ELSE [airlineCode] END",
        "fromCityAirportCode": f"'{dep}' || CAST(l_partkey % 50 AS VARCHAR)",
        "toCityAirportCode": f"'{arr}' || CAST(l_suppkey % 50 + {last} AS VARCHAR)",
        "carrierAirProviderId": "l_suppkey % 7", "carrierAirlineImageFileName": "airlineCode || '.png'",
        "carrierMixedCabinClass": f"{last} > 1", "carrierMultiStop": f"{last} > 0",
        "carrierNextDayArrival": "depHour >= 20"}
    return cols if n == 1 else {f"{k}_leg2": f"CASE WHEN trip = '2' THEN {v} END" for k, v in cols.items()}


def v11_sql(gen: str) -> str:
    """All 89 (b) or 88 (a) canonical columns in closed form over the quotes."""
    cols = {
        "price": "price", "version": f"'1.1{gen}'", "searchDate": "searchDate",
        "tableName": "'fares_' || fromCity || '_' || toCity", "task_id": "l_orderkey", "currencyCode": "'AUD'",
        "fromCity": "fromCity", "toCity": "toCity", "trip": "trip", "depDate": "depDate", "retDate": "retDate",
        "stayDays": "stayDays", "service_code": "airlineCode || CAST(l_partkey % 1000 AS VARCHAR)",
        "plane": "CASE WHEN l_partkey % 4 = 0 THEN '' ELSE 'B7' || CAST(l_partkey % 9 AS VARCHAR) END",
        "airline_code": "airlineCode", "span_days": "99", "power": "false", "video": "false", "wifi": "false",
        "stop_info": "parts", **_leg(1), **_leg(2), **_segments(1), **_segments(2)}
    if gen == "b":
        cols["url"] = "'https://example.com/q/' || CAST(l_orderkey AS VARCHAR)"
    return "SELECT " + ",\n  ".join(f"{v} AS {k}" for k, v in cols.items()) + "\nFROM docq2"


@register("C2_normalize_v1_1b", v11_sql("b"))
def c2(spark, sf_dir):
    docs = DOC.json_round_trip(DOC.v1_1_documents(quote_view(spark, sf_dir), "b"), V1_1B_DOC)
    return N.normalize_v1_1(docs, "b")


@register("C3_normalize_v1_1a", v11_sql("a"))
def c3(spark, sf_dir):
    docs = DOC.json_round_trip(DOC.v1_1_documents(quote_view(spark, sf_dir), "a"), V1_1A_DOC)
    return N.normalize_v1_1(docs, "a")


V10_SQL = """
WITH g AS (
  SELECT *, max(coalesce(stayDays, l_linenumber)) OVER (
    PARTITION BY l_orderkey, fromCity, toCity, depDate, trip, searchDate) AS stay FROM docq2)
SELECT price, '1.0' AS version, searchDate, 'fares_' || fromCity || '_' || toCity AS tableName,
  l_orderkey AS task_id, 'AUD' AS currencyCode, fromCity, toCity, trip, depDate,
  CASE WHEN trip = '1' THEN NULL ELSE CAST(depDate + CAST(stay AS INTEGER) AS DATE) END AS retDate,
  CASE WHEN trip = '1' THEN NULL ELSE CAST(stay AS INTEGER) END AS stayDays,
  dep1 AS departureTime, arr1 AS arrivalTime, airlineName,
  TRY_CAST(NULLIF(regexp_extract(durationText, '^\\s*([0-9]+)h', 1), '') AS INTEGER) * 60
    + TRY_CAST(NULLIF(regexp_extract(durationText, 'h\\s*([0-9]+)m\\s*$', 1), '') AS INTEGER) AS duration_m,
  airlineCode || CAST(l_partkey % 1000 AS VARCHAR) AS service_code,
  CASE WHEN l_partkey % 4 = 0 THEN '' ELSE 'B7' || CAST(l_partkey % 9 AS VARCHAR) END AS plane,
  CAST(stops AS TINYINT) AS stops,
  CAST(CASE WHEN ticketsLeft = 0 THEN 99 ELSE ticketsLeft END AS TINYINT) AS noOfTicketsLeft,
  airlineCode AS airline_code, [airlineCode] AS airline_codes, string_split(stopInfo, ';') AS stop_info,
  CAST(l_suppkey % 3 AS INTEGER) AS span_days, depHour < 12 AS power, l_partkey % 3 = 0 AS video,
  l_suppkey % 2 = 0 AS wifi
FROM g WHERE l_orderkey % 97 <> 0"""


@register("C1_C4_C15_normalize_v1_0", V10_SQL)
def c1(spark, sf_dir):
    docs = DOC.json_round_trip(DOC.v1_0_documents(quote_view(spark, sf_dir)), V1_0_DOC)
    return N.normalize_v1_0(N.flatten_v1_0(docs))


@register("F3_L9_null_documents", """
SELECT count(*) FILTER (WHERE l_orderkey % 97 = 0) AS nullBasic, count(*) AS documents FROM (
  SELECT DISTINCT l_orderkey, fromCity, toCity, depDate, trip, searchDate FROM q)""")
def null_docs(spark, sf_dir):
    docs = DOC.json_round_trip(DOC.v1_0_documents(quote_view(spark, sf_dir)), V1_0_DOC)
    return docs.agg(F.count(F.when(F.col("basic").isNull(), 1)).alias("nullBasic"),
                    F.count(F.lit(1)).alias("documents"))


@register("C5_I2_align_generations", """
SELECT generation, trip, count(*) AS n, count(url) AS withUrl, count(span_days) AS withSpan,
  count(stops_leg2) AS withLeg2, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM (
  SELECT 'v1.0' AS generation, trip, NULL AS url, 1 AS span_days, NULL AS stops_leg2, price
    FROM docq2 WHERE l_orderkey % 97 <> 0
  UNION ALL SELECT 'v1.1a', trip, NULL, 99, CASE WHEN trip = '2' THEN 1 END, price FROM q
  UNION ALL SELECT 'v1.1b', trip, 'u', 99, CASE WHEN trip = '2' THEN 1 END, price FROM q)
GROUP BY generation, trip""")
def c5(spark, sf_dir):
    q = quote_view(spark, sf_dir)
    v10 = N.normalize_v1_0(N.flatten_v1_0(DOC.json_round_trip(DOC.v1_0_documents(q), V1_0_DOC)))
    v1a = N.normalize_v1_1(DOC.json_round_trip(DOC.v1_1_documents(q, "a"), V1_1A_DOC), "a")
    v1b = N.normalize_v1_1(DOC.json_round_trip(DOC.v1_1_documents(q, "b"), V1_1B_DOC), "b")
    allg = N.align_generations(v10, v1a, v1b, names=("v1.0", "v1.1a", "v1.1b"))
    return allg.groupBy("generation", "trip").agg(
        F.count(F.lit(1)).alias("n"), F.count("url").alias("withUrl"), F.count("span_days").alias("withSpan"),
        F.count("stops_leg2").alias("withLeg2"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("revenue"))


TRUNCATED = "l_linenumber % 3 = 2 AND (l_partkey % 1000) % 41 = 0"

#: Documents, canonical rows and truncated lines of ``mixed_lines``.
add_cte("docs10", """
SELECT DISTINCT l_orderkey, fromCity, toCity, depDate, trip, searchDate FROM q WHERE l_linenumber % 3 = 0""")
add_cte("canon", f"""
SELECT 'v1.0' AS generation, q.* FROM q WHERE l_linenumber % 3 = 0 AND l_orderkey % 97 <> 0
UNION ALL SELECT 'v1.1a', q.* FROM q WHERE l_linenumber % 3 = 1
UNION ALL SELECT 'v1.1b', q.* FROM q WHERE l_linenumber % 3 = 2 AND NOT ({TRUNCATED})""")


def mixed_lines(q):
    """(airline, value): JSON lines of all three generations, a third of the
    quotes each; v1.1b lines whose first segment number is a multiple of 41
    arrive truncated."""
    v10 = DOC.v1_0_documents(q.filter(F.col("l_linenumber") % 3 == 0))
    v1a = DOC.v1_1_documents(q.filter(F.col("l_linenumber") % 3 == 1), "a")
    v1b = DOC.v1_1_documents(q.filter(F.col("l_linenumber") % 3 == 2), "b")
    broken = F.get(F.col("timeline_leg1"), 0).getField("carrier").getField("serviceNumber") % 41 == 0
    js = F.to_json(F.struct("*"))
    return (v10.select(F.get("quote_list", 0).getField("company").alias("airline"), js.alias("value"))
            .unionByName(v1a.select(F.col("leg1.carrierSummary.airlineName").alias("airline"), js.alias("value")))
            .unionByName(v1b.select(F.col("quote_leg1.carrierSummary.airlineName").alias("airline"),
                                    F.when(broken, F.substring(js, 1, 20)).otherwise(js).alias("value"))))


@register("A2_generation_router", f"""
SELECT 'v1.0' AS generation, count(*) AS n FROM docs10
UNION ALL SELECT 'v1.1a', count(*) FROM q WHERE l_linenumber % 3 = 1
UNION ALL SELECT 'v1.1b', count(*) FROM q WHERE l_linenumber % 3 = 2 AND NOT ({TRUNCATED})
UNION ALL SELECT 'corrupt', count(*) FROM q WHERE {TRUNCATED}""")
def a2(spark, sf_dir):
    return N.tag_generations(mixed_lines(quote_view(spark, sf_dir))).groupBy("generation") \
        .agg(F.count(F.lit(1)).alias("n"))


@register("A2_C5_canonical_rows", """
SELECT generation, fromCity, trip, count(*) AS n, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(count(CASE WHEN generation = 'v1.1b' THEN 1 END) AS BIGINT) AS withUrl,
  count(CASE WHEN generation <> 'v1.0' AND trip = '2' THEN 1 END) AS withLeg2,
  count(DISTINCT airlineName) AS airlines, min(depDate) AS firstDep
FROM canon GROUP BY 1, 2, 3
UNION ALL SELECT 'corrupt', NULL, NULL, count(*), NULL, 0, 0, 0, NULL FROM q WHERE """ + TRUNCATED)
def canonical(spark, sf_dir):
    rows = N.canonical_rows(N.tag_generations(mixed_lines(quote_view(spark, sf_dir))))
    return rows.groupBy("generation", "fromCity", "trip").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.count("url").alias("withUrl"), F.count("stops_leg2").alias("withLeg2"),
        F.count_distinct("airlineName").alias("airlines"), F.min("depDate").alias("firstDep"))
