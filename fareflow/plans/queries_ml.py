"""Catalog entries: ranking, quantile bands, folds and exact metrics
(G8, G9, H9, M1-M3, M9, M15-M19, M23, M24) on a scored quote table."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.ml import encode as ENC
from fareflow.ml import metrics as MT
from fareflow.operators import ranking as R
from fareflow.operators.labels import with_drop_label
from fareflow.plans.catalog import add_cte, register
from fareflow.plans.quote_view import quote_view
from fareflow.plans.reports import materialize

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
TIE = [*IDS, "price", "depDate"]
SQL_TIE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, price, depDate"

add_cte("sc", """
SELECT *, ((l_partkey * 31 + l_suppkey * 17 + l_linenumber) % 700 + 300 * label) / 1000.0 AS score FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price, depDate, fromCity, toCity, airlineName, cabin,
    CAST(price - min(price) OVER (PARTITION BY fromCity, toCity ORDER BY (searchDate - DATE '1970-01-01')
         RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) > 20 AS INTEGER) AS label
  FROM q WHERE price > 0)""")


def scored(spark, sf_dir):
    """Quotes with the 19-day drop label and a deterministic score."""
    q = quote_view(spark, sf_dir).filter(F.col("price") > 0)
    lab = with_drop_label(q, ["fromCity", "toCity"], 19, 20.0).withColumnRenamed("priceWillDrop", "label")
    raw = F.pmod(F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber"), F.lit(700))
    return lab.select(*IDS, "price", "depDate", "fromCity", "toCity", "airlineName", "cabin", "label",
                      ((raw + 300 * F.col("label")) / 1000.0).alias("score"))


def scored_table(spark, sf_dir):
    """The columns that metrics read, written once: they pass over it more
    than once."""
    return materialize(scored(spark, sf_dir).select(*TIE, "label", "score"), "scored")


@register("M16_auc_rank_sum", """
WITH per AS (SELECT score, count(*) AS c, sum(label) AS p FROM sc GROUP BY score),
r AS (SELECT *, coalesce(sum(c) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM per),
t AS (SELECT sum(p * (below + (c + 1) / 2.0)) AS rs, sum(p) AS P, sum(c) AS n FROM r)
SELECT (rs - P * (P + 1) / 2.0) / (P * (n - P)) AS auc FROM t""")
def m16(spark, sf_dir):
    return MT.auc(scored_table(spark, sf_dir))


@register("M15_G8_normalized_gini", f"""
WITH n AS (SELECT count(*) AS n FROM sc),
a AS (SELECT label, row_number() OVER (ORDER BY score DESC, {SQL_TIE}) - 1 AS pos FROM sc),
b AS (SELECT label, row_number() OVER (ORDER BY label DESC, {SQL_TIE}) - 1 AS pos FROM sc),
ga AS (SELECT (CAST(sum(label * (n - pos)) AS DOUBLE) / sum(label) - (n + 1) / 2.0) / n AS g FROM a, n GROUP BY n),
gb AS (SELECT (CAST(sum(label * (n - pos)) AS DOUBLE) / sum(label) - (n + 1) / 2.0) / n AS g FROM b, n GROUP BY n)
SELECT ga.g AS gini, gb.g AS giniPerfect, ga.g / gb.g AS normalizedGini FROM ga, gb""")
def m15(spark, sf_dir):
    return MT.gini(scored_table(spark, sf_dir), "label", "score", TIE)


@register("G8_running_label_sum", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, score, label,
  row_number() OVER (ORDER BY score DESC, {SQL_TIE}) - 1 AS pos,
  CAST(sum(label) OVER (ORDER BY score DESC, {SQL_TIE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS BIGINT) AS cumLabel
FROM sc""")
def g8(spark, sf_dir):
    s = scored_table(spark, sf_dir)
    order = [F.desc("score"), *[F.asc(c) for c in TIE]]
    s = R.with_prefix_sums(s, order, {"pos": (None, False), "cumLabel": (F.col("label").cast("long"), True)})
    return s.select(*IDS, "score", "label", "pos", "cumLabel")


@register("M17_rmse", """
SELECT sqrt(CAST(sum((CAST(label AS DECIMAL(18,4)) - CAST(score AS DECIMAL(18,4)))
  * (CAST(label AS DECIMAL(18,4)) - CAST(score AS DECIMAL(18,4)))) AS DOUBLE) / count(*)) AS rmse FROM sc""")
def m17(spark, sf_dir):
    return MT.rmse(scored(spark, sf_dir))


@register("M18_confusion_matrix", """
SELECT label AS actual, CAST(score >= 0.5 AS INTEGER) AS predicted, count(*) AS n FROM sc GROUP BY 1, 2""")
def m18(spark, sf_dir):
    return MT.confusion(scored(spark, sf_dir), threshold=0.5)


@register("M9_F20_best_f1_threshold", """
WITH per AS (SELECT score AS threshold, count(*) AS c, sum(label) AS p FROM sc GROUP BY score),
P AS (SELECT sum(label) AS P FROM sc),
r AS (SELECT threshold, sum(c) OVER (ORDER BY threshold DESC) AS predPos,
             sum(p) OVER (ORDER BY threshold DESC) AS tp FROM per),
f AS (SELECT threshold, 2.0 * tp / (predPos + P) AS f1 FROM r, P)
SELECT f1 AS bestF1, threshold FROM f ORDER BY f1 DESC, threshold DESC LIMIT 1""")
def m9(spark, sf_dir):
    return MT.best_f1_threshold(scored_table(spark, sf_dir))


@register("M19_G9_lift_by_quantile_band", f"""
WITH s AS (SELECT *, row_number() OVER (ORDER BY score, {SQL_TIE}) - 1 AS pos FROM sc),
n AS (SELECT count(*) AS n FROM sc),
pr AS (SELECT p, p * (n - 1) AS h, floor(p * (n - 1)) AS lo, ceil(p * (n - 1)) AS hi
       FROM (SELECT unnest(range(1, 20)) / 20 AS p), n),
e AS (SELECT a.score + (b.score - a.score) * (h - lo) AS edge FROM pr JOIN s a ON a.pos = pr.lo JOIN s b ON b.pos = pr.hi),
ed AS (SELECT list(edge ORDER BY edge) AS edges FROM e)
SELECT CAST(len(list_filter(edges, lambda x: x < score)) AS INTEGER) AS band, count(*) AS n, avg(label) AS rate
FROM sc, ed GROUP BY 1""")
def m19(spark, sf_dir):
    return MT.lift_table(scored_table(spark, sf_dir), "label", "score", 20, TIE)


@register("H9_stratified_folds", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label,
  row_number() OVER (PARTITION BY label ORDER BY (l_partkey * 7919 + l_orderkey) % 10007, {SQL_TIE}) - 1 AS r
  FROM sc)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, CAST(r % 3 AS INTEGER) AS fold FROM r""")
def h9(spark, sf_dir):
    s = scored_table(spark, sf_dir).select(*TIE, "label")
    key = F.pmod(F.col("l_partkey") * 7919 + F.col("l_orderkey"), F.lit(10007))
    return R.stratified_folds(s, "label", 3, TIE, shuffle_key=key).select(*IDS, "label", "fold")


@register("M1_frequency_index", """
SELECT airlineName AS value, count(*) AS count,
  CAST(row_number() OVER (ORDER BY count(*) DESC, airlineName) - 1 AS INTEGER) AS code FROM q GROUP BY airlineName""")
def m1(spark, sf_dir):
    return ENC.frequency_index(quote_view(spark, sf_dir), "airlineName")


@register("M2_M3_one_hot_long", """
WITH mp AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT cabin AS v FROM q))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cabin, code AS hot,
  CAST((SELECT count(*) FROM mp) AS INTEGER) AS size FROM q LEFT JOIN mp ON q.cabin = mp.v""")
def m2(spark, sf_dir):
    q = quote_view(spark, sf_dir)
    return ENC.one_hot_long(q, IDS, "cabin", ENC.alphabetical_index(q, "cabin"))


@register("M24_unseen_levels", """
SELECT DISTINCT fromCity AS level FROM q WHERE fromCity NOT IN (SELECT fromCity FROM q WHERE s_nationkey < 20)""")
def m24(spark, sf_dir):
    q = quote_view(spark, sf_dir)
    return ENC.unseen_levels(q.filter(F.col("s_nationkey") < 20), q, "fromCity")


@register("M23_constant_columns", """
SELECT 'cabin' AS "column", coalesce(min(cabin) = max(cabin), true) AS isConstant FROM q
UNION ALL SELECT 'currency', true FROM q GROUP BY 1
UNION ALL SELECT 'leg2', coalesce(min(CASE WHEN trip = '3' THEN 1 END) = max(CASE WHEN trip = '3' THEN 1 END), true) FROM q
UNION ALL SELECT 'trip', coalesce(min(trip) = max(trip), true) FROM q""")
def m23(spark, sf_dir):
    from fareflow.ml.pipeline import constant_columns
    q = quote_view(spark, sf_dir).select("cabin", F.lit("AUD").alias("currency"),
                                         F.when(F.col("trip") == "3", 1).alias("leg2"), "trip")
    return constant_columns(q)
