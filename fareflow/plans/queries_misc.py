"""Catalog entries: cast conformance, schema report, take / fixed-size
sample, chunking (C8, C18, H4, H6, H11, F13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.operators import explore as X
from fareflow.operators import splits as S
from fareflow.operators.normalize import schema_table
from fareflow.plans.catalog import register
from fareflow.plans.quote_view import quote_view

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("C8_cast_failures", """
UNPIVOT (SELECT
  count(*) FILTER (WHERE durationText IS NOT NULL AND TRY_CAST(durationText AS INTEGER) IS NULL) AS durationText,
  count(*) FILTER (WHERE CAST(ticketsLeft AS VARCHAR) IS NOT NULL AND TRY_CAST(CAST(ticketsLeft AS VARCHAR) AS TINYINT) IS NULL) AS ticketsText,
  count(*) FILTER (WHERE substr(airlineCode, 2) IS NOT NULL AND TRY_CAST(substr(airlineCode, 2) AS INTEGER) IS NULL) AS codeNumber,
  count(*) FILTER (WHERE CAST(searchDate AS VARCHAR) || 'x' IS NOT NULL AND TRY_CAST(CAST(searchDate AS VARCHAR) || CASE WHEN l_linenumber = 2 THEN 'x' ELSE '' END AS DATE) IS NULL) AS dateText
FROM q) ON COLUMNS(*) INTO NAME "column" VALUE failures""")
def c8(spark, sf_dir):
    q = quote_view(spark, sf_dir).select(
        "durationText", F.col("ticketsLeft").cast("string").alias("ticketsText"),
        F.substring("airlineCode", 2, 10).alias("codeNumber"),
        F.concat(F.col("searchDate").cast("string"),
                 F.when(F.col("l_linenumber") == 2, "x").otherwise("")).alias("dateText"))
    return X.cast_failures(q, {"durationText": "int", "ticketsText": "tinyint", "codeNumber": "int",
                               "dateText": "date"})


@register("C18_schema_report", """
WITH t AS (SELECT * EXCLUDE (value), value AS type FROM (
  UNPIVOT (SELECT typeof(any_value(COLUMNS(*))) FROM q) ON COLUMNS(*) INTO NAME name VALUE value)),
n AS (UNPIVOT (SELECT count(*) - count(COLUMNS(*)) FROM q) ON COLUMNS(*) INTO NAME name VALUE nulls)
SELECT name, CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(type) END AS type, nulls
FROM t JOIN n USING (name)""")
def c18(spark, sf_dir):
    """Schema (name, type) with each column's NULL count from one pass."""
    q = quote_view(spark, sf_dir)
    nulls = X.null_counts(q).withColumnRenamed("column", "name")
    return schema_table(q).join(nulls, "name", "left")


@register("H4_take_n", "SELECT least(count(*), 20) AS n, 0::BIGINT AS notInTable FROM q")
def h4(spark, sf_dir):
    """Any 20 rows will do: how many there are, and how many are no row of the table."""
    q = quote_view(spark, sf_dir).select(*IDS, "price")
    taken = S.take(q, 20)
    strange = taken.join(q, [*IDS, "price"], "left_anti").agg(F.count(F.lit(1))).scalar()
    return taken.agg(F.count(F.lit(1)).alias("n"), F.max(strange).alias("notInTable"))


@register("H6_fixed_size_sample", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price FROM q
ORDER BY (l_orderkey * 7919 + l_linenumber) % 10007, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50""")
def h6(spark, sf_dir):
    b = F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber"), F.lit(10007))
    return S.fixed_size_sample(quote_view(spark, sf_dir).select(*IDS, "price"), 50, IDS, bucket_expr=b)


@register("H11_chunk_ranges", """
SELECT l_orderkey, CAST(floor((row_number() OVER (ORDER BY l_orderkey) - 1) * 7 / count(*) OVER ()) AS INTEGER)
  AS chunk FROM (SELECT DISTINCT l_orderkey FROM q)""")
def h11(spark, sf_dir):
    keys = quote_view(spark, sf_dir).select("l_orderkey").distinct()
    return S.chunk(keys, 7, ["l_orderkey"])


@register("F13_freq_items_sketch")
def f13a(spark, sf_dir):
    return X.frequent_items_approx(quote_view(spark, sf_dir), ["cabin", "trip"], 0.1)
