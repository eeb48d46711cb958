"""Catalog entries: sources, sinks, quarantine and incremental ingest
(A1-A17, B1-B12, P1, L9).  Each entry writes data derived from the driver
tables to a fresh folder under the shared checkpoint dir and reads it back
through the operator under test."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import sinks as K
from fareflow.operators import explore as X
from fareflow.plans.catalog import register
from fareflow.plans.quote_view import quote_view
from fareflow.session import stage_path
from fareflow.sources import files as FS
from fareflow.sources import html as H
from fareflow.sources.tables import load_table, read_buckets, read_parquet_roots
from fareflow.streaming.ingest import ingest_available

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
NTZ = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def _events(spark, sf_dir):
    return load_table(spark, sf_dir, "events")


@register("A1_B9_json_lines_round_trip", "SELECT * FROM events")
def a1(spark, sf_dir):
    p = stage_path(spark, "events-json")
    K.write_json(_events(spark, sf_dir), p)
    return FS.read_json_lines(spark, p, EVENTS_SCHEMA, options=NTZ)


@register("B11_quarantine_split", """
SELECT (SELECT count(*) FROM events WHERE event_id % 50 = 0) AS quarantined,
       (SELECT count(*) FROM events WHERE event_id % 50 <> 0) AS good,
       (SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) FROM events WHERE event_id % 50 <> 0) AS goodValue""")
def b11(spark, sf_dir):
    p = stage_path(spark, "events-corrupt")
    ev = _events(spark, sf_dir)
    js = F.to_json(F.struct(*ev.columns), NTZ)
    # every 50th line is cut short: a malformed document
    lines = ev.select(F.when(F.col("event_id") % 50 == 0, F.substring(js, 1, 20)).otherwise(js).alias("value"))
    lines.write.text(p)
    good, bad = FS.split_quarantine(FS.read_json_lines(spark, p, EVENTS_SCHEMA, quarantine=True, options=NTZ))
    qdir = stage_path(spark, "quarantine")
    bad.write.parquet(qdir)  # the exception area; the run itself continues
    nbad = spark.read.parquet(qdir).agg(F.count(F.lit(1))).scalar()
    return good.agg(nbad.alias("quarantined"), F.count(F.lit(1)).alias("good"),
                    X.exact_sum("value").alias("goodValue"))


@register("A3_A5_B4_partitioned_parquet", f"""
SELECT {SQL_IDS}, price, searchMonth, fromCity, strftime(searchDate, '%Y') AS searchYear FROM (
  SELECT *, strftime(searchDate, '%Y%m') AS searchMonth FROM q)
WHERE fromCity IN ('NATION_1', 'NATION_2') AND searchMonth >= '199801'""")
def a5(spark, sf_dir):
    p = stage_path(spark, "quotes-by-route")
    q = K.with_search_month(quote_view(spark, sf_dir).select(*IDS, "price", "fromCity", "searchDate")) \
        .withColumn("searchYear", F.date_format("searchDate", "yyyy")).drop("searchDate")
    K.write_parquet(q, p, "errorifexists", ["fromCity", "searchYear"])
    back = spark.read.schema(q.schema).parquet(p)
    # partition filters prune folders; the month filter is pushed into the scan
    return back.filter(F.col("fromCity").isin("NATION_1", "NATION_2") & (F.col("searchMonth") >= "199801"))


@register("B1_B2_B3_write_modes", f"""
SELECT {SQL_IDS}, price FROM q WHERE trip = '1'
UNION ALL SELECT {SQL_IDS}, price FROM q WHERE trip = '2'""")
def b1(spark, sf_dir):
    p = stage_path(spark, "modes")
    q = quote_view(spark, sf_dir).select(*IDS, "price", "trip")
    K.write_parquet(q.filter(F.col("trip") == "2").drop("trip"), p, "errorifexists")
    K.write_parquet(q.drop("trip"), p, "overwrite")          # replaced ...
    K.write_parquet(q.filter(F.col("trip") == "2").drop("trip"), p, "overwrite")  # ... and replaced again
    K.write_parquet(q.filter(F.col("trip") == "1").drop("trip"), p, "append")
    return spark.read.parquet(p)


@register("B5_compaction", f"SELECT {SQL_IDS}, price, cabin FROM q")
def b5(spark, sf_dir):
    src, dst = stage_path(spark, "small-files"), stage_path(spark, "compacted")
    quote_view(spark, sf_dir).select(*IDS, "price", "cabin").repartition(24).write.parquet(src)
    K.compact(spark, src, dst, target_mb=1.0, cluster_by=["cabin"])
    return spark.read.parquet(dst)


@register("B4_B5_pack_small_files", f"""
SELECT {SQL_IDS}, price, r_name AS fromCity, strftime(searchDate, '%Y%m') AS searchMonth
FROM q JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def pack_small_files(spark, sf_dir):
    """Region x month folders (the given tables hold about one row for each
    city pair and month), written by two loads, packed to one file each; a
    second run rewrites nothing."""
    nation, region = (load_table(spark, sf_dir, t) for t in ("nation", "region"))
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("fromRegion"))
    rows = quote_view(spark, sf_dir).join(F.broadcast(place), "s_nationkey") \
        .select(*IDS, "price", F.col("fromRegion").alias("fromCity"), "searchDate")
    rows = K.with_search_month(rows).drop("searchDate")
    layout, p = ["fromCity", "searchMonth"], stage_path(spark, "route-months")
    for odd in (0, 1):
        K.write_parquet(rows.where(F.col("l_orderkey") % 2 == odd), p, "append", layout)
    if not K.compact_partitions(spark, p, layout) or K.compact_partitions(spark, p, layout):
        raise AssertionError("small files are packed once")
    return spark.read.parquet(p).withColumn("searchMonth", F.col("searchMonth").cast("string"))


@register("F15_append_once", f"SELECT DISTINCT {SQL_IDS}, price FROM q")
def append_once(spark, sf_dir):
    """One folder loaded twice and a larger one after it: each quote once."""
    import uuid
    q = quote_view(spark, sf_dir).select(*IDS, "price")
    keys, table, p = [*IDS, "price"], f"quotes_{uuid.uuid4().hex[:10]}", stage_path(spark, "append-once")
    for part in (q.where("l_linenumber <= 4"), q.where("l_linenumber <= 4"), q):
        K.append_new(part, table, keys, p, least=8)
    return spark.table(table)


@register("B6_A4_consolidate_folders", f"""
SELECT {SQL_IDS}, price, fromCity, toCity, strftime(searchDate, '%Y%m') AS searchMonth FROM q""")
def b6(spark, sf_dir):
    q = quote_view(spark, sf_dir).select(*IDS, "price", "fromCity", "toCity", "searchDate", "airlineName")
    folders = []
    for lo, hi in ((1, 9), (10, 17), (18, 25)):  # three route folders
        f = stage_path(spark, f"route-{lo}")
        num = F.substring("airlineName", 7, 3).cast("int")
        q.filter(num.between(lo, hi)).drop("airlineName").write.parquet(f)
        folders.append(f)
    out = stage_path(spark, "consolidated")
    # one folder per route; the month stays a column, as the given tables hold
    # a few rows for each of some 50 000 routes x months
    K.consolidate(spark, folders, out, partition_by=("fromCity", "toCity"))
    back = read_parquet_roots(spark, out)
    return back.select(*IDS, "price", "fromCity", "toCity", F.col("searchMonth").cast("string"))


@register("B8_csv_round_trip", f"""
SELECT {SQL_IDS}, cabin, price, searchDate,
  CAST(to_json(list_filter(string_split(stopInfo, ';'), lambda x: x <> '')) AS VARCHAR) AS stops FROM q""")
def b8(spark, sf_dir):
    from fareflow.functions.text import stop_list
    p = stage_path(spark, "csv")
    q = quote_view(spark, sf_dir)
    out = q.select(*IDS, "cabin", "price", "searchDate",
                   F.transform(stop_list("stopInfo"),
                               lambda s: F.concat_ws(":", s.getField("loc"), s.getField("duration"))).alias("stops"))
    K.write_csv(out, p, sep=",")
    sch = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, cabin string, " \
          "price double, searchDate date, stops string"
    return FS.read_csv(spark, p, sch, header=True)


@register("A6_A7_A8_tsv_drop_malformed", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def a6(spark, sf_dir):
    p = stage_path(spark, "tsv")
    nat = load_table(spark, sf_dir, "nation")
    good = nat.select(F.concat_ws("\t", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    junk = nat.select(F.concat_ws("\t", F.concat(F.lit("x"), F.col("n_nationkey").cast("string")), "n_name")
                      .alias("value"))
    header = spark.range(1).select(F.lit("n_nationkey\tn_name\tn_regionkey").alias("value"))
    header.unionByName(good).unionByName(junk).coalesce(1).write.text(p)
    return FS.read_csv(spark, p, "n_nationkey int, n_name string, n_regionkey int", header=True, sep="\t",
                       drop_malformed=True)


@register("A9_text_fields", """
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, l_returnflag AS flag, CAST(l_tax AS VARCHAR) AS tax,
  NULL::VARCHAR AS missing FROM lineitem""")
def a9(spark, sf_dir):
    p = stage_path(spark, "text")
    li = load_table(spark, sf_dir, "lineitem")
    li.select(F.concat_ws(",", "l_orderkey", "l_partkey", "l_returnflag", "l_tax").alias("value")).write.text(p)
    return FS.read_text_fields(spark, p, ",", {"orderkey": 0, "flag": 2, "tax": 3, "missing": 9})


@register("A10_multiline_json_documents", "SELECT * FROM events")
def a10(spark, sf_dir):
    p, lines = stage_path(spark, "docs"), stage_path(spark, "doc-lines")
    ev = _events(spark, sf_dir)
    # bounded documents: one JSON array of at most 5000 events per file
    docs = (ev.withColumn("doc", F.floor(F.col("event_id") / 5000))
            .groupBy("doc").agg(F.to_json(F.collect_list(F.struct(*ev.columns)), NTZ).alias("value")))
    docs.repartition("doc").write.partitionBy("doc").text(p)
    # conversion job: documents -> JSON lines, then a plain JSON-lines scan
    FS.json_documents_to_lines(spark, p, lines, EVENTS_SCHEMA, options=NTZ)
    return FS.read_json_lines(spark, lines, EVENTS_SCHEMA, options=NTZ)


@register("A13_file_inventory", """
SELECT CAST(l_orderkey % 8 AS VARCHAR) AS folder, CAST(sum(octet_length(encode(airlineName || ';' || cabin)) + 1) AS BIGINT)
  AS bytes, TRUE AS hasFiles FROM q GROUP BY 1""")
def a13(spark, sf_dir):
    """Bytes of every folder by the inventory, against the lines written there."""
    p = stage_path(spark, "inv")
    quote_view(spark, sf_dir).select(F.pmod("l_orderkey", F.lit(8)).alias("folder"),
                                     F.concat_ws(";", "airlineName", "cabin").alias("value")) \
        .write.partitionBy("folder").text(p)
    inv = FS.inventory(spark, p, glob="*.txt").withColumn("folder", F.regexp_extract("path", "folder=([0-9]+)/", 1))
    return inv.groupBy("folder").agg(F.sum("size").alias("bytes"), (F.count(F.lit(1)) > 0).alias("hasFiles"))


@register("A17_html_link_rows", """
WITH lm AS (
  SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">(.*?)</a></li>', 1) AS hrefs,
         regexp_extract_all(html, '<li><a href="([^"]*)">(.*?)</a></li>', 2) AS texts FROM pages),
e AS (SELECT page_id, unnest(range(len(hrefs))) AS pos, unnest(hrefs) AS href, unnest(texts) AS t FROM lm)
SELECT page_id, CAST(pos AS INTEGER) AS pos, href, trim(regexp_replace(t, '<[^>]+>', '', 'g')) AS text FROM e""")
def a17(spark, sf_dir):
    return H.link_rows(load_table(spark, sf_dir, "pages"))


@register("A17_html_table_rows", """
SELECT page_id, 0 AS "table", 0 AS "row", [url, url] AS cells FROM pages
UNION ALL SELECT page_id, 0, 1, [CAST(page_id AS VARCHAR), CAST(length(html) AS VARCHAR)] FROM pages
UNION ALL SELECT page_id, 0, 2, [CAST(page_id AS VARCHAR), 'A & B'] FROM pages
UNION ALL SELECT page_id, 1, 0, ['x', 'y ' || CAST(page_id % 7 AS VARCHAR)] FROM pages WHERE page_id % 2 = 0""")
def a17_tables(spark, sf_dir):
    """Two tables a page, made of the page's own fields: spans over columns and
    rows, references, missing end tags."""
    page, size = F.col("page_id").cast("string"), F.length("html").cast("string")
    first = F.concat(F.lit("<p>t</p><table><thead><tr><th colspan=2>"), F.col("url"), F.lit("</th></tr></thead><tr><td rowspan='2'> "),
                     page, F.lit("</td><td><b>"), size, F.lit("</b></td></tr><tr><td>A &amp;\n B</td></tr></table>"))
    second = F.concat(F.lit("<TABLE><TR><TD>x<TD>y "), (F.col("page_id") % 7).cast("string"), F.lit("</table>"))
    pages = load_table(spark, sf_dir, "pages").select(
        "page_id", F.concat(first, F.when(F.col("page_id") % 2 == 0, second).otherwise("")).alias("html"))
    return H.table_rows(pages)


@register("B10_A18_bucket_export", f"SELECT {SQL_IDS}, price, CAST(l_orderkey % 8 AS INTEGER) AS bucket FROM q")
def b10(spark, sf_dir):
    p = stage_path(spark, "buckets")
    q = quote_view(spark, sf_dir).select(*IDS, "price")
    K.bucket_export(q, p, 8, bucket_expr=F.pmod(F.col("l_orderkey"), F.lit(8)))
    return spark.read.parquet(p)


@register("A18_chosen_buckets", f"SELECT {SQL_IDS}, price, CAST(l_orderkey % 8 AS INTEGER) AS bucket FROM q "
                                "WHERE l_orderkey % 8 IN (1, 6)")
def a18(spark, sf_dir):
    """Two of the exported buckets; the other folders are not listed."""
    p = stage_path(spark, "chosen-buckets")
    q = quote_view(spark, sf_dir).select(*IDS, "price")
    K.bucket_export(q, p, 8, bucket_expr=F.pmod(F.col("l_orderkey"), F.lit(8)))
    return read_buckets(spark, p, [1, 6])


@register("B12_sql_over_nested_view", """
SELECT fromCity, 'D' || CAST(l_partkey % 50 AS VARCHAR) AS depAirport, count(*) AS n FROM q
GROUP BY 1, 2""")
def b12(spark, sf_dir):
    import uuid
    from fareflow.plans.documents import v1_1_documents
    name = "nested_" + uuid.uuid4().hex[:8]
    v1_1_documents(quote_view(spark, sf_dir), "b").createOrReplaceTempView(name)
    return spark.sql(f"SELECT fromCity, quote_leg1.departureLocation.airportCode AS depAirport, "
                     f"count(*) AS n FROM {name} GROUP BY 1, 2")


@register("P1_incremental_ingest", """
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_id % 50 <> 0""")
def p1(spark, sf_dir):
    src, dst = stage_path(spark, "landing"), stage_path(spark, "ingested")
    ck, bad = stage_path(spark, "ingest-ckpt"), stage_path(spark, "ingest-quarantine")
    ev = _events(spark, sf_dir)
    js = F.to_json(F.struct(*ev.columns), NTZ)
    lines = ev.select(F.when(F.col("event_id") % 50 == 0, F.substring(js, 1, 20)).otherwise(js).alias("value"),
                      F.pmod(F.col("event_id"), F.lit(12)).alias("f"))
    # two arrivals of files in the landing folder; the second run must pick
    # up only the new ones, the third finds nothing
    lines.filter(F.col("f") < 6).drop("f").repartition(6).write.mode("append").text(src)
    ingest_available(spark, src, dst, ck, EVENTS_SCHEMA, max_files=2, quarantine=bad)
    lines.filter(F.col("f").between(6, 8)).drop("f").repartition(4).write.mode("append").text(src)
    ingest_available(spark, src, dst, ck, EVENTS_SCHEMA, max_files=2, quarantine=bad)
    ingest_available(spark, src, dst, ck, EVENTS_SCHEMA, max_files=2, quarantine=bad)
    # another stream with a checkpoint of its own adds to the same target
    other = stage_path(spark, "landing-2")
    lines.filter(F.col("f") > 8).drop("f").repartition(3).write.text(other)
    ingest_available(spark, other, dst, stage_path(spark, "ingest-ckpt-2"), EVENTS_SCHEMA, max_files=2,
                     quarantine=bad)
    return spark.read.parquet(dst).select(*EVENTS_SCHEMA.fieldNames())
