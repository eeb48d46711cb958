"""Archives, inventories, file names, empty tables, conversion, reuse."""

import io
import os
import time
import zipfile

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import sinks
from fareflow.plans import reports
from fareflow.sources import archives, files


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_archive_scan_with_final_results_folder(spark, tmpdir_path):
    _zip(os.path.join(tmpdir_path, "fares_SYD_PEK_price_2017-05-11.zip"),
         {"a.txt": '{"price": 1}\n{"price": 2}\n', "final_results/b.txt": '{"price": 3}\n',
          "notes.md": "skip me"})
    _zip(os.path.join(tmpdir_path, "fares_SYD_PVG_price_2017-05-12.zip"), {"c.txt": '{"price": 4}\n\n'})
    rows = archives.read_archives(spark, tmpdir_path)
    got = sorted((os.path.basename(r.archive), r.member, r.line) for r in rows.collect())
    assert [g[1] for g in got] == ["a.txt", "a.txt", "b.txt", "c.txt"]
    parsed = rows.select(F.from_json("line", "price double").alias("j")).select(F.sum("j.price")).first()[0]
    assert parsed == 10.0


def test_inventory_and_name_parsing(spark, tmpdir_path):
    for i, name in enumerate(["fares_SYD_PEK_price_2017-05-11.zip", "fares_MEL_HKG_price_2017-05-14.zip",
                              "other.txt"]):
        with open(os.path.join(tmpdir_path, name), "wb") as fh:
            fh.write(b"x" * (10 + i))
    inv = files.inventory(spark, tmpdir_path, glob="fares_*_price_2017-05-1[1-4]*.zip")
    rows = sorted(inv.select("name", "size", **{}).collect())
    assert [(r.name, r.size) for r in rows] == [("fares_MEL_HKG_price_2017-05-14.zip", 11),
                                                ("fares_SYD_PEK_price_2017-05-11.zip", 10)]
    parsed = inv.select(*[c.alias(n) for n, c in files.parse_archive_name().items()]).orderBy("fromCity").collect()
    assert [(r.fromCity, r.toCity, str(r.fileDate)) for r in parsed] == [("MEL", "HKG", "2017-05-14"),
                                                                         ("SYD", "PEK", "2017-05-11")]
    assert files.inventory_summary(inv, max_size=10).first()["files"] == 1


def test_empty_table_and_convert(spark, tmpdir_path):
    sch = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.ArrayType(T.StringType()))])
    e = sinks.empty_table(spark, sch, os.path.join(tmpdir_path, "empty"))
    assert e.count() == 0 and spark.read.parquet(os.path.join(tmpdir_path, "empty")).schema == sch
    src = os.path.join(tmpdir_path, "src")
    spark.createDataFrame([(1, ["x", "y"])], sch).write.json(src)
    sinks.convert(spark, src, "json", os.path.join(tmpdir_path, "pq"), "parquet", schema=sch)
    assert spark.read.parquet(os.path.join(tmpdir_path, "pq")).first().b == ["x", "y"]
    sinks.convert(spark, os.path.join(tmpdir_path, "pq"), "parquet", os.path.join(tmpdir_path, "csv"), "csv")
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv")).first().b == '["x","y"]'


def test_compaction_file_count(spark, tmpdir_path):
    src, dst = os.path.join(tmpdir_path, "s"), os.path.join(tmpdir_path, "d")
    spark.range(20000).withColumn("v", F.sha2(F.col("id").cast("string"), 256)).repartition(20).write.parquet(src)
    n = sinks.compact(spark, src, dst, target_mb=0.5)
    written = [f for f in os.listdir(dst) if f.endswith(".parquet")]
    assert len(written) == n and spark.read.parquet(dst).count() == 20000


def test_dynamic_partition_overwrite_keeps_other_partitions(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    sinks.write_parquet(df, p, "overwrite", ["k"])
    sinks.write_parquet(spark.createDataFrame([(3, "a")], "v int, k string"), p, "overwrite", ["k"])
    assert sorted((r.v, r.k) for r in spark.read.parquet(p).collect()) == [(2, "b"), (3, "a")]


def test_quarantine_keeps_bad_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "j")
    os.makedirs(p)
    with open(os.path.join(p, "a.txt"), "w") as fh:
        fh.write('{"a": 1}\n{"a": \n{"a": 3}\n')
    good, bad = files.split_quarantine(files.read_json_lines(spark, p, T.StructType(
        [T.StructField("a", T.LongType())]), quarantine=True))
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert [r[files.CORRUPT] for r in bad.collect()] == ['{"a": ']


def test_materialize_gives_up_its_shuffle_files(spark):
    """What a written table was shuffled from does not stay on disk beside it."""
    def kept():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(files.length()) if (n := files.apply(i).getName()).startswith("shuffle_")}
    before = kept()
    m = reports.materialize(spark.range(20_000).repartition(7, "id"), "unit-shuffled")
    for _ in range(50):
        if not kept() - before:
            break
        time.sleep(0.1)
    assert not kept() - before
    assert m.count() == 20_000 and m.agg(F.sum("id")).first()[0] == 199_990_000


def test_materialize_and_persist(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    m = reports.materialize(df, "unit")
    assert m.agg(F.sum("x")).first()[0] == 9900
    with reports.persisted(df) as c:
        assert c.count() == 100 and c.is_cached
    assert not df.is_cached


def test_broken_archive_and_member_paths(spark, tmpdir_path):
    _zip(os.path.join(tmpdir_path, "a.zip"), {"x/a.txt": "1\n", "y/a.txt": "2\n", "x/final_results/b.txt": "3\n"})
    with open(os.path.join(tmpdir_path, "b.zip"), "wb") as fh:
        fh.write(b"PK not an archive")
    rows = archives.read_archives(spark, tmpdir_path).collect()
    good = sorted((r.member, r.line) for r in rows if r.error is None)
    assert good == [("x/a.txt", "1"), ("x/b.txt", "3"), ("y/a.txt", "2")]
    bad = [r for r in rows if r.error is not None]
    assert len(bad) == 1 and bad[0].archive.endswith("b.zip") and bad[0].line is None


def test_hot_partition_key_and_cluster_value_are_split(spark, tmpdir_path):
    df = spark.range(40000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("hot").alias("k"),
                                   F.sha2(F.col("id").cast("string"), 512).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        p = os.path.join(tmpdir_path, "hot")
        sinks.write_parquet(df.repartition(8), p, partition_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(os.path.join(p, "k=hot")) if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(p).count() == 40000
    src, dst = os.path.join(tmpdir_path, "s"), os.path.join(tmpdir_path, "d")
    df.repartition(20).write.parquet(src)
    n = sinks.compact(spark, src, dst, target_mb=0.5, cluster_by=["k"])
    assert n > 2 and len([f for f in os.listdir(dst) if f.endswith(".parquet")]) == n


def test_streams_with_own_checkpoints_share_a_target(spark, tmpdir_path):
    from fareflow.streaming.ingest import ingest_available
    schema = T.StructType([T.StructField("a", T.LongType())])
    dst = os.path.join(tmpdir_path, "dst")
    for i in (1, 2):
        src = os.path.join(tmpdir_path, f"src{i}")
        spark.createDataFrame([(f'{{"a": {i}}}',)], "value string").write.text(src)
        for _ in range(2):
            ingest_available(spark, src, dst, os.path.join(tmpdir_path, f"ck{i}"), schema)
    assert sorted(r.a for r in spark.read.parquet(dst).collect()) == [1, 2]


def test_stream_without_quarantine_fails_on_malformed_lines(spark, tmpdir_path):
    from fareflow.streaming.ingest import ingest_available
    schema = T.StructType([T.StructField("a", T.LongType())])
    src, dst, ck, bad = (os.path.join(tmpdir_path, x) for x in ("src", "dst", "ck", "bad"))
    spark.createDataFrame([('{"a": 1}',), ('{"a": ',)], "value string").coalesce(1).write.text(src)
    with pytest.raises(Exception, match="no quarantine given"):
        ingest_available(spark, src, dst, ck, schema)
    ingest_available(spark, src, dst, ck, schema, quarantine=bad)  # the file was not committed
    assert [r.a for r in spark.read.parquet(dst).collect()] == [1]
    assert spark.read.parquet(bad).count() == 1


def test_broken_input_fails_or_is_kept(spark, tmpdir_path):
    """A broken document, CSV line or JSON line never becomes a row of nulls."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from pyspark.sql import types as T
    from fareflow import sinks as K
    from fareflow.sources import files as FS
    fails = (PySparkException, Py4JJavaError)
    sch = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    docs, lines, csv = (f"{tmpdir_path}/{x}" for x in ("docs", "lines", "csv"))
    for path, rows in ((f"{docs}/one", ['[{"a": 1, "b": "x"}, {"a": 2}]']), (f"{docs}/two", ['{"a": 3, "b"']),
                       (lines, ['{"a": 1}', '{"a": ']), (csv, ["a,b", "1,x", "oops,y", "2,z,more"])):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    with pytest.raises(fails):
        FS.read_json_documents(spark, docs, sch).collect()
    good, bad = FS.split_quarantine(FS.read_json_documents(spark, docs, sch, quarantine=True))
    assert sorted(r.a for r in good.collect()) == [1, 2]
    assert [r[FS.CORRUPT].strip() for r in bad.collect()] == ['{"a": 3, "b"']
    with pytest.raises(fails):
        FS.read_csv(spark, csv, "a int, b string").collect()
    with pytest.raises(fails):
        FS.read_csv(spark, csv, "a int, b string").select("b").collect()
    good, bad = FS.split_quarantine(FS.read_csv(spark, csv, "a int, b string", quarantine=True))
    assert [tuple(r) for r in good.collect()] == [(1, "x")]
    assert sorted(r[FS.CORRUPT] for r in bad.collect()) == ["2,z,more", "oops,y"]
    assert FS.read_csv(spark, csv, "a int, b string", drop_malformed=True).collect() == [(1, "x")]
    for src, fmt in ((lines, "json"), (csv, "csv")):
        with pytest.raises(fails):
            K.convert(spark, src, fmt, f"{tmpdir_path}/out-{fmt}", "parquet", sch)
        with pytest.raises(fails):  # nothing was written
            spark.read.parquet(f"{tmpdir_path}/out-{fmt}").count()


def test_pivots_keep_values_outside_the_list(spark):
    from fareflow.operators.explore import pivot_first
    df = spark.createDataFrame([(1, "a", 5), (1, "new", 3), (1, None, 2), (2, "a", 1)], "k int, c string, v int")
    got = {r.k: (r.a, r.other) for r in pivot_first(df, ["k"], "c", "v", ["a"]).collect()}
    assert got == {1: (5, 2), 2: (1, None)}


def test_chosen_buckets_only(spark, tmpdir_path):
    from fareflow import sinks as K
    from fareflow.sources.tables import read_buckets
    K.bucket_export(spark.range(40), f"{tmpdir_path}/b", 4, ["id"])
    got = read_buckets(spark, f"{tmpdir_path}/b", [1, 3])
    assert {r.bucket for r in got.collect()} == {1, 3}
    assert not any("bucket=0" in f or "bucket=2" in f for f in got.inputFiles())


def test_table_rows_with_spans_and_nesting(spark):
    from fareflow.sources.html import table_rows
    page = ("<table><caption>c</caption><tr><th rowspan=3>r<th colspan='2'>top &lt;1&gt;</tr><tr><td>a<td>b<tr><td>c</td>"
            "<td rowspan=2>d <table><tr><td>in</td></tr></table> e</td></tr><tr><td>f</td><td>g</td></tr></table><tr><td>no")
    rows = [(1, page), (2, None), (3, "<p>none</p>"), (4, "<table><tr></tr><tr><td></td></tr>"), (1, "<table><tr><td colspan=x>z")]
    df = spark.createDataFrame(rows, "page_id int, html string")
    got = sorted((r.page_id, r.table, r.row, r.cells) for r in table_rows(df).collect())
    assert got == sorted([(1, 0, 0, ["r", "top <1>", "top <1>"]), (1, 0, 1, ["r", "a", "b"]), (1, 0, 2, ["r", "c", "d e"]),
                          (1, 0, 3, ["f", "g", "d e"]), (1, 1, 0, ["in"]), (1, 0, 0, ["z"]), (4, 0, 0, []), (4, 0, 1, [""])])


def test_only_folders_with_small_files_are_packed(spark, tmpdir_path):
    import os
    path, layout = f"{tmpdir_path}/t", ["fromCity", "toCity", "searchMonth"]
    rows = [(i, f"A {i % 3}", f"B%{i % 2}", 201701 + i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, fromCity string, toCity string, searchMonth int")
    for k in range(3):
        df.where(f"id % 3 = {k} OR fromCity = 'A 1'").where(f"{k} = 0 OR fromCity <> 'A 2'").repartition(1) \
            .write.mode("append").partitionBy(*layout).parquet(path)
    want = sorted(map(tuple, spark.read.parquet(path).select(df.columns).collect()))
    before = {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    folders = {d for d, _, fs in os.walk(path) if sum(f.endswith(".parquet") for f in fs) > 1}
    assert sinks.compact_partitions(spark, path, layout, folders_at_once=2) == len(folders) > 1
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, spark.read.parquet(path).select(df.columns).collect())) == want
    per = [[f for f in fs if f.endswith(".parquet")] for _, _, fs in os.walk(path)]
    assert {len(f) for f in per if f} == {1}
    after = {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert any(before.get(f) == t for f, t in after.items())  # other folders were left alone
    assert sinks.compact_partitions(spark, path, layout) == 0


def test_bins_keep_the_size_target(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    spark.range(40_000).selectExpr("id", "uuid() AS u", "1 AS p").repartition(40).write.partitionBy("p").parquet(path)
    sizes = {r.path: r.size for r in files.inventory(spark, path, glob="*.parquet").collect()}
    target = 3.5 * max(sizes.values()) / 1024 / 1024
    plan = sinks.small_file_plan(spark, path, target).collect()
    bins = {}
    for r in plan:
        bins[r.bin] = bins.get(r.bin, 0) + sizes[r.file]
    assert len(plan) == 40 and max(bins.values()) <= target * 1024 * 1024 and len(bins) > 5
    assert sinks.compact_partitions(spark, path, ["p"], target) == 1
    assert spark.read.parquet(path).select("id").distinct().count() == 40_000
    assert files.inventory(spark, path, glob="*.parquet").count() == len(bins)


def test_rows_are_appended_once_without_shuffling_the_table(spark, tmpdir_path):
    name, path = "once_" + tmpdir_path[-8:].replace("-", "_").lower(), f"{tmpdir_path}/once"
    kind = "k int, s string, v int"
    first = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (None, None, 4)], kind)
    assert sinks.append_new(first, name, ["k", "s"], path, 4).count() == 3
    more = spark.createDataFrame([(1, "a", 9), (2, None, 9), (None, None, 9), (2, "b", 5), (3, None, 6), (3, None, 6)], kind)
    assert sorted(map(str, sinks.append_new(more, name, ["k", "s"], path, 4).collect())) == sorted(
        map(str, [type(first.first())(k=2, s="b", v=5), type(first.first())(k=3, s=None, v=6)]))
    assert spark.table(name).count() == 5
    big = spark.range(1000).selectExpr("cast(id as int) k", "concat('a', id % 3) s", "1 v")
    plan = sinks.not_in_table(big, spark.table(name), ["k", "s"])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan[:plan.index("Bucketed: true")].count("Exchange") == 1, plan
    spark.sql(f"DROP TABLE {name}")


def test_a_new_table_has_buckets_for_its_rows(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 100)
    name, path = "sized_" + tmpdir_path[-8:].replace("-", "_").lower(), f"{tmpdir_path}/sized"
    rows = spark.range(1000).selectExpr("id k", "if(id % 7 = 0, null, id) v")
    sinks.append_new(rows.where("k < 950"), name, ["k", "v"], path, least=2)
    assert sinks.bucket_count(spark, name) == 10
    assert sinks.append_new(rows, name, ["k", "v"], path).count() == 50
    assert sinks.bucket_count(spark, name) == 10 and spark.table(name).count() == 1000
    assert files.inventory(spark, path, glob="*.parquet").count() <= 20
    spark.sql(f"DROP TABLE {name}")


def test_many_lines_of_one_name_are_dealt_to_more_archives(spark, tmpdir_path, monkeypatch):
    from fareflow.sources import archives as AR
    monkeypatch.setattr(AR, "ARCHIVE_LINES", 50)
    monkeypatch.setattr(AR, "CHUNK_CHARS", 100)
    lines = spark.range(1000).select(F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("name"),
                                     F.concat(F.lit("line "), "id").alias("line"), F.lit("m.txt").alias("member"))
    dealt, count = AR.dealt_archives(lines, "name")
    sizes = [r["count"] for r in dealt.groupBy("archive").count().collect()]
    assert max(sizes) <= 100 and len(sizes) <= count == 36 and sum(sizes) == 1000
    AR.write_archives(dealt, tmpdir_path).count()
    back = AR.read_archives(spark, tmpdir_path)
    assert sorted(r.line for r in back.collect()) == sorted(r.line for r in lines.collect())
    monkeypatch.setattr(AR, "ARCHIVE_LINES", 5000)
    dealt, count = AR.dealt_archives(lines, "name")
    assert count == 2 and sorted(r.archive for r in dealt.select("archive").distinct().collect()) == ["big.zip", "small.zip"]
