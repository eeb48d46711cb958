"""Plan checks: native expressions only, pushed filters, pruned scans,
broadcast of bounded dimensions, partition pruning, late cut-off filter."""

import pytest

from fareflow.plans.model_table import build_model_table
from fareflow.plans.quote_view import model_source, quote_view

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_model_table_has_no_python_and_broadcasts_nation(spark):
    df = build_model_table(model_source(quote_view(spark, SF_SMALL)))
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan


def test_price_filter_is_pushed_and_scan_pruned(spark):
    from fareflow.operators.labels import with_drop_label
    df = with_drop_label(quote_view(spark, SF_SMALL).filter("price > 0"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_extendedprice,0.0)" in plan
    assert "l_tax" not in plan and "l_comment" not in plan  # unused columns never read


def test_nested_normalisation_is_native(spark):
    from fareflow.operators.normalize import normalize_v1_1
    from fareflow.plans.documents import json_round_trip, v1_1_documents
    from fareflow.schemas import V1_1B_DOC
    df = normalize_v1_1(json_round_trip(v1_1_documents(quote_view(spark, SF_SMALL), "b"), V1_1B_DOC))
    assert len(df.columns) == 89
    assert "BatchEvalPython" not in _plan(df)


def test_cutoff_stays_above_the_label(spark):
    src = model_source(quote_view(spark, SF_SMALL))
    full = build_model_table(src)
    cut = build_model_table(src, cutoff="1997-01-01")
    a = {tuple(r) for r in full.filter("searchDate <= DATE'1997-01-01'").select(
        "routeCombKey", "price", "futureMinPrice").collect()}
    b = {tuple(r) for r in cut.select("routeCombKey", "price", "futureMinPrice").collect()}
    assert a == b


def test_partition_filters_reach_the_scan(spark, tmpdir_path):
    import os
    from pyspark.sql import functions as F
    from fareflow import sinks
    p = os.path.join(tmpdir_path, "p")
    q = quote_view(spark, SF_SMALL).select("price", "fromCity", "searchDate")
    sinks.write_parquet(sinks.with_search_month(q), p, "errorifexists", ["fromCity"])
    df = spark.read.parquet(p).filter((F.col("fromCity") == "NATION_1") & (F.col("price") > 1000))
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(fromCity" in plan and "PushedFilters: [IsNotNull(price), GreaterThan(price" in plan


def test_label_window_runs_on_the_daily_aggregate(spark):
    """The range window sees one row per (route, day), never the raw quotes."""
    from pyspark.sql import functions as F
    from fareflow.operators.labels import with_future_min
    q = quote_view(spark, SF_SMALL).select("fromCity", "toCity", "searchDate", "price")
    plan = _plan(with_future_min(q, ["fromCity", "toCity"]))
    win = plan[plan.index("Window ["):]
    assert "partial_min(" in win  # map-side pre-aggregation feeds the window
    assert "RangeFrame" in plan


def _row_shuffles(df):
    """Exchanges by a hash or range of the first plan section, and any by one partition under a window."""
    plan = _plan(df)
    return plan.count("hashpartitioning(") + plan.count("rangepartitioning("), plan


def test_global_order_statistics_shuffle_rows_once(spark, monkeypatch):
    """Bounds are literals, so the range is a plain column: one shuffle for
    each statistic, no checkpoint, no window over all rows."""
    from pyspark.sql import functions as F
    from fareflow.ml import metrics
    from fareflow.operators import ranking
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 100)
    df = spark.range(1000).withColumns({"s": F.col("id") % 7, "label": (F.col("id") % 3 == 0).cast("int")})
    for out in (ranking.with_position(df, [F.desc("s"), F.asc("id")]),
                ranking.with_prefix_sums(df, ["s", "id"], {"a": (None, False), "b": ("label", True)}),
                ranking.with_rank_in_group(df, ["label"], ["id"]),
                metrics.auc(df, "label", "id")):
        shuffles, plan = _row_shuffles(out)
        assert shuffles == 1 and f"hashpartitioning({ranking.RANGE}" in plan
        assert "Scan ExistingRDD" not in plan  # what a checkpoint would leave
    assert ranking.ordered_ranges(df, ["s", "id"]).count > 7


def test_label_of_the_itinerary_is_one_window_and_sees_drops(spark):
    """One shuffle on the key for the fine key, no job while planning, and
    itineraries that repeat over search dates."""
    from pyspark.sql import functions as F
    src = model_source(quote_view(spark, SF_SMALL))
    table = build_model_table(src)
    plan = _plan(table)
    assert plan.count("Window [") >= 1 and "partial_min(" not in plan
    share = table.agg(F.avg("priceWillDrop")).first()[0]
    assert 0.05 < share < 0.5


def test_one_scan_per_report(spark):
    from fareflow.ml.pipeline import constant_columns
    from fareflow.operators.explore import duplicate_report
    q = quote_view(spark, SF_SMALL)
    for df in (constant_columns(q.select("trip", "cabin", "price")), duplicate_report(q, ["l_orderkey"])):
        assert _plan(df).split("(1)")[0].count("lineitem") <= 1


def test_model_entries_train_at_full_size(spark, monkeypatch):
    from fareflow.ml import pipeline as P
    from fareflow.plans import queries_models as Q

    class Caught(Exception):
        pass

    def catch(train, features, *kind, **params):
        raise Caught(kind[-1], params)
    rows = spark.range(4).selectExpr("id", "0 AS split")
    monkeypatch.setattr(Q, "_model_data", lambda *a: rows)
    monkeypatch.setattr(Q, "_held_out", lambda d: rows)
    for name in ("quote_view", "model_source", "build_model_table"):
        monkeypatch.setattr(Q, name, lambda *a: rows)
    monkeypatch.setattr(Q, "stratified_folds", lambda *a: rows)
    for name in ("train_classifier", "train_regressor", "train_folds"):
        monkeypatch.setattr(P, name, catch)
    for entry in (Q.m7, Q.m8, Q.m21, Q.m25):
        with pytest.raises(Caught) as e:
            entry(spark, "")
        kind, params = e.value.args
        model = P.make_classifier(kind, **params)
        assert (model.getMaxIter(), model.getRegParam(), model.getElasticNetParam()) == (100, 0.1, 0.8)
    for entry, least in ((Q.m10, 10), (Q.m11, 10), (Q.m12, 200), (Q.m13, 1000), (Q.m14, 10)):
        with pytest.raises(Caught) as e:
            entry(spark, "")
        kind, params = e.value.args
        params = {k: v for k, v in params.items() if k not in ("one_hot", "vector_index_max")}
        model = P.make_classifier("rf" if kind == "rf" else "gbt", **params)
        assert (model.getNumTrees() if kind == "rf" else model.getMaxIter()) >= least
        assert model.getMaxDepth() >= (18 if entry is Q.m13 else 5)
        assert entry is not Q.m13 or model.getMinInstancesPerNode() == 512


def test_v1_0_documents_are_parsed_once(spark):
    from pyspark.sql import functions as F
    from fareflow.operators import normalize as N
    from fareflow.schemas import V1_0_DOC
    texts = ['{"basic": {"trip": "1"}, "quote_list": [{"price": 1.0}, null, {"price": 2.0}]}', '{"quote_list": [{"price": 3.0}]}',
             '{"basic": {"trip": "2"}, "quote_list": []}', '{"basic": {"trip": "2"}}']
    raw = spark.createDataFrame([(x,) for x in texts], "value string").repartition(2)
    flat = N.flatten_v1_0(raw.select(F.from_json("value", V1_0_DOC).alias("d")).select("d.*"))
    assert sorted(map(str, [r.price for r in flat.collect()])) == ["1.0", "2.0", "None"]
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_document_segments_are_compiled(spark):
    """The segments of a timeline are no interpreted lambda, and are those of the
    stops: the second of three is NULL for part keys divisible by 5."""
    from fareflow.plans.documents import v1_1_documents
    rows = [(n + 1, pk, 7, 3, 4, "PERU", "CHINA", "Brand#11", "A11", "CABIN", 10.0, "2", 5, n, 3, 9, 30, "2h10m",
             "2001-02-03T09:30:00.000+03:00", "") for n in (0, 1, 2) for pk in (10, 11)]
    q = spark.createDataFrame(rows, "l_linenumber int, l_partkey long, l_suppkey long, s_nationkey int, c_nationkey int, "
                              "fromCity string, toCity string, airlineName string, airlineCode string, cabin string, "
                              "price double, trip string, stayDays int, stops int, ticketsLeft int, depHour int, "
                              "depMinute long, durationText string, departureTime string, stopInfo string")
    q = q.selectExpr("*", "1L as l_orderkey", "date'2001-02-03' as depDate", "date'2001-01-01' as searchDate",
                     "date'2001-02-08' as retDate")
    docs = v1_1_documents(q, "a")
    legs = docs.select("task_id", "leg1.stops", "timeline1", "timeline2")
    assert "lambda" not in legs._jdf.queryExecution().optimizedPlan().toString()
    first = {(r.stops, r.timeline1[0].carrier.serviceNumber): r for r in legs.collect()}
    assert [len(first[n, 11].timeline1) for n in (0, 1, 2)] == [1, 2, 3]
    assert [s and s.arrivalAirport.localName for s in first[2, 10].timeline1] == ["hub1", None, "china"]
    assert [s.departureAirport.localName for s in first[2, 11].timeline1] == ["peru", "hub1", "hub2"]
    assert [s.arrivalAirport.city for s in first[1, 11].timeline2] == ["PERU"]
    assert [s.arrivalAirport.city for s in first[0, 11].timeline2] == ["HUB1", "PERU"]


def test_quotes_stay_dealt_by_order(spark):
    """orders are joined last, so grouping by order shuffles no joined quotes, and customers meet the
    orders alone."""
    from pyspark.sql import functions as F
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = quote_view(spark, SF_SMALL)
        plan = _plan(q.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    assert not [x for x in dealt if "l_linenumber" in x.split("hashpartitioning(")[1].split(")")[0]]
    assert len([x for x in dealt if "custkey" in x]) == 2


def test_itinerary_window_sorts_by_a_number_first(spark):
    """itineraries that begin alike are told apart by a hash; NULL keys stay one itinerary."""
    from fareflow.operators.labels import with_future_min
    rows = [("PERU-CHINA-1", 1, 9.0), ("PERU-CHINA-1", 2, 5.0), (None, 1, 4.0), (None, 3, 2.0), ("PERU-CHINA-2", 1, 7.0)]
    df = spark.createDataFrame(rows, "k string, d int, price double").selectExpr("k", "date_add(date'2001-01-01', d) d", "price")
    got = with_future_min(df, ["k"], "d", days=1, per_day=False)
    assert "xxhash64" in _plan(got)
    assert sorted(r.futureMinPrice for r in got.collect()) == [2.0, 4.0, 5.0, 5.0, 7.0]


def test_both_quotes_share_what_is_derived(spark):
    """texts of an itinerary are made below the explode of its two quotes."""
    plan = model_source(quote_view(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate explode") < plan.index("lpad")


def test_weekday_is_looked_up(spark):
    from pyspark.sql import functions as F
    from fareflow.functions.dates import weekday_name
    df = spark.sql("select explode(sequence(date'2000-02-25', date'2000-03-09')) d union all select null")
    out = df.select(weekday_name("d").alias("a"), F.date_format("d", "EEEE").alias("b"))
    assert all(r.a == r.b for r in out.collect()) and out.filter("a is null").count() == 1
    assert "date_format" not in _plan(df.select(weekday_name("d")))


def test_stop_minutes_are_those_of_the_stop_list(spark):
    """the minutes of one stop, without a lambda."""
    from pyspark.sql import functions as F
    from fareflow.functions import text as T
    texts = ["SIN:2h10m;KUL:1h5m", ";;A:1h2m", "", None, "2h3m;B:", "A:B:4h5m;25m;C:1h1m", "X:9h"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for i in (0, 1):
        old = F.get(T.stop_list("t"), i).getField("minutes")
        new = df.select(T.stop_minutes("t", i).alias("m"))
        assert [r.m for r in new.collect()] == [r[0] for r in df.select(old).collect()]
        assert "lambda" not in _plan(new)


def _flights(spark, n=60):
    rows = [(float(i % 7), "ABC"[i % 3], int(i % 7 > 3 or i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "lead double, city string, label int")


def test_encoders_see_a_row_once_for_all_grid_values(spark):
    """stages that do not read the feature come before the grid; the means are those of forced values."""
    from types import SimpleNamespace
    from pyspark.sql import functions as F
    from fareflow.ml import pipeline as P
    df, seen = _flights(spark), []
    model = P.train_classifier(df, ["lead", "city"], "logreg", regParam=0.01)

    class Spy:
        def __init__(self, stage):
            self.stage = stage

        def __getattr__(self, name):
            return getattr(self.stage, name)

        def transform(self, rows):
            seen.append((type(self.stage).__name__, "_ff_grid" in rows.columns))
            return self.stage.transform(rows)

    spied = SimpleNamespace(stages=[Spy(s) for s in model.stages])
    got = {r["value"]: r for r in P.partial_dependence(spied, df, "lead", [0.0, 5.0], ["lead", "city"]).collect()}
    assert [replicated for _, replicated in seen] == [False, False, True, True]
    for v in (0.0, 5.0):
        forced = P.probability_of_one(model.transform(df.withColumn("lead", F.lit(v))))
        assert got[v]["n"] == 60
        assert got[v]["meanProbability"] == pytest.approx(forced.agg(F.avg("p1")).first()[0])
    assert got[0.0]["meanProbability"] != got[5.0]["meanProbability"]


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_estimators_read_encoded_rows(spark, monkeypatch, kind):
    """Estimators pass over rows that were encoded once."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.regression import GBTRegressor
    from fareflow.ml import pipeline as P
    read = []
    base = LogisticRegression if kind == "classifier" else GBTRegressor
    fit = base._fit
    monkeypatch.setattr(base, "_fit", lambda self, data: read.append((data.columns, data.inputFiles())) or fit(self, data))
    df = _flights(spark)
    if kind == "classifier":
        model = P.train_classifier(df, ["lead", "city"], "logreg")
    else:
        model = P.train_regressor(df.withColumn("saving", df.lead), ["lead", "city"], "saving", maxIter=2)
    (columns, files), = read
    assert columns == ["label" if kind == "classifier" else "saving", "features"]
    assert files and all("/encoded-" in f for f in files)
    assert model.transform(df).count() == 60
