"""Unit fixtures for table operators: labels, as-of, joins, ranking."""

import datetime as dt

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.operators import asof, labels, ranking
from fareflow.operators.holidays import EARLY_HOLIDAYS
from fareflow.operators.joins import split_matched


def _d(s):
    return dt.date.fromisoformat(s)


def test_asof_matches_original_semantics(spark):
    cal = spark.createDataFrame([(_d(h),) for h in EARLY_HOLIDAYS], "Date date")
    days = [_d("2016-12-31"), _d("2017-01-01"), _d("2017-01-02"), _d("2017-01-03"), _d("2017-03-01"),
            _d("2017-10-06"), _d("2017-10-07")]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: (r.last_holiday, r.next_holiday) for r in asof.with_previous_next(df, "d", cal).collect()}
    hs = sorted(_d(h) for h in EARLY_HOLIDAYS)

    def ref(d):  # the original loop, on dates
        last = hs[0]
        nxt = None
        for h in hs:
            nxt = h
            if h >= d:
                break
            last = h
        return (None if last > d else last, None if nxt < d else nxt)
    assert got == {d: ref(d) for d in days}


def test_future_min_equals_window_definition(spark):
    rows = [("a", _d("2017-01-01"), 100.0), ("a", _d("2017-01-01"), 90.0), ("a", _d("2017-01-10"), 80.0),
            ("a", _d("2017-01-25"), 50.0), ("b", _d("2017-01-02"), 10.0), (None, _d("2017-01-02"), 5.0),
            (None, _d("2017-01-04"), 3.0)]
    df = spark.createDataFrame(rows, "k string, d date, price double")
    got = sorted(labels.with_future_min(df, ["k"], "d", "price", 19).collect(), key=lambda r: (str(r.k), r.d, r.price))
    w = Window.partitionBy("k").orderBy(F.unix_date("d")).rangeBetween(0, 19)
    exp = sorted(df.withColumn("futureMinPrice", F.min("price").over(w)).collect(),
                 key=lambda r: (str(r.k), r.d, r.price))
    assert [tuple(r) for r in got] == [tuple(r) for r in exp]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60), st.integers(1, 500)), min_size=1, max_size=40),
       st.integers(0, 30), st.floats(0, 100))
def test_label_invariants(spark, rows, days, threshold):
    base = dt.date(2017, 1, 1)
    df = spark.createDataFrame([(str(k), base + dt.timedelta(days=o), float(p)) for k, o, p in rows],
                               "k string, searchDate date, price double")
    out = labels.with_drop_label(df, ["k"], days, threshold).collect()
    for r in out:
        assert r.futureMinPrice <= r.price
        assert r.saving >= 0
        assert r.priceWillDrop == int(r.price - r.futureMinPrice > threshold)
    unb = {(r.k, r.searchDate, r.price): r.futureMinPrice
           for r in labels.with_future_min(df, ["k"], days=None).collect()}
    for r in out:  # a wider horizon can only lower the minimum
        assert unb[(r.k, r.searchDate, r.price)] <= r.futureMinPrice


def test_route_key_null_token(spark):
    df = spark.createDataFrame([("a", None, "c"), ("a", "c", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(labels.route_key("x", "y", "z")).collect()]
    safe = [r[0] for r in df.select(labels.route_key("x", "y", "z", null_token="~")).collect()]
    assert plain[0] == plain[1] == "a-c"          # the original key collides
    assert safe == ["a-~-c", "a-c-~"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=60),
       st.integers(1, 7))
def test_prefix_sum_matches_single_window(spark, rows, parts):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id long, a int, b int")
    order = [F.desc("a"), F.asc("id")]
    got = {r.id: r.s for r in ranking.with_prefix_sum(df, order, "b", "s", inclusive=True,
                                                      partitions=parts).collect()}
    exp = {r.id: r.s for r in df.withColumn("s", F.sum("b").over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).collect()}
    assert got == exp


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_ranges_hold_for_ties_texts_nulls_and_hot_groups(spark, parts):
    """Two thirds of all rows in one group or on one score, text keys that
    share a long beginning, nulls, negative and very large numbers."""
    rows = [(i, None if i % 11 == 0 else "a" * 25 + str(i % 3) if i % 3 else "hot", None if i % 13 == 0 else 0.5 if i % 5 else
             i * -1.5, (1 << 60) - i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, x double, big long")
    for order in (["g", "id"], [F.desc("x"), "id"], ["x", F.desc("id")], [F.desc("big"), "g", "id"]):
        sort = [F.col(o) if isinstance(o, str) else o for o in order]
        exp = {r.id: r.p - 1 for r in df.withColumn("p", F.row_number().over(Window.orderBy(*sort))).collect()}
        got = {r.id: r.pos for r in ranking.with_position(df, order, "pos", partitions=parts).collect()}
        assert got == exp
        number = ranking.ordered_ranges(df, order, parts)
        assert number.count <= 4 * parts + 1 and len(number.tied) == number.count
    w = Window.partitionBy("g").orderBy(F.desc("x"), "id")
    exp = {r.id: r.p - 1 for r in df.withColumn("p", F.row_number().over(w)).collect()}
    got = {r.id: r.rankInGroup for r in
           ranking.with_rank_in_group(df, ["g"], [F.desc("x"), "id"], partitions=parts).collect()}
    assert got == exp
    edges = ranking.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0], ["id"], parts)
    assert edges == pytest.approx(df.toPandas()["x"].quantile([0.0, 0.25, 0.5, 0.9, 1.0]).tolist())


def test_metrics_on_tied_scores_and_empty_input(spark, monkeypatch):
    from fareflow.ml import metrics
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 10)
    rows = [(i, int(i % 4 == 0), 0.5 if i % 3 else (i * 37 % 50) / 50) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    exp = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.auc(df).first()[0] == pytest.approx(exp)
    assert metrics.auc(df.limit(0)).first()[0] is None
    by = sorted(rows, key=lambda r: (-r[2], r[0]))
    area = lambda o: (sum(y * (len(o) - k) for k, (_, y, _) in enumerate(o)) / len(pos) - (len(o) + 1) / 2) / len(o)
    got = metrics.gini(df).first()
    assert got.gini == pytest.approx(area(by))
    assert got.giniPerfect == pytest.approx(area(sorted(rows, key=lambda r: (-r[1], r[0]))))


def test_rank_in_group_and_folds(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(90)], "id long, label boolean")
    f = ranking.stratified_folds(df, "label", 3, ["id"])
    counts = {(r.label, r.fold): r["count"] for r in f.groupBy("label", "fold").count().collect()}
    assert counts == {(True, 0): 10, (True, 1): 10, (True, 2): 10,
                      (False, 0): 20, (False, 1): 20, (False, 2): 20}


def test_split_matched_is_a_partition(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, c string")
    dim = spark.createDataFrame([("x",), ("x",)], "c string")
    a, b = split_matched(fact, dim, ["c"])
    assert sorted(r.id for r in a.collect()) == [1]
    assert sorted(r.id for r in b.collect()) == [2, 3]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 1000)), min_size=1, max_size=50), st.integers(0, 12))
def test_rows_frame_blocks_match_window(spark, rows, n):
    df = spark.createDataFrame([(i, str(k), float(p)) for i, (k, p) in enumerate(rows)], "id long, k string, price double")
    got = {r.id: r.futureMinPrice for r in labels.with_future_min_rows(df, ["k"], ["id"], "price", n).collect()}
    w = Window.partitionBy("k").orderBy("id").rowsBetween(0, n)
    exp = {r.id: r.m for r in df.withColumn("m", F.min("price").over(w)).collect()}
    assert got == exp


@pytest.mark.parametrize("n,parts", [(0, 5), (1, 7), (5, 9), (37, 12), (100, 3), (10_000, 8)])
def test_rows_frame_goes_on_in_later_ranges(spark, n, parts):
    """One key over many ranges, keys that end inside one, null prices, falling
    prices (a step a row), descending order."""
    rows = [(i, None if i % 17 == 0 else "hot" if i < 160 else f"k{i % 7}",
             None if i % 5 == 0 else float(1000 - i if i % 2 else (i * 73) % 101)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, price double")
    for order in ("id", F.desc("id")):
        got = labels.with_future_min_rows(df, ["k"], [order], "price", n, partitions=parts)
        assert got.columns == [*df.columns, "futureMinPrice"]
        w = Window.partitionBy("k").orderBy(order).rowsBetween(0, n)
        exp = {r.id: r.m for r in df.withColumn("m", F.min("price").over(w)).collect()}
        assert {r.id: r.futureMinPrice for r in got.collect()} == exp


@pytest.mark.parametrize("parts,direction,exact", [(1, "backward", True), (9, "backward", False), (7, "forward", True),
                                                    (15, "forward", False)])
def test_asof_join_matches_a_search_for_each_row(spark, parts, direction, exact):
    """A hot key, tied times, null keys and times, keys without right rows, a
    long stretch of left rows after one right row."""
    left = [(i, None if i % 19 == 0 else "hot" if i % 3 else f"k{i % 5}", None if i % 23 == 0 else (i * 37) % 90)
            for i in range(300)]
    right = [(f"k{i % 4}" if i % 2 else "hot", (i * 31) % 60 if i % 2 else 20 + i % 4, i) for i in range(40)]
    right += [(None, 50, 900), ("other", 1, 901), ("hot", None, 902)]
    a = spark.createDataFrame(left, "id long, k string, t int")
    b = spark.createDataFrame(right, "k string, u int, v int")
    got = asof.asof_join(a, b, ["k"], "t", "u", {"u": "at", "v": "got"}, direction, exact, [-F.col("v")], parts)
    assert got.columns == ["id", "k", "t", "at", "got"]

    def search(k, t):
        if t is None:
            return None, None
        near = [(u, v) for kk, u, v in right if kk == k and u is not None
                and ((u <= t if exact else u < t) if direction == "backward" else (u >= t if exact else u > t))]
        return max(near, key=lambda x: (x[0] if direction == "backward" else -x[0], x[1]), default=(None, None))
    assert {r.id: (r.at, r.got) for r in got.collect()} == {i: search(k, t) for i, k, t in left}


def test_fine_key_window_gives_the_same_labels(spark):
    rows = [(str(i % 4), dt.date(2017, 1, 1) + dt.timedelta(days=i % 40), float(i % 97)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, searchDate date, price double")
    key = lambda r: (r.k, r.searchDate, r.price, r.futureMinPrice)
    for days in (19, None):
        a = labels.with_future_min(df, ["k"], days=days)
        b = labels.with_future_min(df, ["k"], days=days, per_day=False)
        assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_bag_equality_and_duplicates_in_one_pass(spark):
    from fareflow.operators.explore import datasets_equal, duplicate_report
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "k int, v string")
    assert tuple(datasets_equal(a, b).first()) == (1, 1, False)
    assert tuple(datasets_equal(a, a).first()) == (0, 0, True)
    assert tuple(duplicate_report(a).first()) == (3, 2, 1)
    assert tuple(duplicate_report(a.limit(0)).first()) == (0, 0, 0)


@pytest.mark.parametrize("leaves", [8, 1024])
def test_hash_tree_compares_only_what_differs(spark, monkeypatch, leaves):
    from fareflow.operators import explore
    monkeypatch.setattr(explore, "LEAVES", leaves)
    rows = [(i % 300, None if i % 7 == 0 else f"v{i % 90}", float(i % 13)) for i in range(1500)]
    a = spark.createDataFrame(rows, "k int, v string, x double")
    same = a.repartition(5).select("x", "v", "k")
    assert tuple(explore.datasets_equal(a, same).first()) == (0, 0, True)
    assert explore.differing_leaves(a, same, a.columns) == []
    other = spark.createDataFrame([*rows[3:], (5, "new", 1.0), (5, "new", 1.0)], a.schema)
    assert tuple(explore.datasets_equal(a, other).first()) == (3, 2, False)
    path = explore.differing_leaves(a, other, a.columns)
    assert path and all(path) and len(path[0]) <= 5
    assert tuple(explore.datasets_equal(a, a.limit(0)).first()) == (1500, 0, False)
    assert tuple(explore.datasets_equal(a.limit(0), a.limit(0)).first()) == (0, 0, True)


def test_equal_tables_are_compared_without_shuffling_rows(spark):
    from fareflow.operators import explore
    plan = explore.row_digest(spark.range(1000).withColumn("v", F.col("id") * 2), ["id", "v"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_frequent_values_are_all_found(spark):
    from fareflow.operators.explore import frequent_exact
    rows = [(None,)] * 300 + [("often",)] * 301 + [("edge",)] * 100 + [(f"rare{i}",) for i in range(299)]
    df = spark.createDataFrame(rows, "c string").repartition(7)
    got = {r.c: r["count"] for r in frequent_exact(df, "c", 0.1).collect()}
    assert got == {None: 300, "often": 301, "edge": 100}
    assert frequent_exact(df.limit(0), "c", 0.1).collect() == []
    numbers = spark.range(1000).select((F.col("id") % 50).cast("int").alias("c"))
    assert frequent_exact(numbers, "c", 0.02).count() == 50 and frequent_exact(numbers, "c", 0.021).count() == 0


def test_ranges_of_many_heavy_values_and_behind_text_keys(spark, monkeypatch):
    """Hundreds of scores that each fill a range, and a text key of one value:
    the following columns cut both, and no range holds many times its share."""
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 20)
    df = spark.range(12_000).select("id", F.lit("a city").alias("a"), F.lit("another city").alias("b"),
                                    (F.col("id") % 400 / 1000).alias("s"))
    for order in ([F.desc("s"), "id"], ["a", "b", "id"], [F.desc("b"), F.desc("id")]):
        ranges = ranking.ordered_ranges(df, order)
        sizes = [r["count"] for r in df.groupBy(ranges.column.alias("r")).count().collect()]
        assert ranges.count > 300 and max(sizes) <= 100
    got = ranking.with_position(df, [F.desc("s"), "id"]).where("s = 0.399 OR s = 0").collect()
    assert all(r.pos == (399 - r.id % 400) * 30 + r.id // 400 for r in got) and len(got) == 60


@pytest.mark.parametrize("direction,exact", [("backward", True), ("backward", False), ("forward", True),
                                             ("forward", False)])
def test_asof_join_to_a_calendar_shuffles_no_left_row(spark, direction, exact):
    from fareflow.operators.asof import asof_join
    left = spark.createDataFrame([(i, None if i % 9 == 0 else f"c{i % 4}", None if i % 7 == 0 else i * 3 % 500)
                                  for i in range(400)], "id long, k string, t int")
    right = spark.createDataFrame([(None if i % 10 == 0 else f"c{i % 3}", i * 5 % 470, i) for i in range(300)] + [("c1", None, 1)],
                                  "k string, u int, v int")
    args = (left, right, ["k"], "t", "u", {"v": "w", "u": "x"}, direction, exact)
    got = asof_join(*args)
    rows = lambda df: sorted(map(str, df.collect()))
    assert got.columns == ["id", "k", "t", "w", "x"] and rows(got) == rows(asof_join(*args, partitions=9))
    assert "hashpartitioning(_ff_range" not in got._jdf.queryExecution().explainString(
        got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
