"""Forward-looking price labels.

"Will this fare drop by more than ``threshold`` within ``days`` days of the
search?"  The reference writes this as a window over every quote of a key.
At scale that window sorts a whole key in one task, and one popular route
can hold a large share of all rows.  Here the day-range minimum is computed
exactly but on a pre-aggregated table:

1. ``groupBy(key, day).min(price)``  (partial aggregation before the shuffle,
   so a hot key costs one row per day, not one row per quote);
2. a range window over that daily table (at most one row per calendar day
   per key, so every window partition is bounded by the calendar);
3. an equi-join back on ``(key, day)``; Spark broadcasts the daily table
   when its measured size allows, otherwise sort-merge with AQE skew-join
   splitting hot ``(key, day)`` partitions.

That is for coarse keys.  For the itinerary key, whose groups are small by
nature, ``per_day=False`` is the plain window with its one shuffle.

Range frames are tie-safe (every quote of the same day sees the same
value), so the result does not depend on row arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = "_ff_day"


def route_key(*cols: str | Column, sep: str = "-", null_token: str | None = None) -> Column:
    """Itinerary key (G1): ``concat_ws`` of the parts; NULL parts are skipped
    and array parts flattened, as the reference key does.  With
    ``null_token`` NULLs are kept as a token so distinct itineraries cannot
    collide."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if null_token is not None:  # scalar parts only; arrays are joined as they are
        parts = [F.coalesce(p.cast("string"), F.lit(null_token)) for p in parts]
    return F.concat_ws(sep, *parts)


def with_future_min(df: DataFrame, key: Sequence[str], order_col: str = "searchDate",
                    price: str = "price", days: int | None = 19,
                    out: str = "futureMinPrice", per_day: bool = True) -> DataFrame:
    """Minimum ``price`` over quotes of the same ``key`` whose ``order_col``
    day lies in ``[day, day + days]`` (G3), or in ``[day, +inf)`` when
    ``days`` is None (G2, tie-safe form).  Lazy: building it runs no job.

    ``per_day=True`` is for coarse keys (a city pair), which may hold a large
    share of all quotes: window over one row per (key, day), joined back.
    ``per_day=False`` is for fine keys (an itinerary, quoted a few times a
    day until it departs): one window over the quotes themselves, one shuffle."""
    key = list(key)
    day = F.unix_date(F.col(order_col).cast("date"))
    end = Window.unboundedFollowing if days is None else int(days)
    w = Window.partitionBy(*key).orderBy(DAY).rangeBetween(0, end)
    if not per_day:
        # one number in front of the key: itineraries begin with the same cities, so sorting
        # by their text alone compares whole texts
        w = Window.partitionBy(F.xxhash64(*key), *key).orderBy(DAY).rangeBetween(0, end)
        return df.withColumn(DAY, day).withColumn(out, F.min(price).over(w)).drop(DAY)
    daily = (df.select(*key, day.alias(DAY), F.col(price))
             .groupBy(*key, DAY).agg(F.min(price).alias("_ff_dmin")))
    fm = daily.select(*[F.col(k).alias(f"_ff_k{i}") for i, k in enumerate(key)],
                      F.col(DAY).alias("_ff_kday"), F.min("_ff_dmin").over(w).alias(out))
    left = df.withColumn(DAY, day)
    cond = F.col(DAY).eqNullSafe(F.col("_ff_kday"))
    for i, k in enumerate(key):
        cond = cond & left[k].eqNullSafe(F.col(f"_ff_k{i}"))
    joined = left.join(fm, cond, "left")
    return joined.drop(DAY, "_ff_kday", *[f"_ff_k{i}" for i in range(len(key))])


def with_future_min_rows(df: DataFrame, key: Sequence[str], order_cols: Sequence,
                         price: str = "price", rows: int = 19 * 86400,
                         out: str = "futureMinPrice", partitions: int | None = None) -> DataFrame:
    """Row-framed variant as the reference writes it (G4): minimum over the
    current row and the next ``rows`` rows of the same key, in a *total*
    order (``order_cols`` must make it unique).  With ``rows`` = 19*86400
    the frame reaches the end of almost every key.

    Rows go once to the ranges of ``ranking.ordered_ranges`` over (key, order),
    so no task sorts a whole key.  Inside a range a key's rows are cut into
    blocks of ``rows + 1``; a frame is the rest of its block and the beginning
    of the next one, whose running minimum is a ``lead`` away: windows that only
    grow, linear in the rows.

    A frame that its range cuts off goes on in the ranges that follow, which
    begin with the same key.  One row a range carries what it needs: where the
    range starts, its least price of that key, where the key ends.  A frame that
    ends amid a later range takes the last step of that range's running minimum
    before its end, from a table of the steps.
    """
    from fareflow.operators.ranking import RANGE, _named, _passed, ordered_ranges, spread
    from fareflow.plans.reports import materialize
    key, width = list(key), int(rows) + 1
    order = _named(order_cols)
    ranges = ordered_ranges(df, [*key, *order_cols], partitions)
    sort = [F.col(n).desc() if d else F.col(n).asc() for n, d in order]
    back = [F.col(n).asc() if d else F.col(n).desc() for n, d in order]
    seg = Window.partitionBy(RANGE, *key)
    blk = Window.partitionBy(RANGE, *key, "_ff_blk")
    grow = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    r = spread(df.withColumn(RANGE, ranges.column), ranges).withColumn("_ff_at", F.row_number().over(seg.orderBy(*sort)) - 1)
    r = r.withColumns({"_ff_blk": F.floor(F.col("_ff_at") / width), "_ff_len": F.count(F.lit(1)).over(seg)})
    r = r.withColumns({"_ff_suf": F.min(price).over(grow(blk.orderBy(*back))),
                       "_ff_pre": F.min(price).over(grow(blk.orderBy(*sort)))})
    r = r.withColumns({"_ff_lead": F.lead("_ff_pre", int(rows)).over(seg.orderBy(*sort)),
                       "_ff_end": F.max_by("_ff_pre", "_ff_at").over(seg)})
    inside = F.col("_ff_at") + int(rows) < F.col("_ff_len")
    last_blk = F.floor((F.col("_ff_len") - 1) / width)
    rest = F.when(inside, F.when(F.col("_ff_at") % width > 0, F.col("_ff_lead"))) \
        .when(last_blk > F.col("_ff_blk"), F.col("_ff_end"))
    r = r.withColumn(out, F.least("_ff_suf", rest)).drop("_ff_blk", "_ff_suf", "_ff_pre", "_ff_lead", "_ff_end")
    if ranges.count == 1:
        return r.drop(RANGE, "_ff_at", "_ff_len")

    # ranges are in key order, so a key that goes on is the last of one and the first of the next
    whole = Window.partitionBy(RANGE)
    r = r.withColumns({"_ff_head": F.rank().over(whole.orderBy(*key)) == 1,
                       "_ff_last": F.rank().over(whole.orderBy(*[F.col(k).desc() for k in key])) == 1,
                       "_ff_low": F.min(price).over(grow(seg.orderBy(*sort)))})
    fell = (F.col("_ff_at") == 0) | ~F.col("_ff_low").eqNullSafe(F.lag("_ff_low").over(seg.orderBy(*sort)))
    r = materialize(r.withColumn("_ff_step", F.col("_ff_head") & fell), "future-min-ranges")
    own = F.struct(*[F.col(k) for k in key])
    found = {x[RANGE]: x for x in r.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("n"), F.min(own).alias("head"), F.max(own).alias("tail"),
        F.count_if("_ff_head").alias("headRows"), F.min(F.when(F.col("_ff_head"), F.col(price))).alias("low")).collect()}
    kind = r.schema[price].dataType
    start, total = [], 0
    for k in range(ranges.count):
        start.append(total)
        total += found[k]["n"] if k in found else 0
    # from the back: global end of the key that a range ends with, least price of its rows in later ranges
    end, later, goes_on, nxt = [0] * ranges.count, [None] * ranges.count, [False] * ranges.count, None
    for k in sorted(found, reverse=True):
        goes_on[k] = nxt is not None and found[nxt]["head"] == found[k]["tail"]
        end[k] = start[k] + found[k]["n"] - 1
        if goes_on[k]:
            whole = found[nxt]["head"] == found[nxt]["tail"]
            end[k] = end[nxt] if whole else start[nxt] + found[nxt]["headRows"] - 1
            known = [x for x in (found[nxt]["low"], later[nxt] if whole else None) if x is not None]
            later[k] = min(known, default=None)
        nxt = k
    lows = [found[k]["low"] if k in found else None for k in range(ranges.count)]
    lit = lambda xs, t=None: F.array(*[F.lit(x).cast(t) if t is not None else F.lit(x) for x in xs])
    of = lambda xs, t=None: F.element_at(lit(xs, t), F.col(RANGE) + 1)
    # the rows of the last key end where the range ends
    sizes = [found[k]["n"] if k in found else 0 for k in range(ranges.count)]
    here = of(start) + of(sizes) - F.col("_ff_len") + F.col("_ff_at")
    cut = of(goes_on) & F.col("_ff_last") & (F.col("_ff_at") + int(rows) >= F.col("_ff_len"))
    stop = here + int(rows)
    to_end = stop >= of(end)
    # other rows meet no step; numbers below 0 keep them out of one task
    where = F.when(cut & ~to_end, _passed(stop, start, False) - 1)
    r = r.withColumns({"_ff_to": F.coalesce(where, -1 - F.col("_ff_at") % 4096),
                       "_ff_off": stop - F.element_at(lit(start), where + 1)})
    between = F.array_min(F.slice(lit(lows, kind), F.col(RANGE) + 2, F.greatest(F.col("_ff_to") - F.col(RANGE) - 1, F.lit(0))))
    steps = r.where("_ff_step").select(
        F.col(RANGE).alias("_ff_r"), F.col("_ff_at").alias("_ff_from"), F.col("_ff_low").alias("_ff_least"),
        F.lead("_ff_at").over(Window.partitionBy(RANGE).orderBy("_ff_at")).alias("_ff_until"))
    r = r.drop("_ff_low", "_ff_head", "_ff_step")
    hit = (F.col("_ff_to") == F.col("_ff_r")) & (F.col("_ff_off") >= F.col("_ff_from")) \
        & (F.col("_ff_off") < F.coalesce("_ff_until", F.lit(1 << 62)))
    ahead = F.when(cut & to_end, of(later, kind)).when(cut, F.least(between, F.col("_ff_least")))
    return r.join(steps, hit, "left").withColumn(out, F.least(out, ahead)) \
        .drop(RANGE, "_ff_at", "_ff_len", "_ff_last", "_ff_to", "_ff_off", "_ff_r", "_ff_from", "_ff_least", "_ff_until")


def drop_label(price: str | Column = "price", future: str | Column = "futureMinPrice",
               threshold: float = 20.0) -> Column:
    """1 when the fare will drop by more than ``threshold``."""
    p = F.col(price) if isinstance(price, str) else price
    f = F.col(future) if isinstance(future, str) else future
    return ((p - f) > F.lit(threshold)).cast("int")


def saving(price: str | Column = "price", future: str | Column = "futureMinPrice") -> Column:
    """``greatest(price - futureMin, 0)``."""
    p = F.col(price) if isinstance(price, str) else price
    f = F.col(future) if isinstance(future, str) else future
    return F.greatest(p - f, F.lit(0.0))


def with_drop_label(df: DataFrame, key: Sequence[str] = ("fromCity", "toCity"),
                    lookahead_days: int | None = 19, threshold: float = 20.0,
                    order_col: str = "searchDate", price: str = "price", per_day: bool = True) -> DataFrame:
    """``futureMinPrice``, ``priceWillDrop`` and ``saving`` in one plan
    (``per_day``: see ``with_future_min``)."""
    out = with_future_min(df, key, order_col, price, lookahead_days, per_day=per_day)
    return out.withColumns({"priceWillDrop": drop_label(price, "futureMinPrice", threshold),
                            "saving": saving(price, "futureMinPrice")})


def with_group_min(df: DataFrame, key: Sequence[str], value: str = "price",
                   out: str = "minPrice", diff: str | None = "diffToMin") -> DataFrame:
    """Join an aggregate back to its detail rows (E5): per-key minimum and
    the difference to it.  Aggregate-then-join (partial aggregation, small
    right side) instead of an unbounded window per key."""
    key = list(key)
    agg = df.groupBy(*key).agg(F.min(value).alias(out))
    agg = agg.select(*[F.col(k).alias(f"_ff_g{i}") for i, k in enumerate(key)], out)
    cond = None
    for i, k in enumerate(key):
        e = df[k].eqNullSafe(F.col(f"_ff_g{i}"))
        cond = e if cond is None else cond & e
    res = df.join(agg, cond, "left").drop(*[f"_ff_g{i}" for i in range(len(key))])
    if diff:
        res = res.withColumn(diff, F.col(value) - F.col(out))
    return res


def week_of_month(df: DataFrame, week_col: str, ym_col: str, out: str = "monthWeek") -> DataFrame:
    """``1 + week - min(week)`` within each year-month (G7), via a small
    aggregate joined back rather than a window per month."""
    return (with_group_min(df, [ym_col], week_col, "_ff_minweek", None)
            .withColumn(out, (F.col(week_col) - F.col("_ff_minweek") + 1).cast("int"))
            .drop("_ff_minweek"))
