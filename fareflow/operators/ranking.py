"""Global order statistics without a single-partition window and with one
shuffle of the rows (G8, G9, H9, M9, M15, M16, M19).

``Window.orderBy(...)`` without ``partitionBy`` moves every row to one task.
Here the order is cut into ranges whose bounds are *literals*, so the range
number is a plain, deterministic column of the row:

1. a random sample of the order columns, ``DRAWN`` rows for each range, gives
   the bounds.  A bound has a value for each order column, so a value of the
   first one that fills whole ranges by itself is cut by the next ones, and
   neither a hot group nor a tied score ends in one task;
2. one aggregate over the range number gives the totals of all ranges, whose
   prefix sums enter the plan as literals;
3. a window per range, the only shuffle of rows, adds the running total inside
   the range to the literal of its range.

The number of ranges comes from the number of rows (``ROWS_PER_RANGE``) and is
at most ``MAX_RANGES``, which bounds the sample and what the driver holds.  Steps 1 and 2 are
jobs that run while the plan is built and read the input again; hand in a
written table (``plans.reports.materialize``) when that is costly.  Nothing
depends on how rows happen to be partitioned, so a lost task may be run again
at any point.

The order columns must make the order total (add an id as tie-breaker) where
rows are numbered.  Order columns are names, ``F.asc(name)`` or
``F.desc(name)`` of numeric, date, time, boolean or text columns, with Spark's
place for nulls (first when ascending, last when descending).
"""

from __future__ import annotations

import itertools
import json
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = "_ff_range"
ROWS_PER_RANGE = 1 << 16
MAX_RANGES = 8192
DRAWN = 32
_SORT = re.compile(r"^Column<'(.+?) (ASC|DESC)(?: NULLS (?:FIRST|LAST))?'>$")


def _named(order: Sequence[Column | str]) -> list[tuple[str, bool]]:
    """(column name, descending) of names and sort columns."""
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o, False))
            continue
        m = _SORT.match(str(o))
        name = m.group(1) if m else str(o)[len("Column<'"):-2]
        out.append((name.strip("`"), bool(m) and m.group(2) == "DESC"))
    return out


def _codes(df: DataFrame, name: str, desc: bool) -> list[Column]:
    """Columns whose struct, in Spark's ascending order of structs (null first,
    NaN last), has the order and the ties of the sort column."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    whole = {T.DateType: F.unix_date, T.TimestampType: F.unix_micros,
             T.TimestampNTZType: lambda x: F.unix_micros(x.cast("timestamp"))}.get(type(kind))
    if isinstance(kind, T.StringType):
        # inverted hex digits order backwards; the end mark puts a beginning of a longer text after it
        turned = F.concat(F.translate(F.hex(F.encode(c, "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
        return [c.isNull(), turned] if desc else [c]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = c.cast("double")
        return [c.isNull(), ~F.isnan(c), -c] if desc else [c]
    if isinstance(kind, T.DecimalType):
        return [c.isNull(), -c] if desc else [c]
    c = (whole(c) if whole else c).cast("long")
    return [c.isNull(), F.bitwise_not(c)] if desc else [c]


def _passed(code: Column, cuts: Sequence, strict: bool) -> Column:
    """How many of the sorted literals ``cuts`` are at most (or below) the code."""
    below = (lambda c: c < code) if strict else (lambda c: c <= code)
    if not cuts:
        return F.lit(0)
    if len(cuts) <= 32:
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), below))
    step = math.isqrt(len(cuts))
    whole = F.size(F.filter(F.array(*[F.lit(c) for c in cuts[::step]]), below))
    part = F.slice(F.array(*[F.lit(c) for c in cuts]), (whole - 1) * step + 1, F.lit(step))
    return F.when(whole > 0, (whole - 1) * step + F.size(F.filter(part, below))).otherwise(0)


@dataclass(frozen=True)
class Ranges:
    """``column`` numbers the rows' ranges 0..count-1 in the order; ``tied``
    marks ranges that hold one value of the first order column only."""
    column: Column
    count: int
    tied: list[bool]
    rows: int


def _reached(code: Column, bounds: Sequence[dict], schema: str) -> Column:
    """How many of the sorted literal structs ``bounds`` are at most the code,
    by steps that narrow the search."""
    lits = lambda some: F.from_json(F.lit(json.dumps(some)), schema)
    step = max(2, math.ceil(len(bounds) ** (1 / 3)))

    def search(x: Column) -> Column:
        at = F.size(F.filter(lits(bounds[::step * step]), lambda b: b <= x))
        for stride, every in ((step * step, step), (step, 1)):
            # bounds[(at - 1) * stride] is the last one known to be reached
            first = (at - 1) * (stride // every)
            part = F.slice(lits(bounds[::every]), F.greatest(first, F.lit(0)) + 1, F.lit(stride // every))
            at = F.when(at > 0, first + F.size(F.filter(part, lambda b: b <= x))).otherwise(0)
        return at
    # bound once, as the search looks at it often
    return F.element_at(F.transform(F.array(code), search), 1)


def ordered_ranges(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None) -> Ranges:
    """Cut the order into ranges of about ``ROWS_PER_RANGE`` rows (or into
    about ``partitions``).  A job that counts and one that draws the bounds:
    rows of a random sample of ``DRAWN`` for each range, all of its order
    columns.  What a range holds depends on the bounds only, not on the draw."""
    per_column = [_codes(df, name, desc) for name, desc in _named(order)]
    names = [f"c{i}" for i in range(sum(len(c) for c in per_column))]
    codes = [c.alias(n) for c, n in zip((c for cs in per_column for c in cs), names)]
    total = df.count()
    target = max(math.ceil(total / partitions) if partitions else ROWS_PER_RANGE, math.ceil(total / MAX_RANGES), 1)
    pieces = math.ceil(total / target)
    if pieces <= 1:
        return Ranges(F.lit(0), 1, [False], total)
    drawn = df.select(F.struct(*codes).alias("k"))
    if DRAWN * pieces < total:
        drawn = drawn.sample(fraction=DRAWN * pieces / total, seed=7)
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in drawn.schema["k"].dataType.fields)
    # bounded by DRAWN * MAX_RANGES rows, so one task may order them
    starts = drawn.withColumn("piece", F.ntile(pieces).over(Window.orderBy("k"))).groupBy("piece") \
        .agg(F.min("k").alias("k")).where("piece > 1").agg(F.to_json(F.array_sort(F.collect_list("k"))))
    chosen = json.loads(starts.first()[0] or "[]")
    bounds = []
    for k, tuples in itertools.groupby(chosen):
        bounds.append({**k, "after": 0})
        if len(list(tuples)) > 1:  # rows that agree in all order columns and fill a range: these alone
            bounds.append({**k, "after": 1})
    if not bounds:
        return Ranges(F.lit(0), 1, [False], total)
    code = F.struct(*codes, F.lit(0).alias("after"))
    first = [[b.get(n) for n in names[:len(per_column[0])]] for b in bounds]
    tied = [False, *[x == y for x, y in zip(first, first[1:])], False]
    return Ranges(_reached(code, bounds, f"array<struct<{fields}, after: int>>").cast("int"), len(bounds) + 1, tied, total)


def spread(rows: DataFrame, ranges: Ranges) -> DataFrame:
    """Rows with their ``RANGE`` dealt by it, about two ranges a task however
    many rows there are; the windows that follow need no other shuffle."""
    tasks = math.ceil(ranges.count / 2)
    few = tasks <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows if few else rows.repartition(tasks, RANGE)


def _by_range(ranges: Ranges, values: Sequence) -> Column:
    """The literal of the row's range."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(RANGE) + 1)


def with_prefix_sums(df: DataFrame, order: Sequence[Column | str],
                     sums: Mapping[str, tuple[Column | str | None, bool]], partitions: int | None = None) -> DataFrame:
    """Running totals in one global order: ``sums`` maps an output name to
    (value, inclusive), a row count where the value is None."""
    ranges = ordered_ranges(df, order, partitions)
    values = {f"_ff_v{i}": F.lit(1).cast("long") if v is None else (F.col(v) if isinstance(v, str) else v)
              for i, (v, _) in enumerate(sums.values())}
    rows = df.withColumns({RANGE: ranges.column, **values})
    before: dict[str, list] = {v: [] for v in values}
    if ranges.count > 1:
        found = {r[RANGE]: r for r in rows.groupBy(RANGE).agg(*[F.sum(v).alias(v) for v in values]).collect()}
        for v in values:
            running = 0
            for k in range(ranges.count):
                before[v].append(running)
                running += (found[k][v] or 0) if k in found else 0
    sort = [F.col(n).desc() if d else F.col(n).asc() for n, d in _named(order)]
    w = Window.partitionBy(RANGE).orderBy(*sort)
    out = spread(rows, ranges)
    for v, (name, (_, inclusive)) in zip(values, sums.items()):
        local = F.coalesce(F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)), F.lit(0))
        out = out.withColumn(name, local + _by_range(ranges, before[v]) if before[v] else local)
    return out.drop(RANGE, *values)


def with_prefix_sum(df: DataFrame, order: Sequence[Column | str], value: Column | str | None = None,
                    out: str = "prefix", inclusive: bool = False,
                    partitions: int | None = None) -> DataFrame:
    """Running total of ``value`` (row count when None) in the global
    ``order``; exclusive by default (sum over strictly earlier rows)."""
    return with_prefix_sums(df, order, {out: (value, inclusive)}, partitions)


def with_position(df: DataFrame, order: Sequence[Column | str], out: str = "pos",
                  partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the global total ``order``."""
    return with_prefix_sum(df, order, None, out, inclusive=False, partitions=partitions)


def with_rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                       out: str = "rankInGroup", partitions: int | None = None) -> DataFrame:
    """0-based position inside each group, for groups of any size: the rank
    inside (range, group), and for the group that a range begins with the rows
    that it has in earlier ranges, a literal of the range."""
    ranges = ordered_ranges(df, [*group, *order], partitions)
    rows = df.withColumn(RANGE, ranges.column)
    sort = [F.col(n).desc() if d else F.col(n).asc() for n, d in _named(order)]
    rank = F.row_number().over(Window.partitionBy(RANGE, *group).orderBy(*sort)) - 1
    if ranges.count > 1:
        key = F.struct(*[F.col(g) for g in group])
        ends = rows.groupBy(RANGE, *group).agg(F.count(F.lit(1)).alias("_n")).groupBy(RANGE).agg(
            F.min(key).alias("head"), F.max(key).alias("tail"), F.max_by("_n", key).alias("n"))
        before, carried, last = [0] * ranges.count, 0, None
        for r in sorted(ends.collect(), key=lambda r: r[RANGE]):
            before[r[RANGE]] = carried if last is not None and r["head"] == last else 0
            carried = r["n"] + (before[r[RANGE]] if r["head"] == r["tail"] else 0)
            last = r["tail"]
        first = F.rank().over(Window.partitionBy(RANGE).orderBy(*group)) == 1
        rank = rank + F.when(first, _by_range(ranges, before)).otherwise(0)
    return spread(rows, ranges).withColumn(out, rank.cast("long")).drop(RANGE)


def stratified_folds(df: DataFrame, label: str, k: int, id_cols: Sequence[str], out: str = "fold",
                     shuffle_key: Column | None = None, partitions: int | None = None) -> DataFrame:
    """Balanced stratified k-fold assignment (H9): within each label, rows in
    hash order (or ``shuffle_key`` order) are dealt round-robin to folds, so
    every fold has the same share of each class (±1 row)."""
    h = shuffle_key if shuffle_key is not None else F.xxhash64(*[F.col(c) for c in id_cols])
    ranked = with_rank_in_group(df.withColumn("_ff_h", h), [label], ["_ff_h", *id_cols], "_ff_r", partitions)
    return ranked.withColumn(out, (F.col("_ff_r") % k).cast("int")).drop("_ff_h", "_ff_r")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], tie: Sequence[str] = (),
                    partitions: int | None = None) -> list[float | None]:
    """Exact quantiles with linear interpolation (``pd.qcut`` /
    ``quantile_cont`` convention) of the non-null values.  Only ranges that
    hold a needed rank are shuffled and sorted; two values for each
    probability reach the driver."""
    values = df.where(F.col(col).isNotNull()).select(col, *tie)
    ranges = ordered_ranges(values, [col, *tie], partitions)
    rows = values.withColumn(RANGE, ranges.column)
    sizes = {r[RANGE]: r["n"] for r in rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    if not n:
        return [None] * len(probs)
    before, running = [], 0
    for k in range(ranges.count):
        before.append(running)
        running += sizes.get(k, 0)
    ranks = sorted({int(f(p * (n - 1))) for p in probs for f in (math.floor, math.ceil)})
    home = {r: max(k for k in range(ranges.count) if before[k] <= r and sizes.get(k)) for r in ranks}
    near = rows.where(F.col(RANGE).isin(sorted(set(home.values()))))
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(col, *tie)) - 1 + _by_range(ranges, before)
    at = {r["at"]: r[col] for r in near.withColumn("at", place).where(F.col("at").isin(ranks)).select("at", col).collect()}
    low = [at[math.floor(p * (n - 1))] for p in probs]
    high = [at[math.ceil(p * (n - 1))] for p in probs]
    return [a + (b - a) * (p * (n - 1) - math.floor(p * (n - 1))) for p, a, b in zip(probs, low, high)]


def quantile_edges(df: DataFrame, col: str, probs: Sequence[float], tie: Sequence[str] = ()) -> DataFrame:
    """``exact_quantiles`` as a table: one row ``(k, p, edge)`` per probability."""
    edges = exact_quantiles(df, col, probs, tie)
    rows = [(i, float(p), None if e is None else float(e)) for i, (p, e) in enumerate(zip(probs, edges))]
    return df.sparkSession.createDataFrame(rows, "k int, p double, edge double")


def with_quantile_band(df: DataFrame, col: str, bands: int, tie: Sequence[str] = (), out: str = "band") -> DataFrame:
    """Band index 0..bands-1 with right-closed bins between the exact
    quantile edges (G9): ``band = #edges < value``, null for a null value.
    The ``bands - 1`` edges are literals, so banding is one native pass."""
    edges = [e for e in exact_quantiles(df, col, [i / bands for i in range(1, bands)], tie) if e is not None]
    band = _passed(F.col(col), edges, True).cast("int")
    return df.withColumn(out, F.when(F.col(col).isNotNull(), band))
