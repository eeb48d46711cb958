"""Exploration aggregates (D2, D6, F1-F20, I3).  All are single-pass
group-bys with partial (map-side) aggregation; none collects to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    """Sum of a money column through a decimal, so the result does not
    depend on the order partial sums are combined in."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """Order-independent mean: decimal sum / non-null count."""
    c = F.col(c) if isinstance(c, str) else c
    return exact_sum(c, scale) / F.count(c)


def exact_stddev(c: str | Column, scale: int = 2) -> Column:
    """Sample standard deviation from exact decimal sums of x and x^2."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.cast(f"decimal(18,{scale})")
    n = F.count(c)
    sx = F.sum(d).cast("double")
    sxx = F.sum(d * d).cast("double")
    return F.when(n > 1, F.sqrt(F.greatest((sxx - sx * sx / n) / (n - 1), F.lit(0.0))))


def zero_share(c: str | Column) -> Column:
    """Share of rows with a non-positive value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.avg(F.when(c <= 0, 1).otherwise(0))


def group_count(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """``groupBy(keys).count()`` (F2/L8); order with ``orderBy`` if needed."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_in_own_groups(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    """``groupBy(c).agg(count(c))``: the NULL group counts 0."""
    return df.groupBy(c).agg(F.count(c).alias(name or f"count_{c}"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column in one pass, long form ``(column, nulls)``."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "nulls").select(
        "column", F.coalesce("nulls", F.lit(0)).cast("long").alias("nulls"))


def describe_long(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """count / mean / stddev / min / max per column, one row per column
    (F12), from ONE aggregation pass over the table.  Numeric columns get
    exact moments; text columns count / min / max."""
    aggs = []
    for i, c in enumerate(columns):
        is_num = c in numeric
        aggs += [F.count(c).alias(f"n{i}"),
                 (exact_avg(c) if is_num else F.lit(None).cast("double")).alias(f"a{i}"),
                 (exact_stddev(c) if is_num else F.lit(None).cast("double")).alias(f"s{i}"),
                 F.min(c).cast("string").alias(f"l{i}"), F.max(c).cast("string").alias(f"h{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                              F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                              F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"))
                     for i, c in enumerate(columns)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form ``(a, b, count)`` (F9): no driver-side
    distinct of column values, works for any number of levels."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def pivot_values(pivot_col: str, values: Sequence, other: str = "other") -> Column:
    """The pivot column with every value outside ``values``, null included, as
    ``other``, so that a fixed list of columns loses no row."""
    return F.when(F.col(pivot_col).isin(*values), F.col(pivot_col)).otherwise(F.lit(other))


def pivot_first(df: DataFrame, keys: Sequence[str], pivot_col: str, value: str,
                values: Sequence | None = None, prefix: str = "", other: str = "other") -> DataFrame:
    """One column per category (F8).  ``min`` replaces the order-dependent
    ``first``; pass ``values`` to skip the distinct job and fix the schema: what
    is not among them goes to the column ``other``."""
    if values is not None:
        df, values = df.withColumn(pivot_col, pivot_values(pivot_col, values, other)), [*values, other]
    out = df.groupBy(*keys).pivot(pivot_col, values).agg(F.min(value))
    if prefix:
        out = out.select(*keys, *[F.col(f"`{c}`").alias(prefix + str(c))
                                  for c in out.columns if c not in keys])
    return out


def cube_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``cube(keys)`` with counts and ``grouping_id``."""
    return df.cube(*keys).agg(F.count(F.lit(1)).alias("count"),
                              F.grouping_id(*keys).cast("int").alias("gid"))


def frequent_exact(df: DataFrame, c: str, support: float) -> DataFrame:
    """Values whose share of rows is at least ``support`` (exact F13).

    A mergeable counter summary (``freqItems``, counters in each task) names
    every value that can reach the share, and some that don't; a second pass
    counts those exactly.  What is shuffled and what reaches the driver is
    bounded by 1 / support, however many values there are."""
    summary = df.select(F.struct(F.col(c)).alias("v")).select(F.to_json("v", {"ignoreNullFields": "false"}).alias("v"))
    # half the support, as the summary only promises shares above its own
    named = summary.freqItems(["v"], max(1e-4, support / 2)).first()[0] or []
    value = F.to_json(F.struct(F.col(c)), {"ignoreNullFields": "false"})
    total = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery, no join
    counts = df.where(value.isin(named)).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    return (counts.filter(F.col("count") >= F.lit(support) * total)
            .select(c, "count", (F.col("count") / total).alias("share")))


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """rows, distinct rows (on ``keys`` or all columns), surplus."""
    cols = list(keys) if keys else df.columns
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_ff_n"))
    return (per_key.agg(F.coalesce(F.sum("_ff_n"), F.lit(0)).alias("rows"),
                        F.count(F.lit(1)).alias("distinctRows"))
            .withColumn("duplicates", F.col("rows") - F.col("distinctRows")))


#: Leaves of the hash tree on each level, and its levels above the rows.
LEAVES, LEVELS = 1 << 10, 3


def row_digest(df: DataFrame, columns: Sequence[str], path: Sequence[Sequence[int]] = ()) -> DataFrame:
    """One level of a hash tree over the rows (I3): (leaf, rows, s1, s2), counts
    and order-free sums of two 64-bit row hashes for each of ``LEAVES`` leaves.
    Only rows below the leaves of ``path``, one list for each level before, count.  Tasks give one row a leaf, so no rows are shuffled."""
    h = F.xxhash64(*[F.col(c) for c in columns])
    level = len(path)
    leaf = lambda k: F.pmod(F.shiftrightunsigned(h, 20 * k), F.lit(LEAVES)).cast("int")
    rows = df
    for k, leaves in enumerate(path):
        rows = rows.where(leaf(k).isin(list(leaves)))
    wide = lambda c: F.sum(c.cast("decimal(20,0)"))
    return rows.groupBy(leaf(level).alias("leaf")).agg(
        F.count(F.lit(1)).alias("rows"), wide(h).alias("s1"),
        wide(F.xxhash64(F.lit(7919), *[F.col(c) for c in reversed(columns)])).alias("s2"))


def differing_leaves(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> list[list[int]]:
    """Leaves of each level below which the tables differ, by digests of at
    most ``LEAVES`` rows; an empty list for equal tables.  Goes on to the next
    level while that leaves out most of what is left."""
    path: list[list[int]] = []
    for _ in range(LEVELS):
        found = [{r["leaf"]: tuple(r)[1:] for r in row_digest(t, columns, path).collect()} for t in (a, b)]
        apart = sorted(k for k in found[0].keys() | found[1].keys() if found[0].get(k) != found[1].get(k))
        if not apart:
            return []
        path.append(apart)
        if 4 * len(apart) > LEAVES:
            break
    return path


def datasets_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag equality of two tables (I3): rows only in a / only in b.

    Both tables are digested first; equal tables are read once each and none of
    their rows is shuffled.  Where digests differ, only rows below differing
    leaves are compared, by one signed count per distinct row.  Equal digests of
    different tables need two 64-bit sums to collide at once."""
    columns = a.columns
    path = differing_leaves(a, b.select(*columns), columns)
    if not path:
        return a.sparkSession.createDataFrame([(0, 0, True)], "onlyLeft long, onlyRight long, equal boolean")
    h = F.xxhash64(*[F.col(c) for c in columns])
    below = F.lit(True)
    for k, leaves in enumerate(path):
        if 4 * len(leaves) <= LEAVES:
            below = below & F.pmod(F.shiftrightunsigned(h, 20 * k), F.lit(LEAVES)).cast("int").isin(leaves)
    signed = a.where(below).withColumn("_ff_s", F.lit(1)).unionByName(b.select(*columns).where(below)
                                                                      .withColumn("_ff_s", F.lit(-1)))
    surplus = signed.groupBy(*columns).agg(F.sum("_ff_s").alias("_ff_s"))
    side = lambda s: F.coalesce(F.sum(F.greatest(F.col("_ff_s") * s, F.lit(0))), F.lit(0)).cast("long")
    return (surplus.agg(side(1).alias("onlyLeft"), side(-1).alias("onlyRight"))
            .withColumn("equal", (F.col("onlyLeft") == 0) & (F.col("onlyRight") == 0)))


def max_row(df: DataFrame, metric: str, value: str) -> DataFrame:
    """Value at the maximum metric (F20), as one aggregate (no self-join)."""
    return df.agg(F.max(metric).alias(f"max_{metric}"),
                  F.max_by(value, F.struct(F.col(metric), F.col(value))).alias(value))


def cast_failures(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Cast-conformance report (C8): per column, non-NULL values that do not
    convert to the target type (``try_cast`` gives NULL), in one pass."""
    aggs = []
    for c, t in targets.items():
        aggs.append(F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), 1)).alias(c))
    wide = df.agg(*aggs)
    cols = list(targets)
    return wide.unpivot([], cols, "column", "failures").select("column", F.col("failures").cast("long"))


def frequent_items_approx(df: DataFrame, cols: list[str], support: float = 0.01) -> DataFrame:
    """Spark's one-pass frequent-items sketch (F13, may contain false
    positives); see ``frequent_exact`` for the exact variant."""
    return df.freqItems(cols, support)
