"""Sampling and splits (H5-H9).

Hash-based variants are deterministic across re-runs and executor loss
(a seeded ``rand`` is only stable while the input partitioning is).  The
bucket expression is ``pmod(xxhash64(key...), buckets)`` by default; pass
``bucket_expr`` to use plain key arithmetic (the form an SQL engine
without xxhash64 can reproduce).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000


def hash_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))


def hash_sample(df: DataFrame, fraction: float, keys: Sequence[str] | None = None,
                bucket_expr: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Keep rows whose bucket is below ``fraction * buckets`` (H5)."""
    b = bucket_expr if bucket_expr is not None else hash_bucket(keys or df.columns, buckets)
    return df.filter(b < F.lit(int(round(fraction * buckets))))


def hash_split(df: DataFrame, weights: Sequence[float], keys: Sequence[str] | None = None,
               bucket_expr: Column | None = None, buckets: int = BUCKETS,
               out: str = "split") -> DataFrame:
    """Label each row with a split index 0..len(weights)-1 (H7); one pass,
    unlike ``randomSplit`` which rescans the input once per split."""
    b = bucket_expr if bucket_expr is not None else hash_bucket(keys or df.columns, buckets)
    total = float(sum(weights))
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w
        edges.append(int(round(acc / total * buckets)))
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(edges))):
        expr = F.when(b < F.lit(edges[i]), F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr.cast("int"))


def time_split(df: DataFrame, date_col: str, start_test: str, out: str = "split") -> DataFrame:
    """``train`` before ``start_test``, ``test`` from it (H8)."""
    return df.withColumn(out, F.when(F.col(date_col) < F.lit(start_test).cast("date"), "train")
                         .otherwise("test"))


def fixed_size_sample(df: DataFrame, n: int, keys: Sequence[str], bucket_expr: Column | None = None) -> DataFrame:
    """n rows with the smallest key hash (H6): a deterministic top-k, so
    Spark keeps only n rows per task before the final merge."""
    h = bucket_expr if bucket_expr is not None else F.xxhash64(*[F.col(k) for k in keys])
    return df.withColumn("_ff_h", h).orderBy("_ff_h", *keys).limit(n).drop("_ff_h")


def take(df: DataFrame, n: int) -> DataFrame:
    """First n rows in no particular order (H4): a LIMIT, so each task stops
    after n rows."""
    return df.limit(n)


def chunk(df: DataFrame, n_chunks: int, order: Sequence[str], out: str = "chunk") -> DataFrame:
    """Split an (ordered) list such as a file inventory into ``n_chunks``
    contiguous ranges of near-equal size (H11), using distributed positions
    instead of driver-side slicing."""
    from fareflow.operators.ranking import with_position
    total = df.agg(F.count(F.lit(1))).scalar()
    pos = with_position(df, list(order), "_ff_p")
    return pos.withColumn(out, F.floor(F.col("_ff_p") * n_chunks / total).cast("int")).drop("_ff_p")
