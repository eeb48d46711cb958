"""Joins (E1-E5, E9-E13, D7).

Broadcast policy: a side is broadcast explicitly only when its size is
bounded by construction (a fixed dimension such as the 25-row nation table,
a holiday calendar, one row per category).  Everything else is left to
Spark's size-checked choice (``autoBroadcastJoinThreshold`` at plan time,
AQE's runtime statistics after each stage), which falls back to a
sort-merge join with skew splitting when a side is too large.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Dim:
    """One dimension of a star join.

    ``df`` is joined on ``fact_keys == dim_keys``; ``rename`` maps dimension
    columns to output names (role-playing: the same table twice with
    different names); ``bounded`` marks a dimension whose size is fixed by
    construction and may be broadcast without a size check.
    """
    df: DataFrame
    fact_keys: Sequence[str]
    dim_keys: Sequence[str]
    rename: dict[str, str] = field(default_factory=dict)
    how: str = "left"
    bounded: bool = False


def star_join(fact: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    """Chain of left (or inner) joins of a fact table to its dimensions."""
    out = fact
    for i, d in enumerate(dims):
        tmp = [f"_ff_d{i}_{j}" for j in range(len(d.dim_keys))]
        cols = [F.col(k).alias(t) for k, t in zip(d.dim_keys, tmp)]
        cols += [F.col(c).alias(d.rename.get(c, c)) for c in d.df.columns
                 if c not in d.dim_keys and (c in d.rename or not d.rename)]
        side = d.df.select(*cols)
        if d.bounded:
            side = F.broadcast(side)
        cond = None
        for fk, t in zip(d.fact_keys, tmp):
            e = out[fk] == side[t]
            cond = e if cond is None else cond & e
        out = out.join(side, cond, d.how).drop(*tmp)
    return out


def split_matched(fact: DataFrame, dim: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with / without a match in ``dim`` (D7): semi and anti join; the
    dimension's rows are never duplicated into the fact."""
    keys = dim.select(*on).distinct()
    return fact.join(keys, list(on), "left_semi"), fact.join(keys, list(on), "left_anti")


def lookup_codes(df: DataFrame, mapping: DataFrame, col: str, key: str = "value",
                 code: str = "code", out: str | None = None) -> DataFrame:
    """Dictionary lookup (E11): category -> code by left join on a mapping
    table; unseen categories get NULL."""
    m = mapping.select(F.col(key).alias("_ff_key"), F.col(code).alias(out or f"{col}_code"))
    return df.join(m, df[col] == m["_ff_key"], "left").drop("_ff_key")


def movement(df: DataFrame, date_col: str, d1: str, d2: str, keys: Sequence[str],
             value: str = "price") -> DataFrame:
    """Value change between two observation dates per key (E13/L7): mean value
    per key on each date, full outer joined, ``v2 - v1``."""
    def side(d: str, name: str) -> DataFrame:
        return (df.filter(F.col(date_col) == F.lit(d).cast("date"))
                .groupBy(*keys).agg(F.avg(value).alias(name)))
    a, b = side(d1, "before"), side(d2, "after")
    return a.join(b, list(keys), "full_outer").withColumn("change", F.col("after") - F.col("before"))


def align_series(df: DataFrame, index: str, series: str, value: str,
                 series_values: Sequence[str]) -> DataFrame:
    """Full outer alignment of several series on a shared index (E10/F18):
    one column per series, NULL where a series has no observation."""
    return df.groupBy(index).pivot(series, list(series_values)).agg(F.min(value))
