"""Loading the driver tables (A3) and many-root Parquet scans (A4/A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; callers ``select`` right away so Catalyst
    prunes the ``ReadSchema`` and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet_roots(spark: SparkSession, *paths: str, merge_schema: bool = False,
                       base_path: str | None = None) -> DataFrame:
    """One scan over several roots / globs (A4) instead of a driver loop of
    per-folder jobs.  ``base_path`` keeps partition columns when reading a
    subset of ``key=value`` folders (A5/A18)."""
    r = spark.read.option("mergeSchema", str(merge_schema).lower())
    if base_path:
        r = r.option("basePath", base_path)
    return r.parquet(*paths)


def read_buckets(spark: SparkSession, path: str, buckets: Sequence[int], column: str = "bucket") -> DataFrame:
    """Chosen pieces of a bucket export (A18): only their folders are listed
    and read; a bucket that was not written fails."""
    folders = [f"{path.rstrip('/')}/{column}={b}" for b in buckets]
    return spark.read.option("basePath", path).parquet(*folders)
