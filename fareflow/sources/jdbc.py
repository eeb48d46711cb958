"""Relational sources (A15) behind the same ``load_table(name)`` interface
as the Parquet tables.  Reads are split over ``numPartitions`` ranges of a
numeric column so the database is read in parallel, never through one
connection for a large table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int = 64) -> DataFrame:
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def table_loader(spark: SparkSession, root: str | None = None, url: str | None = None,
                 properties: dict | None = None, splits: dict[str, dict] | None = None):
    """``load(name)`` over Parquet files under ``root`` or a JDBC database.
    ``splits`` gives the ``read_jdbc`` split options of each large table
    (``partition_column``, ``lower``, ``upper``, ``num_partitions``); a table
    without them is read over one connection."""
    from fareflow.sources.tables import load_table

    def load(name: str) -> DataFrame:
        if url is not None:
            return read_jdbc(spark, url, name, properties, **(splits or {}).get(name, {}))
        return load_table(spark, root, name)
    return load
