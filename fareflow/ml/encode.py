"""Category encodings (M1, M2, M3, E11, M24) as plain DataFrames.

The mapping tables have one row per distinct category, so they are small
(bounded by the number of levels) and are computed from a pre-aggregated
distinct, never by collecting values to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.operators.ranking import with_position


def alphabetical_index(df: DataFrame, col: str, value: str = "value", code: str = "code") -> DataFrame:
    """``value -> code`` with codes 0.. in alphabetical order (M2,
    LabelEncoder semantics).  The window runs over the distinct levels only."""
    levels = df.select(F.col(col).alias(value)).filter(F.col(value).isNotNull()).distinct()
    # distributed positions: the number of levels is not bounded in general
    return with_position(levels, [value], "_ff_p").select(value, F.col("_ff_p").cast("int").alias(code))


def frequency_index(df: DataFrame, col: str, value: str = "value", code: str = "code") -> DataFrame:
    """``value -> index`` by descending frequency, ties alphabetical (M1,
    StringIndexer ``frequencyDesc``); counts are aggregated first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(value)).agg(
        F.count(F.lit(1)).alias("count"))
    pos = with_position(counts, [F.desc("count"), F.asc(value)], "_ff_p")
    return pos.select(value, "count", F.col("_ff_p").cast("int").alias(code))


def one_hot_long(df: DataFrame, id_cols: list[str], col: str, mapping: DataFrame,
                 value: str = "value", code: str = "code") -> DataFrame:
    """One-hot encoding in long form (M3, ``dropLast=False``): one row per
    input row with the index of its hot slot and the vector size."""
    size = mapping.agg(F.count(F.lit(1))).scalar()
    m = mapping.select(F.col(value).alias("_ff_v"), F.col(code).alias("hot"))
    return (df.select(*id_cols, col).join(m, F.col(col) == F.col("_ff_v"), "left")
            .select(*id_cols, col, "hot", size.cast("int").alias("size")))


def unseen_levels(train: DataFrame, score: DataFrame, col: str) -> DataFrame:
    """Levels present at scoring time but absent from training."""
    a = train.select(F.col(col).alias("level")).distinct()
    b = score.select(F.col(col).alias("level")).filter(F.col("level").isNotNull()).distinct()
    return b.join(a, "level", "left_anti")
