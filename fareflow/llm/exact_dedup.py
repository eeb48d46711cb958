"""Exact duplicates by a 128-bit content hash with byte comparison.

Two texts are equal when they are identical after replacing each run of ASCII
white space by one space (null counts as empty).  Rows are grouped by the MD5
of the normalised text *and* the text itself, so the hash only deals the rows
out and the group key is compared byte by byte: texts that collide on the
hash fall into groups of their own.  The grouping pre-aggregates per task, so
a group holding a third of all rows reaches its reducer as one row per task.

The way back from group to rows joins on (hash, SHA-256, salt): the salted
keys are counted first, so no join key gathers more than a small share of a
hot group.  Only hashes and ids travel there, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import fresh, groups_to_members, normalised_text, staged

SALTS = 256


def _hash128(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_h, _sha, _keep, _n), one row per distinct normalised text."""
    norm = docs.select(F.col(id_col).alias("_id"), normalised_text(F.col(text_col)).alias("_norm"))
    g = norm.select("_id", _hash128(F.col("_norm")).alias("_h"), "_norm").groupBy("_h", "_norm") \
        .agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    return g.select("_h", F.unhex(F.sha2("_norm", 256)).alias("_sha"), "_keep", "_n")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     salts: int = SALTS) -> DataFrame:
    """One row per input row: id, ``keep_id`` (smallest id of its group),
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.

    * null text equals empty text; rows of empty text form one group;
    * a null id is kept only if every id of its group is null;
    * rows that repeat both id and text: one of them is kept;
    * an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    norm = docs.select(F.col(id_col).alias("_id"), normalised_text(F.col(text_col)).alias("_norm"))
    members = staged(spark, norm.select(
        "_id", _hash128(F.col("_norm")).alias("_h"), F.unhex(F.sha2("_norm", 256)).alias("_sha"),
        F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt")), "dedup-members")
    copies = _groups(docs, id_col, text_col).where("_n > 1")
    rows = groups_to_members(members, copies, ["_h", "_sha"], "_salt")
    # rows that repeat an id land in one (hash, salt) already: no new shuffle
    same = Window.partitionBy("_h", "_sha", "_salt", "_id").orderBy("_id")
    single = F.col("_n").isNull()
    return rows.select(
        F.col("_id").alias(id_col),
        F.when(single, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        ((single | F.col("_id").eqNullSafe(F.col("_keep"))) & (F.row_number().over(same) == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows with all their columns: of equal texts the row with the
    smallest id (one of them, if rows repeat it)."""
    key, h, sha, r = fresh(docs, "_key", "_h", "_sha", "_r")
    # ids as text, null included, so that join and window share one shuffle
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    g = _groups(docs, id_col, text_col).select(as_text("_keep").alias(key), F.col("_h").alias(h),
                                               F.col("_sha").alias(sha))
    norm = normalised_text(F.col(text_col))
    rows = docs.withColumns({key: as_text(id_col), h: _hash128(norm), sha: F.unhex(F.sha2(norm, 256))})
    kept = rows.join(g, [key, h, sha], "left_semi")
    first = Window.partitionBy(key, h, sha).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    return kept.withColumn(r, F.row_number().over(first)).where(F.col(r) == 1).select(*docs.columns)
