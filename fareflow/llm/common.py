"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fareflow.session import drop_stage, giving_up_shuffles, stage_path

#: White space of the word and normalisation rules (ASCII only).
WS_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have, so that
    extra input columns never clash with working columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def not_taken(df: DataFrame, *names: str) -> None:
    """Fail where a result column would replace one of the input's."""
    taken = sorted({n for n in names if n.lower() in {c.lower() for c in df.columns}})
    if taken:
        raise ValueError(f"the table already has {', '.join(taken)}: name another result column")


def staged(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage,
    survives lost executors and gives Spark the real size of the table.  The
    shuffle files behind it go when the table is written."""
    path = path or stage_path(spark, name)
    with giving_up_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A form of ``staged`` for tables that only steps inside the block read:
    their folders are deleted at its end."""
    paths = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        paths.append(stage_path(spark, name))
        return staged(spark, df, name, paths[-1])
    try:
        yield stage
    finally:
        for path in paths:
            drop_stage(spark, path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Inside the block texts go to Python about ``size`` bytes at a time:
    Spark's own batches count rows, and are held on both sides several times."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done: it does so
    when the driver's garbage is collected, which a long job may not trigger
    before executors have run out of disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def normalised_text(col: Column) -> Column:
    """Null as empty, each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), WS_CLASS + "+", " ")


def fold(doc_id: Column, mod: int, rest: int) -> Column:
    """True for rows whose crc32 of the id as text leaves ``rest``; a null id
    is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


def groups_to_members(members: DataFrame, groups: DataFrame, keys: list[str], salt: str) -> DataFrame:
    """Left join of ``groups`` (one row per ``keys``) to the rows of
    ``members`` over (keys, salt).  The pairs that occur are counted first, so
    a group holding a third of all rows is spread over its salts."""
    seats = members.select(*keys, salt).groupBy(*keys, salt).count().drop("count")
    return members.join(seats.join(groups, keys), [*keys, salt], "left")


#: Words of 64 bits in the filter of ``maybe_in``: its size never grows.
FILTER_WORDS = 1 << 17


def flag_maybe(rows: DataFrame, row_hash: Column, keys: DataFrame, key_hash: Column, flag: str,
               words: int = FILTER_WORDS) -> DataFrame:
    """``rows`` with a boolean: may the row's 64-bit hash be among those of
    ``keys``?  False is certain.  A bit table of a fixed size is broadcast, so
    that only flagged rows need an exact join, and its shuffle."""
    word, bits, own = fresh(rows, "_word", "_bits", "_hash")
    place = lambda h: F.pmod(h, F.lit(words)).cast("int")
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"),
                                    F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int"))
    table = keys.select(key_hash.alias("_k")).groupBy(place(F.col("_k")).alias(word)) \
        .agg(F.bit_or(bit(F.col("_k"))).alias(bits))
    hashed = rows.withColumn(own, row_hash)
    hashed = hashed.withColumn(word, place(F.col(own)))
    hit = F.coalesce(F.col(bits).bitwiseAND(bit(F.col(own))) != 0, F.lit(False))
    return hashed.join(F.broadcast(table), word, "left").select(*rows.columns, hit.alias(flag))


def maybe_in(rows: DataFrame, row_hash: Column, keys: DataFrame, key_hash: Column) -> DataFrame:
    """Rows that ``flag_maybe`` flags: all that match and a few more."""
    flag, = fresh(rows, "_maybe")
    return flag_maybe(rows, row_hash, keys, key_hash, flag).where(F.col(flag)).drop(flag)


def text_chunks(texts: pa.Array, max_bytes: int = 2_000_000, max_rows: int = 1024) -> Iterator[pa.Array]:
    """Cut an Arrow text column so that a chunk holds at most ``max_bytes``
    (one longer text forms a chunk of its own): what a kernel holds beside its
    batch is bounded.  No text is cut."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > max_bytes or i - start >= max_rows):
            yield texts.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(texts) > start:
        yield texts.slice(start)


def text_udf(kernel: Callable[[pa.Array], pa.Array], returns: str,
             max_bytes: int = 2_000_000) -> Callable[[Column], Column]:
    """A column function of one text column from ``kernel``, which maps a
    chunk of texts (nulls included) to as many results."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [kernel(c) for c in text_chunks(batch, max_bytes)]
            yield pa.concat_arrays(parts) if parts else kernel(batch)
    return arrow_udf(run, returns)


def bounded_sample(rows: DataFrame, strata: str, per_stratum: int, seed: int = 11) -> DataFrame:
    """About ``per_stratum`` rows of each value of ``strata``, chosen by a
    seeded hash of all columns.  Used for training only."""
    n, key = fresh(rows, "_n", "_k")
    # written, so that Spark sees how small it is and need not shuffle the texts
    counts = staged(rows.sparkSession, rows.groupBy(F.col(strata).alias(key)).agg(F.count(F.lit(1)).alias(n)),
                    "sample-counts")
    share = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in rows.columns]), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(counts, rows[strata] == counts[key]).where(share * F.col(n) < per_stratum).drop(n, key)


def class_weights(rows: DataFrame, label: str, sampled: np.ndarray) -> np.ndarray:
    """Weights that give the sampled 0/1 labels the shares that they have in
    all labelled rows, with mean 1."""
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    out = np.ones(len(sampled))
    for value in (0, 1):
        own = sampled == value
        out[own] = counts.get(value, 0) / max(1, own.sum())
    return out * len(out) / max(1.0, out.sum())
