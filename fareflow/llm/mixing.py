"""Mixing sources to target weights by capped water-filling.

Sizes are words.  The sources share ``share`` times all words by weight; a
source's target stops at ``max_epochs`` times its size and what exceeds that
is shared again by weight among the others, until no target is above its cap.
Sorted by cap / weight the clamped sources are a prefix, so the fixed point is
found in one pass over one row per source.

A source is then taken whole ``floor(target / size)`` times, and the rest of
its target is filled with its documents in a seeded hash order.  The document
in which the target falls gives the words that are still missing, so each
source meets its target to the word.  The order is not sorted as a whole:
words are summed per (source, hash bucket), and only the bucket that holds
the cut is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import WORD_CLASS, fresh, staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-7"
BUCKETS = 1024
_HASH_BITS = 60


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")), F.lit(0)).cast("long")


def _order_key(doc_id: Column, seed: str) -> Column:
    """60 bits of the MD5 of seed and id: the seeded order of documents."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``.  One row per source:
    the unpartitioned windows read the list of sources, not documents."""
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("_pos", F.row_number().over(by_name))
    s = s.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                        ((F.col("_pos") - 1) % len(weights) + 1).cast("int")))
    s = s.withColumns({"_cap": F.col("source_size").cast("double") * float(max_epochs),
                       "_all": F.sum("source_size").over(everything).cast("double") * float(share)})
    by_ratio = everything.orderBy(F.col("_cap") / F.col("_w"), "_pos")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumns({"_before": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
                       "_onward": F.sum("_w").over(onward)})
    full = (F.col("_all") - F.col("_before")) * F.col("_w") >= F.col("_cap") * F.col("_onward")
    s = s.withColumn("_full", full)
    s = s.withColumns({
        "_left": F.col("_all") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything),
        "_open": F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))).over(everything)})
    level = F.when(F.col("_full"), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_left") * F.col("_w") / F.col("_open")))
    return s.select("source", "source_size", level.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        buckets: int = BUCKETS, extra: list[str] | None = None) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``,
    ``taken`` and the columns in ``extra`` (``taken`` counts repetitions).

    * null text has size 0; the null source is a source, last in order;
    * a source without words has target 0;
    * rows that repeat an id share one place in the seeded order;
    * an empty table gives an empty result.
    """
    spark = docs.sparkSession
    extra = extra or []
    base = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
                       words(F.col(text_col)).alias("_size"), _order_key(F.col(id_col), seed).alias("_key"))
    slim = staged(spark, base, "mix-sizes")
    shift = _HASH_BITS - (buckets - 1).bit_length()
    bucket = F.shiftright("_key", shift)
    per_bucket = staged(spark, slim.groupBy(F.col("_source").alias("source"), bucket.alias("_bucket"))
                        .agg(F.sum("_size").alias("_words")), "mix-buckets")
    targets = source_targets(per_bucket.groupBy("source").agg(F.sum("_words").alias("source_size")),
                             weights, share, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("_whole", ratio.cast("long")) \
        .withColumn("_rest", F.floor(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long"))
    targets = staged(spark, targets, "mix-targets")

    # the bucket in which a source's rest ends
    up_to = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    b = per_bucket.withColumn("_sum", F.sum("_words").over(up_to))
    b = b.join(targets.select(F.col("source").alias("_s"), "_rest"), F.col("source").eqNullSafe(F.col("_s")))
    cut = b.where((F.col("_sum") > F.col("_rest")) & (F.col("_sum") - F.col("_words") <= F.col("_rest"))
                  & (F.col("_rest") > 0)) \
        .select("source", F.col("_bucket").alias("_cut"),
                (F.col("_rest") - (F.col("_sum") - F.col("_words"))).alias("_need"))
    # order only that bucket's documents, summed per place in the order
    inside = slim.join(cut, F.col("_source").eqNullSafe(F.col("source")) & (bucket == F.col("_cut"))) \
        .groupBy("source", "_key", "_need").agg(F.sum("_size").alias("_words"))
    in_order = Window.partitionBy("source").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("_sum", F.sum("_words").over(in_order))
    edge = inside.where((F.col("_sum") > F.col("_need")) & (F.col("_sum") - F.col("_words") <= F.col("_need"))) \
        .select(F.col("source").alias("_s2"), F.col("_key").alias("_edge"), F.col("_words").alias("_edge_words"),
                (F.col("_need") - (F.col("_sum") - F.col("_words"))).alias("_edge_need"))
    plan = targets.join(edge, F.col("source").eqNullSafe(F.col("_s2")), "left").drop("_s2")
    # written, so that Spark sees its size and broadcasts it only if it is small
    plan = staged(spark, plan.withColumnRenamed("source", "_src"), "mix-plan")

    if extra:
        names = fresh(docs, "_id", "_size", "_key")
        full = docs.withColumns({names[1]: words(F.col(text_col)), names[2]: _order_key(F.col(id_col), seed)})
        rows, sid, size, key, src = full, F.col(id_col), F.col(names[1]), F.col(names[2]), F.col(source_col)
    else:
        rows, sid, size, key, src = slim, F.col("_id"), F.col("_size"), F.col("_key"), F.col("_source")
    plan = plan.toDF(*[f"_plan{c}" for c in plan.columns])
    p = lambda c: F.col(f"_plan{c}")
    rows = rows.join(plan, src.eqNullSafe(p("_src")), "left")
    part = F.when(p("_rest") <= 0, F.lit(0)) \
        .when(p("_edge").isNull() | (key < p("_edge")), size) \
        .when(key == p("_edge"), F.floor(size * p("_edge_need") / p("_edge_words"))) \
        .otherwise(F.lit(0)).cast("long")
    return rows.select(*[F.col(c) for c in extra], *([] if id_col in extra else [sid.alias(id_col)]),
                       size.alias("size"), p("source_size").cast("long").alias("source_size"),
                       p("target").alias("target"), (p("_whole") * size + part).alias("taken"))
