"""Classes of linked sets from shared buckets, without all pairs of a bucket.

Sets that share a bucket (a band, a signature) may link; whether they do is
told by a join of their texts.  Most buckets are families whose members all
link, so their classes are found from few comparisons:

1. every set meets one pivot, the smallest set of one of its buckets;
2. every set meets the pivots of its other buckets that are not in its class
   by then;
3. buckets that still hold more than one class have their sets, but for the
   pivot, compared with each other in pairs of blocks of bounded size; buckets
   with the same sets count once, and pairs within a class are skipped.

No pair that could join two classes is left out, and rows, texts that travel
and edges grow with the number of (set, bucket) rows: a family of n copies
costs n comparisons.  Only step 3 ships a text more than once or twice, for
sets that share buckets without being linked to their pivot.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import maybe_in
from fareflow.llm.components import connected_components

BLOCK = 512
#: Holders from which a shingle goes into the matrix, and the numbers that a piece of work holds.
_MANY, _CELLS = 32, 1 << 22

#: Gets the rows of one cell, (id, side, label, text) and the extra columns;
#: side 1 meets side 0 (or side 0 itself where there is no side 1), sets of
#: one label are known to be connected.  Gives edges (u, v).
CellJoin = Callable[[pa.Table], pa.Table]


def shared_shingles(own: np.ndarray, gram: np.ndarray, rows: int, cells: int = _CELLS) -> np.ndarray:
    """(rows, rows): how many shingles each two sets of a cell share.  Shingles
    that few sets hold add their pairs one by one; those of many sets form a
    0/1 matrix, multiplied by itself in pieces of about ``cells`` numbers."""
    order = np.argsort(gram, kind="stable")
    own, gram = own[order], gram[order]
    start = np.concatenate([[0], np.flatnonzero(np.diff(gram)) + 1]) if len(gram) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(gram)))
    out = np.zeros(rows * rows, dtype=np.float32)
    few = (size > 1) & (size < _MANY)
    at, n = start[few], size[few]
    step = max(1, cells // (_MANY * _MANY))
    for lo in range(0, len(at), step):
        s, k = at[lo:lo + step], n[lo:lo + step]
        entry = np.repeat(s, k) + _within(k)
        a = np.repeat(entry, np.repeat(k, k))
        b = np.repeat(np.repeat(s, k), np.repeat(k, k)) + _within(np.repeat(k, k))
        out += np.bincount(own[a] * rows + own[b], minlength=rows * rows).astype(np.float32)
    out = out.reshape(rows, rows)
    many = np.flatnonzero(size >= _MANY)
    width = max(64, cells // max(1, rows))
    for lo in range(0, len(many), width):
        part = many[lo:lo + width]
        held = np.zeros((rows, len(part)), dtype=np.float32)
        entry = np.repeat(start[part], size[part]) + _within(size[part])
        held[own[entry], np.repeat(np.arange(len(part)), size[part])] = 1
        out += held @ held.T
    np.fill_diagonal(out, np.bincount(own, minlength=rows))
    return out


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each run of the given sizes."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass(frozen=True)
class _Blocks:
    """Bounds of a block: sets, and the sum of the notes' column ``size``; and
    of that sum over the cells whose texts travel at once."""
    sets: int
    size: int | None
    notes: DataFrame | None
    at_once: int | None = None

    def rounds(self, cells: DataFrame) -> list[DataFrame]:
        """The cells in so many parts that the texts of each stay within
        ``at_once``: shuffle files are given up after each part, so what is on
        disk does not grow with the number of blocks that a set goes to."""
        if self.at_once is None:
            return [cells]
        total = cells.join(self.notes.select("id", "size"), "id").agg(F.sum("size")).first()[0] or 0
        parts = max(1, -(-int(total) // self.at_once))
        part = F.pmod(F.xxhash64("key", "a", "b", F.lit(31)), F.lit(parts))
        return [cells.where(part == i) for i in range(parts)] if parts > 1 else [cells]

    def dealt(self, rows: DataFrame, key: str, out: str, seed: int) -> DataFrame:
        """``rows`` with ``n``, over how many blocks their key's rows are dealt,
        and ``out``, the row's block.  Only keys of more than one block have a
        row in the joined table."""
        need = F.ceil(F.count(F.lit(1)) / F.lit(self.sets))
        sized = rows
        if self.size is not None:
            sized = rows.join(self.notes.select("id", "size"), "id")
            need = F.greatest(need, F.ceil(F.sum("size") / F.lit(self.size)))
        large = sized.groupBy(key).agg(need.cast("int").alias("n")).where("n > 1").withColumnRenamed(key, "_key")
        return rows.join(large, F.col(key) == F.col("_key"), "left").drop("_key") \
            .withColumn("n", F.coalesce("n", F.lit(1))) \
            .withColumn(out, F.pmod(F.xxhash64("id", F.lit(seed)), F.col("n")).cast("int"))

    def cells(self, pairs: DataFrame) -> DataFrame:
        """(key, a, b, id, side): members (side 0) in blocks, each with its
        pivot (side 1)."""
        dealt = self.dealt(pairs, "pivot", "a", 17)
        members = dealt.select(F.col("pivot").alias("key"), "a", F.lit(0).alias("b"), "id", F.lit(0).alias("side"))
        pivots = dealt.select("pivot", "a").distinct()
        return members.union(pivots.select(F.col("pivot").alias("key"), "a", F.lit(0).alias("b"),
                                           F.col("pivot").alias("id"), F.lit(1).alias("side")))

    def pairs(self, rows: DataFrame) -> DataFrame:
        """(key, a, b, id, side): every block of the rows of a ``key`` with
        itself (b = a, side 0 only) and with each other one (a < b)."""
        placed = self.dealt(rows, "key", "own", 23)
        pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.struct(
            F.least(k, F.col("own")).alias("a"), F.greatest(k, F.col("own")).alias("b"),
            (k < F.col("own")).cast("int").alias("side")))
        return placed.select("key", "id", F.explode(pairs).alias("p")).select("key", "p.a", "p.b", "id", "p.side")


def _joined(cells: DataFrame, labels: DataFrame | None, texts: DataFrame, notes: DataFrame | None,
            join: CellJoin) -> DataFrame:
    """Edges of all cells; only texts of their sets are shuffled."""
    found = cells.withColumn("label", F.col("id")) if labels is None else \
        cells.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    if notes is not None:
        found = found.join(notes, "id")
    wanted = cells.select("id").distinct()
    found = maybe_in(texts, F.xxhash64("id"), wanted, F.xxhash64("id")).join(found, "id")
    return found.groupBy("key", "a", "b").applyInArrow(join, "u long, v long")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """(pivot, id) pairs whose sets are not known to be in one class."""
    own = labels.select("id", F.col("label").alias("own"))
    other = labels.select(F.col("id").alias("pivot"), F.col("label").alias("other"))
    return pairs.join(own, "id", "left").join(other, "pivot", "left") \
        .where(F.coalesce("own", "id") != F.coalesce("other", "pivot")).select("pivot", "id")


def _after_pivots(edges: DataFrame) -> DataFrame:
    """(id, label) after the first round, where each set has one edge at most,
    to a smaller set: the end of its path, or a set some steps along it."""
    up = edges.select(F.greatest("u", "v").alias("id"), F.least("u", "v").alias("label"))
    for _ in range(2):
        on = up.select(F.col("id").alias("label"), F.col("label").alias("on"))
        up = up.join(on, "label", "left").select("id", F.coalesce("on", "label").alias("label"))
    return up


def linked_classes(near: DataFrame, texts: DataFrame, join: CellJoin, stage: Callable[[DataFrame, str], DataFrame],
                       weight: Column | None = None, notes: DataFrame | None = None,
                   active: Callable[[DataFrame], DataFrame] | None = None, block: int | None = None,
                   block_size: int | None = None, at_once: int | None = None, early: bool = False) -> DataFrame:
    """(node, component) of linked sets; sets that link with nothing are left out.

    ``near`` holds (bucket, id, root): the sets of every bucket of two or more,
    root the smallest, and maybe a column ``able`` (false: the set cannot link
    with the root).  ``texts`` holds (id, text), ``notes`` (id, ...) what ``join``
    needs besides, one row for each set.
    A set meets first the root with the largest sum of ``weight`` (one a row).
    ``active`` may drop rows of (key, a, b, id, side, label, notes) that cannot
    link with anything in their cell; it gives (key, id).  It looks at the cells
    of step 3, and with ``early`` at those of step 2 too.  ``block`` sets meet
    in a cell at most, and no more than their ``size`` in the notes sums up to
    ``block_size``, if given.  Cells meet in rounds whose sets' ``size`` sums
    up to about ``at_once``, if given.
    """
    blocks = _Blocks(block or BLOCK, block_size, notes, at_once)

    def met_in(cells: DataFrame, known: DataFrame | None) -> DataFrame:
        found = [stage(_joined(part, known, texts, notes, join), "pivot-edges") for part in blocks.rounds(cells)]
        return reduce(DataFrame.unionAll, found)

    def open_in(cells: DataFrame) -> DataFrame:
        found = []
        for part in blocks.rounds(cells):
            seen = part.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
            seen = seen if notes is None else seen.join(notes, "id")
            found.append(stage(active(seen).select("key", "id").distinct(), "pivot-active"))
        return reduce(DataFrame.unionAll, found).distinct()
    able = F.col("able") if "able" in near.columns else F.lit(True)
    met = near.where((F.col("id") != F.col("root")) & able)
    pairs = stage(met.groupBy("id", F.col("root").alias("pivot"))
                  .agg(F.sum(F.lit(1.0) if weight is None else weight).alias("w")), "pivot-pairs")
    best = pairs.groupBy("id").agg(F.max_by("pivot", F.struct("w", -F.col("pivot"))).alias("pivot"))
    edges = met_in(stage(blocks.cells(best), "pivot-cells"), None)
    labels = stage(_after_pivots(edges), "pivot-labels")

    rest = _apart(pairs.select("id", "pivot").join(best, ["id", "pivot"], "left_anti"), labels)
    rest = stage(rest, "pivot-rest")
    if early and active is not None and not rest.isEmpty():
        rest = open_in(stage(blocks.cells(rest), "pivot-cells")).where("id <> key").select(F.col("key").alias("pivot"), "id")
        rest = stage(rest, "pivot-rest")
    cells = stage(blocks.cells(rest), "pivot-cells")
    if not cells.isEmpty():
        edges = edges.union(met_in(cells, labels))
    classes = stage(connected_components(edges), "pivot-classes")
    labels = classes.select(F.col("node").alias("id"), F.col("component").alias("label"))

    named = near.where("id <> root").select("bucket", "id").join(labels, "id", "left") \
        .withColumn("label", F.coalesce("label", "id"))
    split = named.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("k1"),
        F.count(F.lit(1)).alias("k2"), F.min("id").alias("k3"), F.max("id").alias("k4")).where("low <> high")
    # buckets with the same sets are one
    split = stage(split.groupBy("k1", "k2", "k3", "k4").agg(F.min("bucket").alias("bucket")).select("bucket"), "pivot-split")
    if split.isEmpty():
        return classes
    left = stage(near.where("id <> root").join(split, "bucket").select(F.col("bucket").alias("key"), "id"), "pivot-left")
    cells = blocks.pairs(left)
    if active is not None:
        cells = blocks.pairs(stage(open_in(stage(cells, "pivot-cells")), "pivot-active"))
    more = met_in(stage(cells, "pivot-cells"), labels)
    if more.isEmpty():
        return classes
    # the new edges join classes, of which only the smallest members count
    for end in ("u", "v"):
        other = labels.select(F.col("id").alias(end), "label")
        more = more.join(other, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    joined = connected_components(more).select(F.col("node").alias("label"), F.col("component").alias("new"))
    known = labels.union(joined.select(F.col("label").alias("id"), "label")).distinct()
    return known.join(joined, "label", "left") \
        .select(F.col("id").alias("node"), F.coalesce("new", "label").alias("component"))
