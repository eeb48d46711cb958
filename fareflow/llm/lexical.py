"""Ranked lexical search: the best documents of every query item, exactly.

A document is a vector of integer impacts over the terms of the items, an item
a 0/1 vector, the score their inner product.  Search goes by vector length:

* the impact vectors are written in descending order of their Euclidean
  length and read in buckets of ``BUCKET`` neighbours;
* an item skips a bucket when |item| * (longest vector) cannot reach its 50th
  best score so far (Cauchy-Schwarz), and with it all shorter ones;
* inside a bucket the largest impact of each coordinate bounds an item again;
  then, per document, the exact impacts of the item's ``FOCUS`` strongest
  coordinates plus the smaller of two bounds of the rest (by largest impacts,
  by the length that is left);
* survivors are scored in 64-bit integers.

The first bound of each item comes from searching the longest vectors only
(``SEED_SHARE`` of them); tasks then go on from there on their own and give
their best ``top`` rows an item.  Every document is in the index and every
bound is an upper one, so nothing that belongs to the result is skipped.

Items are taken in blocks of at most ``BLOCK_TERMS`` (item, term) pairs, which
bounds what is sent to tasks; the documents are read once for each block.
Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import passing, staged, text_chunks
from fareflow.operators.ranking import with_prefix_sum

TOP = 50
BUCKET = 256
FOCUS = 8
SEED_SHARE = 1 / 64
BLOCK_TERMS = 1 << 20

#: Bytes of terms: digits, letters (A-Z as a-z) and all of other scripts.
_TERM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of the text, term) of all terms of a chunk of texts in order;
    null has none."""
    parts = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    raw = np.frombuffer(b"".join(p + b"\n" for p in parts), dtype=np.uint8)
    keep = _TERM[raw]
    edge = np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_end = np.cumsum([len(p) + 1 for p in parts])
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[raw[keep]])])
    return np.searchsorted(text_end, start, side="right"), found


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = 0
        for chunk in text_chunks(b.column(1)):
            own, found = terms(chunk)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(chunk)).take(pa.array(own)), found.cast(pa.binary())],
                                             names=["item", "term"])
            at += len(chunk)


def _frequencies(vocabulary: pa.Array):
    """(id, n, term, tf): a text's number of terms, and how often it holds each
    term of the vocabulary (by its place there)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for chunk in text_chunks(b.column(1)):
                rows = len(chunk)
                own, found = terms(chunk)
                place = pc.index_in(found, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
                known = place >= 0
                key, tf = np.unique(own[known] * np.int64(len(vocabulary)) + place[known], return_counts=True)
                ends = np.searchsorted(key, np.arange(rows + 1) * np.int64(len(vocabulary)))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32()))
                         for x in (key % len(vocabulary), tf)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, rows), pa.array(np.bincount(own, minlength=rows), pa.int64()), *lists],
                    names=["id", "n", "term", "tf"])
                at += rows
    return run


def _document_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["term", "df"])
    return run


def _impacts(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _flat(b: pa.RecordBatch, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, impact) of all coordinates of a batch (m, term, tf)."""
    lists = b.column("term")
    size = pc.list_value_length(lists).to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    term, tf = lists.flatten().to_numpy(), b.column("tf").flatten().to_numpy().astype(np.int64)
    return row, term, _impacts(tf, b.column("m").to_numpy()[row], weight[term])


def _lengths(weight: np.ndarray):
    """Adds the vector's length, rounded up so that bounds stay upper ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, _, impact = _flat(b, weight)
            square = np.bincount(row, weights=impact.astype(np.float64) ** 2, minlength=b.num_rows)
            yield b.append_column("length", pa.array(np.sqrt(square) * (1 + 1e-9)))
    return run


class _Best:
    """The best ``top`` (score, id) of each item, equal scores by smaller id."""

    def __init__(self, bounds: np.ndarray, top: int):
        self.bounds, self.top = np.maximum(bounds, 1), top
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.bounds[item]
        item, score, ids = item[good], score[good], ids[good]
        order = np.argsort(item, kind="stable")
        item, score, ids = item[order], score[order], ids[order]
        cut = np.flatnonzero(np.diff(item)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(item)]):
            if lo == hi:
                continue
            i = int(item[lo])
            s, d = self.rows.get(i, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            s, d = np.concatenate([s, score[lo:hi]]), np.concatenate([d, ids[lo:hi]])
            if len(s) > self.top:
                keep = np.lexsort((d, -s))[:self.top]
                s, d = s[keep], d[keep]
                self.bounds[i] = max(self.bounds[i], s[-1])
            self.rows[i] = s, d

    def result(self) -> pa.RecordBatch:
        item = np.repeat(np.array(list(self.rows), np.int32), [len(s) for s, _ in self.rows.values()])
        s, d = ([x[k] for x in self.rows.values()] or [np.zeros(0, np.int64)] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(np.concatenate(d)), pa.array(np.concatenate(s))],
                                          names=["item", "id", "score"])


def search_bucket(row: np.ndarray, term: np.ndarray, impact: np.ndarray, length: np.ndarray, ids: np.ndarray,
                  starts: np.ndarray, item_terms: np.ndarray, best: _Best) -> bool:
    """Search one bucket for all items (terms of item i: ``item_terms`` from
    ``starts[i]`` to ``starts[i + 1]``).  False: no item can find anything here,
    nor among shorter vectors."""
    count = np.diff(starts)
    alive = np.sqrt(count) * length.max() >= best.bounds
    if not alive.any():
        return False
    # largest impact of each coordinate, and the coordinate's entries
    order = np.argsort(term, kind="stable")
    row, term, impact = row[order], term[order], impact[order]
    coordinate, first = np.unique(term, return_index=True)
    last = np.append(first[1:], len(term))
    most = np.maximum.reduceat(impact, first)
    items = np.flatnonzero(alive)
    entry = np.repeat(items, count[items])
    wanted = item_terms[np.repeat(starts[items], count[items]) + _within(count[items])]
    at = np.searchsorted(coordinate, wanted)
    here = (at < len(coordinate)) & (coordinate[np.minimum(at, len(coordinate) - 1)] == wanted)
    entry, at = entry[here], at[here]
    limit = np.bincount(entry, weights=most[at], minlength=len(count))
    alive = alive & (limit * (1 + 1e-9) >= best.bounds)
    go = alive[entry]
    entry, at = entry[go], at[go]
    if not len(entry):
        return True
    # strongest coordinates of each item first
    order = np.lexsort((-most[at], entry))
    entry, at = entry[order], at[order]
    new = np.concatenate([[0], np.flatnonzero(np.diff(entry)) + 1])
    sizes = np.diff(np.append(new, len(entry)))
    focus = _within(sizes) < FOCUS
    width, items = len(length), entry[new]
    slot = np.repeat(np.arange(len(items)), sizes)
    seen, square = _sums(slot[focus], at[focus], first, last, row, impact, len(items) * width, width)
    left = np.bincount(slot[~focus], weights=most[at[~focus]], minlength=len(items))
    others = np.bincount(slot[~focus], minlength=len(items))
    rest = np.sqrt(others)[:, None] * np.sqrt(np.maximum(length[None, :] ** 2 - square.reshape(-1, width), 0) + 1)
    bound = seen.reshape(-1, width) + np.minimum(rest, left[:, None])
    passed = bound * (1 + 1e-9) >= best.bounds[items][:, None]
    score = seen.reshape(-1, width).astype(np.int64)
    more = ~focus & passed.any(axis=1)[slot]
    if more.any():
        key, value = _spread(slot[more], at[more], first, last, row, impact, width)
        good = passed.ravel()[key]
        np.add.at(score.reshape(-1), key[good], value[good])
    which, doc = np.nonzero(passed)
    best.add(items[which], score[which, doc], ids[doc])
    return True


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each run of the given sizes."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _spread(slot, at, first, last, row, impact, width) -> tuple[np.ndarray, np.ndarray]:
    """(slot * width + row, impact) of all entries of the coordinates ``at``."""
    size = last[at] - first[at]
    entry = np.repeat(first[at], size) + _within(size)
    return np.repeat(slot, size) * width + row[entry], impact[entry]


def _sums(slot, at, first, last, row, impact, cells, width) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and float sums of squares of the entries, per (slot, row)."""
    key, value = _spread(slot, at, first, last, row, impact, width)
    total = np.zeros(cells, dtype=np.int64)
    np.add.at(total, key, value)
    return total, np.bincount(key, weights=value.astype(np.float64) ** 2, minlength=cells)


def _search(starts: np.ndarray, item_terms: np.ndarray, weight: np.ndarray, bounds: np.ndarray, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, going = _Best(bounds.copy(), top), True
        for b in batches:
            if not going:
                continue
            for lo in range(0, b.num_rows, BUCKET):
                part = b.slice(lo, BUCKET)
                row, term, impact = _flat(part, weight)
                going = search_bucket(row, term, impact, part.column("length").to_numpy(), part.column("id").to_numpy(),
                                      starts, item_terms, best)
                if not going:
                    break
        yield best.result()
    return run


def _block(docs: DataFrame, pairs: DataFrame, top: int, stage) -> DataFrame | None:
    """(item, id, score) of one block of items, ``item`` a number; and the
    item's id.  At most BLOCK_TERMS pairs reach the driver."""
    spark = docs.sparkSession
    found = pairs.select("item", "term").toArrow().combine_chunks()
    names = found["item"].combine_chunks().dictionary_encode(null_encoding="encode")
    vocabulary = pc.unique(found["term"].combine_chunks().cast(pa.large_binary()))
    tf = stage(docs.mapInArrow(_frequencies(vocabulary), "id long, n long, term array<int>, tf array<int>"), "lexical-terms")
    many, total = tf.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not many:
        return None
    weights = tf.select("term").mapInArrow(_document_counts(len(vocabulary)), "term int, df long").groupBy("term") \
        .agg(F.sum("df").alias("df")).select("term", F.floor(1000 * F.log(
            F.lit(2.0 * many + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long").alias("w"))
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for r in weights.collect():
        weight[r["term"]] = r["w"]
    place = pc.index_in(found["term"].combine_chunks().cast(pa.large_binary()), value_set=vocabulary).to_numpy()
    item = names.indices.to_numpy()
    order = np.lexsort((place, item))
    order = order[weight[place[order]] > 0]
    item, place = item[order], place[order]
    starts = np.searchsorted(item, np.arange(len(names.dictionary) + 1))
    vectors = tf.where("size(term) > 0 AND id IS NOT NULL").select(
        "id", (F.lit(50) + F.expr(f"(50 * n * {many}L) div {total}L")).cast("long").alias("m"), "term", "tf")
    vectors = vectors.mapInArrow(_lengths(weight), "id long, m long, term array<int>, tf array<int>, length double")
    vectors = stage(vectors.where("length > 0").repartitionByRange(F.desc("length"), F.col("id"))
                    .sortWithinPartitions(F.desc("length")), "lexical-vectors")
    bounds = np.zeros(len(names.dictionary), dtype=np.int64)
    kind = "item int, id long, score long"
    longest = vectors.agg(F.percentile_approx("length", F.lit(1 - SEED_SHARE), F.lit(1000))).first()[0]
    if longest is not None:
        seeds = vectors.where(F.col("length") >= longest).mapInArrow(_search(starts, place, weight, bounds, top), kind)
        last = seeds.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "id"))) \
            .where(F.col("r") == top).select("item", "score")
        for r in last.collect():
            bounds[r["item"]] = r["score"]
    hits = vectors.mapInArrow(_search(starts, place, weight, bounds, top), kind)
    labels = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(names.dictionary)), pa.int32()),
                                             "item_id": names.dictionary}))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(labels, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item, rank, id, score): each item's ``top`` documents by score, equal
    scores by smaller id; all with a score above 0 if there are fewer.

    * null, empty and termless texts are in no result and no count; termless
      items have no rows;
    * rows that repeat an item's id (null included) are one item with the terms
      of all; every document row counts and ranks by itself, so a repeated row
      may take two ranks;
    * a document without id counts in all statistics but is never listed;
    * empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = items.schema[item_col].dataType.simpleString()
    with passing(spark) as stage:
        pairs = stage(items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
                      .mapInArrow(_item_terms, f"item {kind}, term binary").distinct(), "lexical-items")
        sizes = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
        upto = with_prefix_sum(sizes, ["item"], "n", "before")
        dealt = upto.select(F.col("item").alias("of"), F.expr(f"before div {BLOCK_TERMS}").alias("block"))
        pairs = stage(pairs.join(dealt, F.col("item").eqNullSafe(F.col("of"))).select("item", "term", "block"),
                      "lexical-blocks")
        out = []
        for (block,) in sorted(pairs.select("block").distinct().collect()):
            found = _block(base, pairs.where(F.col("block") == block), top, stage)
            if found is not None:
                out.append(staged(spark, found, "lexical-ranked"))
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for found in out:
        result = result.unionAll(found.select(result.columns))
    return result.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
