"""Near-duplicates by b-bit MinHash.

Every text's set of word shingles gets ``MINIMA`` minima of hashed shingles.
Bands of ``BAND`` whole minima each name a bucket: sets that share one are
candidates.  Of each minimum only the lowest two bits are kept, packed into
four longs; two sets' signatures agree in about J + (1 - J) / 4 of the places,
so (agreement - 1/4) * 4/3 estimates their similarity J, with the chance hits
taken off.  It is a bit count of an exclusive or.  Pairs whose estimate lies
more than ``MARGIN`` standard errors below the threshold go no further; the
others are confirmed on their full sets.

Chances at a similarity of 0.85: no common band (1 - 0.85^5)^25 < 5e-7, an
estimate beyond the margin < 1e-5; both fall fast above the threshold.

Classes come from pivot rounds (``pivots``): a family of n near copies costs n
confirmations and n edges, whatever its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import flag_maybe, groups_to_members, maybe_in, passing, staged, text_chunks
from fareflow.llm.ngram_join import Union, ngram_sets
from fareflow.llm.pivots import linked_classes, shared_shingles
from fareflow.llm.tokens import mix

NGRAM = 3
#: Threshold as a fraction of integers: 100 * intersection >= 85 * union.
PERCENT = 85
MINIMA = 128
BAND = 5
BITS = 2
MARGIN = 4.5
SALTS = 64
#: Sets that meet in one cell, and the shingles that they have at most (one larger set is a cell of its own).
BLOCK = 1536
BLOCK_SHINGLES = 1 << 18
_WORDS = MINIMA * BITS // 64
_PLACES = 64 // BITS
_rng = np.random.default_rng(85)
_XOR = _rng.integers(1, 1 << 63, MINIMA, dtype=np.uint64)
_FACTOR = _rng.integers(1, 1 << 62, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(gram: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, MINIMA): the least hash of each set under each hash function;
    ``starts`` are the first elements of the (non-empty) sets."""
    out = np.empty((len(starts), MINIMA), dtype=np.uint64)
    for k in range(MINIMA):
        out[:, k] = np.minimum.reduceat((gram ^ _XOR[k]) * _FACTOR[k], starts)
    return mix(out)


def pack(least: np.ndarray) -> np.ndarray:
    """(sets, words): the lowest bits of the minima, 32 minima to a long."""
    low = (least & np.uint64((1 << BITS) - 1)).reshape(len(least), _WORDS, _PLACES)
    return np.bitwise_or.reduce(low << (np.arange(_PLACES, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def band_keys(least: np.ndarray) -> np.ndarray:
    """(sets, bands): hash of the whole minima of each band."""
    bands = MINIMA // BAND
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(least), 1))
    for j in range(BAND):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + least[:, j:bands * BAND:BAND])
    return out


def least_agreement(percent: int) -> int:
    """Agreeing places below which a pair is let go: the expected number at
    the threshold less ``MARGIN`` standard errors."""
    chance = 1 / (1 << BITS)
    p = percent / 100 + (1 - percent / 100) * chance
    return max(0, math.floor(MINIMA * p - MARGIN * math.sqrt(MINIMA * p * (1 - p))))


def agreement(a: Column, b: Column) -> Column:
    """Places in which two packed signatures agree."""
    differ = F.lit(0)
    for k in range(_WORDS):
        x = F.element_at(a, k + 1).bitwiseXOR(F.element_at(b, k + 1))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return F.lit(MINIMA) - differ


def similarity(agreed: Column) -> Column:
    """Estimate of the Jaccard similarity, collisions of the kept bits taken off."""
    chance = 1 / (1 << BITS)
    return F.greatest(F.lit(0.0), (agreed / MINIMA - chance) / (1 - chance))


def agreements(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(rows of a, rows of b): ``agreement`` of all pairs of two small blocks."""
    x = a[:, None, :] ^ b[None, :, :]
    return MINIMA - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=2, dtype=np.int64)


def _describe(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for chunk in text_chunks(b.column(1)):
                rows = len(chunk)
                own, gram = ngram_sets(chunk, ngram)
                n = np.bincount(own, minlength=rows)
                ends = np.cumsum(n)
                some = np.flatnonzero(n)
                sigs, bands = np.zeros((rows, _WORDS), np.uint64), np.zeros((rows, MINIMA // BAND), np.uint64)
                key = np.zeros((rows, 2), np.uint64)
                if len(some):
                    starts = (ends - n)[some]
                    least = minima(gram, starts)
                    sigs[some], bands[some] = pack(least), band_keys(least)
                    for j, salt in enumerate((0, 0x589965CC75374CC3)):
                        key[some, j] = np.add.reduceat(mix(gram ^ np.uint64(salt)), starts)
                fixed = lambda x: pa.ListArray.from_arrays(
                    pa.array(np.arange(rows + 1) * x.shape[1], pa.int32()), pa.array(x.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, rows), pa.array(n, pa.int64()), pa.array(key[:, 0].copy().view(np.int64)),
                     pa.array(key[:, 1].copy().view(np.int64)), fixed(sigs), fixed(bands)],
                    names=["id", "n", "hi", "lo", "sig", "bands"])
                at += rows
    return run


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    side = table["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return left, right if len(right) else left


def _signatures(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Packed signatures, and which rows have none (they agree with all)."""
    column = table["sig"].combine_chunks()
    found = pc.is_valid(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), _WORDS), dtype=np.uint64)
    out[found] = column.flatten().to_numpy().view(np.uint64).reshape(-1, _WORDS)
    return out, ~found


def _confirm(percent: int, ngram: int):
    """Edges of a cell: pairs of its sides with enough agreement are compared
    on their full sets, unless they are connected already."""
    floor = least_agreement(percent)

    def run(table: pa.Table) -> pa.Table:
        left, right = _sides(table)
        ids, (sig, free) = table["id"].to_numpy(), _signatures(table)
        own, gram = ngram_sets(table["text"].combine_chunks(), ngram)
        sizes = np.bincount(own, minlength=len(ids))
        if len(right) == 1:
            mine = gram[own == right[0]]
            held = np.bincount(own[np.isin(gram, mine)], minlength=len(ids))
            both = held[None, left]
        else:
            both = shared_shingles(own, gram, len(ids))[np.ix_(right, left)]
        union = Union(len(ids))
        union.label = np.unique(table["label"].to_numpy(), return_inverse=True)[1].astype(np.int64)
        edges = []
        for q, shared in zip(right, both):
            near = (agreements(sig[left], sig[q:q + 1])[:, 0] >= floor) | free[left] | free[q]
            linked = left[near & (sizes[left] > 0) & (100 * shared >= percent * (sizes[left] + sizes[q] - shared))]
            label, first = np.unique(union.label[linked], return_index=True)
            for s in linked[first[label != union.label[q]]]:
                edges.append((int(ids[q]), int(ids[s])))
                union.join(np.array([q]), np.array([s]))
        u, v = (pa.array([e[j] for e in edges], pa.int64()) for j in (0, 1))
        return pa.table({"u": u, "v": v})
    return run


def _open(percent: int):
    """Sets of a cell that agree enough with one of another class."""
    floor = least_agreement(percent)

    def run(table: pa.Table) -> pa.Table:
        left, right = _sides(table)
        (sig, free), label = _signatures(table), table["label"].to_numpy()
        some = np.zeros(len(label), dtype=bool)
        for at in range(0, len(right), 64):
            q = right[at:at + 64]
            near = (agreements(sig[left], sig[q]) >= floor) | free[left][:, None] | free[q][None, :]
            hit = near & (label[left][:, None] != label[q][None, :])
            some[left] |= hit.any(axis=1)
            some[q] |= hit.any(axis=0)
        return table.select(["key", "id"]).filter(pa.array(some))
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                    percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links, itself included) and ``kept`` (the id is
    its component's).

    * null and empty texts have no shingles, link with nothing and are kept;
    * texts with fewer than ``ngram`` words have one shingle, all their words;
    * equal sets link; rows that repeat an id are one node with the sets of
      all, and all are kept or none;
    * a row without id links only with equal sets; its class is their id, or
      null, and it is kept in the second case only;
    * an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keys = ["hi", "lo"]
    with passing(spark) as stage:
        rows = stage(base.mapInArrow(_describe(ngram), "id long, n long, hi long, lo long, sig array<long>, "
                                     "bands array<long>"), "minhash-sets")
        groups = stage(rows.where("n > 0").groupBy(*keys).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")),
                       "minhash-groups")
        # equal sets are one: those that may be given again are looked up
        again = groups.where("rows > 1 AND rep IS NOT NULL")
        signed = flag_maybe(rows.where("n > 0 AND id IS NOT NULL"), F.xxhash64(*keys), again, F.xxhash64(*keys), "again")
        first = groups.where("rep IS NOT NULL").select(F.col("rep").alias("id"), *keys)
        columns = ["id", "n", "sig", "bands"]
        sets = signed.where("NOT again").select(*columns).unionAll(
            signed.where("again").join(first, ["id", *keys], "left_semi").dropDuplicates(["id", *keys]).select(*columns))
        sets = stage(sets, "minhash-reps")
        banded = sets.select("id", "n", "sig", F.explode("bands").alias("bucket"))
        shared = stage(banded.groupBy("bucket").agg(F.min("id").alias("root"), F.max("id").alias("last"))
                       .where("root < last").select("bucket", "root"), "minhash-shared")
        near = maybe_in(banded, F.col("bucket"), shared, F.col("bucket")).join(shared, "bucket")
        near = stage(near.select("bucket", "id", "root", "n", "sig"), "minhash-near")
        # an id given with several sets has no one signature: it may link with all of its buckets
        one = lambda: F.when(F.min("sig") == F.max("sig"), F.min("sig"))
        pivots = near.where("id = root").groupBy("root").agg(one().alias("other"))
        agreed = F.coalesce(agreement(F.col("sig"), F.col("other")), F.lit(MINIMA))
        seen = stage(near.join(pivots, "root").select(
            "bucket", "id", "root", (agreed >= least_agreement(percent)).alias("able"),
            similarity(agreed).alias("similarity")), "minhash-estimates")
        notes = stage(near.groupBy("id").agg(one().alias("sig"), F.max("n").alias("size")), "minhash-notes")
        active = lambda cells: cells.groupBy("key", "a", "b").applyInArrow(_open(percent), "key long, id long")
        classes = linked_classes(seen, base.where("id IS NOT NULL"), _confirm(percent, ngram), stage,
                                 weight=F.col("similarity"), notes=notes, active=active, block=BLOCK,
                                 block_size=BLOCK_SHINGLES)
        named = groups.join(classes, groups["rep"] == classes["node"], "left") \
            .select(*keys, F.coalesce("component", "rep").alias("class"))
        members = rows.select("id", "n", *keys).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        own = F.when(F.col("n") > 0, F.coalesce("class", "id")).otherwise(F.col("id"))
        out = groups_to_members(members, named, keys, "salt").select("id", "n", own.alias("class"))
        out = staged(spark, out, "minhash-classes")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("class").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("class")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                         percent: int = PERCENT) -> DataFrame:
    """The kept rows with all their columns."""
    gone = near_duplicates(docs, id_col, text_col, ngram, percent).where("NOT kept") \
        .select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
