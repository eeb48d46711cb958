"""Importance resampling towards a target distribution (hashed n-grams).

A 256-byte table lower-cases A-Z and blanks every separator byte of the UTF-8
text, ``bytes.split`` yields the words, and crc32 of the words, chained over a
blank for longer n-grams, names the feature's bucket.  Counters reduce the
features of a task to one row for each bucket; Spark adds those up for both
tables.  The log ratio of the two bucket distributions is a table of at most
``buckets`` integers, which goes to every task; a document's weight is the sum
of its features' gains.  Seeded Gumbel noise on the weight turns the highest
scores into a draw without replacement.

The texts are read twice (counts, weights) and never shuffled; only
(id, score) rows are ordered, in ranges with literal bounds.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import staged
from fareflow.operators.ranking import with_position

NGRAM = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Words whose gain a task remembers; beyond that it starts anew.
REMEMBERED = 1 << 18

#: Digits and letters stay (A-Z as a-z), so do all bytes of other scripts.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def feature_hashes(found: list[bytes], ngram: int = NGRAM) -> list[int]:
    """crc32 of every run of 1 to ``ngram`` words joined by a blank: a longer
    run goes on from the value of the run that it extends."""
    seeds = [zlib.crc32(w) for w in found]
    out = list(seeds)
    for n in range(1, ngram):
        seeds = [zlib.crc32(w, zlib.crc32(b" ", s)) for s, w in zip(seeds, found[n:])]
        out += seeds
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes | None]:
    for b in batches:
        for value in b.column(0):  # one text at a time: no list of copies
            yield None if (buffer := value.cast(pa.binary()).as_buffer()) is None else buffer.to_pybytes()


def _count(ngram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        plain: Counter[bytes] = Counter()
        for text in _texts(batches):
            if ngram == 1:
                plain.update(words(text))
                if len(plain) < REMEMBERED:
                    continue
            else:
                total.update(Counter(h % buckets for h in feature_hashes(words(text), ngram)))
            for w, n in plain.items():
                total[zlib.crc32(w) % buckets] += n
            plain.clear()
        for w, n in plain.items():
            total[zlib.crc32(w) % buckets] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())],
                                         names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often features of all texts fall into each bucket."""
    return texts.select(text_col).mapInArrow(_count(ngram, buckets), "bucket int, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", ngram: int = NGRAM,
          buckets: int = BUCKETS) -> list[int]:
    """Per bucket floor(1000 * ln of target share / source share), counts plus
    one: a list of ``buckets`` integers."""
    sides = [bucket_counts(d, text_col, ngram, buckets).select("bucket", F.lit(k).alias("side"), "n")
             for k, d in enumerate((docs, target))]
    per = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")) \
        .join(sides[0].unionAll(sides[1]), "bucket", "left").groupBy("bucket").agg(
            *[F.coalesce(F.sum(F.when(F.col("side") == k, F.col("n"))), F.lit(0)).alias(c) for k, c in enumerate("st")])
    rows = staged(docs.sparkSession, per, "importance-buckets")
    all_s, all_t = rows.agg(F.sum("s"), F.sum("t")).first()
    ratio = (F.col("t").cast("double") + 1) * F.lit(float(all_s + buckets)) \
        / ((F.col("s").cast("double") + 1) * F.lit(float(all_t + buckets)))
    found = rows.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()
    return [r["gain"] for r in sorted(found, key=lambda r: r["bucket"])]


def _weigh(gain: list[int], ngram: int):
    buckets = len(gain)

    class Gains(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) >= REMEMBERED:
                self.clear()
            value = self[word] = gain[zlib.crc32(word) % buckets]
            return value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Gains()
        for b in batches:
            n_words, n_features, weight = [], [], []
            for text in _texts([b]):
                found = words(text)
                hashes = feature_hashes(found, ngram) if ngram > 1 else found
                n_words.append(len(found))
                n_features.append(len(hashes))
                weight.append(sum(map(known.__getitem__, found)) if ngram == 1
                              else sum(gain[h % buckets] for h in hashes))
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))],
                                             names=["id", "n_words", "n_features", "weight"])
    return run


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256("seed:id");
    a null id reads "null"."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    ngram: int = NGRAM, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
                    percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per input row: id, ``n_features``, ``weight``, ``score`` and
    ``rank`` (1, 2, ... of the drawn ones, null otherwise), all long.

    * null, empty and wordless texts have no features, weight 0, and are never
      drawn unless ``min_words`` is 0;
    * of equal scores the smaller id goes first, a row without id before all;
      rows that repeat an id and its text are drawn one by one;
    * an empty table gives an empty result; with an empty target every feature
      counts alike against it; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    gain = gains(docs, target, text_col, ngram, buckets)
    weighed = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id")).mapInArrow(
        _weigh(gain, ngram), f"id {kind.simpleString()}, n_words long, n_features long, weight long")
    scored = staged(spark, weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
                    .withColumn("late", (F.col("n_words") < min_words).cast("int")), "importance-scores")
    drawn = scored.where("late = 0").count() * percent // 100
    placed = with_position(scored, ["late", F.desc("score"), "id"], "at")
    rank = F.when((F.col("late") == 0) & (F.col("at") < drawn), F.col("at") + 1).cast("long")
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.alias("rank"))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn documents with all their columns (every row of a drawn id)."""
    ids = importance_draw(docs, target, id_col, **options).where("rank IS NOT NULL") \
        .select(F.col(id_col).alias("_drawn")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(ids["_drawn"]), "left_semi")
