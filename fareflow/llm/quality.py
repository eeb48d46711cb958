"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

The pairwise term costs one pass over the features of a text.  The model is
fitted on a bounded sample of labelled rows; texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from fareflow.llm.common import bounded_sample, class_weights, not_taken, text_chunks
from fareflow.llm.tokens import CORE, Tokens, mix

#: Labelled rows per class used for fitting (about).
ROWS_PER_CLASS = 1500
WORD_BUCKETS = 1 << 14
BINS = 12
FACTORS = 8
EPOCHS = 6
THRESHOLD = 0.3

#: Structure statistics: name, lowest and highest value of the bins.
STATISTICS = (("upper", 0, 1), ("digits", 0, 0.3), ("punctuation", 0, 0.4), ("word_length", 1, 13),
              ("distinct_words", 0, 1), ("distinct_pairs", 0, 1), ("lines", 0, 0.3), ("bare_symbols", 0, 0.5),
              ("log_bytes", 0, 18), ("log_n_chars", 0, 18))
WIDTH = WORD_BUCKETS + len(STATISTICS) * (BINS + 1)
_UPPER, _DIGIT, _PUNCT = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[65:91] = _DIGIT[48:58] = True
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True


def _distinct(keys: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, key, count) of the distinct keys of each text."""
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return d[at], k[at], np.diff(np.append(at, len(k)))


def features(texts: pa.Array, n_chars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features of the texts: (text, feature, value), sorted by text.
    Null and empty texts have statistics only; a null ``n_chars`` has a bin of
    its own."""
    t = Tokens(texts)
    rows = t.rows
    bucket = (t.hash & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    d, k, n = _distinct(bucket, t.doc, rows)
    value = 1 + np.log(n)
    norm = np.sqrt(np.bincount(d, value ** 2, rows))
    value = value / norm[d]

    size = (t.doc_end - t.doc_start - 1).astype(float)
    words = np.maximum(t.words, 1)
    pair = np.flatnonzero(t.doc[1:] == t.doc[:-1])
    pairs = mix(t.hash[pair] * np.uint64(31) + t.hash[pair + 1])
    pair_doc = t.doc[pair]
    core_bytes = np.concatenate([[0], np.cumsum(CORE[t.data])])
    bare = np.bincount(t.doc[core_bytes[t.end] == core_bytes[t.start]], minlength=rows)
    letters = np.maximum(t.per_text(CORE[t.data]), 1)
    safe = np.maximum(size, 1)
    distinct = lambda keys, doc: np.bincount(_distinct(keys, doc, rows)[0], minlength=rows)
    given = np.array([np.nan if x is None else float(x) for x in n_chars.to_pylist()])
    stats = [t.per_text(_UPPER[t.raw]) / letters, t.per_text(_DIGIT[t.raw]) / safe,
             t.per_text(_PUNCT[t.raw]) / safe, np.bincount(t.doc, t.end - t.start, rows) / words,
             distinct(t.hash, t.doc) / words,
             distinct(pairs, pair_doc) / np.maximum(np.bincount(pair_doc, minlength=rows), 1),
             (t.per_text(t.raw == 10) - 1) / words, bare / words, np.log2(1 + size),
             np.log2(1 + np.maximum(given, 0))]
    ids = np.empty((rows, len(stats)), dtype=np.int64)
    for j, ((_, low, high), x) in enumerate(zip(STATISTICS, stats)):
        bins = np.clip((np.nan_to_num(x) - low) / (high - low) * BINS, 0, BINS - 1).astype(np.int64)
        ids[:, j] = WORD_BUCKETS + j * (BINS + 1) + np.where(np.isnan(x), BINS, bins)
    row = np.concatenate([d, np.repeat(np.arange(rows), len(stats))])
    idx = np.concatenate([k, ids.ravel()])
    val = np.concatenate([value, np.full(ids.size, 1 / np.sqrt(len(stats)))])
    order = np.argsort(row, kind="stable")
    return row[order], idx[order], val[order]


@dataclass
class FactorisationMachine:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, row: np.ndarray, idx: np.ndarray, val: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the sums the gradient needs."""
        out = self.bias + np.bincount(row, self.w[idx] * val, rows)
        sums = np.empty((rows, self.v.shape[1]))
        for f in range(self.v.shape[1]):
            vx = self.v[idx, f] * val
            sums[:, f] = np.bincount(row, vx, rows)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(row, vx ** 2, rows))
        return out, sums


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weight: np.ndarray, factors: int = FACTORS,
        epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-4, batch: int = 64,
        seed: int = 5) -> FactorisationMachine:
    """Adagrad on the weighted logistic loss."""
    rng = np.random.default_rng(seed)
    model = FactorisationMachine(0.0, np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, factors)))
    positive = labels.mean() if len(labels) else 0.5
    if positive in (0.0, 1.0) or not len(labels):
        model.bias, model.v[:] = (0.0 if not len(labels) else 4.0 if positive else -4.0), 0
        return model
    gw, gv, gb = np.full(WIDTH, 1e-6), np.full(model.v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // batch)):
            idx = np.concatenate([samples[i][0] for i in part])
            val = np.concatenate([samples[i][1] for i in part])
            row = np.repeat(np.arange(len(part)), [len(samples[i][0]) for i in part])
            raw, sums = model.raw(row, idx, val, len(part))
            g = (sigmoid(raw) - labels[part]) * weight[part] / len(part)
            used, inverse = np.unique(idx, return_inverse=True)
            dw = np.bincount(inverse, g[row] * val) + decay * model.w[used]
            gw[used] += dw ** 2
            model.w[used] -= rate * dw / np.sqrt(gw[used])
            for f in range(factors):
                dv = np.bincount(inverse, g[row] * val * (sums[row, f] - model.v[idx, f] * val)) \
                    + decay * model.v[used, f]
                gv[used, f] += dv ** 2
                model.v[used, f] -= 0.25 * rate * dv / np.sqrt(gv[used, f])
            gb += g.sum() ** 2
            model.bias -= rate * g.sum() / np.sqrt(gb)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          n_chars_col: str = "n_chars", label_col: str = "quality",
          rows_per_class: int = ROWS_PER_CLASS) -> FactorisationMachine:
    """Fit on about ``rows_per_class`` labelled rows of each class.  The
    sample's ids (two classes of that many rows) are broadcast; its features
    come to the driver.  Rows without label or id are left out."""
    rows = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("_label")) \
        .where("_lid IS NOT NULL AND _label IN (0, 1)")
    sample = F.broadcast(bounded_sample(rows, "_label", rows_per_class))
    data = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"),
                       F.col(n_chars_col).cast("long").alias("n_chars")) \
        .join(sample, F.col("_id") == F.col("_lid")).select("_id", "text", "n_chars", "_label")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for chunk in text_chunks(b.column(1)):
                row, idx, val = features(chunk, b.column(2).slice(at, len(chunk)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(chunk)))]).astype(np.int32)
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(ends), pa.array(x, kind))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(chunk)), b.column(3).slice(at, len(chunk)),
                     lists(idx, pa.int32()), lists(val, pa.float32())], names=["id", "label", "idx", "val"])
                at += len(chunk)

    got = data.mapInArrow(extract, "id long, label int, idx array<int>, val array<float>").toPandas()
    got = got.sort_values("id", kind="stable").drop_duplicates("id")
    samples = [(np.asarray(i, dtype=np.int64), np.asarray(v, dtype=float)) for i, v in zip(got["idx"], got["val"])]
    got_labels = got["label"].to_numpy(dtype=float)
    return fit(samples, got_labels, class_weights(rows, "_label", got_labels))


def scorer(model: FactorisationMachine):
    """Column function (text, n_chars) -> score from 0 to 1."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, n_chars in batches:
            scores, at = [np.zeros(0)], 0
            for chunk in text_chunks(texts):
                row, idx, val = features(chunk, n_chars.slice(at, len(chunk)))
                scores.append(sigmoid(model.raw(row, idx, val, len(chunk))[0]))
                at += len(chunk)
            yield pa.array(np.concatenate(scores), pa.float64())
    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return arrow_udf(run, "double")


def score(docs: DataFrame, model: FactorisationMachine, text: Column, n_chars: Column,
          into: str = "score") -> DataFrame:
    """``docs`` with the quality score (null and empty texts get one too); all
    rows and columns stay, and a column of that name already there is an error."""
    not_taken(docs, into)
    return docs.withColumn(into, scorer(model)(text, n_chars.cast("long")))
