"""Toxicity: a linear-chain conditional random field over words.

Document labels are turned into token labels: words and word beginnings that
occur in toxic documents far more often than in others (log-likelihood ratio)
mark a token of a toxic document as toxic.  The chain is trained on those
tokens; its features are the word, its beginnings and ending, its shape and
its neighbours, so it also tags forms that the marks do not list.
Forward-backward marginals give the offending spans, and their maximum and sum
the score of a document.

With two states the forward and backward messages are log-odds, one number per
word; all texts of a chunk advance together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import bounded_sample, class_weights, not_taken, text_chunks, text_udf
from fareflow.llm.quality import sigmoid
from fareflow.llm.tokens import Tokens, mix

#: Labelled rows per class used for fitting (about), and the longest of them.
ROWS_PER_CLASS = 2000
TRAIN_WORDS = 1200
THRESHOLD = 0.3
TAG_AT = 0.5
TABLE_BITS = 18
BEGINNINGS = (3, 4, 5, 6, 7)  # code points
#: A mark needs this log-likelihood ratio and this share of toxic documents.
MARK_RATIO = 24.0
MARK_SHARE = 0.9
EPOCHS = 10


def _marks(t: Tokens) -> np.ndarray:
    """Hashes per token that may become marks: the word and its beginnings
    (0 where the word is not longer than the beginning)."""
    first, last = t.cores()
    out = np.zeros((len(BEGINNINGS) + 1, len(first)), dtype=np.uint64)
    out[0] = t.range_hash(first, last)
    starts = np.append(np.flatnonzero((t.raw & 0xC0) != 0x80), len(t.raw))
    number = np.searchsorted(starts, first)
    for j, n in enumerate(BEGINNINGS):
        end = starts[np.minimum(number + n, len(starts) - 1)]
        longer = end < last
        out[j + 1, longer] = t.range_hash(first[longer], end[longer]) ^ np.uint64(0x5BD1E995 + n)
    return out


def token_features(t: Tokens) -> np.ndarray:
    """Positions in the weight table, one row per feature and one column per token."""
    first, last = t.cores()
    marks = _marks(t)
    ending = t.range_hash(np.maximum(first, last - 3), last)
    upper = (t.raw[t.start] >= 65) & (t.raw[t.start] <= 90)
    shape = (np.minimum(last - first, 15) * 4 + upper * 2 + (last - first != t.end - t.start)).astype(np.uint64)
    near = lambda step: np.where(np.roll(t.doc, step) == t.doc, np.roll(marks[0], step), np.uint64(1))
    rows = [*marks, ending, shape, near(1), near(-1)]
    size = np.uint64((1 << TABLE_BITS) - 1)
    return np.stack([(mix(r + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & size).astype(np.int32)
                     for j, r in enumerate(rows)]) if len(first) else np.zeros((len(rows), 0), np.int32)


def _steps(lengths: np.ndarray):
    """Sequences by falling length, and how many are still running at each step."""
    order = np.argsort(-lengths, kind="stable")
    running = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
    return order, running


def forward_backward(e: np.ndarray, start: np.ndarray, lengths: np.ndarray,
                     trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds messages of all sequences: forward (with the token's own
    evidence) and backward.  ``e`` is the evidence for state 1 per token."""
    x = np.exp(trans)
    f, b = np.empty(len(e)), np.zeros(len(e))
    order, running = _steps(lengths)
    first, last = start[order], (start + lengths - 1)[order]
    for step, k in enumerate(running):
        at = first[:k] + step
        if step == 0:
            f[at] = e[at]
        else:
            r = np.exp(np.clip(f[at - 1], -30, 30))
            f[at] = e[at] + np.log((x[0, 1] + r * x[1, 1]) / (x[0, 0] + r * x[1, 0]))
            at = last[:k] - step
            q = np.exp(np.clip(e[at + 1] + b[at + 1], -30, 30))
            b[at] = np.log((x[1, 0] + x[1, 1] * q) / (x[0, 0] + x[0, 1] * q))
    return f, b


@dataclass
class ToxicityChain:
    weights: np.ndarray  # hashed features -> evidence for the toxic state
    bias: float
    trans: np.ndarray    # 2 x 2 transition scores
    doc_w: np.ndarray    # weights of _doc_features

    def marginals(self, t: Tokens) -> np.ndarray:
        e = self.weights[token_features(t)].sum(axis=0) + self.bias
        has = np.flatnonzero(t.words)
        lengths = t.words[has]
        f, b = forward_backward(e, np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
                                if len(has) else has, lengths, self.trans)
        return sigmoid(f + b)

    def doc_scores(self, t: Tokens, p: np.ndarray) -> np.ndarray:
        return sigmoid(_doc_features(t, p) @ self.doc_w)


def _doc_features(t: Tokens, p: np.ndarray) -> np.ndarray:
    """Constant, log-odds of the largest marginal, log of the sum of the
    marginals, tagged words and log of all words."""
    most = np.full(t.rows, 1e-3)
    np.maximum.at(most, t.doc, np.clip(p, 1e-3, 1 - 1e-3))
    total, tagged = np.bincount(t.doc, p, t.rows), np.bincount(t.doc, p >= TAG_AT, t.rows)
    return np.stack([np.ones(t.rows), np.log(most / (1 - most)) / 3, np.log(total + 0.05),
                     np.log1p(tagged), np.log1p(t.words) / 3], axis=1)


def _find_marks(sample: DataFrame) -> np.ndarray:
    """Hashes that mark toxic tokens, from document counts in the sample."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, at = np.array(b.column(1).to_pylist()), 0
            for chunk in text_chunks(b.column(0)):
                t = Tokens(chunk)
                marks = _marks(t)
                toxic = labels[at:at + len(chunk)][t.doc]
                at += len(chunk)
                doc = np.tile(t.doc, len(marks))
                pairs = np.unique(np.stack([marks.ravel(), doc.astype(np.uint64),
                                            np.tile(toxic, len(marks)).astype(np.uint64)]), axis=1)
                for label in (0, 1):
                    h, n = np.unique(pairs[0][(pairs[2] == label) & (pairs[0] != 0)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(np.full(len(h), label, np.int32)), pa.array(n)],
                        names=["h", "label", "n"])

    total = sample.agg(F.sum("_label").alias("t"), F.sum(1 - F.col("_label")).alias("c")).first()
    n_t, n_c = float(total["t"] or 0), float(total["c"] or 0)
    if not n_t or not n_c:
        return np.zeros(0, dtype=np.uint64)
    pick = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0)).cast("double")
    got = sample.select("text", "_label").mapInArrow(count, "h long, label int, n long") \
        .groupBy("h").agg(pick(1).alias("t"), pick(0).alias("c")) \
        .where((F.col("t") >= 3) & (F.col("t") / n_t >= MARK_SHARE * (F.col("t") / n_t + F.col("c") / n_c))).toPandas()
    a, c = got["t"].to_numpy(), got["c"].to_numpy()
    both = (a + c) / (n_t + n_c)
    part = lambda k, n, q: np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / (n * q)), 0)
    ratio = 2 * (part(a, n_t, both) + part(n_t - a, n_t, 1 - both) + part(c, n_c, both) + part(n_c - c, n_c, 1 - both))
    return np.sort(got["h"].to_numpy()[ratio >= MARK_RATIO].view(np.uint64))


def fit_chain(feats: list[np.ndarray], tags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS,
              rate: float = 0.3, decay: float = 1e-5, batch: int = 250, seed: int = 3) -> ToxicityChain:
    """Adagrad on the likelihood of the tagged sequences."""
    rng = np.random.default_rng(seed)
    model = ToxicityChain(np.zeros(1 << TABLE_BITS), -4.0, np.zeros((2, 2)), np.array([-2.0, 1.0, 0.0, 0.0, 0.0]))
    keep = [i for i, x in enumerate(feats) if x.shape[1]]
    gw, gb, gt = np.full(1 << TABLE_BITS, 1e-4), 1e-4, np.full((2, 2), 1e-4)
    for _ in range(epochs if keep and any(t.any() for t in tags) else 0):
        for part in np.array_split(rng.permutation(keep), max(1, len(keep) // batch)):
            x = np.concatenate([feats[i] for i in part], axis=1)
            y = np.concatenate([tags[i] for i in part]).astype(float)
            lengths = np.array([feats[i].shape[1] for i in part])
            start = np.cumsum(lengths) - lengths
            e = model.weights[x].sum(axis=0) + model.bias
            f, b = forward_backward(e, start, lengths, model.trans)
            g = (sigmoid(f + b) - y) / len(part)
            dw = sum(np.bincount(r, g, 1 << TABLE_BITS) for r in x) + decay * model.weights
            gw += dw ** 2
            model.weights -= rate * dw / np.sqrt(gw)
            gb += g.sum() ** 2
            model.bias -= rate * g.sum() / np.sqrt(gb)
            # expected less observed transitions
            inner = np.ones(len(e), dtype=bool)
            inner[start] = False
            at = np.flatnonzero(inner)
            a1, q = sigmoid(f[at - 1]), sigmoid(e[at] + b[at])
            w = np.stack([[(1 - a1) * (1 - q), (1 - a1) * q], [a1 * (1 - q), a1 * q]]) \
                * np.exp(model.trans)[:, :, None]
            w /= w.sum(axis=(0, 1))
            y0, y1 = y[at - 1], y[at]
            seen = np.array([[((1 - y0) * (1 - y1)).sum(), ((1 - y0) * y1).sum()],
                             [(y0 * (1 - y1)).sum(), (y0 * y1).sum()]])
            dt = (w.sum(axis=2) - seen) / len(part) + decay * model.trans
            gt += dt ** 2
            model.trans -= 0.2 * rate * dt / np.sqrt(gt)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> ToxicityChain:
    """Fit on about ``rows_per_class`` labelled rows of each class with at
    most ``TRAIN_WORDS`` words.  The sample's ids are broadcast; its token
    features come to the driver.  Without toxic rows every score is low."""
    rows = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("_label")) \
        .where("_lid IS NOT NULL AND _label IN (0, 1)")
    sample = F.broadcast(bounded_sample(rows, "_label", rows_per_class))
    data = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")) \
        .join(sample, F.col("_id") == F.col("_lid")).select("text", "_label", "_id")
    marks = _find_marks(data)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for chunk in text_chunks(b.column(0)):
                t = Tokens(chunk)
                x, m = token_features(t), _marks(t)
                hit = np.isin(m, marks).any(axis=0)
                ends = np.concatenate([[0], np.cumsum(t.words)])
                for i in range(t.rows):
                    s = slice(ends[i], ends[i + 1])
                    if 0 < t.words[i] <= TRAIN_WORDS:
                        label = b.column(1)[at + i].as_py()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([b.column(2)[at + i].as_py()], pa.int64()), pa.array([label], pa.int32()),
                             pa.array([x[:, s].tobytes()], pa.binary()),
                             pa.array([(hit[s] & (label == 1)).tobytes()], pa.binary())],
                            names=["id", "label", "x", "y"])
                at += len(chunk)

    got = data.mapInArrow(extract, "id long, label int, x binary, y binary").toPandas()
    got = got.sort_values("id", kind="stable").drop_duplicates("id")
    n = len(BEGINNINGS) + 5  # the word, its beginnings, ending, shape, two neighbours
    feats = [np.frombuffer(x, np.int32).reshape(n, -1) for x in got["x"]]
    tags = [np.frombuffer(y, bool) for y in got["y"]]
    model = fit_chain(feats, tags, got["label"].to_numpy(float))
    model.doc_w = _fit_documents(data, rows, model)
    return model


def _fit_documents(data: DataFrame, rows: DataFrame, model: ToxicityChain) -> np.ndarray:
    """Logistic weights of the document features over the whole sample
    (ridge, gradient steps), each class with its share of all labelled rows."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for chunk in text_chunks(b.column(0)):
                t = Tokens(chunk)
                x = _doc_features(t, model.marginals(t))
                yield pa.RecordBatch.from_arrays([b.column(2).slice(at, t.rows), b.column(1).slice(at, t.rows),
                                                  *[pa.array(c) for c in x.T]],
                                                 names=["id", "label", *[f"x{j}" for j in range(x.shape[1])]])
                at += t.rows

    width = len(model.doc_w)
    got = data.mapInArrow(extract, "id long, label int, " + ", ".join(f"x{j} double" for j in range(width))) \
        .toPandas().sort_values("id", kind="stable").drop_duplicates("id")
    labels = got["label"].to_numpy(float)
    if not len(got) or labels.mean() in (0.0, 1.0):
        return model.doc_w
    x, w = got[[f"x{j}" for j in range(width)]].to_numpy(), model.doc_w.copy()
    weight = class_weights(rows, "_label", labels) / len(labels)
    step = 4 / np.linalg.eigvalsh((x * weight[:, None]).T @ x)[-1]
    for _ in range(3000):
        w = w - step * (x.T @ (weight * (sigmoid(x @ w) - labels)) + 1e-3 * w * (np.arange(width) > 0))
    return w


def tagger(model: ToxicityChain):
    """Column function: text -> struct(score, spans) with the offending spans
    as code-point offsets (adjacent toxic words form one span).  Null and
    empty texts get the score of a text without evidence and no spans."""
    def kernel(texts: pa.Array) -> pa.Array:
        t = Tokens(texts)
        p = model.marginals(t)
        at = np.flatnonzero(p >= TAG_AT)
        spans: list[list[dict]] = [[] for _ in range(t.rows)]
        if len(at):
            cp = t.code_points()
            for i in at:
                doc = int(t.doc[i])
                base = cp[t.doc_start[doc]]
                s, e = int(cp[t.start[i]] - base), int(cp[t.end[i]] - base)
                if spans[doc] and spans[doc][-1]["_word"] == i - 1:
                    spans[doc][-1] |= {"end": e, "_word": i, "marginal": max(spans[doc][-1]["marginal"], float(p[i]))}
                else:
                    spans[doc].append({"start": s, "end": e, "marginal": float(p[i]), "_word": i})
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
        return pa.StructArray.from_arrays(
            [pa.array(model.doc_scores(t, p), pa.float64()),
             pa.array([[{k: v for k, v in s.items() if k != "_word"} for s in row] for row in spans], kind)],
            names=["score", "spans"])

    return text_udf(kernel, "score double, spans array<struct<start:bigint,end:bigint,marginal:double>>",
                    max_bytes=4_000_000)


def tag(docs: DataFrame, model: ToxicityChain, text: Column, into: str = "toxicity") -> DataFrame:
    """``docs`` with struct ``into``: score and spans; all rows and columns
    stay, and a column of that name already there is an error."""
    not_taken(docs, into)
    return docs.withColumn(into, tagger(model)(text))
