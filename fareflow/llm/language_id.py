"""Language identification with a bit-sliced Bloom filter of character n-grams.

Every position of the filter holds a mask with one bit per language.  The
frequent n-grams of each language set its bit at their hash positions; ANDing
the masks at an n-gram's positions gives all languages that contain it.  A text
is decided by popcounts per language over its n-grams, less the false
positives expected from how full that language's bit slice is:
(count - n * f) / (1 - f).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import bounded_sample, fresh, not_taken, text_udf

#: Training rows per language (about), n-grams kept per language, and hashes.
DOCS_PER_LANG = 1500
GRAMS_PER_LANG = 3000
ORDERS = (3, 4)
HASHES = 2
BITS_PER_GRAM = 16

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(29))) * _M2
    return h ^ (h >> np.uint64(32))


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts with runs of other characters than
    letters as 0, the text's number per position, letters per text."""
    if not texts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lowered = [(t or "").lower() + "\n\n" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    present = np.flatnonzero(np.bincount(codes))
    letter = np.zeros(int(present[-1]) + 1 if len(present) else 1, dtype=bool)
    letter[[c for c in present if chr(c).isalpha()]] = True
    is_letter = letter[codes]
    codes = np.where(is_letter, codes, 0)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one boundary after each run of letters
    letters = np.bincount(doc[is_letter], minlength=len(texts))
    return codes[keep], doc[keep], letters


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the text of each, and letters per text.  N-grams
    lie within a word and its two boundaries."""
    codes, doc, letters = _codes(texts)
    codes = np.concatenate([np.zeros(1, np.uint32), codes]).astype(np.uint64)
    doc = np.concatenate([doc[:1], doc]) if len(doc) else np.zeros(1, np.int64)
    grams, owners = [], []
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        h = np.full(size, np.uint64(n), dtype=np.uint64)
        inside = np.ones(size, dtype=bool)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + codes[k:k + size] + np.uint64(1)
            if 0 < k < n - 1:
                inside &= codes[k:k + size] != 0
        grams.append(_mix(h[inside]))
        owners.append(doc[1:1 + size][inside])
    if not grams:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), letters
    return np.concatenate(grams), np.concatenate(owners), letters


@dataclass
class LanguageFilter:
    """The trained filter: ``planes[p, pos]`` is the mask of languages
    64 p .. 64 p + 63 at a position."""
    languages: list[str]
    planes: np.ndarray
    false_rate: np.ndarray
    common: int  # language of texts with letters but no known n-gram

    def masks(self, grams: np.ndarray) -> np.ndarray:
        size = np.uint64(self.planes.shape[1] - 1)
        out = None
        for k in range(HASHES):
            pos = ((grams >> np.uint64(31 * k)) & size).astype(np.int64)
            m = self.planes[:, pos]
            out = m if out is None else out & m
        return out


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
          docs_per_lang: int = DOCS_PER_LANG, grams_per_lang: int = GRAMS_PER_LANG) -> LanguageFilter:
    """Count n-grams in about ``docs_per_lang`` rows of each language (rows
    without language or text are left out), keep the most frequent ones of each
    and set their bits.  The driver gets languages x ``grams_per_lang`` rows."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = bounded_sample(rows, "lang", docs_per_lang)

    def count(batches):
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs.tolist())):
                texts = b.column(1).filter(pa.array(langs == lang)).to_pylist()
                for i in range(0, len(texts), 256):
                    g, n = np.unique(ngrams(texts[i:i + 256])[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n)],
                        names=["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counts.withColumn("r", F.row_number().over(best)).where(F.col("r") <= grams_per_lang)
    got = top.select("lang", "gram", "n").toPandas()
    languages = sorted(got["lang"].unique().tolist())
    size = 1 << max(10, int(np.ceil(np.log2(max(1, len(got)) * BITS_PER_GRAM))))
    planes = np.zeros((max(1, -(-len(languages) // 64)), size), dtype=np.uint64)
    totals = []
    for j, lang in enumerate(languages):
        own = got[got["lang"] == lang]
        totals.append(int(own["n"].sum()))
        grams = own["gram"].to_numpy().view(np.uint64)
        for k in range(HASHES):
            pos = ((grams >> np.uint64(31 * k)) & np.uint64(size - 1)).astype(np.int64)
            planes[j // 64, pos] |= np.uint64(1) << np.uint64(j % 64)
    fill = np.array([((planes[j // 64] >> np.uint64(j % 64)) & np.uint64(1)).mean() for j in range(len(languages))])
    return LanguageFilter(languages, planes, fill ** HASHES, int(np.argmax(totals)) if totals else 0)


def detector(model: LanguageFilter):
    """Column function: text -> struct(lang, score).  ``und`` with score 0 for
    null, empty and letterless texts and when no language was learned."""
    names = np.array([*model.languages, "und"], dtype=object)
    und = len(model.languages)

    def kernel(texts: pa.Array) -> pa.Array:
        grams, owner, letters = ngrams(texts.to_pylist())
        rows, langs = len(texts), len(model.languages)
        counts = np.zeros((rows, max(1, langs)))
        masks = model.masks(grams) if langs else None
        for j in range(langs):
            bit = (masks[j // 64] >> np.uint64(j % 64)) & np.uint64(1)
            counts[:, j] = np.bincount(owner[bit.astype(bool)], minlength=rows)
        total = np.bincount(owner, minlength=rows)[:, None]
        if langs:
            counts = np.maximum(0, (counts - total * model.false_rate) / (1 - model.false_rate))
        pick = counts.argmax(axis=1)
        pick[counts.sum(axis=1) == 0] = model.common
        best = counts[np.arange(rows), pick]
        rest = counts.copy()
        rest[np.arange(rows), pick] = 0
        score = np.where(best > 0, best / np.maximum(best + rest.max(axis=1), 1e-12), 0.0)
        pick = np.where((letters > 0) & (langs > 0), pick, und)
        score = np.where(pick == und, 0.0, score)
        return pa.StructArray.from_arrays(
            [pa.array(names[pick], pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    return text_udf(kernel, "lang string, score double")


def detect(docs: DataFrame, model: LanguageFilter, text: Column, into: str = "lang_pred",
           score: str = "lang_score") -> DataFrame:
    """``docs`` with the language ``into`` and its ``score``; all rows and
    columns stay, and a column of these names already there is an error."""
    not_taken(docs, into, score)
    found, = fresh(docs, "_lang_id")
    return docs.withColumn(found, detector(model)(text)) \
        .withColumns({into: F.col(found)["lang"], score: F.col(found)["score"]}).drop(found)
