"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words: words under a 0 are ignored.
Seeds of all benchmark items and of all documents are joined by hash; a hit
makes its document, item and diagonal (document position less item position) a
candidate.  Every stretch of at least ``SPAN`` words of which ``MIN_SHARE``
agree has a hit: with one substitution in five words, 16 words or more keep
four equal neighbours, and all patterns over 10 to 15 words were tried.

Candidates are verified word by word: the item is laid over the document at the
diagonal and equal words are counted.  A document is contaminated when these
are at least ``MIN_SHARE`` of the item, or when any run of ``MIN_RUN`` or more
item words, wherever it begins and ends, has ``MIN_SHARE`` that agree.

Only built-in functions are used.  A bit table of a fixed size over the
benchmark's seeds, which is broadcast, keeps document seeds that cannot hit out
of the shuffle.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import maybe_in, staged

#: Masks of the candidates; together they lose no overlap (see module text).
SEEDS = ("1111", "11011")
SPAN = 10
MIN_SHARE = 0.8
MIN_RUN = 20
SALTS = 16


def words(text: Column) -> Column:
    """Lower-cased words without punctuation; null text has none."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")
    return F.array_remove(F.split(plain, r"[\x20\x09-\x0D]+"), "")


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda x: F.xxhash64(x))


def _seed_hashes(mask: str, hashes: Column, count: Column) -> Column:
    """(pos, h) of each placement of ``mask``; ``hashes`` are those of the words."""
    offsets = [i for i, c in enumerate(mask) if c == "1"]
    at = lambda i: F.struct(i.alias("pos"), F.xxhash64(
        F.lit(mask), *[F.get(hashes, i + F.lit(o)) for o in offsets]).alias("h"))
    places = F.sequence(F.lit(0), count - F.lit(len(mask)))
    return F.when(count >= len(mask), F.transform(places, at)).otherwise(
        F.array().cast("array<struct<pos:int,h:bigint>>"))


def seeds(texts: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """(id, text) -> (id, n, pos, h): all placements of the masks, in one pass."""
    w = texts.select("id", _word_hashes(F.col("text")).alias("w"))
    w = w.select("id", "w", F.size("w").alias("n"))
    s = w.select("id", "n", F.explode(F.concat(*[_seed_hashes(m, F.col("w"), F.col("n")) for m in masks])).alias("s"))
    return s.select("id", "n", "s.pos", "s.h")


def _spread(items: DataFrame) -> DataFrame:
    """``items`` once for each salt: a passage in a third of all documents is
    joined in as many places."""
    return items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(doc: str) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(SALTS)).cast("int")


def _hits(docs: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """(doc, item, items' word count, diagonal) of each seed that both have."""
    own = seeds(items, masks).select(F.col("id").alias("item"), F.col("n").alias("item_words"),
                                     F.col("pos").alias("item_pos"), "h")
    theirs = seeds(docs, masks).select(F.col("id").alias("doc"), F.col("pos").alias("doc_pos"), "h")
    theirs = maybe_in(theirs, F.col("h"), own, F.col("h")).withColumn("salt", _salt("doc"))
    hits = theirs.join(_spread(own), ["h", "salt"])
    return hits.select("doc", "item", "item_words", (F.col("doc_pos") - F.col("item_pos")).alias("diagonal"))


def _overlaps(docs: DataFrame, items: DataFrame, hits: DataFrame) -> DataFrame:
    """(doc, item, item_words, diagonal, same): for each place with a hit,
    whether each item word equals the document's word there."""
    near = hits.groupBy("doc").agg(F.collect_set(F.struct("item", "item_words", "diagonal")).alias("near"))
    near = staged(docs.sparkSession, near, "leak-candidates")
    texts = maybe_in(docs, F.xxhash64("id"), near, F.xxhash64("doc"))
    texts = texts.select("id", _word_hashes(F.col("text")).alias("w"))
    laid = lambda c: F.struct(c["item"].alias("item"), c["item_words"].alias("item_words"),
                              c["diagonal"].alias("diagonal"), F.transform(
        F.sequence(F.lit(0), c["item_words"] - 1), lambda k: F.get(F.col("w"), c["diagonal"] + k)).alias("theirs"))
    found = texts.join(near, texts["id"] == near["doc"]) \
        .select("doc", F.explode(F.transform("near", laid)).alias("c")).select("doc", "c.*") \
        .withColumn("salt", _salt("doc"))
    own = items.select(F.col("id").alias("item"), _word_hashes(F.col("text")).alias("own"))
    same = F.zip_with("own", "theirs", lambda a, b: F.coalesce(a == b, F.lit(False)))
    return found.join(_spread(own), ["item", "salt"]).select("doc", "item", "item_words", "diagonal", same.alias("same"))


def _best_run(same: Column) -> Column:
    """struct<matched, from, to> of the run of at least ``MIN_RUN`` words, of
    which ``MIN_SHARE`` agree, with the most agreeing words; matched is -1 if
    there is none.  One pass: a run reaches the share when its end has no lower
    balance than its beginning, so for each balance the earliest place that is
    as low is kept (``starts``, by the balance below zero)."""
    share = Fraction(MIN_SHARE).limit_denominator(1000)
    place = "struct<at:int,matched:int>"
    run = "struct<matched:int,before:int,to:int>"

    def step(acc: Column, agrees: Column) -> Column:
        at, matched = acc["at"] + 1, acc["matched"] + agrees.cast("int")
        balance = matched * share.denominator - at * share.numerator
        here = F.struct(at.alias("at"), matched.alias("matched"))
        starts = F.concat(acc["starts"], F.array_repeat(here, F.greatest(1 - balance - F.size(acc["starts"]), F.lit(0))))
        start = F.get(starts, F.greatest(-balance, F.lit(0)))
        found = F.struct((matched - start["matched"]).alias("matched"), (-start["at"]).alias("before"), at.alias("to"))
        best = F.when(at - start["at"] >= MIN_RUN, F.greatest(acc["best"], found)).otherwise(acc["best"])
        return F.struct(at.alias("at"), matched.alias("matched"), starts.alias("starts"), best.alias("best"))

    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("matched"),
                    F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("matched"))).cast(f"array<{place}>")
                    .alias("starts"),
                    F.struct(F.lit(-1).alias("matched"), F.lit(0).alias("before"), F.lit(0).alias("to")).cast(run)
                    .alias("best"))
    best = F.aggregate(same, zero, step, lambda acc: acc["best"])
    return F.transform(F.array(best), lambda b: F.struct(
        b["matched"].alias("matched"), (-b["before"]).alias("from"), b["to"].alias("to")))[0]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item that it holds: ids,
    ``matched`` (item words found), ``item_words``, ``first``/``last`` (item
    positions of the first and last of them) and ``doc_pos`` (word position in
    the document at which the item would start), of the best diagonal.  They
    describe the whole item where it reaches the share, else its best run.

    * items with equal words are reported under their smallest id;
    * items shorter than ``SPAN`` must occur whole (seeds of their length);
    * items without words, null texts and rows without id match nothing;
    * rows that repeat an id count as one document;
    * other columns are ignored.
    """
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    named = items.where(F.col(item_id_col).isNotNull()) \
        .select(F.col(item_id_col).alias("id"), F.array_join(words(F.col(item_text_col)), " ").alias("text")) \
        .where("text <> ''").groupBy("text").agg(F.min("id").alias("id")).select("id", "text")
    lengths = F.size(words(F.col("text")))
    hits = _hits(texts, named.where(lengths >= SPAN), SEEDS)
    short = named.where(lengths < SPAN).select(lengths.alias("n")).distinct().collect()  # at most SPAN - 1 lengths
    for n in sorted(r["n"] for r in short):
        hits = hits.unionByName(_hits(texts, named.where(lengths == n), ("1" * n,)))
    total = F.size(F.filter("same", lambda x: x))
    whole = total >= F.col("item_words") * MIN_SHARE
    item = F.struct(total.alias("matched"), F.lit(0).alias("from"), F.col("item_words").alias("to"))
    found = _overlaps(texts, named, hits).where(whole | (total >= MIN_RUN * MIN_SHARE)) \
        .withColumn("run", F.when(whole, item).otherwise(_best_run(F.col("same")))).where("run.matched > 0")
    part = F.slice("same", F.col("run.from") + 1, F.col("run.to") - F.col("run.from"))
    found = found.select(
        "doc", "item", "item_words", "diagonal", F.col("run.matched").cast("long").alias("matched"),
        (F.col("run.from") + F.array_position(part, True) - 1).alias("first"),
        (F.col("run.to") - F.array_position(F.reverse(part), True)).alias("last"))
    best = F.max_by(F.struct("matched", "first", "last", "diagonal"),
                    F.struct("matched", -F.abs("diagonal"), "diagonal"))
    return found.groupBy("doc", "item", "item_words").agg(best.alias("b")).select(
        F.col("doc").alias(id_col), F.col("item").alias(item_id_col), F.col("b.matched").alias("matched"),
        F.col("item_words").cast("long").alias("item_words"), F.col("b.first").cast("long").alias("first"),
        F.col("b.last").cast("long").alias("last"), F.col("b.diagonal").cast("long").alias("doc_pos"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **names: str) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    bad = contaminated(docs, items, id_col, text_col, **names).select(F.col(id_col).alias("_bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")
