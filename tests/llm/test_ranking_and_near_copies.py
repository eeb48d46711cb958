"""Importance resampling, MinHash near-duplicates and lexical search against
brute force, on nulls, empty and very long texts, ties, repeated rows, empty
tables and clashing column names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareflow.llm import importance, lexical, minhash

from .test_corpus_operators import brute_classes, documents, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def term_list(text):
    return TERM.findall((text or "").translate(LOWER))


def odd_rows():
    rng = random.Random(3)
    some = [f"Wort{i}" for i in range(40)] + ["É", "naïve", "x1", "日本", "I", "K"]
    rows = [(i, " ".join(rng.choice(some) + rng.choice(["", ",", "!", "-x"]) for _ in range(rng.randint(0, 60))), "s")
            for i in range(60)]
    long_text = " ".join(f"w{i % 577}" for i in range(40_000))
    return rows + [(70, None, "s"), (71, "", "s"), (72, "...  --", "s"), (73, long_text, "s"), (74, rows[5][1], "s"),
                   (75, "a\tb\nc" * 9, "s"), (5, rows[5][1], "s")]


def brute_draw(rows, target, ngram, buckets=10_000, min_words=20, percent=10, seed=2024):
    def features(text):
        w = term_list(text)
        return [" ".join(w[i:i + n]) for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(bucket(f) for _, t, _ in rows for f in features(t))
    g = collections.Counter(bucket(f) for t in target for f in features(t))
    all_s, all_t = sum(s.values()), sum(g.values())
    gain = lambda k: math.floor(1000 * math.log((g[k] + 1) * (all_s + buckets) / ((s[k] + 1) * (all_t + buckets))))
    out = []
    for i, text, _ in rows:
        weight = sum(gain(bucket(f)) for f in features(text))
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(features(text)), weight, weight + noise, len(term_list(text)) >= min_words))
    drawn = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0]))
    drawn = drawn[:percent * len(drawn) // 100]
    ranks = collections.Counter()
    result = []
    for r in sorted(out, key=lambda r: (-r[3], r[0])):
        same = [k + 1 for k, d in enumerate(drawn) if d[0] == r[0]]
        result.append((*r[:4], same[ranks[r[0]]] if ranks[r[0]] < len(same) else None))
        ranks[r[0]] += 1
    return sorted(result, key=str)


@pytest.mark.parametrize("ngram,percent", [(1, 10), (2, 50), (3, 100)])
def test_importance_draw_matches_brute_force(spark, ngram, percent):
    rows, target = odd_rows(), ["Wort1 wort2, WORT3 naïve 日本", "", None, "Wort1 wort2"]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    clash = {c: F.lit("x") for c in ("weight", "score", "rank", "late", "at", "n", "side", "bucket", "n_words")}
    docs = with_clashes(documents(spark, rows)).withColumns(clash).repartition(5)
    got = importance.importance_draw(docs, items, ngram=ngram, percent=percent).collect()
    assert sorted(map(tuple, got), key=str) == brute_draw(rows, target, ngram, percent=percent)
    drawn = {r.doc_id for r in got if r["rank"] is not None}
    kept = importance.importance_resample(docs, items, ngram=ngram, percent=percent)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == drawn


def test_importance_of_empty_tables_and_missing_ids(spark):
    docs = documents(spark, odd_rows() + [(None, "wort1 " * 30, "s")])
    items = spark.createDataFrame([(1, "wort1")], "item_id long, text string")
    assert importance.importance_draw(docs.limit(0), items).collect() == []
    got = {r.doc_id: r for r in importance.importance_draw(docs, items.limit(0), percent=100).collect()}
    assert got[70].weight == 0 and got[70]["rank"] is None and got[None].n_features == 30
    assert sorted(r["rank"] for r in got.values() if r["rank"])[0] == 1


def test_feature_hash_of_a_longer_run_extends_the_shorter(spark):
    w = [b"one", b"two", b"three"]
    assert importance.feature_hashes(w, 3) == [zlib.crc32(x) for x in (*w, b"one two", b"two three", b"one two three")]
    text = bytes(range(1, 128)).decode() + " Äb"
    assert [x.decode() for x in importance.words(text.encode())] == term_list(text)


def near_rows(seed, ngram):
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(500)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 8, 30, 90, 250]))]
        base += passage * (family % 3 == 0)
        for _ in range(7):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary).upper()
            rows.append((len(rows), "  ".join(w), "s"))
    return rows + [(500, None, "s"), (501, "", "s"), (502, "one two", "s"), (503, "ONE\ttwo", "s"), (504, "...", "s")]


@pytest.mark.parametrize("ngram,percent,block", [(3, 85, 512), (5, 80, 3)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, ngram, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows(ngram, ngram)
    want = brute_classes(rows, ngram, percent)
    docs = with_clashes(documents(spark, rows)).withColumns({c: F.lit(1) for c in ("hi", "lo", "sig", "kept", "label")})
    got = minhash.near_duplicates(docs, ngram=ngram, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = minhash.drop_near_duplicates(docs, ngram=ngram, percent=percent)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_near_duplicates_that_do_not_link_with_their_pivot(spark, monkeypatch):
    """A chain: each text differs from the next by little, from the first by
    much, so classes come from the later rounds and from blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(words[4 * k:4 * k + 120]), "s") for k in range(20)]
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows, 3, 85)


def test_near_duplicates_without_ids_repeated_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text, "s"), (3, text, "s"), (None, text, "s"), (None, "only here", "s"), (4, text + " more", "s"), (9, None, "s")]
    got = sorted(minhash.near_duplicates(documents(spark, rows)).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == sorted(
        [(3, 3, True), (3, 3, True), (None, 3, False), (None, None, True), (4, 3, False), (9, 9, True)],
        key=lambda r: str([x for x in got if (x.doc_id, x.component_id, x.kept) == r][0]))
    assert minhash.near_duplicates(documents(spark, rows).limit(0)).collect() == []
    assert minhash.near_duplicates(documents(spark, [(1, None, "s"), (2, "", "s")])).count() == 2


def test_an_id_with_several_texts_links_by_each(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a, "s"), (5, b, "s"), (3, a + " x", "s"), (8, b + " y", "s"), (9, "other words here", "s")]
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted({(r.doc_id, r.component_id) for r in got}) == [(3, 3), (5, 3), (8, 3), (9, 9)]


def test_estimate_takes_chance_hits_off(spark):
    rng = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.85, 1.0):
        size, both = 3000, int(round(3000 * share * 2 / (1 + share)))
        common = rng.integers(0, 1 << 63, both, dtype=np.uint64)
        sets = [np.concatenate([common, rng.integers(0, 1 << 63, size - both, dtype=np.uint64)]) for _ in range(2)]
        sig = minhash.pack(minhash.minima(np.concatenate(sets), np.array([0, size])))
        agreed = int(minhash.agreements(sig[:1], sig[1:])[0, 0])
        df = spark.createDataFrame([([int(x) for x in sig[0].view(np.int64)], [int(x) for x in sig[1].view(np.int64)])],
                                   "a array<long>, b array<long>")
        same, estimate = df.select(minhash.agreement(F.col("a"), F.col("b")).alias("n")) \
            .select("n", minhash.similarity(F.col("n"))).first()
        assert same == agreed and abs(estimate - share) < 0.16
        assert agreed >= minhash.least_agreement(85) or share < 0.85


def test_family_of_copies_gives_edges_in_proportion():
    """A cell of n linked sets and their pivot gives n edges."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join([*words, f"x{k}"]) for k in range(300)]
    from fareflow.llm.ngram_join import ngram_sets
    own, gram = ngram_sets(pa.array(texts))
    sig = minhash.pack(minhash.minima(gram, np.searchsorted(own, np.arange(300))))
    table = pa.table({"id": pa.array(range(300)), "side": [1] + [0] * 299, "label": pa.array(range(300)), "text": texts,
                      "sig": [x.tolist() for x in sig.view(np.int64)]})
    assert minhash._confirm(85, 3)(table).num_rows == 299


def test_shared_shingles_of_a_cell():
    rng = np.random.default_rng(4)
    sets = [rng.choice(400, rng.integers(0, 120), replace=False).astype(np.uint64) for _ in range(90)]
    sets += [np.arange(350, dtype=np.uint64)] * 50  # shingles of many sets and of few
    own = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    got = minhash.shared_shingles(own, np.concatenate(sets), len(sets))
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]


def brute_search(rows, items, top):
    docs = [(i, collections.Counter(term_list(t))) for i, t, _ in rows]
    filled = [d for _, d in docs if d]
    many, total = len(filled), sum(sum(d.values()) for d in filled)
    out = []
    queries = collections.defaultdict(set)
    for item, text in items:
        queries[item] |= set(term_list(text))
    for item, query in queries.items():
        found = []
        for i, d in docs:
            n, score = sum(d.values()), 0
            for t in query & set(d):
                w = math.floor(1000 * math.log((2 * many + 2) / (2 * sum(t in x for x in filled) + 1)))
                score += w * (10 ** 9 * d[t] // (1000 * d[t] + 20 * (50 + 50 * n * many // total)))
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:top])]
    return out


@pytest.mark.parametrize("bucket,terms,top", [(256, 1 << 20, 50), (4, 12, 5), (7, 30, 1)])
def test_ranked_search_matches_brute_force(spark, monkeypatch, bucket, terms, top):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", terms)
    monkeypatch.setattr(lexical, "SEED_SHARE", 0.3)
    rows = odd_rows() + [(None, "wort1 wort2 wort3", "s")]
    items = [(1, "WORT1 wort2 x1"), (2, "wort7 naïve 日本 É"), (3, ""), (4, None), (5, "nothing here"), (1, "wort30"),
             (None, "wort5"), (6, " ".join(f"w{i} wort{i}" for i in range(40)))]
    clash = {c: F.lit("x") for c in ("score", "rank", "term", "tf", "m", "length", "item", "block", "df")}
    docs = with_clashes(documents(spark, rows)).withColumns(clash).repartition(4)
    table = spark.createDataFrame(items, "item_id long, text string").withColumns(clash)
    got = lexical.ranked_search(docs, table, top=top).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_search(rows, items, top), key=str)


def test_ranked_search_of_empty_tables(spark):
    docs = documents(spark, [(1, "a b", "s"), (2, None, "s")])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked_search(docs.limit(0), items).collect() == []
    assert lexical.ranked_search(docs, items.limit(0)).collect() == []
    assert lexical.ranked_search(docs.where("doc_id = 2"), items).collect() == []
    got = lexical.ranked_search(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 1


def test_buckets_of_short_vectors_are_skipped():
    best = lexical._Best(np.array([100]), 2)
    starts, item_terms = np.array([0, 1]), np.array([3])
    args = (np.array([0]), np.array([3]), np.array([90]), np.array([90.0]), np.array([7]), starts, item_terms, best)
    assert lexical.search_bucket(*args) is False and not best.rows
    args = (np.array([0]), np.array([3]), np.array([120]), np.array([120.1]), np.array([7]), starts, item_terms, best)
    assert lexical.search_bucket(*args) is True and best.rows[0][0].tolist() == [120]


def test_result_columns_never_replace_input_columns(spark):
    from fareflow.llm import language_id, quality, toxicity
    from fareflow.llm.common import not_taken
    docs = documents(spark, [(1, "a b", "s")]).withColumns({c: F.lit("mine") for c in ("Toxicity", "score", "lang_pred")})
    for call in (lambda: toxicity.tag(docs, None, F.col("text")), lambda: quality.score(docs, None, F.col("text"), F.col("n_chars")),
                 lambda: language_id.detect(docs, None, F.col("text"))):
        with pytest.raises(ValueError, match="already has"):
            call()
    not_taken(docs, "other")


def test_many_revisits_of_one_payload(spark):
    """A third of all pages share a payload; responses keep their own figures."""
    from fareflow.llm import warc
    rows = [("r0", "response", None, 0, 7, "A"), ("r1", "response", None, 1, 0, "B")]
    rows += [(f"v{i}", "revisit", "r0", 10 + i, None, None) for i in range(40)]
    kind = "record_id string, record_type string, refers_to string, page_id long, payload_bytes long, payload_digest string"
    got = {r.page_id: tuple(r)[1:] for r in warc.resolve_revisits(spark.createDataFrame(rows, kind)).collect()}
    assert got == {0: (7, "A", "response", None), 1: (0, "B", "response", None),
                   **{10 + i: (7, "A", "revisit", 0) for i in range(40)}}
    assert warc.resolve_revisits(spark.createDataFrame([], kind)).collect() == []
