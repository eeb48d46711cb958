"""Registered queries of the corpus operators, one ``opN_<name>`` each, and
their DuckDB twins where SQL can state them.

Each query applies its operator, with production parameters, to the whole
table and derives the digest columns of the query's contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import (decontaminate, exact_dedup, html_extract, importance, language_id, lexical, mixing,
                          minhash, ngram_join, quality, secrets, toxicity, warc)
from fareflow.llm.common import fold
from fareflow.session import stage_path
from fareflow.sources.tables import load_table


def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~fold(F.col("doc_id"), 4, 2)))
    return toxicity.tag(docs, model, F.col("text")).select(
        "doc_id", fold(F.col("doc_id"), 4, 2).alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.col("toxicity.spans").alias("spans"))


def op2_quality_factorisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = load_table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~fold(F.col("doc_id"), 5, 0)))
    return quality.score(docs, model, F.col("text"), F.col("n_chars")).select(
        "doc_id", fold(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4, 2)
    model = language_id.train(docs.where(~held_out))
    return language_id.detect(docs.drop("lang"), model, F.col("text")) \
        .select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(load_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", secrets.secret_spans(F.col("text")).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return docs.select("doc_id", *[count(k) for k in secrets.BASE_KINDS],
                       F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                       secrets.joined(F.col("found")).alias("spans"))


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.select("page_id", "url", html_extract.main_text(html_extract.train(), F.col("html")).alias("text")) \
        .withColumn("n_chars", F.length("text").cast("long"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(load_table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


def op10_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "warc-archives")
    warc.write_warc(load_table(spark, sf_dir, "pages"), path)
    return warc.resolve_revisits(warc.read_warc(spark, path))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_draw(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(load_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity_chain, op2_quality_factorisation, op3_language_id, op4_source_mixing, op5_exact_dedup, op6_secret_scan,
        op7_html_main_text, op8_ngram_jaccard_join, op9_benchmark_decontamination, op10_warc_boundary_chain,
        op11_importance_resampling, op12_minhash_near_dedup, op13_lexical_search)
}

OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS key
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS pos
  FROM docs GROUP BY source),
w AS (
  SELECT *, CASE (pos - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size::DOUBLE * 2.0::DOUBLE AS cap,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total
  FROM src),
lv AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
         sum(w) OVER (ORDER BY cap / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onw
  FROM w),
fl AS (SELECT *, (total - bef) * w >= cap * onw AS isfull FROM lv),
tg AS (
  SELECT source, source_size,
         CASE WHEN isfull THEN cap ELSE least(cap,
              (total - sum(CASE WHEN isfull THEN cap ELSE 0 END) OVER ()) * w
              / sum(CASE WHEN isfull THEN 0 ELSE w END) OVER ()) END AS target
  FROM fl),
pl AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM tg),
rs AS (SELECT *, CAST(floor(target - whole * source_size) AS BIGINT) AS rest FROM pl),
ks AS (
  SELECT source, key, sum(size) AS words,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs GROUP BY source, key)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(r.whole * d.size + CASE
         WHEN r.rest <= 0 OR k.upto - k.words >= r.rest THEN 0
         WHEN k.upto <= r.rest THEN d.size
         ELSE floor(d.size * (r.rest - (k.upto - k.words)) / k.words) END AS BIGINT) AS taken
FROM docs d
JOIN rs r ON d.source IS NOT DISTINCT FROM r.source
JOIN ks k ON d.source IS NOT DISTINCT FROM k.source AND d.key = k.key
"""

OP5_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm, doc_id) AS r
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND r = 1 AS kept,
       sha256(norm) AS text_sha256
FROM g
"""

_WORDS = r"""list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')),
  '[^\p{L}\p{N}\x20\x09-\x0D]+', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
#: Each item laid over each document at every distance and words compared: no
#: seeds.  Balances of all beginnings and ends of an item give its best run.
OP9_SQL = f"""
WITH d AS (SELECT doc_id AS id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
i0 AS (SELECT item_id AS id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
i AS (SELECT min(id) AS id, w FROM i0 WHERE len(w) > 0 GROUP BY w),
dw AS (SELECT id AS doc, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
iw AS (SELECT id AS item, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS k FROM i),
m AS (SELECT doc, item, n, p - k AS diagonal, count(*) AS total FROM dw JOIN iw USING (word) GROUP BY ALL),
c AS (SELECT *, total >= n * 0.8::DOUBLE AS whole FROM m
      WHERE CASE WHEN n < {decontaminate.SPAN} THEN total = n ELSE total >= n * 0.8::DOUBLE OR total >= 16 END),
k AS (SELECT c.doc, c.item, c.diagonal, list(iw.k ORDER BY iw.k) AS ks
      FROM c JOIN iw ON iw.item = c.item JOIN dw ON dw.doc = c.doc AND dw.p = c.diagonal + iw.k AND dw.word = iw.word
      GROUP BY ALL),
e AS (SELECT doc, item, n, diagonal, j, len(list_filter(ks, lambda x: x < j)) AS upto
      FROM (SELECT c.doc, c.item, c.n, c.diagonal, ks, unnest(range(0, c.n + 1)) AS j
            FROM c JOIN k USING (doc, item, diagonal) WHERE NOT whole)),
r AS (SELECT a.doc, a.item, a.n, a.diagonal, b.upto - a.upto AS matched, a.j AS f, b.j AS t,
        row_number() OVER (PARTITION BY a.doc, a.item, a.diagonal ORDER BY b.upto - a.upto DESC, a.j, b.j DESC) AS o
      FROM e a JOIN e b ON a.doc = b.doc AND a.item = b.item AND a.diagonal = b.diagonal
        AND b.j - a.j >= {decontaminate.MIN_RUN} AND 5 * (b.upto - a.upto) >= 4 * (b.j - a.j)),
g AS (SELECT doc, item, n, diagonal, matched, f, t FROM r WHERE o = 1
      UNION ALL SELECT doc, item, n, diagonal, total, 0, n FROM c WHERE whole),
h AS (SELECT g.*, list_min(list_filter(ks, lambda x: x >= f AND x < t)) AS first,
        list_max(list_filter(ks, lambda x: x >= f AND x < t)) AS last,
        row_number() OVER (PARTITION BY doc, item ORDER BY matched DESC, abs(diagonal), diagonal DESC) AS o
      FROM g JOIN k USING (doc, item, diagonal) WHERE matched > 0)
SELECT doc AS doc_id, item AS item_id, matched, n AS item_words, first, last, diagonal AS doc_pos FROM h WHERE o = 1
"""

OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
      WHERE 100 * o >= 90 * (a.n + b.n - o)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.u, r.c FROM r JOIN e ON e.v = r.id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.id = d.doc_id GROUP BY d.doc_id
"""

#: As op8 with its own threshold, and the document that stays.
OP12_SQL = "SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM (" \
    + OP8_SQL.replace("100 * o >= 90", "100 * o >= 85") + ")"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH step AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(list_concat([b], range(0, 8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY ALL),
bw AS (SELECT w, count(*) AS c FROM (SELECT unnest(w) AS w FROM b) GROUP BY ALL),
v AS (SELECT DISTINCT w FROM dw UNION SELECT w FROM bw),
h AS (SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(0, octet_length(encode(w))),
         lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
         lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS k FROM v, step),
s AS (SELECT k, sum(c) AS s FROM dw JOIN h USING (w) GROUP BY k),
t AS (SELECT k, sum(c) AS t FROM bw JOIN h USING (w) GROUP BY k),
g AS (SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
      FROM (SELECT DISTINCT k FROM h) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
e AS (SELECT doc_id, CAST(sum(c * gain) AS BIGINT) AS weight FROM dw JOIN h USING (w) JOIN g USING (k) GROUP BY doc_id),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8)
        AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN e USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM f WHERE n_features >= 20)
SELECT f.doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END AS rank
FROM f LEFT JOIN r USING (doc_id)
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
st AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
       FROM tf, st GROUP BY term, nn),
im AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))) AS x
       FROM tf JOIN wt USING (term), st),
sc AS (SELECT item_id, doc_id, CAST(sum(x) AS BIGINT) AS score FROM q JOIN im USING (term) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

ORACLE_SQL: dict[str, str] = {
    "op4_source_mixing": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op8_ngram_jaccard_join": OP8_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_minhash_near_dedup": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
