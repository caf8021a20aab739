"""One registered query for each operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import bpe, fingerprints, jaccard, leaks, packing, phrases, quotes, substrings, topk, toxicity, urls, warc, whitening
from pageloom.llm.common import table
from pageloom.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.unquote(quotes.quoting(table(spark, sf_dir, "conversations")))


ORACLES["op1_quotation_linking"] = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         CASE WHEN trim(coalesce(text, ''), E' \n') <> '' THEN trim(regexp_replace(lower(text), '\s+', ' ', 'g')) END AS said
  FROM conversations),
firsts AS (SELECT conv_id, said, min(turn) AS origin FROM t WHERE said IS NOT NULL GROUP BY conv_id, said),
told AS (
  SELECT t.conv_id, t.turn, t.text, CASE WHEN f1.origin < t.turn THEN f1.origin END AS o1, CASE WHEN f2.origin < t.turn THEN f2.origin END AS o2,
         (a.said IS NOT NULL)::INT AS q1, (b.said IS NOT NULL)::INT AS q2
  FROM t LEFT JOIN t a ON a.conv_id = t.conv_id AND a.turn = t.turn - 1 LEFT JOIN t b ON b.conv_id = t.conv_id AND b.turn = t.turn - 2
         LEFT JOIN firsts f1 ON f1.conv_id = a.conv_id AND f1.said = a.said LEFT JOIN firsts f2 ON f2.conv_id = b.conv_id AND f2.said = b.said),
linked AS (
  SELECT conv_id, turn, text, coalesce(o1, o2) AS parent_turn, q1 + q2 AS n_quotes,
         (o1 IS NOT NULL)::INT + (o2 IS NOT NULL)::INT AS n_linked
  FROM told),
chain AS (
  SELECT conv_id, turn, turn AS thread, 0 AS depth FROM linked WHERE parent_turn IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, c.thread, c.depth + 1 FROM linked l JOIN chain c ON l.conv_id = c.conv_id AND l.parent_turn = c.turn)
SELECT conv_id, turn, parent_turn, thread, depth, n_quotes, n_linked, trim(text, E' \n') AS own_text
FROM linked JOIN chain USING (conv_id, turn)
"""


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS s FROM w WHERE len(words) >= 20),
wins AS (SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS win FROM places),
firsts AS (SELECT win, min({'d': doc_id, 's': s}) AS f FROM wins GROUP BY win HAVING count(*) > 1),
later AS (SELECT doc_id, s FROM wins JOIN firsts USING (win) WHERE f < {'d': doc_id, 's': s}),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS p FROM later),
every AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM every ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=1024)


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = shared_path(spark, "warc")
    warc.write_warc(warc.with_revisits(table(spark, sf_dir, "pages")), archives)
    return warc.page_records(warc.read_warc(spark, archives))


ORACLES["op4_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=1024, end_id=2)
    return packed.withColumnRenamed("id", "doc_id")


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


ORACLES["op8_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
places AS (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS s FROM w WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[s : s + 4], ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY x, y),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 75 * (p.n + q.n - common)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(min(y), w.doc_id)) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.x = w.doc_id GROUP BY w.doc_id, n
"""


#: The rules that op6 judges by.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES, default="allow")


ORACLES["op6_url_filters"] = r"""
WITH rules(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
hits AS (
  SELECT n, rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC, rule) AS rank
  FROM parts, rules
  WHERE ends_with('.' || host, '.' || split_part(rule, '/', 1))
    AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1)))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM hits WHERE rank = 1) h USING (n)
"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = toxicity.train_on(docs, labels.where(~held_out), most=1000)
    scored = toxicity.score_texts(docs, model).select("row.doc_id", "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10, scale=1024)


ORACLES["op10_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, longest=4, top=2000, share=80)


ORACLES["op11_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS s FROM w WHERE len(ws) > 0),
grams AS (SELECT lang, size, array_to_string(ws[s : s + size - 1], ' ') AS phrase FROM starts, (VALUES (1), (2), (3), (4)) v(size) WHERE s + size - 1 <= len(ws)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size >= 2 AND f >= 30),
cuts AS (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1 : k], ' ')
              JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1 : c.size], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored),
inner_ AS (
  SELECT lang, array_to_string(ws[s : s + n - 1], ' ') AS phrase, max(a) AS longer
  FROM cand, (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) v(s, n) WHERE n < size AND s + n - 1 <= size GROUP BY ALL),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, score
  FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE nth = 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), most=16, scale=64, shift=1_000_000)
    return found.withColumn("deviation", F.col("deviation").try_cast("long")).withColumnRenamed("id", "vec_id")


@query
def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
