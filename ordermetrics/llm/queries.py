"""One query for each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermetrics.llm import (
    blocks, fingerprints, jaccard, language, licenses, mixing, neighbours, packing, resampling,
    spelling, substrings, toxicity, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """The fold of a document, from its id alone; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def _held_out(folds: int, at: int) -> Column:
    return F.coalesce(fold(folds) == at, F.lit(False)).alias("held_out")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").filter(fold(3) != 1))
    found = toxicity.score(docs, model, others=[_held_out(3, 1)])
    return found.select("doc_id", "held_out", "score", "predicted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return substrings.digest(kept)


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.filter("vec_id % 20 = 0"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    models = language.fit(docs.filter(fold(5) != 0))
    found = language.identify(docs, models, others=[_held_out(5, 0)])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc.archive(_table(spark, sf_dir, "pages"))
    return warc.read(folder, index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(_table(spark, sf_dir, "documents")))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.source", F.col("tokens").alias("n_tokens"), "pass")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.extract(_table(spark, sf_dir, "pages"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def query_catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in (
        op1_toxicity, op2_substring_dedup, op3_nearest_neighbours, op4_language_id, op5_warc,
        op6_ngram_jaccard_join, op7_fingerprints, op8_license_scan, op9_best_fit_packing,
        op10_source_mixing, op11_spelling_variants, op12_html_extraction,
        op13_importance_resampling,
    )}


_WORDS = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# One row with the CRC-32 of every byte, and a text's CRC from its bytes in hexadecimal.
_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce([b] || [0 FOR i IN range(0, 8)], lambda c, i:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(0, 256) r(b)))"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce([4294967295] || list_transform(
      regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT)),
      lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"""


ORACLE_SQL = {
    "op2_substring_dedup": rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 34), ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM texts
        WHERE len(words) >= 35)),
again AS (SELECT body FROM windows GROUP BY body HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT doc_id, i + k AS place
  FROM windows JOIN again USING (body), range(0, 35) t(k)),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT doc_id, count(c.place) AS n_removed,
         string_agg(word, ' ' ORDER BY place) FILTER (WHERE c.place IS NULL) AS body
  FROM placed p LEFT JOIN covered c USING (doc_id, place) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)""",
    "op5_warc": """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex FROM pages),
owners AS (SELECT hex, max(page_id) AS owner FROM digests GROUP BY hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER)
               >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1) FOR i IN range(0, 32)], '')
         AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM digests JOIN owners USING (hex)""",
    "op6_ngram_jaccard_join": rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{_WORDS}') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts
        WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b USING (body) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reach AS (
  SELECT doc_id, doc_id AS other FROM texts
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT t.doc_id, CAST(coalesce(max(s.n), 0) AS BIGINT) AS n_shingles,
       min(r.other) AS component_id
FROM texts t JOIN reach r ON r.doc_id = t.doc_id LEFT JOIN sizes s ON s.doc_id = t.doc_id
GROUP BY t.doc_id""",
    "op11_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS mark, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, '{_UPPER}', lower('{_UPPER}')), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL),
marked AS (SELECT run, times, {_crc("mark || run")} AS h FROM runs, crc_table),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) + 2 AS INTEGER))
      ELSE run END AS word FROM marked)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
gone AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
  FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gone a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gone a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near,
         first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 5 * w.n THEN other END AS form,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.at
  WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN steps s ON s.word = f.word JOIN forms l ON l.word = s.at
WHERE l.form IS NULL""",
    "op13_importance_resampling": rf"""
WITH {_CRC_TABLE},
texts AS (
  SELECT corpus, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', lower('{_UPPER}')),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT 's' AS corpus, doc_id, text FROM documents
        UNION ALL SELECT 't', NULL, text FROM benchmark)),
runs AS (
  SELECT corpus, doc_id, unnest(words || [words[i] || ' ' || words[i + 1]
    FOR i IN range(1, len(words))]) AS feature FROM texts),
counted AS (SELECT corpus, doc_id, feature, count(*) AS n FROM runs GROUP BY ALL),
coded AS (
  SELECT feature, {_crc("feature")} % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), crc_table),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE corpus = 's'), 0) AS s,
         coalesce(sum(n) FILTER (WHERE corpus = 't'), 0) AS t
  FROM counted JOIN coded USING (feature) GROUP BY bucket),
alls AS (SELECT CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM totals),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(x.t + 1 AS DOUBLE) * (a.s + 10000)
         / (CAST(x.s + 1 AS DOUBLE) * (a.t + 10000)))) AS BIGINT) AS gain FROM totals x, alls a),
weights AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features,
         CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM counted JOIN coded USING (feature) JOIN gains USING (bucket)
  WHERE corpus = 's' GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
         coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || left(sha256('7:' || CAST(doc_id AS VARCHAR)), 8) AS BIGINT) + 0.5)
           / 4294967296.0))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (doc_id) WHERE corpus = 's'),
placed AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many
  FROM scored WHERE n_words >= 20)
SELECT doc_id, s.n_features, s.weight, s.score,
       CASE WHEN place <= 25 * many // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed USING (doc_id)""",
}


def oracle_catalog() -> dict[str, str]:
    return dict(ORACLE_SQL)
