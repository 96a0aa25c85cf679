"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from mercato.llm.bpe import encode
from mercato.llm.common import scratch_dir, table
from mercato.llm.exact_dedup import exact_dedup
from mercato.llm.lexical import lexical_search
from mercato.llm.mixing import mix
from mercato.llm.near_dedup import near_dedup
from mercato.llm.packing import pack
from mercato.llm.quality import quality
from mercato.llm.search import top_k
from mercato.llm.secrets import find_secrets
from mercato.llm.sharding import place
from mercato.llm.spelling import spelling_variants
from mercato.llm.toxicity import toxicity
from mercato.llm.warc import round_trip


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document; a document's text decides nothing, its id does."""
    return place(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "source", "n_chars", "slot", "shard")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).drop("text_sha256")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_top_k_search": op3_top_k_search,
    "op4_warc_archives": op4_warc_archives,
    "op5_shard_documents": op5_shard_documents,
    "op6_secret_scan": op6_secret_scan,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_near_dedup": op10_near_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_packing": op13_packing,
}

OP1_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g USING (body)
"""

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS shuffle,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
caps AS (SELECT *, (3 * source_size)::DOUBLE AS cap, (3 * source_size)::DOUBLE / weight AS full_at FROM s),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY full_at, source NULLS LAST
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM caps),
chosen AS (SELECT min(full_at) AS open_at, arg_min(level, full_at) AS level FROM levels WHERE full_at > level),
targets AS (
  SELECT source, source_size,
         CASE WHEN c.open_at IS NULL OR full_at < c.open_at THEN cap ELSE c.level * weight END AS target
  FROM levels, chosen c),
timed AS (
  SELECT d.*, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY shuffle, doc_id, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT doc_id, size, p, sum(size) OVER (
           ORDER BY (source_size * p + upto)::BIGINT / target, source NULLS LAST, shuffle, doc_id, size, p
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sofar
  FROM timed, (VALUES (0), (1), (2)) AS passes(p) WHERE size > 0),
n AS (
  SELECT doc_id, count(*) AS copies FROM copies
  WHERE sofar <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT timed.doc_id, size, source_size, target, (coalesce(n.copies, 0) * size)::BIGINT AS taken
FROM timed LEFT JOIN n USING (doc_id)
"""

OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, body, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM h
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {LOWER} AS body FROM documents),
words AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(body, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
tf AS (SELECT rid, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY rid, term),
size AS (SELECT rid, sum(tf)::BIGINT AS n FROM tf GROUP BY rid),
total AS (SELECT count(*)::BIGINT AS cn, sum(n)::BIGINT AS cl FROM size),
weight AS (
  SELECT term, floor(1000 * ln((2 * cn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, total GROUP BY term, cn),
norm AS (SELECT rid, 100 - 75 + (75 * n * cn) // cl AS m FROM size, total),
asked AS (
  SELECT item_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
times AS (SELECT item_id, term, count(*)::BIGINT AS times FROM asked GROUP BY item_id, term),
scored AS (
  SELECT item_id, rid, any_value(doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM times JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (rid) GROUP BY item_id, rid),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# The checksum goes byte by byte through the table of its polynomial (fixed value).
OP12_SQL = rf"""
WITH RECURSIVE poly AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*)::BIGINT AS n FROM runs GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hex FROM counted),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(0, len(hex) // 2), lambda i: ('0x' || substr(hex, 2 * i::INT + 1, 2))::BIGINT),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM bytes, poly),
noisy AS (
  SELECT CASE WHEN h % 97 = 0
         THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS gap
  FROM (SELECT word, n, unnest(range(0, length(word)))::INT AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.gap = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.gap = b.word),
best AS (
  SELECT word, count(*)::BIGINT AS n_near, arg_min(other, (-n, encode(other))) AS form, max(n) AS form_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
         CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op2_mix_sources": OP2_SQL,
    "op3_top_k_search": OP3_SQL,
    "op4_warc_archives": OP4_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
}
