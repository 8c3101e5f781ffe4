"""Queries over the test tables, one per operator, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.llm.chat import SYNTHETIC, chat_digests, with_synthetic
from sonoledger.llm.decontaminate import WINDOW, contamination
from sonoledger.llm.language import identify
from sonoledger.llm.near_dup import near_duplicates
from sonoledger.llm.page_text import extract_pages, learn_weights
from sonoledger.llm.pieces import encode_texts
from sonoledger.llm.ranked_search import BEST, ranked_search
from sonoledger.llm.secrets_scan import scan, train as train_secrets
from sonoledger.llm.shards import SHARDS, byte_shards
from sonoledger.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, compress
from sonoledger.llm.vector_links import near_duplicate_vectors
from sonoledger.llm.vectors import nearest
from sonoledger.llm.toxicity import score_documents, train as train_toxicity


# Rows of text that go to a Python worker at once. Spark's default of 10,000 makes buffers of
# a hundred megabytes on either side where texts are long.
ARROW_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data. Sets the session's Arrow batches to ``ARROW_ROWS``."""

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_pages(pages, learn_weights(pages))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), piece_model())


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digests(with_synthetic(table(spark, sf_dir, "conversations")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train_secrets(docs))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"))


def op11_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_language_id": op2_language_id,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_decontamination": op6_decontamination,
    "op7_secret_scan": op7_secret_scan,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
    "op11_vector_duplicates": op11_vector_duplicates,
    "op12_vector_codes": op12_vector_codes,
    "op13_ranked_search": op13_ranked_search,
}

# formatted_chars: a turn's markers take 24 code points, a part's 11; escaping adds one for each
# escape sign, a control opening keeps its two, a line break in a role adds one.
OP4_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{SYNTHETIC}'
  UNION ALL SELECT -1, 1, 'assistant', '{SYNTHETIC}'
), o AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace(text, '␛', '␛0'))
           + CASE WHEN before = role THEN 11
                  ELSE 24 + length(replace(replace(role, '␛', '␛0'), chr(10), '␛2')) END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

# CRC-32 by its table, as DuckDB has no function for it.
OP10_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (
  SELECT list(c::BIGINT ORDER BY byte) AS tab FROM steps WHERE k = 8
), sized AS (
  SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents
), sums AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT,
             list_transform(range(1, size), lambda i: ('0x' || hex(encode(text))[2 * i - 1 : 2 * i])::BIGINT)),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM sized, crc_table
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (ORDER BY doc_id, text_crc32, size) AS nth, sum(size) OVER () AS total
  FROM sums
), cut AS (
  SELECT *, least({SHARDS - 1}, (2 * upto - size) * {SHARDS} // (2 * total))::INTEGER AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (nth - min(nth) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""

# An occurrence is an equal run of words at a place; words are numbered from 1.
OP6_SQL = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, w, len(w) AS n FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents)
), b AS (
  SELECT item, w, least({WINDOW}, len(w)) AS m FROM (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
), pat AS (
  SELECT DISTINCT item, m, array_to_string(w[i : i + m - 1], ' ') AS p
  FROM (SELECT item, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM b)
), places AS (
  SELECT r, w, m, unnest(range(1, n - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM pat) WHERE n >= m
), occ AS (
  SELECT r, i, pat.m, item
  FROM (SELECT r, i, m, array_to_string(w[i : i + m - 1], ' ') AS p FROM places) x JOIN pat USING (m, p)
), hit AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM occ) GROUP BY r
), it AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r
)
SELECT doc_id, n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""



def _op12_sql() -> str:
    """Codebooks round by round, every part measured against every entry."""

    steps = [f"""
WITH held AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM held, range({PARTS}) t(p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x AS c FROM part WHERE r <= {ENTRIES}
)"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, min(d * {ENTRIES} + e)::BIGINT % {ENTRIES} AS e, min(d * {ENTRIES} + e)::BIGINT // {ENTRIES} AS d
  FROM (SELECT r, p, e, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d
        FROM part JOIN book{k} USING (p))
  GROUP BY r, p
)""")
        if k < ROUNDS:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(moved, c) AS c FROM book{k} LEFT JOIN (
    SELECT p, e, list(floor(s / n) ORDER BY j) AS moved FROM (
      SELECT p, e, j, sum(x[j]) AS s, count(*) AS n
      FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS j FROM near{k} JOIN part USING (r, p))
      GROUP BY p, e, j)
    GROUP BY p, e) USING (p, e)
)""")
    return ", ".join(steps) + f""", coded AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r
), digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) AS s
  FROM book{ROUNDS}
)
SELECT vec_id, label, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT s FROM digest) AS codebooks_sha256
FROM held JOIN coded USING (r)
"""


OP12_SQL = _op12_sql()

# Every pair is measured; a component's smallest id spreads along links, as far as there are vectors.
OP11_SQL = """
WITH RECURSIVE held AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v,
         coalesce(len(embedding) > 0 AND vec_id IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS good
  FROM embeddings
), link AS MATERIALIZED (
  SELECT a.r, b.r AS o FROM held a JOIN held b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE a.good AND b.good AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT r, r AS o FROM held
  UNION
  SELECT reach.r, link.o FROM reach JOIN link ON reach.o = link.r
), low AS (
  SELECT reach.r, min(h.vec_id) AS component_id FROM reach JOIN held h ON reach.o = h.r GROUP BY reach.r
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM held JOIN low USING (r) LEFT JOIN (SELECT r, count(*) AS n FROM link GROUP BY r) USING (r)
"""

# Every document that shares a term with an item is scored.
OP13_SQL = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, w FROM (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents)
  WHERE len(w) > 0
), b AS MATERIALIZED (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark
), asked AS MATERIALIZED (
  SELECT q, item_id, unnest(w) AS t FROM b
), total AS (
  SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d
), posting AS MATERIALIZED (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY r, t
), weight AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM posting, total GROUP BY t, n_docs
), impact AS (
  SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(d.w) * n_docs) // n_terms)) AS f
  FROM posting JOIN d USING (r), total
), scored AS (
  SELECT q, item_id, r, doc_id, sum(w * f)::BIGINT AS score
  FROM asked JOIN weight USING (t) JOIN impact USING (t) GROUP BY q, item_id, r, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY rank <= {BEST}
"""

ORACLE = {"op11_vector_duplicates": OP11_SQL, "op13_ranked_search": OP13_SQL, "op12_vector_codes": OP12_SQL, "op6_decontamination": OP6_SQL, "op4_chat_formatting": OP4_SQL, "op10_sharding": OP10_SQL}
