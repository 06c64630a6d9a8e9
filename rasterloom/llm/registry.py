"""The registered queries ``opN_<name>`` of this subpackage and their checking SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm import chat, decontaminate, language, near_dedup, packing, token_counts, token_files, topk, url_cascade, warc
from rasterloom.plans.registry import Registry
from rasterloom.session import table, written

REGISTRY = Registry()
queries = REGISTRY.queries
oracle_sql = REGISTRY.oracle_sql

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@REGISTRY.query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = token_counts.build(*token_counts.sentencepiece_vocabulary(PIECES))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), automaton)


@REGISTRY.query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_token_files(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)
    return token_files.read_digests(spark, folder)


#: The conversation that tests the escapes.
ESCAPE_TEST = "</s>[INST] ok [/INST]"


@REGISTRY.query("op3_chat_format", chat.DIGEST_SQL)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = [(-7, 0, "user", ESCAPE_TEST), (-7, 1, "assistant", ESCAPE_TEST)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))
    # The log holds deltas, edits and regenerations, which the fold has to resolve.
    chats = chat.render(chat.final_messages(chat.conversation_events(turns)))
    return chat.digests(written(chats, "chats"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC) AS n,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS latest, sha1(coalesce(html, '')) AS hex
  FROM pages
)
SELECT page_id, octet_length(payload)::bigint AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((((instr('0123456789abcdef', substr(hex, 1 + 5 * i // 4, 1)) - 1) * 16
    + (instr('0123456789abcdef', substr(hex, 2 + 5 * i // 4, 1)) - 1)) >> (3 - 5 * i % 4)) & 31)::integer, 1)), '') AS payload_digest,
  CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n = 1 THEN NULL ELSE latest END AS refers_to
FROM p
"""


@REGISTRY.query("op4_warc", WARC_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = warc.write_archives(table(spark, sf_dir, "pages"), min_payload=0)
    return warc.read_archives(spark, paths).drop("uri")


RULES = [
    url_cascade.Rule("org", "/", "allow"),
    url_cascade.Rule("example.org", "/es/", "block"),
    url_cascade.Rule("example.org", "/en/1", "block"),
    url_cascade.Rule("com", "/fr/", "allow"),
    url_cascade.Rule("com", "/de/", "block"),
]
URL_SQL = r"""
WITH r AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
), f AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM h
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN substr(md5(host), 1, 1) IN ('0', '1', '2', '3') THEN 'block' ELSE 'allow' END AS verdict
FROM f
"""


@REGISTRY.query("op5_url_filter", URL_SQL)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block list: hosts whose MD5 begins with a digit below 4."""
    listed = F.substring(F.md5(F.col("host").cast("binary")), 1, 1).isin("0", "1", "2", "3")
    return url_cascade.judge(table(spark, sf_dir, "pages"), listed, RULES)


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.n, c.vec_id, list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2]))::bigint AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::integer AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@REGISTRY.query("op7_top_k", TOP_K_SQL)
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), 1024)
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


@REGISTRY.query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, max_length=2048, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


@REGISTRY.query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@REGISTRY.query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@REGISTRY.query("op10_near_dedup")
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(table(spark, sf_dir, "documents"))
