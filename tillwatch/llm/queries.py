"""The registered queries of the operators, and their SQL where SQL can express them.

SQL has no byte-pair merges, XXH64, samples from hashes, string kernels or forests, so most operators are
tested against brute force in tests/llm instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import (
    byte_bpe,
    chat,
    fingerprints,
    lexical,
    licenses,
    merkle,
    mixing,
    neighbours,
    sharding,
    simhash,
    statements,
    toxicity,
    url_rules,
    warc,
)
from tillwatch.llm.common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = sharding.shard(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_next(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.with_probe(table(spark, sf_dir, "conversations")))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked(table(spark, sf_dir, "documents"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_sharding": op3_sharding,
    "op4_warc": op4_warc,
    "op5_fingerprints": op5_fingerprints,
    "op6_chat": op6_chat,
    "op7_neighbours": op7_neighbours,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_lexical": op12_lexical,
    "op13_url_rules": op13_url_rules,
}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, {5 * i + 1}, 5))::INT >> {shift}) & 31) + 1, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)

_WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS sha FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS largest FROM d)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM m
"""

#: Marks of a turn: 12 + 10 + 10 characters; an escape adds one for each control string.
_CONTROLS = r"[<\[]\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)"

_CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(32 + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROLS}'))
           + len(regexp_extract_all(text, '{_CONTROLS}')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

SQL: dict[str, str] = {
    "op4_warc": _WARC,
    "op6_chat": _CHAT,
    "op11_merkle": statements.MERKLE,
    "op12_lexical": statements.LEXICAL,
    "op13_url_rules": statements.URL_RULES,
}
