"""Queries of the operators that write formats: chat, token files, WARC."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat_format, token_files, warc
from millrace.llm.common import cut, table
from millrace.session import shared_path

END_ID = 1
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def conversation_records(conversations: DataFrame) -> DataFrame:
    """Every turn as a JSON record in one of four layouts, by conversation."""
    role, text = F.col("role"), F.coalesce(F.col("text"), F.lit(""))
    layouts = [
        F.struct(role.alias("role"), text.alias("text")),
        F.struct(F.struct(role.alias("role"), text.alias("content")).alias("message")),
        F.struct(F.struct(role.alias("speaker"), text.alias("utterance")).alias("turn")),
        F.struct(F.struct(role.alias("role")).alias("author"),
                 F.struct(F.lit("text").alias("content_type"), F.array(text).alias("parts")).alias("content")),
    ]
    kind = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(len(layouts)))
    record = F.coalesce(*(F.when(kind == i, F.to_json(x, {"ignoreNullFields": "false"}))
                          for i, x in enumerate(layouts)))
    return conversations.select("conv_id", "turn", record.alias("record"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = conversation_records(table(spark, sf_dir, "conversations"))
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
        F.to_json(F.struct(F.lit(CONTROL_TEXT).alias("prompt"), F.lit(CONTROL_TEXT).alias("completion"))).alias("record"))
    turns = chat_format.canonical_turns(records.unionByName(extra))
    return chat_format.conversation_digests(cut(chat_format.format_turns(turns), "chat"))


_CONTROL_RE = r"(<\\*(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)|\[\\*/?INST\])"

OP1_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(text) + length(role) + 24 + len(regexp_extract_all(text, '{_CONTROL_RE}')))
            AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    encoded = token_files.encode_sorted(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    token_files.write_token_files(encoded, path)
    return token_files.document_table(token_files.read_token_files(spark, path))


def op9_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    monolithic, members = shared_path(spark, "warc-whole"), shared_path(spark, "warc-members")
    warc.write_archives(warc.deduplicate(table(spark, sf_dir, "pages")), monolithic)
    index = warc.normalise(spark, monolithic, members)
    return warc.read_records(index, members).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                    "refers_to")


OP9_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.REVISIT_MIN} AND page_id <> first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= {warc.REVISIT_MIN} AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

QUERIES = {"op1_chat_format": op1_chat_format, "op2_token_files": op2_token_files,
           "op9_warc_members": op9_warc_members}
ORACLES = {"op1_chat_format": OP1_SQL, "op9_warc_members": OP9_SQL}
