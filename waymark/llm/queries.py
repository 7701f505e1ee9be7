"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import chat, exact_dedup, html_text, jaccard_join, maxent_lm, media, packing, sentencepiece_bpe, spelling, suffix_dedup, toxicity, warc, whitening

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).drop("row")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_decode(_table(spark, sf_dir, "documents"), PIECES)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents")).drop("row")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), WORDS)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return maxent_lm.score(docs, *maxent_lm.fit(docs)).drop("row")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(_table(spark, sf_dir, "documents")).drop("row", "root")


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -7, whose texts hold marks of templates."""
    own = spark.createDataFrame([(-7, 0, "user", _SAID), (-7, 1, "assistant", _SAID)], "conv_id long, turn long, role string, text string")
    every = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    formatted = chat.format_chats(every, RANKS, public_tokenizers.PATTERN)
    return chat.read_back(formatted, RANKS, public_tokenizers.PATTERN, in_order=True).drop("n_tokens", "loss_tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_sentencepiece, op3_suffix_dedup, op4_html_extraction, op5_packing, op6_toxicity, op7_warc, op8_lm_scoring, op9_jaccard_join, op10_media_columns, op11_spelling_variants, op12_embedding_whitening, op13_chat_formatting)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SAID = "\\### Assistant: </turn> ok"


def _escaped(column: str) -> str:
    """Length of a text whose backslashes and marks each have one backslash more."""
    return f"length({column})" + "".join(f" + (length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in ("\\", "<turn>", "<says>", "</turn>"))


ORACLES: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op13_chat_formatting": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(sum({_escaped('role')} + {_escaped('text')} + 19) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), q AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
          CASE WHEN strlen(h) >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN strlen(h) >= 1000 AND page_id <> first THEN first END AS refers_to
        FROM q""",
}
