"""The registered queries: one for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.llm import ann, byte_bpe, chat, exact_dedup, mixing, ngram_join, secrets, sharding, toxicity, url_filter
from terracell.llm.shared import documents


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_slots(documents(spark, sf_dir), shards=24)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.encode_documents(documents(spark, sf_dir), codec, decode=True))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = chat.with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat.read_back(chat.examples(talks))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(documents(spark, sf_dir)).drop("copy")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.neighbours(vectors, F.col("vec_id") % 20 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir), words=3, percent=90).drop("set_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir))


OP5_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
rows AS (SELECT doc_id, sha256(body) AS text_sha256, body FROM docs)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY body) AS kept, text_sha256
FROM rows
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_url_filter": op2_url_filter,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_chat_formatting": op4_chat_formatting,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_nearest_neighbours": op6_nearest_neighbours,
        "op7_toxicity": op7_toxicity,
        "op8_ngram_join": op8_ngram_join,
        "op9_mixing": op9_mixing,
        "op10_secret_scans": op10_secret_scans,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_formatting": chat.SQL, "op5_exact_dedup": OP5_SQL, "op9_mixing": mixing.SQL}
