"""The corpus pipeline: from documents to token ids, each stage working on what the one before it kept.

Stages: documents that the toxicity model rejects go; of exact copies one
stays; of each group of near copies (five-word shingles, similarity of 0.8 or
more) one stays; sources are mixed to their target weights, which repeats
documents of sources that weigh more than they hold; texts are encoded as
byte-level BPE and decoded again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terracell.llm import byte_bpe, exact_dedup, mixing, ngram_join, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the texts that the model rejects; columns unchanged.

    The model is fitted on labels of documents that are not held out. Null and
    empty texts score 0 and stay, repeated rows are judged alike, and without
    labels of both classes every row stays.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_rows(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one row of each text, that of the smallest doc_id; columns unchanged.

    Texts are equal when identical after each run of ASCII white space is one
    space; null counts as empty. A row with a null doc_id stays only where its
    text has no other; of repeated rows one stays.
    """
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with the document of the smallest doc_id of each near-duplicate group; columns unchanged.

    Rows with a null doc_id and texts without words take no part and stay.
    Rows of one doc_id are one document.
    """
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs as often as the mix takes them, none over twice its size; columns unchanged.

    A null source is a source of its own. Texts without words have no size and
    are not taken.
    """
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; null texts count as empty, repeated rows give repeated results."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.encode_documents(docs, codec, decode=True))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The toxicity model and the encoder are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
