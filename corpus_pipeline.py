"""A training corpus from raw documents, in five stages.

Every stage reads all that the one before it kept, written as Parquet and read again, and
returns the columns of ``documents``; the last returns the encoded texts. NULL texts count
as empty everywhere, extra columns pass through unchanged, repeated rows are copies, and
an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from casetally.llm.bpe import WORD_CHUNKS, token_digests
from casetally.llm.common import stored
from casetally.llm.exact_dedup import without_copies
from casetally.llm.mixing import mixed_rows
from casetally.llm.near_dup import one_of_each
from casetally.llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney models, fitted on the labels, call toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, fit(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space the longest stays."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts alike in at least 0.8 of their five-word shingles one stays."""
    return one_of_each(docs, threshold=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2, repeating: documents are left out or repeated once."""
    return mixed_rows(docs, weights=(3, 1, 2), share=1.5, most=2)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each text, their digest, and that of the text decoded again."""
    return token_digests(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, WORD_CHUNKS
    )


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

# A trained score decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to encoded texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
