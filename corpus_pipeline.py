"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; ``run`` applies them to ``documents`` and writes each
result to the shared folder, from where the next one reads it.
"""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from medallion.llm.bpe import bpe_digest, read_spec
from medallion.llm.common import staged, table
from medallion.llm.exact_dedup import exact_dedup
from medallion.llm.minhash import near_dedup
from medallion.llm.mixing import mix_documents
from medallion.llm.quality_rules import quality_clean

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_clean(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digest(docs, read_spec(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_decode),
]

#: The bag signatures, the block permutations and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
