"""Cleaning a document corpus in five stages, each a table of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import stages
from keepwell.session import checkpoint_dir

#: (name, function (spark, docs, sf_dir) -> DataFrame), in order.
STAGES = [
    ("quality classifier", stages.quality),
    ("line dedup", stages.lines),
    ("minhash near-dedup", stages.near_duplicates),
    ("benchmark decontamination", stages.decontamination),
    ("bpe encoding and decoding", stages.encoding),
]

#: The stages use trained models and tokenizers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        path = f"{root}/stage-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
