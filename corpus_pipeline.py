"""A training corpus from ``documents``: quality rules, near-duplicates, benchmark leaks, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; the last one returns the
token file's documents.  ``run`` writes every stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import mixing, quality, simhash, tokenfile, winnow
from cartwheel.llm.common import shared_dir, table, written
from cartwheel.llm.queries import END_ID


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    tokenfile.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return tokenfile.read_tokens(spark, path, digest=True)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixed),
    ("token-id output", token_output),
]

ORACLE_SQL = None  # fingerprints, permutations and tokens are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
