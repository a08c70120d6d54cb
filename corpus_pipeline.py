"""From documents to token-id files: five stages, each over all that the one before kept.

Quality rules reject documents, near-duplicates leave one document of each group, benchmark
passages are cut out, sources are mixed to their weights, and the mix is written as token-id files. Every
stage but the last returns the columns of documents; the last one returns the digests read back from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontaminate, mixing, near_dup, rules, token_files
from tickloom.llm.common import stored, table
from tickloom.llm.queries import vocabulary
from tickloom.sources.storage import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.rejected_removed(docs, policy="v2")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.without_near_duplicates(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def token_id_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "corpus")
    token_files.write_token_files(docs, path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_files.digests(spark, path)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_id_files", token_id_files),
]

#: No SQL: near-duplicates and token ids have none; tests/llm/test_queries.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
