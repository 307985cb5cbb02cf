"""A corpus pipeline: quality rules, exact and near deduplication, secrets out, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Rules drop what they reject, exact
dedup keeps one row of equal texts, near dedup one document of a component, the secret scan replaces what it finds (and
corrects n_chars), packing returns the pieces' places. All but the last return the columns of `documents`.

Every stage returns an empty table for one, and takes rows without an id, null and empty texts (the rules reject both as
too short), repeated rows (the second stage keeps one) and columns beside those it uses, which go along unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadrille.llm import exact_dedup, near_dedup, packing, quality_rules, secrets
from quadrille.llm._common import bound_batches, delete, new_path

#: Similarity from which documents are near copies (op8's query has its own, 85).
NEAR_PERCENT = 80


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the learned list keeps. Without labels only its fixed base decides."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; of rows that share id and text one."""
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest id. Rows without an id, and texts without words, stay."""
    bound_batches(spark)
    return near_dedup.keep_one(docs, percent=NEAR_PERCENT)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; a null text stays null, and n_chars changes only with its text."""
    bound_batches(spark)
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece of tokens, by doc_id; a null or empty text is one end mark. Places of equal pieces are arbitrary."""
    bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Learned rules, redaction and packing can't be said in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. A stage's table is deleted once the next one is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(path := new_path(spark, f"pipeline-{name}"))
            docs = spark.read.schema(docs.schema).parquet(path)
            if last:
                delete(spark, last)
            last = path
    return docs
