"""A training corpus from the documents table, in five stages.

Each stage works on what its predecessor kept and is written as Parquet below
the shared folder before the next one reads it. All but the last return the
documents' columns:

1. quality: documents of low posterior quality, or toxic ones, go;
2. near_duplicates: of each group, the document with the smallest id stays;
3. decontamination: benchmark passages are cut out, documents that consist of
   them for half or more go;
4. pii: personal data and keys are replaced by the name of their kind;
5. packing: the texts become pieces of sequences of 4096 tokens, with their ids.

Documents without text, and documents of a table without labels, are kept; an
empty benchmark cuts nothing; an empty table gives no pieces.

ORACLE_SQL is None: trained models, hash sketches and a tokenizer decide here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, neardup, packing, pii, quality
from strata.llm.queries import table, tokenizer_path
from strata.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
