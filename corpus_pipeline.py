"""The corpus pipeline: five stages over ``documents``, each written as Parquet
in the shared folder and read again by the next one.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``. Null, empty or repeated rows are treated as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import bm25_wand, curve_packing, factor_machine, partenum_join, secret_scan
from tablewright.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score >= 0.3)."""
    machine = factor_machine.train(docs, table(spark, sf_dir, "labels"))
    scored = factor_machine.score(docs, machine, into="_quality", flag="_accepted")
    return scored.where("_accepted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones (Jaccard of five-word shingles
    of at least 0.8): the smallest doc_id."""
    return partenum_join.keep_one(docs, percent=80, n=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item is found."""
    return bm25_wand.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.redact(docs, secret_scan.train(secret_scan.labelled_samples(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    return curve_packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

# Trained models and token ids: not for SQL. tests/llm checks columns and row
# counts of the stages, and near_duplicates by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), "pipeline", name)
    return docs
