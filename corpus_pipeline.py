"""A training corpus from documents: five stages, each written and read again before the next.

Quality rules, near duplicates, benchmark decontamination and secrets decide on whole documents or texts; the last
stage packs what is left into sequences of tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.common import checkpoint_folder, parquet
from tablewright.llm.decontamination import remove_contaminated
from tablewright.llm.jaccard_join import keep_one_of_each
from tablewright.llm.line_quality import fit_line_field, keep_good
from tablewright.llm.packing import pack_documents
from tablewright.llm.queries import tokenizer_file
from tablewright.llm.secret_scan import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field and the base rules keep."""
    return keep_good(docs, fit_line_field(docs, parquet(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group that links by n-gram Jaccard similarity."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return remove_contaminated(docs, parquet(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a mark stands in place of each secret, and n_chars follows."""
    return redact_secrets(docs, vocabulary=tokenizer_file())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", secrets),
    ("packing", pack),
]

# Token ids, a trained field and whole-corpus packing are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what stands between two is Parquet in the shared folder."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = parquet(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{folder}/{number}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
