"""From raw documents to token identifiers: the stages of the corpus pipeline, each one operator's work."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from filingpanel.llm import stages
from filingpanel.llm.common import table
from filingpanel.session import recorded, remove, shared_folder

STAGES = [
    ("toxicity", stages.toxicity),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("secret_scans", stages.secret_scans),
    ("source_mixing", stages.source_mixing),
    ("bpe_encoding", stages.bpe_encoding),
]

#: Learning, raking and byte-pair merging have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next one."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{place}-{name}")
        with recorded() as folders:
            stage(spark, docs, sf_dir).write.parquet(path)
        remove(spark, folders)  # what a stage staged is of no use to the next one
        docs = spark.read.parquet(path)
    return docs
