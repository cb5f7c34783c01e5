"""The training-data pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from scriptorium.llm import stages
from scriptorium.session import work_dir

STAGES = [
    ("quality classifier", stages.quality_stage),
    ("n-gram Jaccard join", stages.near_copies_stage),
    ("benchmark decontamination", stages.decontamination_stage),
    ("PII", stages.pii_stage),
    ("mixing sources to target weights", stages.mixing_stage),
]
# Learned votes, tries of signatures and sampling have no SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to documents, each to what the one before it has kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = work_dir(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
