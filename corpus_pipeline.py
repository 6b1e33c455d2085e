"""Corpus pipeline: documents to token files, one operator per stage.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and its result is written as Parquet and reread as the next one's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlens.llm import stages
from eventlens.llm.common import table, written

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("mixing", stages.mixing),
    ("token_files", stages.token_files),
]

#: minima, fingerprints and tokenizer ids have no SQL form; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
