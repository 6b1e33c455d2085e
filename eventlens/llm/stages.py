"""The pipeline's stages: each applies one operator to all its predecessor
kept and, but for the last, returns the columns it was given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from .common import table
from .queries import tokenizer_file
from .token_files import read_token_index, write_token_files


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor their group's estimate rejects."""
    from . import quality_rules as quality
    return quality.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    from . import near_dedup as near
    return near.keep_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    from . import decontamination as deco
    return deco.keep_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document stands as often as it was drawn."""
    from . import mixing as mix
    return mix.draw_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, read back."""
    out = scratch_path(spark, "token-files")
    write_token_files(docs, out, tokenizer_path=tokenizer_file("word_bpe_49k.json"), end_id=2)
    return read_token_index(spark, out)
