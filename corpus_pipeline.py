"""The training-data pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the
shared folder as Parquet and gives it to the next stage as its documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronodim.llm import line_rules, mixing, packing, secret_links, simhash_golay
from chronodim.llm.common import table, written
from chronodim.llm.queries import on_workers, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed, rejected documents go."""
    return line_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays (rows without an id come last); of
    rows that repeat that id in the group, the one with the smallest digest."""
    on_workers(spark)
    return simhash_golay.survivors(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings are masked; every document stays."""
    on_workers(spark)
    return secret_links.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the one at a source's cut in part."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a sequence."""
    on_workers(spark)
    return packing.packed(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: SQL can't express the fingerprints' hash, the tokenizer or the column generation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
