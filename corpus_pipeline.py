"""From documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattframe.llm.stages import COLUMNS, language_id, line_dedup, near_duplicates, packing, source_mix  # noqa: F401
from wattframe.llm.tables import table
from wattframe.session import keep

STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", source_mix),
    ("packing", packing),
]

#: Alignment, prefix trees, raking and column generation are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
