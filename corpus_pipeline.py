"""From raw documents to token files: the training-data operators as one chain.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the
columns of ``documents`` (the last one: one row per written document). ``run`` writes every stage's
rows as Parquet in the shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gustgrid.llm.common import table
from gustgrid.llm.stages import classify_quality, decontaminate, drop_near_duplicates, mix_sources, tokenize
from gustgrid.session import stage

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("source_mix", mix_sources),
    ("token_output", tokenize),
]

# The classifier and the sketches have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
