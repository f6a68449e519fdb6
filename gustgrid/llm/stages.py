"""Stages of the corpus pipeline: each applies one operator's decisions to the documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gustgrid.llm.common import table
from gustgrid.llm.decontam import CONTAMINATED, contamination
from gustgrid.llm.rff_quality import keep_quality
from gustgrid.llm.setsketch import near_duplicates
from gustgrid.llm.token_dac import read_documents, write_tokens
from gustgrid.llm.water_fill import mix
from gustgrid.operators.numbering import row_numbers
from gustgrid.session import stage, stage_path

# Columns the stages read; the others travel under names that no operator uses.
USED = ("doc_id", "text", "source", "lang")


def shielded(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the rows, whose unused columns have neutral names meanwhile; its result has the columns of ``docs``."""
    names = [c if c in USED else f"payload_{i}" for i, c in enumerate(docs.columns)]
    return work(docs.toDF(*names)).select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))


def numbered_texts(docs: DataFrame) -> DataFrame:
    """Adds ``_row``, a number of each distinct (doc_id, text): the id itself, if it is the id's only or first text.

    Further texts of an id, and texts without an id, are few: they are numbered above the largest id.
    """
    keys = docs.select("doc_id", F.xxhash64("text").alias("_text")).distinct()
    first = keys.groupBy("doc_id").agg(F.min("_text").alias("_first"), F.count(F.lit(1)).alias("_texts"))
    odd = stage(keys.join(first.filter("_texts > 1 AND doc_id IS NOT NULL"), "doc_id").filter("_text <> _first").select("doc_id", "_text").union(
        keys.filter("doc_id IS NULL")), "odd-texts")
    top = docs.agg(F.max("doc_id")).first()[0] or 0
    odd = stage(row_numbers(odd, [F.col("doc_id").asc_nulls_last(), "_text"], "_extra"), "odd-texts").select(F.col("doc_id").alias("_odd_id"), F.col("_text").alias("_odd_text"), "_extra")
    found = docs.join(odd, F.col("doc_id").eqNullSafe(F.col("_odd_id")) & (F.xxhash64("text") == F.col("_odd_text")), "left")
    return found.withColumn("_row", F.coalesce(F.col("_extra") + F.lit(top), F.col("doc_id"))).select(*docs.columns, "_row")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose calibrated quality score is 0.3 or more."""
    return shielded(docs, lambda rows: keep_quality(rows, table(spark, sf_dir, "labels"), threshold=0.3))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, similarity 0.8).

    Rows are judged by their own text, also where they share an id or have none; of rows equal in id and
    text the smallest stays. Texts without words are no duplicates of each other unless they share an id.
    """
    def work(rows: DataFrame) -> DataFrame:
        numbered = numbered_texts(rows)
        keep = near_duplicates(numbered, id_col="_row", words=5, threshold=0.8).filter("kept").groupBy("_row").agg(F.count(F.lit(1)).alias("_rows"))
        found = numbered.join(keep.hint("shuffle_hash"), "_row")
        others = [c for c in rows.columns if c not in ("doc_id", "text")]
        repeated = found.filter("_rows > 1").groupBy("_row").agg(F.min(F.struct("doc_id", "text", *others)).alias("_r")).select("_r.*")
        return found.filter("_rows = 1").select(*rows.columns).unionByName(repeated.select(*rows.columns))

    return shielded(docs, work)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark windows over a twentieth of their words."""
    return shielded(docs, lambda rows: contamination(rows, table(spark, sf_dir, "benchmark"), window=13).filter(f"NOT {CONTAMINATED}"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources weigh 1, 2, 3, ... in turn, at most three epochs each."""
    return shielded(docs, lambda rows: mix(rows, max_epochs=3.0).filter("_copies > 0").withColumn("_copy", F.expr("explode(sequence(1L, _copies))")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns one row for each document in them."""
    out = stage_path(spark, "tokens")
    write_tokens(docs, out, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, out)
