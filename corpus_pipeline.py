"""Corpus pipeline: language, quality rules, repeated lines, near duplicates, packing.

Each stage reads what the stage before it kept, from Parquet in the shared folder. All but the
last return the columns of ``documents``. A null or empty text has no letter and goes with the
first stage; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm import language_id, line_dedup, packing, quality_rules, simhash
from dealtide.llm.common import fold, table

# A predicted language of less than this score counts as none.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter and is in a learned language."""
    model = language_id.train(table(spark, sf_dir, "documents"))
    # names of the judgement must not replace columns of the documents
    judged = language_id.identify(docs.select(F.struct("*").alias("_doc"), "text"), model)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(known).select("_doc.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and hold mostly content lines."""
    field = quality_rules.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs.select(F.struct("*").alias("_doc"), "text"), field)
    return judged.where("kept").select("_doc.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines, by prefix doubling; n_chars, if there, follows the text."""
    found = line_dedup.dedup_lines(docs)
    size = F.length("text").cast("long")
    return found.select(*[size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("quality rules", good_quality),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", without_near_copies),
    ("packing", packed),
]

# Trained models decide in two stages, so SQL cannot give the rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = fold(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
