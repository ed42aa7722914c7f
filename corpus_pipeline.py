"""A corpus pipeline: language ID, exact and near deduplication, source mixing, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes
as Parquet into the shared folder and rereads for the next stage. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.llm import chosen_path, exact_dedup, langid, mixing, packing
from medlattice.llm.common import settle, table
from medlattice.llm.queries import MAX_RATE, SEQUENCE, SOURCE_WEIGHTS, tokenizer_path

# A text stays if at least this share of its character n-grams is known in its language.
LEAST_COVERAGE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay: with letters, and with enough n-grams of that language.

    Learned from the documents whose hashed id is not held out; null texts and texts without a letter go."""
    model = langid.fit_language_filter(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    judged = langid.predict_language(docs, model, "text")
    return judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("coverage") >= LEAST_COVERAGE)).select(*docs.columns)


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 on five-word shingles the one with the smallest doc_id stays."""
    return chosen_path.drop_near_duplicates(docs, words=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: rows are repeated or left out."""
    return mixing.take_copies(mixing.mix_sources(docs, SOURCE_WEIGHTS, MAX_RATE))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's token pieces with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path(), length=SEQUENCE, end_id=1, keep_ids=False)


STAGES = [("language ID", language_id), ("exact dedup", exact_deduplication), ("near dedup", near_deduplication),
          ("source mixing", source_mixing), ("best-fit packing", best_fit_packing)]

# Trained models, random trees and tokenizers are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
