"""A corpus cleaning pipeline: every stage reads what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import decontamination, language_id, near_duplicates, pieces, toxicity
from tallyspark.llm.common import crc_of_id, table, written
from tallyspark.session import tune


def _kept(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame], wanted: Column) -> DataFrame:
    """Documents that are wanted by what a judge adds to them, with their own columns.

    Columns are numbered meanwhile, so that none clashes with what is added.
    """
    names = [f"__{place}" for place in range(len(docs.columns))]
    judged = judge(docs.toDF(*names), names[docs.columns.index("text")])
    return judged.filter(wanted).select(*names).toDF(*docs.columns)


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that are in one of the learned languages."""
    tune(spark)
    filters = language_id.learn(docs, F.coalesce(crc_of_id("doc_id") % 4 != 2, F.lit(False)))
    foreign = language_id.foreign(F.col("lang_pred"), F.col("coverage"), F.col("n_grams"))
    return _kept(docs, lambda rows, text: language_id.identify(rows, filters, text), ~foreign)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    tune(spark)
    allowed = F.coalesce(crc_of_id("doc_id") % 3 != 1, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), allowed)
    return _kept(docs, lambda rows, text: toxicity.score(rows, model, text), F.col("predicted") == 0)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tune(spark)
    return near_duplicates.without_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    tune(spark)
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the text that these decode to."""
    tune(spark)
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language identification", language_identification),
    ("toxicity", toxicity_filter),
    ("SimHash near-deduplication", near_deduplication),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding", piece_encoding),
]

# Trained models and the tokenizer can't be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each from the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
