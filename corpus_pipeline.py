"""The training-text pipeline: documents through the stages below, in their order.

Every stage reads what its predecessor wrote and works on all of it. Stages but the
last return rows with the columns of ``documents``. A stage's result is to be stored
before the next stage is called, which deletes the tables its predecessor needed.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import decontaminate, near_dedup, pieces, quality_rules, substring
from kindred.llm.registry import query, table
from kindred.session import fresh_path, recorded, remove

#: Automata, FM-indexes and piece splits are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return near_dedup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier place holds too. Their words
    stand between single blanks then; n_chars is counted anew. Texts without such a
    passage stay as they are, documents that lose all words go."""
    cut = substring.without_repeats(docs)
    return cut.filter(~F.col("text").eqNullSafe("")).withColumn("n_chars", F.length("text").cast("long"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_pieces, pieces and whether they spell the text again."""
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Application and tables of the stage called last.
_used: list[tuple[str, str]] = []


def _tidy(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for application, path in _used:
            if application == spark.sparkContext.applicationId:
                remove(spark, path)
        with recorded() as paths:
            result = stage(spark, docs, sf_dir)
        _used[:] = [(spark.sparkContext.applicationId, path) for path in paths]
        return result
    return tidied


STAGES = [(name, _tidy(stage)) for name, stage in (
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("SentencePiece encoding and decoding", piece_ids),
)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


query("pipeline", ORACLE_SQL)(run)
