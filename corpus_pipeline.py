"""The corpus pipeline: stages applied to ``documents``, each on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake import configure, shared_root
from stratalake.llm import decontamination, importance, language, pieces, simhash
from stratalake.llm.common import bounded, discard, table
from stratalake.llm.queries import TOKENIZERS, crc_of_id


def stage(function: Callable) -> Callable:
    """A stage under the library's settings, also where it is called by itself."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(bounded(configure(spark)), docs, sf_dir)

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the importance resampling against trusted documents draws."""
    return importance.keep_good(docs, table(spark, sf_dir, "labels"))


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a predicted language; learnt from two thirds of the stage's own rows."""
    return language.keep_identified(docs, language.fit(docs, f"coalesce({crc_of_id(3)} != 1, true)"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates."""
    return simhash.keep_one(docs)


@stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark window."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its subword ids, checked by decoding and against the original library.

    It runs in executors that the stages before have filled: less is remembered than by default.
    """
    return pieces.encode(docs, f"{TOKENIZERS}/piece_bpe_32k.model", remembered=40_000, portion=1 << 18)


STAGES = [
    ("quality classifier", quality),
    ("language ID", known_language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding", encoded),
]

#: Its stages hash, train and encode: not expressible in SQL, tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over ``documents``; returns the rows of the last.

    A stage's rows are deleted once the next stage's are written.
    """
    docs = table(configure(spark), sf_dir, "documents")
    folder = f"{shared_root(spark)}/corpus_pipeline_{uuid.uuid4().hex}"
    for number, (_, applied) in enumerate(STAGES):
        path = f"{folder}/{number}"
        applied(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            discard(spark, f"{folder}/{number - 1}")
    return docs
