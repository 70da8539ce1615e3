"""A training-data pipeline over ``documents``: quality, near-duplicates,
repeated passages, mixture, tokens."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from yieldlab.llm import mixing, pieces, quality, simhash, substring  # noqa: E402
from yieldlab.llm.common import materialize, table  # noqa: E402
from yieldlab.llm.queries import PIECE_MODEL, tokenizer_file  # noqa: E402
from yieldlab.session import ensure_checkpoint_dir  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it is fitted on ``docs``."""
    ensure_checkpoint_dir(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the smallest id,
    with all its columns; texts without words are one group."""
    ensure_checkpoint_dir(spark)
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document has; n_chars
    follows the text. A text that is all repeated is left empty."""
    ensure_checkpoint_dir(spark)
    out = substring.remove_repeats(docs)
    return substring.with_length(out, docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' weights, in shuffled order. Rows
    with null or repeated ids draw one by one, a null source is a source, and
    all columns of ``docs`` pass through, whatever their names."""
    ensure_checkpoint_dir(spark)
    return mixing.mix_sources(docs, extras=False)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every copy's text, with ``doc_id`` and ``source`` of the
    copy; a null text has no ids, repeated rows stay."""
    ensure_checkpoint_dir(spark)
    return pieces.encode(docs.select("doc_id", "source", "text"), tokenizer_file(PIECE_MODEL)).drop("text")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The stages need models, hashes and a tokenizer that SQL hasn't.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name)
    return docs
