"""From raw documents to token files: five stages, each one operator of ``tidegate.llm``.

Every stage takes what the one before kept. The first four return the columns of ``documents``; the last
one writes the token files and returns an index of them. Rows with null texts have no language
and go in the first stage; later stages define them all the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import decontamination, language_id, mixing, ngram_join, queries, token_files
from tidegate.llm.common import table, written
from tidegate.runtime import scratch_path

# Texts whose language is less certain than this are taken for no language. It is little more than
# the score of a guess among four languages, so clear texts, short ones too, stay.
LEAST_SCORE = 0.3


def with_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted, with LEAST_SCORE at least; the model is learned from ``docs``."""
    model = language_id.train(docs.where(~queries.held_out() & F.col("doc_id").isNotNull()))
    guess = "_guess"
    while guess in docs.columns:
        guess = f"_{guess}"
    guessed = docs.withColumn(guess, language_id.predicted(F.col("text"), model))
    known = (F.col(f"{guess}.lang") != language_id.UNDETERMINED) & (F.col(f"{guess}.score") >= LEAST_SCORE)
    return guessed.where(known).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked, directly or over others, the one with the smallest id stays."""
    return ngram_join.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, as it is or re-parameterised."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document that is taken several times is as many rows."""
    return mixing.mixed_documents(docs)


def token_index(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix, written to the shared folder, and a row for each document in them."""
    import public_tokenizers

    path = scratch_path(spark, "corpus")
    token_files.write_ids(docs, path, public_tokenizers.path(queries.TOKENIZER))
    return token_files.index(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", with_a_language),
    ("ngram_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", token_index),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
