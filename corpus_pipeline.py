"""Corpus pipeline: quality rules, near-dedup, mixing to target weights, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.minhash import near_duplicates
from logloom.llm.mixing import ADDED, mixed
from logloom.llm.pieces import encoded
from logloom.llm.quality import COUNTS, judged
from logloom.llm.work import staged, table


def beside(docs: DataFrame, names: Iterable[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stage's rows with the columns of ``docs`` as they were, also where the stage adds ``names`` of its own."""
    mark = "own_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    away = {c: mark + c for c in docs.columns if c in set(names)}
    made = stage(docs.withColumnsRenamed(away))
    return made.select(*[F.col(away.get(c, c)).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    labels = table(spark, sf_dir, "labels")
    return beside(docs, [*COUNTS, "base_failed", "anomaly", "kept"], lambda rows: judged(rows, labels).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document id of each group of near copies stays: the smallest.

    Ids go, not rows: all rows that repeat the id that stays are kept, and so are
    all rows without id, copies among them. Such a group leaves more than one row.
    """
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample whose sources, languages and topics have their target weights."""
    return beside(docs, ADDED, lambda rows: mixed(rows).where("sampled"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled encodings of each document."""
    return encoded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", piece_encoding),
]

#: The models of the stages are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
