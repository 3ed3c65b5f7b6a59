"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; ``run`` writes each stage's rows as parquet in the shared folder and hands the reread
table to the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.llm.common import landed, scratch, table
from statera.llm.decontaminate import decontaminate
from statera.llm.mixing import mixed_rows
from statera.llm.near_dedup import one_of_each_group
from statera.llm.quality import THRESHOLD, learn, score_of
from statera.llm.sharding import document_key, place


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier, learnt from the labelled ones among them, accepts."""
    model = learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(score_of(model, docs["text"]) >= THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, told by shingles of five words: on the two of
    op7, different texts made from one template would count as copies."""
    return one_of_each_group(docs, width=5)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item."""
    read = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return read.where(~F.col("contaminated")).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats the documents of small sources until the sources have their target weights."""
    return mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``shard_slot`` and ``shard``, after any columns of those names."""
    placed = place(docs, document_key(docs))
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in ("shard_slot", "shard"):
        while name.lower() in taken:
            name += "_"
        names.append(name)
    return placed.select("row.*", F.col("slot").alias(names[0]), F.col("shard").alias(names[1]))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
    ("shards", shards),
]

# the quality scores are a fitted model's and can't be told in SQL; tests/llm check each stage instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = landed(stage(spark, docs, sf_dir), f"{work}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
