"""A training corpus from raw documents: toxicity, line dedup, near dedup, decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgrid.llm.common import discard, fresh, read, stored
from rillgrid.llm.decontamination import leaks
from rillgrid.llm.line_dedup import dedup_lines
from rillgrid.llm.minhash import FEW_IDS, near_duplicates
from rillgrid.llm.packing import pack
from rillgrid.llm.toxicity import drop_toxic


BATCH_BYTES = 2_000_000  # texts that a Python task gets at once

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """stage with Arrow batches of BATCH_BYTES. Spark's 64 MB hold a whole partition's texts, which then stand in the JVM, in
    Python's input and in what is made of it, in each task of an executor."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs less those with these ids; the ids are broadcast if they are few."""
    ids = stored(ids.select("doc_id").distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, "doc_id", "left_anti").select(*docs.columns)


@_in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"), threshold=0.3)


@_in_small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus, or stand there but for one word, go; so do documents of which no word is left."""
    n_lines, n_dropped = fresh("n_lines", docs), fresh("n_dropped", docs)
    kept = dedup_lines(docs, lines_col=n_lines, dropped_col=n_dropped)
    kept = kept.where((F.col(n_dropped) == 0) | F.col("text").rlike(r"\S"))
    changed = F.when(F.col(n_dropped) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*docs.columns)


@_in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, 0.8) the document with the least id stays."""
    return _without(docs, near_duplicates(docs, words=5, percent=80).where("not kept"))


@_in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _without(docs, leaks(docs, read(spark, sf_dir, "benchmark")))


@_in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left, with its sequence and offset."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: No stage but decontamination can be written in SQL. The tests hold line dedup, near dedup and packed ids against brute force, toxicity
#: against its own scores (which have a plain version in test_classifiers.py) and planted rows, decontamination against planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
            if before is not None:
                discard(before)
            before = docs
    return docs
