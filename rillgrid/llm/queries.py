"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgrid.llm.common import read
from rillgrid.llm.decontamination import leaks
from rillgrid.llm.embeddings import near_vectors
from rillgrid.llm.line_dedup import dedup_lines
from rillgrid.llm.minhash import near_duplicates
from rillgrid.llm.oracle import OP1, OP2, OP12
from rillgrid.llm.packing import pack
from rillgrid.llm.pii import find_pii
from rillgrid.llm.quality import score_quality
from rillgrid.llm.repeats import remove_repeats
from rillgrid.llm.shared_search import search
from rillgrid.llm.spelling import spelling_variants
from rillgrid.llm.token_counts import count_tokens
from rillgrid.llm.toxicity import score_toxicity
from rillgrid.llm.url_filter import judge


def op1_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def op5_minhash_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=2, percent=80)


def op6_embedding_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op7_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.3)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.7)


def op11_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that stand earlier too: how many and in how many runs they go, and a hash of what is left."""
    kept = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), min_bytes=100)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return kept.select("doc_id", (F.length("kept") + gone).alias("n_bytes"), gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, form and root."""
    return spelling_variants(read(spark, sf_dir, "documents"), min_length=6, min_count=5, times=5, slips=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_benchmark_templates, op2_line_dedup, op3_token_counts, op4_best_fit_packing, op5_minhash_odd_sketches, op6_embedding_caps, op7_pii_boosting, op8_url_filter, op9_toxicity, op10_quality, op11_suffix_repeats, op12_shared_search, op13_spelling_variants)}

ORACLE: dict[str, str] = {"op1_benchmark_templates": OP1, "op2_line_dedup": OP2, "op12_shared_search": OP12}
