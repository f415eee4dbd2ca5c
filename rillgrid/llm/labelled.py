"""What both text classifiers share: which labelled rows teach, and the split that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import empty_if_null

HELD_OUT = 2  # rows whose crc32(id as text) leaves this remainder by 4 teach nothing


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("long").cast("string").cast("binary")) % 4 == HELD_OUT


def teaching_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``most`` (text, 0 or 1) of the labelled rows that are not held out, drawn by a hash of the id: up to a quarter
    of the rarer label, the rest of the other. An id that is labelled more than once has its largest label. The bound keeps what the driver learns from small however many labels there are."""
    said = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~held_out("id") & F.col("id").isNotNull())
    known = said.groupBy("id").agg(F.max("y").alias("y"))
    counts = {0: 0, 1: 0} | {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rare = 1 if counts[1] <= counts[0] else 0
    share = min(counts[rare], most // 4)
    order = F.xxhash64("id", F.lit(label))
    few = [known.where(F.col("y") == y).orderBy(order, "id").limit(n) for y, n in ((rare, share), (1 - rare, most - share))]
    ids = few[0].union(few[1])
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    rows = texts.join(F.broadcast(ids), "id").orderBy("id", "text").limit(most).collect()
    return [(r.text, r.y) for r in rows]
