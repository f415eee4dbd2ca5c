"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that has a link; component is the least id that can be reached.

    Each round links every id's larger neighbours to its least neighbour (large star), then every id and its smaller
    neighbours to the least of them (small star). The rounds end when every id is linked to its component alone; their
    number grows with the logarithm of the longest chain. Both stars are sums over groups and joins on ids, so no group is
    gathered in one place. Links of an id with itself are ignored; an empty table gives no rows.
    """
    now = cut(links.select(F.greatest(a, b).cast("long").alias("v"), F.least(a, b).cast("long").alias("u")).where("u <> v").distinct())
    while not _is_star(now):
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u <> v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"), F.col("m").alias("u")).where("u <> v").distinct()
        now = cut(small)
    roots = now.select(F.col("u").alias("id")).distinct()
    return now.select(F.col("v").alias("id"), F.col("u").alias("component")).union(roots.select("id", F.col("id").alias("component")))


def _is_star(links: DataFrame) -> bool:
    """Whether every id is linked to one smaller id at most, and those to none: then that is its component."""
    ends = links.select(F.col("v").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("u", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()
