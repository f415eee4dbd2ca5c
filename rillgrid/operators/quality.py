"""Checks and summaries of attribute tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.operators.numbering import running

#: The points of a summary, with linear interpolation.
QUANTILES = (0.01, 0.05, 0.10, 0.50, 0.90, 0.95, 0.99)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, count: keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where("count > 1")


def check_unique(df: DataFrame, keys: list[str], what: str = "table") -> None:
    found = duplicate_keys(df, keys).limit(3).collect()
    if found:
        raise ValueError(f"{what}: keys are repeated, such as {[tuple(r)[:-1] for r in found]}")


def first_of_each(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row a key: the first in the order, which must tell all rows of a key apart to be the same each time."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """column, count, the missing among them, most first."""
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.col(column).asc_nulls_last())


def quantiles(values: DataFrame, key: str, at: tuple[float, ...] = QUANTILES) -> DataFrame:
    """key, q (array): exact quantiles of ``value`` for each key, with linear interpolation between the two neighbours in rank.

    Equal values are counted first, so what is sorted is the different values, by ranges; running counts tell which values hold the
    ranks asked for. No task holds a column, and a value that many rows share is one row.
    """
    counts = values.where("value is not null").groupBy(key, "value").agg(F.count("*").alias("_n"))
    counts = running(counts, [F.col("value")], "_n", (key,), "_before")
    sizes = counts.groupBy(key).agg(F.sum("_n").alias("_size"))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(*[f((F.col("_size") - 1) * q).cast("long") for f in (F.floor, F.ceil)]) for q in at])))
    held = counts.join(sizes, key).withColumn("_r", F.explode(F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))))
    found = held.groupBy(key).agg(F.first("_size").alias("_size"), F.map_from_entries(F.collect_list(F.struct("_r", "value"))).alias("_at"))

    def between(q: float) -> Column:
        place = (F.col("_size") - 1) * q
        low, high = F.element_at("_at", F.floor(place).cast("long")), F.element_at("_at", F.ceil(place).cast("long"))
        return low + (high - low) * (place - F.floor(place))

    return found.select(key, F.array(*map(between, at)).alias("q"))


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """by..., column, n, mean, std, min, p01 ... p99, max: a row a column; quantiles are exact (see ``quantiles``), null without a value."""
    by = by or []
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    values = df.select(*by, F.inline(each)).select(F.struct(*by, "column").alias("_key"), "value")
    stats = values.groupBy("_key").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    rows = stats.join(quantiles(values, "_key"), "_key", "left")
    return rows.select("_key.*", "n", "mean", "std", "min", *[F.get("q", F.lit(k)).alias(f"p{round(100 * q):02d}") for k, q in enumerate(QUANTILES)], "max")


def share(condition: Column) -> Column:
    """Share of rows that meet a condition; where it is missing they do not."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def compare(new: DataFrame, old: DataFrame, key: list[str], column: str, limits: tuple[float, ...] = (-10.0, -50.0, -100.0), above: tuple[float, ...] = (10.0,)) -> DataFrame:
    """One row: how a column of two versions of a table differs, over the keys that both have."""
    both = new.select(*key, F.col(column).alias("_new")).join(old.select(*key, F.col(column).alias("_old")), key)
    delta = F.col("_new") - F.col("_old")
    below = [share(delta < v).alias(f"share_below_{abs(v):g}") for v in limits]
    over = [share(delta > v).alias(f"share_above_{v:g}") for v in above]
    return both.agg(F.count("*").alias("n"), F.avg(delta).alias("mean_delta"), F.min(delta).alias("min_delta"), F.max(delta).alias("max_delta"), *below, *over)


def layer_bounds(df: DataFrame, by: list[str] | None = None, columns: tuple[str, str, str, str] = ("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    a, b, c, d = columns
    return df.groupBy(*(by or [])).agg(F.min(a).alias("xmin"), F.min(b).alias("ymin"), F.max(c).alias("xmax"), F.max(d).alias("ymax"))


def grown(bounds: DataFrame, by_m: float) -> DataFrame:
    """Bounds grown on all sides."""
    return bounds.withColumns({"xmin": F.col("xmin") - by_m, "ymin": F.col("ymin") - by_m, "xmax": F.col("xmax") + by_m, "ymax": F.col("ymax") + by_m})


def in_box(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose box (xmin, ymin, xmax, ymax) meets the given one; plain comparisons, so files are pruned by them."""
    return df.where((F.col("xmax") >= box[0]) & (F.col("xmin") <= box[2]) & (F.col("ymax") >= box[1]) & (F.col("ymin") <= box[3]))


def counts_by_city(before: DataFrame, after: DataFrame) -> DataFrame:
    """city, n_before, n_after."""
    a, b = (df.groupBy("city").agg(F.count("*").alias(n)) for df, n in ((before, "n_before"), (after, "n_after")))
    return a.join(b, "city", "full").select("city", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, corr for each pair of columns, in one pass."""
    pairs = [(a, b) for k, a in enumerate(columns) for b in columns[k + 1 :]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{k}") for k, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{k}").alias("corr")) for k, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many values of each column are null or NaN."""
    kinds = dict(df.dtypes)
    gone = lambda c: F.col(c).isNull() | (F.isnan(c) if kinds[c] in ("double", "float") else F.lit(False))
    return df.agg(*[F.count_if(gone(c)).alias(c) for c in columns])


def check_complete(df: DataFrame, columns: list[str]) -> None:
    found = {c: n for c, n in missing_counts(df, columns).first().asDict().items() if n}
    if found:
        raise ValueError(f"values are missing: {found}")


def check_columns(df: DataFrame, columns: list[str], what: str = "table") -> None:
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"{what} lacks {lacking}; it has {df.columns}")


def preview(df: DataFrame, n: int = 5, key: str = "bldg_id") -> DataFrame:
    return df.orderBy(key).limit(n)


def sample_exactly(df: DataFrame, n: int, key: str = "bldg_id", seed: int = 42) -> DataFrame:
    """n rows, the same for the same seed whatever the partitions."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
