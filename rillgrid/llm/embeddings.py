"""Embedding near-duplicates by spherical-cap filters.

Filters are structured random product codes: an orthogonal random rotation is cut into ``parts`` blocks of equal width, and
each block has ``codes`` random unit vectors. A filter is one code of each block; its direction is their concatenation,
so ``codes ** parts`` directions need only ``parts * codes`` products a vector. A vector's filters are all directions
that its projection exceeds ``alpha`` on; they are list-decoded block by block, best codes first, and a branch is left as
soon as the best codes of the other blocks cannot reach alpha any more. Vectors of one label that share a filter are
candidates and are verified in double precision.

Recall depends on alpha. The share of all directions that a vector passes, and the chance that another one at the threshold's
cosine passes such a direction too, are areas of caps of the sphere; alpha is where a pair at the threshold shares SHARED
filters of each table on average, whatever the width and the number of codes. More codes mean a higher alpha, at which fewer
filters are shared, so a vector passes more of them. ``tables`` independent rotations are used (tests measure the pairs missed
against brute force, up to 2,048 codes). The number of codes grows with the rows of the largest label, so a bucket of vectors
that are not alike stays at about BLOCK of them.

Links must be counted, so pairs within a bucket are counted, never written: a vector belongs to many buckets, and its
links must not be counted again in each: a pair counts in the first filter that both pass, which the vectors' lists of
filters tell. Buckets that hold many vectors are dealt into blocks of about BLOCK vectors, and pairs of
blocks are rows of their own, so that no task holds a whole bucket.

Vectors that are null, zero or hold null or non-finite components, and those without a label, are linked with nothing but
are returned. Equal vectors of one label are one class with a count; its members link to each other. Repeated ids count as
vectors of their own in the counts and share the id's row. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import discard, stored
from rillgrid.llm.components import components

BLOCK = 1024  # vectors of a bucket, about, that are held against as many others at once
PARTS, CODES = 2, 16  # blocks of a product code, and codes of each at least
TABLES = 8  # independent rotations
THRESHOLD = 0.93  # cosine
SHARED = 1.25  # filters of a table that a pair at the threshold shares on average; its best one each passes anyway
AT_ONCE = 1 << 23  # projections that a task holds


@lru_cache(maxsize=16)
def rotation(dim: int, table: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(7919 + table).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=64)
def codebook(width: int, table: int, part: int, codes: int) -> np.ndarray:
    c = np.random.default_rng(104729 + 97 * table + part).standard_normal((codes, width))
    return c / np.linalg.norm(c, axis=1, keepdims=True)


@lru_cache(maxsize=64)
def cap_shares(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Heights from 0 to 1, and the share of the sphere beyond each: how many directions have a projection above it."""
    height = np.linspace(0, 1, 1 << 16)
    density = np.exp((dim - 3) / 2 * np.log(np.maximum(1 - height**2, 1e-300)))
    beyond = np.cumsum(density[::-1])[::-1]
    return height, beyond / beyond[0] / 2


@lru_cache(maxsize=64)
def limit(dim: int, parts: int = PARTS, codes: int = CODES, threshold: float = THRESHOLD) -> tuple[float, float]:
    """alpha, the projection from which on a vector of this width passes a filter, and how many filters of a table it passes."""
    if dim < 4:
        return 0.0, codes**parts / 2
    height, beyond = cap_shares(dim)
    c = min(max(threshold, 0.0), 1 - 1e-9)
    # of a vector at height h, the least height at which the other one is, less what they have in common, must be passed
    rest = height * (1 - c) / np.sqrt(1 - c * c) / np.sqrt(np.maximum(1 - height**2, 1e-12))
    both = np.interp(rest, *cap_shares(dim - 1), right=0.0)
    shared = codes**parts * beyond * both
    k = max(0, int(np.searchsorted(-shared, -SHARED)) - 1)
    return float(height[k]), float(codes**parts * beyond[k])


def codes_for(rows: int, dim: int, parts: int = PARTS, threshold: float = THRESHOLD) -> int:
    """Codes of a block, so that a filter is passed by about BLOCK of so many rows; a power of two."""
    codes = CODES
    while rows * limit(dim, parts, codes, threshold)[1] > BLOCK * codes**parts:
        codes *= 2
        if dim < 4:
            break
    return codes


def decode(x: np.ndarray, table: int, parts: int = PARTS, codes: int = CODES, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters of one table that unit vectors pass: list decoding, block by block with pruning."""
    step = max(16, AT_ONCE // codes**parts)
    found = [_decode(x[at : at + step], table, parts, codes, threshold) for at in range(0, max(1, len(x)), step)]
    return np.concatenate([row + k * step for k, (row, _) in enumerate(found)]), np.concatenate([code for _, code in found])


def _decode(x: np.ndarray, table: int, parts: int, codes: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    n, dim = x.shape
    alpha = limit(dim, parts, codes, threshold)[0]
    y = x @ rotation(dim, table).T
    bounds = np.linspace(0, dim, parts + 1).astype(int)
    shares = [y[:, a:b] @ codebook(b - a, table, k, codes).T / np.sqrt(parts) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
    best = [s.max(axis=1) for s in shares]
    need = np.minimum(alpha, sum(best) - 1e-12)  # the best filter always counts
    row, score, code = np.arange(n), np.zeros(n), np.zeros(n, np.int64)
    for k, s in enumerate(shares):
        rest = sum(best[k + 1 :], np.zeros(n))
        now = score[:, None] + s[row]
        i, j = np.nonzero(now + rest[row][:, None] >= need[row][:, None])
        row, score, code = row[i], now[i, j], code[i] * codes + j
    return row, code


def _clean(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label, v; v is null if it can link with nothing."""
    v = F.col(f"`{vec_col}`")
    if vectors.schema[vec_col].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    usable = v.isNotNull() & (F.size(v) > 0) & F.col(f"`{label_col}`").isNotNull() & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.when(usable, v).alias("v"))


def _unit(values: pa.Array, rows: int) -> np.ndarray:
    x = np.asarray(values.flatten(), np.float64).reshape(rows, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, parts: int = PARTS, codes: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, n_links, component_id (least id of its component), kept. ``codes`` goes by the rows of the largest label if none is given."""
    rows = _clean(vectors, id_col, vec_col, label_col)
    each = stored(rows.withColumn("class", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v"))))
    classes = each.where("class is not null").groupBy("class").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = stored(classes)
    if codes is None:
        largest, width = classes.groupBy("label").agg(F.count("*").alias("n"), F.min(F.size("v")).alias("width")).agg(F.max("n"), F.min("width")).first()
        codes = codes_for(largest or 0, width or 4, parts, threshold)
    n_filters = tables * codes**parts

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.asarray(batch.column(2).value_lengths())
            for dim in np.unique(sizes):  # vectors of different widths have no cosine
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                x = _unit(part.column(2), part.num_rows)
                found = [decode(x, t, parts, codes, threshold) for t in range(tables)]
                row = np.concatenate([r for r, _ in found])
                code = np.concatenate([t * codes**parts + c for t, (_, c) in enumerate(found)])
                order = np.lexsort((code, row))
                ends = np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, int(dim) * n_filters + code[order])], names=["rep", "label", "v", "copies", "filters"])

    kind = classes.schema["v"].dataType.simpleString()
    passed = stored(classes.select("rep", "label", "v", "copies").mapInArrow(passes, f"rep long, label long, v {kind}, copies long, filters array<long>"))
    in_buckets = passed.select("rep", "label", F.explode("filters").alias("filter"))
    sizes_of = in_buckets.groupBy("label", "filter").agg(F.count("*").alias("n")).where("n > 1").select("label", "filter", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    dealt = in_buckets.join(sizes_of, ["label", "filter"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    # a part meets itself and all others of its bucket; a vector goes to each meeting of its part
    sides = dealt.join(passed.select("rep", "v", "copies", "filters"), "rep").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sides = sides.select("label", "filter", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "rep", "copies", "v", "filters")

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("rep")
        own, p, q = (k.as_py() for k in key[1:])
        part, rep, copies = (np.asarray(table.column(c).combine_chunks()) for c in ("part", "rep", "copies"))
        x = _unit(table.column("v").combine_chunks(), len(rep))
        earlier = _bitmaps(table.column("filters").combine_chunks(), own)
        left, right = np.flatnonzero(part == p), np.flatnonzero(part == q)
        links = np.zeros(len(rep), np.int64)
        for at in range(0, len(left), 64):
            i = left[at : at + 64]
            a, b = np.nonzero(x[i] @ x[right].T >= threshold)
            a, b = i[a], right[b]
            if p == q:
                ordered = a < b
                a, b = a[ordered], b[ordered]
            first = ~(earlier[a] & earlier[b]).any(axis=1)  # a pair counts where it meets first
            a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            yield from _edges(rep, a, b)
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.nulls(len(some), pa.int64()), pa.array(links[some])], names=["a", "b", "links"])

    met = stored(sides.groupBy("label", "filter", "p", "q").applyInArrow(meet, "a long, b long, links long"))
    discard(passed)
    linked = met.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("others"))
    grouped = components(met.where("b is not null").select("a", "b"))
    final = classes.select("class", "rep", "copies").join(linked, "rep", "left").join(grouped.withColumnRenamed("id", "rep"), "rep", "left")
    final = final.select("class", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = each.select("vec_id", "class").join(final, "class", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.select(F.col("vec_id").alias(id_col), "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def _bitmaps(lists: pa.ListArray, own: int) -> np.ndarray:
    """A row of bits for each list: which of the filters before ``own`` it holds, of those that several lists hold."""
    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    code = np.asarray(lists.flatten())
    row, code = row[code < own], code[code < own]
    _, place, times = np.unique(code, return_inverse=True, return_counts=True)
    shared = times > 1
    row, place = row[shared[place]], (np.cumsum(shared) - 1)[place[shared[place]]]
    bits = np.zeros((len(lists), (shared.sum() + 7) // 8), np.uint8)
    np.bitwise_or.at(bits, (row, place // 8), (1 << (place % 8)).astype(np.uint8))
    return bits


def _edges(rep: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Enough of a block's links for its components: a forest, found by lowering each vector's root until none changes."""
    if not len(a):
        return
    root = np.arange(len(rep))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(rep)))
    yield pa.RecordBatch.from_arrays([pa.array(rep[child]), pa.array(rep[root[child]]), pa.array(np.zeros(len(child)), pa.int64())], names=["a", "b", "links"])

