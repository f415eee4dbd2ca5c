"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    sc = spark.sparkContext
    at = sc._jsc.sc().getCheckpointDir()
    if at.isDefined():
        return at.get()
    given = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not given and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="rillgrid-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, so that later jobs neither repeat it nor need its executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As cut(), as compressed Parquet: for wide rows, which checkpoint() would keep uncompressed."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/rillgrid-{uuid.uuid4().hex}"
    df.write.parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out.stored_at = at
    return out


def discard(*held: DataFrame) -> None:
    """Deletes what stored() wrote, once all that is made of it stands in the shared folder itself."""
    for df in held:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


FEW_GROUPS = 500_000  # groups that may be broadcast as they are: some tens of MB
HOT_KEYS, HOT_ROWS = 50_000, 1000  # hot keys that may be broadcast beyond that, and rows that a key has at least for it


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], times: str) -> DataFrame:
    """rows joined with groups, which have one row a key; their column ``times`` says how many rows have the key. Up to
    FEW_GROUPS groups are broadcast. Of more, the keys with more than 1 / HOT_KEYS of all rows, so fewer than HOT_KEYS
    whatever the data, are broadcast, so that none of them meets in one task; the others are shuffled."""
    n, total = groups.agg(F.count("*"), F.sum(times)).first()
    if n <= FEW_GROUPS:
        return rows.join(F.broadcast(groups), on)
    least = max(HOT_ROWS, total // HOT_KEYS)
    hot = groups.where(F.col(times) > least)
    if hot.isEmpty():
        return rows.join(groups, on)
    cold = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups.where(F.col(times) <= least), on)
    return rows.join(F.broadcast(hot), on).unionByName(cold)


def fresh(name: str, df: DataFrame) -> str:
    """name, made longer until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def empty_if_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file is; RILLGRID_TOKENIZERS can name another folder."""
    folder = os.environ.get("RILLGRID_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


SLICE_BYTES = 3_000_000  # text that a task holds as words at once

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Task) -> Task:
    """run, which at a task's end gives the memory it has freed back to the system: Python workers are used again, also by
    stages that need little, and would keep the most that any of them ever took."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return tidied


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """A batch's texts in runs of about ``most`` bytes, one text at least: (first row, texts)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, texts.slice(at, upto - at)
        at = upto


def coded_words(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lists of words as (distinct words, code of each word, where each list's words begin and end)."""
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return flat.dictionary, np.asarray(flat.indices), offsets - offsets[0]


def coded(lists: pa.ListArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The same with the distinct words as a list."""
    words, codes, bounds = coded_words(lists)
    return words.to_pylist(), codes, bounds


_TABLE = np.random.default_rng(20011).integers(0, 2**64, (64, 256), np.uint64).ravel()  # a random number for each byte at each place
_FACTOR = 0x9E3779B97F4A7C15  # for each further 64 bytes


def byte_offsets(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an array of strings without nulls, and where each begins and ends."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings by tabulation: the sum of a random number for each byte at its place, then mixed. A million
    bytes at a time, however long a word is."""
    data, offsets = byte_offsets(words)
    sums = np.zeros(len(offsets), np.uint64)  # of all bytes before each offset
    carry = np.uint64(0)
    with np.errstate(over="ignore"):
        for at in range(int(offsets[0]), int(offsets[-1]), 1 << 20):
            upto = min(at + (1 << 20), int(offsets[-1]))
            lo, hi = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, upto, "left")
            bounds = np.clip(offsets[lo : hi + 1], at, upto)
            place = np.arange(at, upto) - np.repeat(offsets[lo:hi], np.diff(bounds))
            value = _TABLE[((place & 63) << 8) + data[at:upto]]
            if (far := np.flatnonzero(place > 63)).size:
                turns = place[far] >> 6
                powers = np.cumprod(np.concatenate([[1], np.full(turns.max(), _FACTOR, np.uint64)]).astype(np.uint64), dtype=np.uint64)
                value[far] *= powers[turns]
            scan = np.cumsum(value, dtype=np.uint64) + carry
            inside = offsets[lo : hi + 1]
            own = np.flatnonzero((inside > at) & (inside <= upto)) + lo
            sums[own] = scan[offsets[own] - at - 1]
            carry = scan[-1]
        h = np.diff(sums) + np.diff(offsets).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once a row: an explode of one element, into which no later use is inlined."""
    return df.select("*", F.explode(F.array(value)).alias(name))
