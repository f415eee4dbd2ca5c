"""MinHash near-duplicates with odd sketches.

A document's set holds the hashes of its distinct word shingles. Documents with equal sets are one class; all that follows
works on one document of each class.

1. ``bands`` x ``rows`` MinHash samples of each set are cut into bands; documents that share a band are candidates.
2. Another ``BINS`` MinHash samples come from one permutation (the least hash of each bin of the hash range). They are folded
   into an odd sketch: a bitmap in which every sample flips one bit. The XOR of two sketches holds the parity of the samples
   in which they differ, so its population count estimates how many those are, most exactly where they are few, that is
   where the similarity is high. It rules out candidates; its limit lies ``SIGMAS`` deviations beyond the threshold, so that
   a true link is not lost to it.
3. What the sketch leaves is confirmed on the full sets, in whole numbers.

Only the components of the links are asked for, so no bucket is expanded into pairs. First every document of a bucket is
held against the bucket's first (a star). Then documents of one bucket that are in different components yet are held
against each other, in two passes over meetings of parts of a bucket, each a row of its own: the first reads sketches and
returns the documents (not pairs) that some partner is left for; the second brings the full sets of these, joins what it
confirms as it goes, skips what is joined already and returns a forest: at most one link a document and meeting. So what is
written grows with the documents and not with their pairs.

Null texts count as empty. Texts without words have an empty set, are linked with nothing and stay. Rows without an id are
left out. Repeated rows of one id count as one document of that id (by the largest set); other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import coded_words, cut, discard, empty_if_null, join_groups, slices, stored, tidy, word_hashes
from rillgrid.llm.components import components

BINS = 1024  # samples that an odd sketch is folded from, at most
BITS = 2048  # bits of an odd sketch
SIGMAS = 4.5  # a link at the threshold is lost to the sketch with a chance of about 3e-6, as to the bands
BLOCK = 8192  # documents of a bucket, about, that are held against as many others at once
BLOCK_SHINGLES = 1_000_000  # shingles of these, about: 8 MB
SMALL = 16  # documents of a meeting whose pairs are looked at together with those of other meetings
FEW_IDS = 2_000_000  # ids that may be broadcast: 16 MB
FEW_BUCKETS = 200_000  # hot buckets that may be broadcast
SEED = 0x9E3779B97F4A7C15

def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a text of fewer words is one shingle, one without words none."""
    distinct, codes, ends = coded_words(pc.ascii_split_whitespace(pc.ascii_lower(texts)))
    hashes = word_hashes(distinct)
    filled = np.asarray(pc.binary_length(distinct)) > 0
    with np.errstate(over="ignore"):
        for k in range(len(texts)):
            own = codes[ends[k] : ends[k + 1]]
            h = hashes[own[filled[own]]]
            size = min(words, len(h))
            if not size:
                yield h
                continue
            out = np.full(len(h) - size + 1, np.uint64(SEED + size))
            for j in range(size):
                out = _mix(out * np.uint64(0x100000001B3) + h[j : len(h) - size + 1 + j])
            yield np.unique(out)


def _factors(perms: int) -> np.ndarray:
    """Odd numbers; a product with one of them orders hashes anew."""
    with np.errstate(over="ignore"):
        return _mix(np.arange(1, perms + 1, dtype=np.uint64) * np.uint64(SEED)) | np.uint64(1)


def _samples(h: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A MinHash sample of a set for each factor, some hundred shingles at a time."""
    least = np.full(len(factors), np.uint64(2**64 - 1))
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 512):
            least = np.minimum(least, (h[at : at + 512, None] * factors[None, :]).min(axis=0))
    return least


def odd_sketch(h: np.ndarray) -> bytes:
    """The parity bitmap of a sorted set's one-permutation samples."""
    bins = h >> np.uint64(64 - BINS.bit_length() + 1)
    samples = h[np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))]
    with np.errstate(over="ignore"):
        bit = _mix(samples) % np.uint64(BITS)
    return np.packbits((np.bincount(bit.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def sketch_limit(n: np.ndarray, percent: int) -> np.ndarray:
    """The most bits in which the sketches of a true link differ, of sets that have n shingles together.

    At the threshold t the union has n / (1 + t) shingles, which fill a number of bins. In a hypergeometric number of these,
    (1 - t) of them on average, the least hash is not in both sets: the set that has it flips a bit, and the other one
    flips one too if it has anything in that bin. Flips that meet cancel. The limit is the mean and SIGMAS deviations, of the
    flips and then of their parities, and a few flips more for small sets. Closer pairs differ in less.
    """
    t = percent / 100
    union = np.maximum(n / (1 + t), 1.0)
    load = union / BINS
    empty = np.exp(-load)
    bins = BINS * (1 - empty)
    own = (1 + t) / 2  # share of the union that a set has; what else is in a bin lacks it with 1 - own
    both = 1 - empty * np.expm1(load * (1 - own)) / ((1 - own) * (1 - empty)) if own < 1 else 1 - empty * load / (1 - empty)
    differ = bins * (1 - t)
    spread = differ * t * np.maximum(1 - bins / union, 0) + (1 - t) ** 2 * BINS * empty * np.maximum(1 - (1 + load) * empty, 0)
    flips = differ * (1 + both)
    flips += SIGMAS * np.sqrt((1 + both) ** 2 * spread + differ * both * (1 - both)) + 3
    odd = BITS / 2 * (1 - (1 - 2 / BITS) ** flips)
    noise = (BITS + BITS * (BITS - 1) * (1 - 4 / BITS) ** flips - BITS**2 * (1 - 2 / BITS) ** (2 * flips)) / 4
    return odd + SIGMAS * np.sqrt(np.maximum(noise, 0))


def _class_of(h: np.ndarray) -> int:
    """A hash of a whole set; equal sets are one class."""
    return xxhash.xxh3_64_intdigest(h.tobytes()) - 2**63


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32), np.concatenate([*parts, np.zeros(0, np.int64)]))


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, class, sketch, keys (one hash a band) of rows (doc_id, text)."""

    factors = _factors(bands * rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                sizes, classes, sketches, keys = [], [], [], []
                for h in shingle_sets(texts, words):
                    sizes.append(len(h))
                    classes.append(_class_of(h))
                    if not len(h):
                        sketches.append(b"")
                        keys.append(np.zeros(0, np.int64))
                        continue
                    samples = _samples(h, factors)
                    sketches.append(odd_sketch(h))
                    with np.errstate(over="ignore"):
                        key = np.arange(bands, dtype=np.uint64)
                        for j in range(rows):
                            key = _mix(key * np.uint64(0x100000001B3) + samples[j::rows])
                    keys.append(key.view(np.int64))
                columns = [batch.column(0).slice(first, len(texts)), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(sketches, pa.binary()), _lists(keys)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "class", "sketch", "keys"])

    return docs.mapInArrow(tidy(sign), "doc_id long, n_shingles long, class long, sketch binary, keys array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, shingles) of the wanted (rep, class), made again from the texts: most documents need no set beyond its sketch."""
    wanted = wanted.select(F.col("rep").alias("doc_id"), "class")
    chosen = docs.join(F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted, "doc_id").select("doc_id", "text", "class")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                ids, asked = (batch.column(c).slice(first, len(texts)).to_pylist() for c in (0, 2))
                kept = [(i, h.view(np.int64)) for i, c, h in zip(ids, asked, shingle_sets(texts, words), strict=True) if _class_of(h) == c]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in kept], pa.int64()), _lists([h for _, h in kept])], names=["rep", "shingles"])

    return chosen.mapInArrow(tidy(make), "rep long, shingles array<long>")


def _confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    ids = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets = stored(full_sets(docs, cut(reps.select("rep", "class").join(ids, "rep", "left_semi")), words))
    left, right = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            x, y = batch.column(2), batch.column(3)
            for k in range(batch.num_rows):
                u, v = np.asarray(x[k].values), np.asarray(y[k].values)
                common = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * common >= percent * (len(u) + len(v) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    out = cut(both.mapInArrow(tidy(confirm), "a long, b long"))
    discard(sets)
    return out


class Side:
    """Documents of a meeting: ids, components, sizes, sketches, and which part each is of."""

    def __init__(self, docs: pa.StructArray):
        self.rep, self.comp, self.n, self.part = (np.asarray(docs.field(f)) for f in ("rep", "comp", "n", "part"))
        self.bits = _bits(docs.field("sketch"))


def _bits(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).view(np.uint64).reshape(-1, BITS // 64)


def _left(side: Side, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (a, b) sizes and sketches leave."""
    x, y = side.n[a], side.n[b]
    apart = np.bitwise_count(side.bits[a] ^ side.bits[b]).sum(axis=1, dtype=np.int64)
    return (100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & (apart <= sketch_limit(x + y, percent))


def _some_left(side: Side, percent: int) -> np.ndarray:
    """Which documents of one large meeting have a partner of another component left."""
    order = np.argsort(side.comp, kind="stable")  # so that a chunk is mostly of one component and need not meet that one
    some = np.zeros(len(order), bool)
    two = side.part.min() != side.part.max()
    step = max(1, 65536 // len(order))
    for at in range(0, len(order), step):
        i = order[at : at + step]
        rest = order[at + 1 :]
        if (side.comp[i] == side.comp[i[0]]).all():
            rest = rest[side.comp[rest] != side.comp[i[0]]]
        apart = np.bitwise_count(side.bits[i][:, None, :] ^ side.bits[rest][None, :, :]).sum(axis=2, dtype=np.int64)
        x, y = side.n[i][:, None], side.n[rest][None, :]
        ok = (apart <= sketch_limit(x + y, percent)) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
        ok &= side.comp[i][:, None] != side.comp[rest][None, :]
        if two:
            ok &= side.part[i][:, None] != side.part[rest][None, :]
        some[i[ok.any(axis=1)]] = True
        some[rest[ok.any(axis=0)]] = True
    return some


def _forest(side: Side, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all components of a meeting which true links join: at most one a document."""
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([len(h) for h in sets])
    starts = ends - side.n
    root = np.unique(side.comp, return_inverse=True)[1]
    two = side.part.min() != side.part.max()
    mark = np.zeros(codes.max() + 1, bool)
    found = []
    for i in range(len(root) - 1):
        others = np.arange(i + 1, len(root))
        others = others[(root[others] != root[i]) & ((side.part[others] != side.part[i]) | (not two))]
        if not len(others):
            continue
        own = np.full(len(others), i)
        apart = np.bitwise_count(side.bits[others] ^ side.bits[i]).sum(axis=1, dtype=np.int64)
        ok = _left(side, own, others, percent)
        others = others[ok][np.argsort(apart[ok], kind="stable")]  # the nearest first: what they join need not be looked at
        mark[codes[starts[i] : ends[i]]] = True
        while len(others):
            now, others = others[:32], others[32:]
            held = np.concatenate([codes[starts[j] : ends[j]] for j in now])
            common = np.add.reduceat(mark[held].astype(np.int64), np.cumsum(side.n[now]) - side.n[now])
            for j in now[100 * common >= percent * (side.n[i] + side.n[now] - common)]:
                if root[j] != root[i]:
                    found.append((i, j))
                    root[root == root[j]] = root[i]
            others = others[root[others] != root[i]]
        mark[codes[starts[i] : ends[i]]] = False
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return side.rep[a], side.rep[b]


def _meetings(members: DataFrame, columns: list[str]) -> DataFrame:
    """(key, p, q, docs): parts p and q of a bucket, with all their documents, where these are of several components.
    members: key, p, q, part, comp and the columns."""
    docs = F.collect_list(F.struct("part", "comp", *columns)).alias("docs")
    return members.groupBy("key", "p", "q").agg(docs, F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").drop("low", "high")


def _undecided(open_: DataFrame, slim: DataFrame, percent: int) -> DataFrame:
    """(key, p, q, part, rep, comp) of the documents that sizes and sketches leave a partner of another component for."""
    hot = open_.groupBy("key").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles")).where((F.col("docs") > BLOCK) | (F.col("shingles") > BLOCK_SHINGLES))
    hot = cut(hot.select("key", F.ceil(F.greatest(F.col("docs") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("parts")))
    dealt = open_.join(F.broadcast(hot) if hot.count() <= FEW_BUCKETS else hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # a part meets itself and all others of its bucket; a document goes to each meeting of its part
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "rep", "comp", "n")
    meetings = _meetings(dealt.join(slim.select("rep", "sketch"), "rep"), ["rep", "n", "sketch"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = np.asarray(lists.value_lengths())
            side = Side(lists.flatten())
            row, firsts = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
            some = np.zeros(len(row), bool)
            for size in np.unique(sizes[sizes <= SMALL]):  # all small meetings of one size at once
                a, b = np.triu_indices(size, 1)
                at = firsts[sizes == size][:, None]
                a, b = (at + a).ravel(), (at + b).ravel()
                two = (batch.column(1).to_numpy() != batch.column(2).to_numpy())[row[a]]
                ok = (side.comp[a] != side.comp[b]) & ((side.part[a] != side.part[b]) | ~two)
                a, b = a[ok], b[ok]
                for at in range(0, len(a), 4096):
                    x, y = a[at : at + 4096], b[at : at + 4096]
                    ok = _left(side, x, y, percent)
                    some[x[ok]] = some[y[ok]] = True
            for k in np.flatnonzero(sizes > SMALL):
                some[firsts[k] : firsts[k] + sizes[k]] = _some_left(Side(lists[k].values), percent)
            at = np.flatnonzero(some)
            keys = [batch.column(c).take(pa.array(row[at])) for c in range(3)]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x[at]) for x in (side.part, side.rep, side.comp))], names=["key", "p", "q", "part", "rep", "comp"])

    return meetings.mapInArrow(tidy(match), "key long, p int, q int, part int, rep long, comp long")


def _joined(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the documents that were left: a forest of each meeting, confirmed on the full sets."""
    meetings = _meetings(left.join(sets, "rep"), ["rep", "shingles"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                docs = batch.column(3)[k].values
                lists = docs.field("shingles")
                sets = [np.asarray(lists[i].values).view(np.uint64) for i in range(len(docs))]
                fields = [docs.field(f) for f in ("rep", "comp", "part")] + [pa.array([len(h) for h in sets]), pa.array([odd_sketch(h) for h in sets], pa.binary())]
                a, b = _forest(Side(pa.StructArray.from_arrays(fields, ["rep", "comp", "part", "n", "sketch"])), sets, percent)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return meetings.mapInArrow(tidy(join), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (least id of its component), kept, one row per id.

    With 32 bands of 5 rows a pair at exactly 0.8 shares no band with a chance of (1 - 0.8 ** 5) ** 32 = 3e-6.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), empty_if_null(F.col(f"`{text_col}`")).alias("text")).where("doc_id is not null")
    signed = stored(signatures(texts, words, bands, rows))
    each = cut(signed.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "class")).alias("top")).select("doc_id", "top.n_shingles", "top.class"))
    # equal sets are one class: its least id stands for it
    classes = cut(each.where("n_shingles > 0").groupBy("class", "n_shingles").agg(F.min("doc_id").alias("rep")))
    reps = signed.join(classes.select(F.col("rep").alias("doc_id"), "class"), ["doc_id", "class"], "left_semi").dropDuplicates(["doc_id"])
    reps = stored(reps.select(F.col("doc_id").alias("rep"), "class", F.col("n_shingles").alias("n"), "sketch", "keys"))
    discard(signed)
    banded = reps.select("rep", "n", F.explode("keys").alias("key"))
    # buckets of two at least; the first of a bucket is its hub
    hubs = cut(banded.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1"))
    members = cut(join_groups(banded, hubs, ["key"], "size").drop("size"))
    slim = reps.select("rep", "n", "sketch")
    stars = members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    # of a document's hubs only the one with the nearest sketch
    hubs_of = _sketched(stars, slim, percent).groupBy("b").agg(F.min(F.struct("apart", "a")).alias("near")).select("near.a", "b")
    links = _confirmed(cut(hubs_of), texts, reps, words, percent)
    grouped = components(links)
    # then links between components
    known = members.join(grouped.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    # buckets whose documents are not all in one component yet
    mixed = known.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    open_ = cut(known.join(mixed, "key", "left_semi").select("key", "rep", "comp", "n"))
    left = cut(_undecided(open_, slim, percent))
    if not left.isEmpty():
        wanted = cut(reps.select("rep", "class").join(left.select("rep").distinct(), "rep", "left_semi"))
        sets = stored(full_sets(texts, wanted, words))
        links = links.union(cut(_joined(left, sets, percent)))
        discard(sets)
        grouped = components(links)
    # the classes' other documents follow their first
    final = classes.join(grouped.withColumnRenamed("id", "rep"), "rep", "left").select("class", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    discard(reps)
    out = each.join(final, ["class", "n_shingles"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _sketched(pairs: DataFrame, slim: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and sketches leave, and in how many bits their sketches differ."""
    left, right = (slim.select(F.col("rep").alias(c), *[F.col(f).alias(f"{f}_{c}") for f in ("n", "sketch")]) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    both = both.select("a", "b", "sketch_a", "sketch_b", (F.col("n_a") + F.col("n_b")).alias("n"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = np.bitwise_count(_bits(batch.column(2)) ^ _bits(batch.column(3))).sum(axis=1, dtype=np.int64)
                ok = apart <= sketch_limit(np.asarray(batch.column(4)), percent)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(apart)], names=["a", "b", "apart"]).filter(pa.array(ok))

    return both.mapInArrow(tidy(close), "a long, b long, apart long")
