"""Suffix-array dedup: bytes of strings of ``min_bytes`` that stand earlier too, by threshold-bounded interval expansion.

A byte is removed if a string of ``min_bytes`` bytes that covers it also starts earlier: in a document of a smaller id, or in the
same one at an earlier place. Strings are judged on the input.

1. Anchors deal the strings out, so that equal ones meet: of the shorter strings within a string of ``min_bytes``, the one with
   the least hash (the first of those) is its anchor. Neighbouring starts with one anchor are a piece, of 64 starts at most. An
   anchor follows from the string alone, so no repeat is lost.
2. Pieces that are equal as a whole are one, at its earliest place: all others repeat it wholly. A task does so among the pieces
   that it has at hand, and joins the repeats of a text to spans; only the earliest of each go on, to where all of an anchor meet,
   so that a piece in very many texts is there once a batch. That is the only time that pieces are shuffled; those that repeat
   nothing and whose anchor has no other piece end there.
3. Different pieces with one anchor get their texts and meet in groups of about a million bytes. A group's pieces get a suffix
   order and its Burrows-Wheeler transform. From the empty string on, intervals of the order are extended backward by one byte,
   breadth first; an interval that ends at a border not met before gives that border the length so far as its common prefix, and
   is extended further. So common prefixes come by increasing value, and the search ends at min_bytes: between suffixes whose
   border was not met, min_bytes are shared at least. Of each such run the earliest place stays.
4. An anchor with over MANY different pieces (a common phrase in ever other surroundings) would make a group without bound. Its
   pieces are cut to their single strings, of which equal ones are one again, as in 2. Such anchors are looked for among one in
   SHARE of the documents first, and their pieces are dealt out by themselves as a whole, so that they do not meet in 2 either;
   what that sample misses is seen in 2. Which way an anchor goes does not change what is found.
5. Each document's marked strings are united and its other bytes joined.

Texts are cut in UTF-8 bytes, so what is kept may end within a character. Null texts are empty. Null ids count as the largest id.
Rows of one id with different texts are apart, one after another by a hash of the text; rows equal in both are one document and
do not repeat each other. Documents shorter than min_bytes lose nothing. An empty table gives no rows. Other columns are kept, but
for those named as the results, which are replaced. Strings are told apart by 64-bit hashes in 1, 2 and 4, by their bytes in 3.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from rillgrid.llm.common import discard, empty_if_null, fresh, join_groups, slices, stored, tidy
from rillgrid.llm.text_bytes import Rolling, bytes_of

STARTS = 64  # of a piece, at most: bits of a mask
MANY = 4_000  # different pieces of an anchor that meet in one group
SHARE, HOT = 64, 50_000  # one in so many documents is looked at for such anchors, and so many are dealt out at most
TOGETHER = 500_000  # pieces among which a task looks for equal ones
GROUP_BYTES = 1_000_000
BLOCK = 3_000_000  # bytes of a text that are hashed at once
_PLACE = np.uint64((1 << 22) - 1)  # room for a place within a block
LAST_ID = 2**63 - 1


def starts_of(min_bytes: int) -> int:
    """How many starts share an anchor at most."""
    return max(1, min(STARTS, 2 * min_bytes // 3))


def text_key(text: bytes | memoryview) -> int:
    """What tells texts of one id apart; the high half of a place."""
    return (zlib.crc32(text) & 0x7FFFFFFF) << 32


def pieces(data: np.ndarray, min_bytes: int) -> tuple[np.ndarray, ...]:
    """(start, end, anchor hash, whole hash) of the pieces of one text, or of several if none is longer than a block."""
    width = starts_of(min_bytes)
    k = min_bytes - width + 1
    out = []
    for at in range(0, max(1, len(data) - min_bytes + 1), BLOCK):
        block = data[at : at + BLOCK + min_bytes - 1]
        if len(block) < min_bytes:
            break
        rolling = Rolling(block)
        grams = rolling.grams(k)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        have = 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        anchor = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        end = np.concatenate([first[1:], [len(anchor)]]) + min_bytes - 1
        out.append((first + at, end + at, grams[anchor[first]], rolling.of(first, end)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _pieces_of_batch(texts: pa.Array, min_bytes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start in the text, length, anchor, whole, place) for runs of texts. Short texts are hashed together, and cut after."""
    for at, some in slices(texts):
        data, bounds = bytes_of(some)
        long = np.diff(bounds) >= min_bytes
        keys = _keys(data, bounds)
        for k in np.flatnonzero(long):
            a, b = bounds[k], bounds[k + 1]
            start, end, anchor, whole = pieces(data[a:b], min_bytes)
            yield np.full(len(start), at + k), start, end - start, anchor, whole, keys[k] + start


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _of_batches(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc, place, length, anchor, whole) of the pieces of batches (doc, text), about TOGETHER at a time."""
    held, n = [], 0
    for batch in batches:
        ids = batch.column("doc").to_numpy(zero_copy_only=False)
        for row, _, size, anchor, whole, at in _pieces_of_batch(batch.column("text"), min_bytes):
            held.append((ids[row], at, size, _signed(anchor), _signed(whole)))
            n += len(row)
            if n >= TOGETHER:
                yield _joined(held)
                held, n = [], 0
    if n:
        yield _joined(held)


def _frequent_anchors(docs: DataFrame, min_bytes: int) -> np.ndarray:
    """Anchors that may have over MANY different pieces, from one in SHARE of docs (doc, text); at most HOT, the most frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, anchor, whole in _of_batches(batches, min_bytes):
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(whole)], names=["a", "c"])

    some = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SHARE)) == 0).mapInArrow(tidy(run), "a long, c long")
    kinds = some.distinct().groupBy("a").agg(F.count("*").alias("kinds")).where(F.col("kinds") >= max(2, MANY // SHARE))
    return np.sort(np.array([r.a for r in kinds.orderBy(F.desc("kinds"), "a").limit(HOT).collect()], np.int64))


def earliest(doc: np.ndarray, at: np.ndarray, size: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Of pieces: the numbers of those that are the earliest of their kind, and (doc, at, size) of the spans that all others
    make. A piece at the very place of another is of a repeated row, and goes."""
    by = np.lexsort((at, doc, whole))
    other = np.ones(len(by), bool)
    other[1:] = whole[by[1:]] != whole[by[:-1]]
    moved = np.ones(len(by), bool)
    moved[1:] = other[1:] | (doc[by[1:]] != doc[by[:-1]]) | (at[by[1:]] != at[by[:-1]])
    late = by[~other & moved]
    late = late[np.lexsort((at[late], doc[late]))]
    doc, at, end = doc[late], at[late], at[late] + size[late]
    new = np.ones(len(late), bool)  # pieces of one text that touch have the high half of their places in common
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > end[:-1])
    first = np.flatnonzero(new)
    upto = np.maximum.reduceat(end, first) if len(first) else end
    return np.sort(by[other]), (doc[first], at[first], upto - at[first])


def _dealt_pieces(docs: DataFrame, min_bytes: int, frequent: Broadcast) -> DataFrame:
    """(k, c, doc, at, size) of docs (doc, text): the earliest pieces of each batch, where k is the anchor, or c itself if that
    is frequent; and spans that repeat such pieces wholly, without c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, at, size, anchor, whole in _of_batches(batches, min_bytes):
            stay, late = earliest(doc, at, size, whole)
            key = np.where(np.isin(anchor[stay], frequent.value), whole[stay], anchor[stay])
            columns = [np.concatenate([x[stay], y]) for x, y in zip((doc, at, size), late, strict=True)]
            spread = late[0] * 0x5851F42D4C957F2D + late[1]  # any numbers, so that spans go everywhere
            c = pa.array(np.concatenate([whole[stay], spread]), mask=np.arange(len(stay) + len(spread)) >= len(stay))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([key, spread])), c, *map(pa.array, columns[:2]), pa.array(columns[2].astype(np.int32))], names=["k", "c", "doc", "at", "size"])

    return docs.mapInArrow(tidy(run), "k long, c long, doc long, at long, size int")


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of symbols (0 to 511) in the order of their first ``depth`` symbols at least, by doubling."""
    n = len(symbols)
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | np.roll(symbols, -k)
    done = 7
    while True:
        order = np.argsort(key)
        new = np.empty(n, bool)
        new[0] = True
        ranked = key[order]
        np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
        if done >= depth or new.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        key = rank * (n + 1) + np.roll(rank, -done)
        done *= 2


def borders(transform: np.ndarray, depth: int) -> np.ndarray:
    """For each place of the suffix order whether it shares fewer than ``depth`` symbols with the one before.

    transform: the symbol before each suffix. Breadth-first backward extension, see the module's text.
    """
    n = len(transform)
    by_symbol = np.argsort(transform, kind="stable")
    to = np.empty(n, np.int64)  # where the suffix that is longer by its transform's symbol stands
    to[by_symbol] = np.arange(n)
    head = transform[by_symbol]  # first symbol of each suffix
    met = np.zeros(n + 1, bool)
    met[[0, n]] = True
    low, high = np.zeros(1, np.int64), np.full(1, n)
    mark = np.zeros(n, np.int32)
    for _ in range(depth):
        sizes = high - low
        ends = np.cumsum(sizes)
        if not len(ends):
            break
        of = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
        longer = to[np.arange(ends[-1]) + np.repeat(low - (ends - sizes), sizes)]
        if len(longer) > n >> 4:
            mark[longer] = of + 1
            longer = np.flatnonzero(mark)
            of = mark[longer]
            mark[longer] = 0
        else:
            order = np.argsort(longer)
            longer, of = longer[order], of[order]
        # extensions of one interval by one symbol are neighbours
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (head[longer[1:]] != head[longer[:-1]])])
        first = np.flatnonzero(new)
        high = np.concatenate([longer[first[1:] - 1], longer[-1:]]) + 1
        low = longer[first]
        unmet = ~met[high]
        low, high = low[unmet], high[unmet]
        met[high] = True
    return met[:n]


def repeated_starts(texts: list[bytes], doc: np.ndarray, at: np.ndarray, min_bytes: int) -> np.ndarray:
    """For each text a mask of the starts (bit 0 first) whose min_bytes stand at an earlier place of these texts; (doc, at) is
    where a text begins."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
    symbols[ends - 1] = 0
    order = suffix_order(symbols, min_bytes)
    border = borders(symbols[order - 1].astype(np.uint16), min_bytes)
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    offset = np.arange(len(symbols)) - np.repeat(ends - sizes - 1, sizes + 1)
    is_start = offset <= np.repeat(sizes, sizes + 1) - min_bytes
    run = np.cumsum(border)
    alone = border & np.append(border[1:], True)
    of = np.flatnonzero(is_start[order] & ~alone)
    starts, run = order[of], run[of]
    t, o = text[starts], offset[starts]
    place = at[t] + o
    by = np.lexsort((place, doc[t], run))
    t, o, place, run = t[by], o[by], place[by], run[by]
    masks = np.zeros(len(texts), np.uint64)
    if len(run):
        first = np.maximum.accumulate(np.where(np.concatenate([[True], run[1:] != run[:-1]]), np.arange(len(run)), 0))
        later = (doc[t] != doc[t[first]]) | (place != place[first])
        np.bitwise_or.at(masks, t[later], np.uint64(1) << o[later].astype(np.uint64))
    return masks.view(np.int64)


def _keys(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """text_key of each text."""
    return np.array([text_key(data[a:b].data) if b > a else 0 for a, b in zip(bounds, bounds[1:], strict=False)], np.int64)


def _flat(lists: pa.ListArray) -> tuple[pa.StructArray, np.ndarray]:
    """The elements of all lists, one after another, and the row of each."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    return lists.flatten(), np.repeat(np.arange(len(lists)), sizes)


def _text_of_pieces(docs: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """wanted (a, kinds, doc, at, size) with text, cut from their documents."""
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("a", "kinds", "at", "size")).alias("_w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                data, bounds = bytes_of(texts)
                keys, ids = _keys(data, bounds), batch.column("doc").slice(first, len(texts)).to_numpy(zero_copy_only=False)
                flat, row = _flat(batch.column("_w").slice(first, len(texts)))
                at = flat.field("at").to_numpy(zero_copy_only=False)
                own = np.flatnonzero((at >> 32 << 32) == keys[row])
                for some in range(0, len(own), 20_000):
                    by = own[some : some + 20_000]
                    rows = flat.take(pa.array(by))
                    size = rows.field("size").to_numpy(zero_copy_only=False)
                    upto = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
                    each = np.repeat(at[by] - keys[row[by]] + bounds[row[by]] - upto[:-1], size) + np.arange(upto[-1])
                    cut_out = pa.BinaryArray.from_buffers(pa.binary(), len(by), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(data[each])])
                    yield pa.RecordBatch.from_arrays([rows.field("a"), rows.field("kinds"), pa.array(ids[row[by]]), rows.field("at"), cut_out], names=["a", "kinds", "doc", "at", "text"])

    found = docs.join(lists.hint("shuffle_hash"), "doc")
    return found.select("doc", "text", "_w").mapInArrow(tidy(run), "a long, kinds int, doc long, at long, text binary")


def _masks_of_groups(rows: DataFrame, n_bytes: int, min_bytes: int) -> DataFrame:
    """(doc, at, size, mask) of pieces (a, doc, at, text), of n_bytes: which of their starts stand earlier in another piece."""
    dealt = rows.withColumn("_g", F.pmod("a", F.lit(n_bytes // GROUP_BYTES + 1))).drop("a", "kinds")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        doc, at = (table.column(c).to_numpy() for c in ("doc", "at"))
        masks = repeated_starts(table.column("text").to_pylist(), doc, at, min_bytes)
        size = pc.binary_length(table.column("text"))
        out = pa.table({"doc": table.column("doc"), "at": table.column("at"), "size": size, "mask": pa.array(masks)})
        yield from out.filter(pa.array(masks != 0)).combine_chunks().to_batches()

    return dealt.groupBy("_g").applyInArrow(tidy_group(run), "doc long, at long, size int, mask long")


def tidy_group(run):
    """tidy() for a function of a group."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tidy(run)(batches)

    return grouped


def _masks_of_strings(rows: DataFrame, min_bytes: int) -> DataFrame:
    """The same with every string of min_bytes by itself; the earliest place of equal ones decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = bytes_of(batch.column("text").cast(pa.large_binary()).view(pa.large_string()))
            if not len(data):
                continue
            n = np.maximum(np.diff(bounds) - min_bytes + 1, 0)
            row = np.repeat(np.arange(len(n)), n)
            o = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = bounds[row] + o
            string = _signed(Rolling(data).of(start, start + min_bytes))
            by = pa.array(row)
            kept = [c.take(by) for c in (batch.column("doc"), batch.column("at"), pc.binary_length(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(o.astype(np.int32)), pa.array(string)], names=["doc", "at", "size", "o", "string"])

    strings = stored(rows.mapInArrow(tidy(run), "doc long, at long, size int, o int, string long"))
    first = strings.groupBy("string").agg(F.min(F.struct("doc", (F.col("at") + F.col("o")).alias("at"))).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = stored(first)
    later = join_groups(strings, first, ["string"], "n").where("doc <> f.doc or at + o <> f.at")
    return later.groupBy("doc", "at", "size").agg(F.bit_or(F.expr("shiftleft(1L, o)")).alias("mask"))


def _judged(dealt: DataFrame) -> DataFrame:
    """(doc, at, size, a, kinds) of what _dealt_pieces gives: without a what repeats an earlier piece wholly, else the first of
    each of several pieces of an anchor. Rows are shuffled and sorted once."""
    ordered = Window.partitionBy("k").orderBy("c", "doc", "at")
    before = dealt.repartition("k").select("*", *(F.lag(c).over(ordered).alias(f"_{c}") for c in ("c", "doc", "at")))
    first = F.col("c").isNotNull() & (F.col("_c").isNull() | (F.col("_c") != F.col("c")))
    same = F.col("c").isNotNull() & (F.col("_c") == F.col("c")) & (F.col("_doc") == F.col("doc")) & (F.col("_at") == F.col("at"))
    rows = before.select("k", "c", "doc", "at", "size", first.alias("first"), F.coalesce(same, F.lit(False)).alias("same"))
    rows = rows.withColumn("kinds", F.sum(F.col("first").cast("int")).over(Window.partitionBy("k"))).where("not same")
    rows = rows.withColumn("kinds", F.when(F.col("k") == F.col("c"), MANY + 1).otherwise(F.col("kinds")))
    rows = rows.where("not first or kinds > 1")
    return rows.select("doc", "at", "size", F.when(F.col("first"), F.col("k")).alias("a"), F.when(F.col("first"), F.col("kinds").cast("int")).alias("kinds"))


def _marked(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(doc, marks: list of place, size, mask) of docs (doc, text)."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent_anchors(docs, min_bytes))
    judged = stored(_judged(_dealt_pieces(docs, min_bytes, frequent)))
    wanted, many = judged.where("a is not null"), F.col("kinds") > MANY
    n_bytes, n_many = wanted.agg(F.sum(F.when(~many, F.col("size"))), F.count_if(many)).first()
    texts = _text_of_pieces(docs, wanted, min_bytes)
    if n_many:  # few in number, and else what no anchor has many of meets without being written
        texts = stored(texts)
    masks = _masks_of_groups(texts.where(~many), n_bytes or 0, min_bytes)
    if n_many:
        masks = masks.unionByName(_masks_of_strings(texts.where(many), min_bytes))
    masks = stored(masks)
    if n_many:
        discard(texts)
    marks = judged.where("a is null").select("doc", "at", "size", F.lit(-1).cast("long").alias("mask")).unionByName(masks)
    return marks.groupBy("doc").agg(F.collect_list(F.struct("at", "size", "mask")).alias("marks"))


def _removed(start: np.ndarray, size: np.ndarray, mask: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the maximal runs that marks cover; -1 marks the whole piece."""
    all_of = mask == -1
    part = np.flatnonzero(~all_of)
    bits = np.unpackbits(mask[part].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    k, o = np.nonzero(bits)
    begin = np.concatenate([start[all_of], start[part[k]] + o])
    end = np.concatenate([(start + size)[all_of], start[part[k]] + o + min_bytes])
    if not len(begin):
        return begin, end
    by = np.argsort(begin)
    begin, end = begin[by], np.maximum.accumulate(end[by])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[new], np.concatenate([end[:-1][new[1:]], end[-1:]])


def remove_repeats(docs: DataFrame, min_bytes: int = 100, id_col: str = "doc_id", text_col: str = "text", kept_col: str = "kept", removed_col: str = "removed") -> DataFrame:
    """docs with ``kept``, the bytes left of each text, and ``removed``, the maximal runs (from, to) of bytes taken out; see the
    module's text for what is removed and how odd rows are treated."""
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID))
    texts = docs.select(doc.alias("doc"), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    marks = _marked(texts, min_bytes)
    key, lists = fresh("_doc", docs), fresh("_marks", docs)
    beside = docs.drop(kept_col, removed_col).withColumn(key, doc)
    beside = beside.join(marks.select(F.col("doc").alias(key), F.col("marks").alias(lists)).hint("shuffle_hash"), key, "left").drop(key)
    out = beside.drop(lists).schema.add(kept_col, "binary").add(removed_col, ArrayType(StructType().add("start", "long").add("end", "long")))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(text_col).cast(pa.string()), batch.column(lists)
            for first, some in slices(texts):
                data, bounds = bytes_of(some)
                flat, row = _flat(marks.slice(first, len(some)))
                at, size, mask = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "size", "mask"))
                keys = _keys(data, bounds)
                own = np.flatnonzero((at >> 32 << 32) == keys[row])
                row = row[own]
                # texts side by side, with a place between them that no run covers
                begin, end = _removed(at[own] - keys[row] + bounds[row] + row, size[own], mask[own], min_bytes)
                of = np.searchsorted(bounds + np.arange(len(bounds)), begin, "right") - 1
                begin, end = begin - of, end - of
                edge = np.zeros(len(data) + 1, np.int8)
                edge[begin] += 1
                edge[end] -= 1  # a run may begin where the text before, and a run of it, ends
                stay = np.cumsum(edge[:-1], dtype=np.int8) == 0
                upto = np.concatenate([[0], np.cumsum(stay)])[bounds].astype(np.int32)
                kept = pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(upto), pa.py_buffer(data[stay])])
                runs = pa.StructArray.from_arrays([pa.array(begin - bounds[of]), pa.array(end - bounds[of])], fields=list(span))
                removed = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(some) + 1)).astype(np.int32)), runs)
                same = [c.slice(first, len(some)) for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != lists]
                names = [name for name in batch.schema.names if name != lists]
                yield pa.RecordBatch.from_arrays([*same, kept, removed], names=[*names, kept_col, removed_col])

    return beside.mapInArrow(tidy(run), out)
