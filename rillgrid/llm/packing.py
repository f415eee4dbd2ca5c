"""Best-fit packing of tokenized documents by linear grouping.

1. Every document becomes pieces of at most ``capacity`` tokens; only longer documents are cut.
2. The lengths are counted: at most ``capacity`` counters, however many documents there are. All planning works on these
   counters and on runs of equal sequences, so its size does not grow with the input.
3. Large lengths are sorted and split into groups of equal cardinality; each length counts as its group's largest
   (linear grouping). With so few sizes, the configurations that fill a sequence best are found by dynamic programming
   and used as often as the groups last.
4. The actual lengths take their groups' places, which leaves room; the small lengths then go, longest first, to the
   fullest sequence that has room for them (best fit), and new sequences are opened only when none has.
5. Pieces of a length are numbered, and the plan gives each number its sequence and offset.

Null texts count as empty; an empty document is one piece that holds just the end token. Ties and repeated rows each get
their own place; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.llm.common import byte_offsets, coded_words, cut, empty_if_null, slices, tidy, tokenizer_path

MEMO_WORDS = 200_000  # parts of texts whose ids one task keeps
END_SIGNS = ".,!?;:&#$%*"  # signs that the tokenizer parts from a word before them
#: How tokenizers of whole words part a text (a fixed value of their files).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: (n, groups): lengths over capacity / n are large and form so many groups. All are planned; the one with the fewest sequences counts.
SETTINGS = ((2, 12), (3, 12), (4, 96), (8, 96))
BUCKETS, BUCKET_ROWS = 64, 1_000_000  # the pieces of one length are numbered in so many parts at least, or in one for so many pieces of all


class ChunkIds:
    """Ids of texts from the ids of their parts, which are looked up once.

    For a tokenizer of whole lower-case words (``by_words``), no token spans a blank, nor the end of a word and a sign after
    it, and case does not matter: a text is parted by blanks, and a part that is letters and END_SIGNS into its lower-case
    word and its signs. Ids of the first MEMO_WORDS parts are kept, among them the frequent ones. With any other tokenizer
    each text goes to the library as it is.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.by_words = self._is_by_words()
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)  # tokens that end a word
        self.ends[[k for w, k in names.items() if w.endswith("</w>")]] = True
        self.known, self.ids, self.sizes = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _is_by_words(self) -> bool:
        rules = json.loads(self.tokenizer.to_str())
        steps = lambda key, of: [x["type"] for x in (rules[key] or {}).get(of, [])]
        split = [x["pattern"].get("Regex") for x in (rules["pre_tokenizer"] or {}).get("pretokenizers", []) if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]]
        return rules["model"].get("end_of_word_suffix") == "</w>" and steps("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"] and split == [WORD_PATTERN] and not any(set(t["content"]) & set(END_SIGNS + " ") for t in rules["added_tokens"])

    def encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of some parts, one after the other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.fromiter((k for ids in found for k in ids), "<u4"), np.fromiter(map(len, found), np.int64, len(found))

    def of_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each part's begin, how many they are) of distinct parts."""
        at = pc.index_in(parts, value_set=self.known)
        missed = parts.filter(pc.is_null(at))
        at = np.asarray(at.fill_null(-1)).astype(np.int64)
        letters = np.asarray(pc.and_(pc.string_is_ascii(missed), pc.ascii_is_alpha(missed)))
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        missed = missed.take(pa.array(order))
        words, others = missed[: letters.sum()].to_pylist(), missed[letters.sum() :].to_pylist()
        # each word is one piece to the model, so the tokens that end words part them
        ids, _ = self.encoded([" ".join(words[i : i + 500]) for i in range(0, len(words), 500)])
        sizes = np.diff(np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1]))
        if len(sizes) != len(words):
            ids, sizes = self.encoded(words)
        other_ids, other_sizes = self.encoded(others)
        ids, sizes = np.concatenate([self.ids, ids, other_ids]), np.concatenate([self.sizes, sizes, other_sizes])
        number = np.empty(len(order), np.int64)
        number[order] = len(self.known) + np.arange(len(order))
        at[at < 0] = number
        starts = np.cumsum(sizes) - sizes
        got = starts[at], sizes[at]
        if len(self.known) < MEMO_WORDS:
            keep = np.arange(len(sizes)) < MEMO_WORDS
            keep[len(self.known) :] &= np.asarray(pc.binary_length(missed)) <= 64
            self.known = pa.concat_arrays([self.known, missed.filter(pa.array(keep[len(self.known) :]))])
            self.ids, self.sizes = ids[np.repeat(keep, sizes)], sizes[keep]
        return ids, *got

    def of_texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by end_id, and where each text's begin and end."""
        if not self.by_words:
            ids, sizes = self.encoded(texts.to_pylist())
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))
        chunks, codes, bounds = coded_words(pc.split_pattern(pc.replace_substring(texts, "\n", " "), " "))
        word = pc.ascii_rtrim(chunks, END_SIGNS)
        plain = pc.and_(pc.string_is_ascii(word), pc.ascii_is_alpha(word))
        last = pc.utf8_slice_codeunits(word, -1)
        other = pc.and_(pc.utf8_is_alpha(word), pc.and_(pc.less(last, "\u0250"), pc.not_equal(last, "İ")))
        word = pc.if_else(plain, pc.ascii_lower(word), pc.if_else(other, word, chunks))
        # what is left of each chunk: its end signs
        data, ends = byte_offsets(chunks)
        length = np.diff(ends) - np.asarray(pc.binary_length(word))
        upto = np.concatenate([[0], np.cumsum(length)])
        signs = data[np.repeat(ends[1:] - length - upto[:-1], length) + np.arange(upto[-1])]
        signs = pa.StringArray.from_buffers(len(chunks), pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(signs))
        parts = pa.concat_arrays([word, signs]).dictionary_encode()
        pool, starts, sizes = self.of_parts(parts.dictionary)
        of_word, of_signs = np.asarray(parts.indices).reshape(2, -1)
        pairs = np.stack([of_word, of_signs], axis=1).ravel()
        # the ids of each distinct chunk, and as one more chunk the end; then those of all chunks in their order
        size = sizes[pairs]
        to = np.cumsum(size)
        ids = pool[np.repeat(starts[pairs] - (to - size), size) + np.arange(to[-1] if len(to) else 0)]
        each = np.concatenate([[0], to[1::2], [len(ids) + 1]]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(each), pa.array(np.append(ids, np.uint32(end_id))))
        got = lists.take(pa.array(np.insert(codes, bounds[1:], len(chunks))))
        offsets = np.asarray(got.offsets)
        return np.asarray(got.values), offsets[bounds + np.arange(len(bounds))]


_held: dict[str, ChunkIds] = {}


def pieces(docs: DataFrame, tokenizer_file: str | None = None, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    path = tokenizer_file or tokenizer_path("word_bpe_49k.json")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), empty_if_null(F.col(f"`{text_col}`")).alias("text"))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        chunk_ids = _held.get(path)
        if chunk_ids is None:
            chunk_ids = _held[path] = ChunkIds(path)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                ids, bounds = chunk_ids.of_texts(texts, end_id)
                many = -(-np.diff(bounds) // capacity)
                doc = np.repeat(np.arange(len(texts)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                at = bounds[:-1][doc] + start
                upto = np.minimum(at + capacity, bounds[1:][doc])
                crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), upto.tolist(), strict=True)), np.int64, len(doc))
                columns = [batch.column(0).slice(first, len(texts)).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array((upto - at).astype(np.int64)), pa.array(crc)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(tidy(cut_up), f"`{id_col}` long, piece int, start long, length long, ids_crc32 long")


def grouped(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """The large lengths, longest first, in groups of equal cardinality: [(length, count), ...] each. A length may span groups."""
    total = sum(counts.values())
    k = min(groups, total)
    out: list[list[tuple[int, int]]] = [[] for _ in range(k)]
    seen = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            g = seen * k // total
            fits = min(left, -(-(g + 1) * total // k) - seen)
            out[g].append((length, fits))
            seen, left = seen + fits, left - fits
    return [g for g in out if g]


def best_configuration(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each size fill one sequence most, with no more of a size than are left, and one of the largest at least."""
    first = next(i for i, n in enumerate(left) if n)
    room = capacity - sizes[first]
    # reach[w]: how w tokens are made up, as counts by size; few sizes, each a few times at most
    reach: dict[int, tuple[int, ...]] = {0: (0,) * len(sizes)}
    for i, size in enumerate(sizes):
        most = left[i] - (i == first)
        if most <= 0 or size > room:
            continue
        for w in sorted(reach):
            made = reach[w]
            for n in range(1, min(most, (room - w) // size) + 1):
                if w + n * size not in reach:
                    reach[w + n * size] = (*made[:i], n, *made[i + 1 :])
    best = list(reach[max(reach)])
    best[first] += 1
    return best


class Runs:
    """Equal sequences side by side: (first sequence, how many), by the room they have left."""

    def __init__(self):
        self.by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []

    def add(self, room: int, first: int, n: int) -> None:
        if n > 0 and room > 0:
            if not self.by_room[room]:
                bisect.insort(self.rooms, room)
            self.by_room[room].append((first, n))

    def take(self, need: int, most: int) -> tuple[int, int, int] | None:
        """Up to most sequences with the least room that is enough: room, first, how many."""
        at = bisect.bisect_left(self.rooms, need)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.by_room[room].pop()
        if n > most:
            self.by_room[room].append((first + most, n - most))
        if not self.by_room[room]:
            self.rooms.pop(at)
        return room, first, min(n, most)


def plan(counts: dict[int, int], capacity: int, large: int, groups: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, how many, first sequence, offset): pieces number k and on of a length go, one each, to
    sequences first and on at that offset. Its size depends on capacity and groups, not on how many pieces there are."""
    out: list[tuple[int, int, int, int, int]] = []
    runs, used, sequences = Runs(), defaultdict(int), 0

    def place(length: int, n: int, first: int, room: int) -> None:
        out.append((length, used[length], n, first, capacity - room))
        used[length] += n

    split = capacity // large
    if whole := counts.get(capacity, 0):
        place(capacity, whole, 0, capacity)
        sequences = whole
    sets = grouped({s: n for s, n in counts.items() if split < s < capacity}, groups)
    sizes = [g[0][0] for g in sets]  # each length counts as the largest of its group
    left = [sum(n for _, n in g) for g in sets]
    queues = [list(reversed(g)) for g in sets]  # the next actual length is last
    while any(left):
        config = best_configuration(sizes, left, capacity)
        times = min(left[i] // n for i, n in enumerate(config) if n)
        block: list[tuple[int, int, int]] = [(sequences, times, capacity)]  # first, how many, room
        for i, n in enumerate(config):
            for _ in range(n):  # the actual lengths of group i take one place in each sequence of the block
                filled = []
                for first, many, room in block:
                    while many:
                        length, count = queues[i].pop()
                        fits = min(count, many)
                        if fits < count:
                            queues[i].append((length, count - fits))
                        place(length, fits, first, room)
                        filled.append((first, fits, room - length))
                        first, many = first + fits, many - fits
                block = filled
            left[i] -= n * times
        for first, many, room in block:
            runs.add(room, first, many)
        sequences += times
    for length in sorted((s for s in counts if s <= split), reverse=True):
        n = counts[length]
        while n:
            got = runs.take(length, n)
            if got is None:  # no sequence has room: open as many as these pieces fill
                fresh = -(-n // (capacity // length))
                runs.add(capacity, sequences, fresh)
                sequences += fresh
                continue
            room, first, many = got
            place(length, many, first, room)
            runs.add(room - length, first, many)
            n -= many
    return out


def pack(docs: DataFrame, tokenizer_file: str | None = None, capacity: int = 4096, end_id: int = 1, settings: tuple[tuple[int, int], ...] = SETTINGS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with sequence_id and offset; the pieces of a sequence lie side by side from 0 and hold at most capacity tokens."""
    spark = docs.sparkSession
    cut_up = cut(pieces(docs, tokenizer_file, capacity, end_id, id_col, text_col))
    buckets = max(BUCKETS, cut_up.count() // BUCKET_ROWS)
    cut_up = cut_up.withColumn("bucket", F.pmod(F.xxhash64(id_col, "piece"), F.lit(buckets)).cast("int"))
    # number the pieces of each length: inside its buckets, after the buckets before
    sums = cut_up.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    sums = cut(sums.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")))
    counts = {r.length: r.n for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    rows = min((plan(counts, capacity, *s) for s in settings), key=lambda p: max((first + n for _, _, n, first, _ in p), default=0))
    places = spark.createDataFrame(rows, "length long, k long, n long, first long, offset long")
    # of one length: its runs of numbers as one sorted array, so that each piece meets one row
    by_length = places.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("k", "n", "first", "offset"))).alias("runs"))
    inside = Window.partitionBy("length", "bucket").orderBy(id_col, "piece", "ids_crc32")
    numbered = cut_up.withColumn("at", F.row_number().over(inside) - 1).join(sums.select("length", "bucket", "before"), ["length", "bucket"])
    numbered = numbered.withColumn("at", F.col("at") + F.col("before"))
    got = numbered.join(F.broadcast(by_length), "length").withColumn("run", F.expr("filter(runs, r -> at >= r.k AND at < r.k + r.n)[0]"))
    return got.select(id_col, "piece", "start", "length", "ids_crc32", (F.col("run.first") + F.col("at") - F.col("run.k")).alias("sequence_id"), F.col("run.offset").alias("offset"))
