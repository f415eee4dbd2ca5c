"""Spelling variants by asymmetric q-chunks.

Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least ``min_length`` code points and
``min_count`` occurrences in all documents. Two words are near if one inserted, deleted or replaced code point makes them equal.
A word's form is its near word with most occurrences (of equal ones the first in code-point order), if that has ``times`` as
many as the word; its root is where the forms lead.

1. Each text's words are counted in place; so what is shuffled is each task's different words.
2. Of two near words one gives its two disjoint chunks of half its length, the other all its positional grams of that size: an
   edit touches one chunk at most, so the other stands in both words, at places one apart at most. The join is on chunk, length
   and place, the grams' places moved by one at most, and pairs are verified by their edit distance.
   Both sides are shuffled; only the crowded chunks of step 3, at most two for each CROWDED words, may be broadcast.
3. A chunk of over CROWDED words would make many pairs that are not near. There what an edit leaves of the chunk's word is cut in
   two chunks again, and so on: the edit lies in what is between a common beginning and a common end, and half of that is
   common too. It ends where one code point is left, which the alphabet bounds.
4. Forms lead to words of 5 times the count (``times``), so pointers doubled a few times reach all roots.

As the given rule asks, if 199 divides the crc32 of ``<doc_id>:<lower-cased run>``, the run's code point number crc32 % length is
left out first (``slips`` in the call: texts as they are without). Null texts have no words; a null id is written as nothing. Rows
of one id count as often as they stand there. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import cut, discard, empty_if_null, slices, stored, tidy
from rillgrid.llm.text_bytes import Rolling, bytes_of, lowered, runs

CROWDED = 200  # words of a chunk that are compared as they are
HELD = 200_000  # different words that a task counts before it gives them on
LONG = 1_000  # bytes of a word beyond which it is not hashed with others
SLIP = 199

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True  # U+00C0 to U+00FF are 0xC3 and one byte more


def _letters(data: np.ndarray) -> np.ndarray:
    kind = _LETTER[data]
    kind[1:] |= data[:-1] == 0xC3
    return kind


def slipped(prefix: int, run: bytes) -> bytes:
    """run without the code point that the rule leaves out, if it does; prefix: crc32 of the id and a colon."""
    h = zlib.crc32(run, prefix)
    if h % SLIP:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def word_counts(docs: DataFrame, min_length: int, slips: bool) -> DataFrame:
    """(word, n) of docs (doc: string, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = defaultdict(int)

        def given() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return rows

        for batch in batches:
            ids = batch.column("doc").to_pylist()
            for at, some in slices(batch.column("text")):
                data, bounds = bytes_of(some)
                start, end, text = runs(_letters(data), bounds)
                two = np.concatenate([[0], np.cumsum(data == 0xC3)])
                long_enough = end - start - (two[end] - two[start]) >= min_length
                start, end, text = start[long_enough], end[long_enough], text[long_enough]
                low = lowered(data)
                once = end - start > LONG
                few = ~once
                # equal words of a text slip alike, so each is looked at once
                hashes = np.concatenate([_in_spans(low, start[few], end[few]), np.arange(once.sum(), dtype=np.uint64)])
                kind = np.concatenate([text[few], text[once]])
                start, end = np.concatenate([start[few], start[once]]), np.concatenate([end[few], end[once]])
                by = np.lexsort((hashes, end - start, kind))
                hashes, kind, start, end = hashes[by], kind[by], start[by], end[by]
                new = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (kind[1:] != kind[:-1]) | ((end - start)[1:] != (end - start)[:-1])])) if len(by) else by
                times = np.diff(np.append(new, len(by)))
                whole = low.tobytes()
                of, prefix = -1, 0
                for k, a, b, n in zip(kind[new].tolist(), start[new].tolist(), end[new].tolist(), times.tolist(), strict=True):
                    word = whole[a:b]
                    if slips:
                        if k != of:
                            of, prefix = k, zlib.crc32(f"{ids[at + k]}:".encode())
                        word = slipped(prefix, word)
                    held[word] += n
                if len(held) > HELD:
                    yield given()
        yield given()

    counted = docs.mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.char_length("word") >= min_length)


def _in_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, span: int = 3_000_000) -> np.ndarray:
    """Hashes of the spans, over some bytes at a time."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(end, start[at] + span, side="right")))
        out[at:upto] = Rolling(data[start[at] : end[upto - 1]]).of(start[at:upto] - start[at], end[at:upto] - start[at])
        at = upto
    return out


def _sub(word: Column, start: Column, size: Column) -> Column:
    """size code points from start, counted from 0."""
    return F.substring(word, start + 1, size)


def _lengths(words: DataFrame, min_length: int) -> DataFrame:
    """words with each length L that a near word can have."""
    size = F.char_length("word")
    return words.withColumn("L", F.explode(F.sequence(size - 1, size + 1))).where(F.col("L") >= min_length)


def _chunks(words: DataFrame) -> DataFrame:
    """(L, at, gram, word, n): the two disjoint chunks of each word."""
    size = F.char_length("word")
    q = F.floor(size / 2).cast("int")
    return words.withColumn("at", F.explode(F.array(F.lit(0), size - q))).select(size.alias("L"), "at", _sub(F.col("word"), F.col("at"), q).alias("gram"), "word", "n")


def _grams(words: DataFrame, min_length: int) -> DataFrame:
    """(L, at, gram, near, near_n): all positional grams of each word, for chunks one place from them at most."""
    q = F.floor(F.col("L") / 2).cast("int")
    every = _lengths(words, min_length).withColumn("p", F.explode(F.sequence(F.lit(0), F.char_length("word") - q)))
    chunk_at = F.filter(F.array(F.lit(0), F.col("L") - q), lambda at: F.abs(at - F.col("p")) <= 1)
    return every.withColumn("at", F.explode(F.array_distinct(chunk_at))).select("L", "at", _sub(F.col("word"), F.col("p"), q).alias("gram"), F.col("word").alias("near"), F.col("n").alias("near_n"))


def _frames(words: DataFrame, frames: Column) -> DataFrame:
    """words (word, n, L) by the common beginning of a code points and end of b of each frame, a struct<a, b>."""
    by = words.withColumn("_f", F.explode(frames)).select("*", "_f.a", "_f.b").drop("_f")
    by = by.where(F.col("a") + F.col("b") <= F.char_length("word"))
    return by.withColumns({"head": _sub(F.col("word"), F.lit(0), F.col("a")), "tail": F.substring(F.col("word"), F.char_length("word") - F.col("b") + 1, F.col("b"))})


def _frame(a: Column, b: Column) -> Column:
    return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))


def _pairs(words: DataFrame, min_length: int) -> DataFrame:
    """(word, n, near, near_n): every near word of each. words: word, n."""
    verified = (F.col("word") != F.col("near")) & (F.abs(F.char_length("word") - F.char_length("near")) <= 1) & (F.levenshtein("word", "near", 1) == 1)
    on = ["L", "at", "gram"]
    chunks, grams = _chunks(words), _grams(words, min_length)
    crowds = cut(chunks.groupBy(*on).agg(F.count("*").alias("_k")).where(F.col("_k") > CROWDED).drop("_k"))
    # the planner takes a row's grams for no more than the row and would broadcast them all
    found = grams.join(chunks.join(crowds, on, "left_anti").hint("merge"), on).where(verified).select("word", "n", "near", "near_n")
    if crowds.isEmpty():
        return found.distinct()
    # an edit after the first chunk leaves it a beginning, one before the last leaves it an end
    q = F.floor(F.col("L") / 2)
    first = F.col("at") == 0
    crowds = crowds.select("L", F.when(first, q).otherwise(0).cast("int").alias("a"), F.when(first, 0).otherwise(q).cast("int").alias("b"), F.when(first, F.col("gram")).otherwise("").alias("head"), F.when(first, F.lit("")).otherwise(F.col("gram")).alias("tail"))
    on = ["L", "a", "b", "head", "tail"]
    halves = F.array(_frame(q, F.lit(0)), _frame(F.lit(0), q))
    own = _frames(words.withColumn("L", F.char_length("word")), halves).join(crowds, on, "left_semi")
    other = _frames(_lengths(words, min_length), halves).join(crowds, on, "left_semi")
    while True:
        # half of what is between is common too
        a, b = F.col("a"), F.col("b")
        step = F.floor((F.col("L") - a - b) / 2)
        halves = F.array_distinct(F.array(_frame(a + step, b), _frame(a, b + step)))
        own, other = cut(_frames(own.select("word", "n", "L", "a", "b").withColumn("_h", halves).drop("a", "b"), F.col("_h")).drop("_h")), cut(_frames(other.select("word", "n", "L", "a", "b").withColumn("_h", halves).drop("a", "b"), F.col("_h")).drop("_h"))
        last = F.col("L") - F.col("a") - F.col("b") <= 1
        crowds = cut(own.where(~last).groupBy(*on).agg(F.count("*").alias("_k")).where(F.col("_k") > CROWDED).drop("_k"))
        near = other.select(*on, F.col("word").alias("near"), F.col("n").alias("near_n"))
        found = found.unionByName(near.join(own.join(crowds, on, "left_anti").hint("merge"), on).where(verified).select("word", "n", "near", "near_n"))
        if crowds.isEmpty():
            return found.distinct()
        own, other = own.join(crowds, on, "left_semi"), other.join(crowds, on, "left_semi")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where the forms lead."""
    now = cut(forms.select("word", F.col("form").alias("to")))
    while True:
        further = now.select(F.col("word").alias("to"), F.col("to").alias("_next"))
        moved = cut(now.join(further.hint("merge"), "to", "left").select("word", F.coalesce("_next", "to").alias("to"), F.col("_next").isNotNull().alias("_moved")))
        now = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return now.withColumnRenamed("to", "root")


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, times: int = 5, slips: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root of every word; see the module's text. min_length is 2 at least."""
    if min_length < 2 or times < 2:
        raise ValueError("words have two chunks, and forms are more frequent: min_length and times are 2 at least")
    texts = docs.select(empty_if_null(F.col(f"`{id_col}`")).alias("doc"), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    words = stored(word_counts(texts, min_length, slips).where(F.col("n") >= min_count))
    near = stored(_pairs(words, min_length))
    most = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("_best"))
    enough = -F.col("_best.m") >= times * F.col("n")
    judged = cut(most.select("word", "n_near", F.when(enough, F.col("_best.near")).alias("form"), F.when(enough, -F.col("_best.m")).alias("form_n")))
    roots = _roots(judged.where("form is not null"))
    out = words.join(judged.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left")
    out = cut(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")))
    discard(words, near)
    return out
