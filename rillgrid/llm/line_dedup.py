"""Line dedup by a deletion-neighbourhood join.

A line is its sequence of words (lower case, parted by white space). Two lines are near if one word edit - a word changed,
added or left out - makes them equal and the longer has ``min_words`` words at least, so that they agree in 0.8 of them; equal
sequences are near at any length. A line is dropped if a line near to it stands earlier in the corpus, by (id, place in the
text); of each set of near lines the earliest stays. Nearness is not carried on through third lines. Blank lines stay.

1. Equal lines are one class with its earliest place; each class has a polynomial hash of its words.
2. One edit leaves the first or the last half of a line as it is. Only classes that share such a half with another class
   go on, so the neighbourhood is made for few lines.
3. Each of those emits its deletion neighbourhood: a hashed key for every word left out. All lines that give the same key
   with a word left out at the same place are one word apart from each other; a line whose own hash equals such a key is
   one word shorter. So a group needs only its earliest line, not its pairs.
4. The word edit distance of each line and its earlier partner is verified on their words.

Null texts count as empty; texts without a word stay as they are. Repeated rows of one id count by their ids, so their lines
are equal lines in one place and stay together. Rows without an id keep all lines and drop none of others. An empty table
gives no rows; other columns are kept as they are, but for those named as the two counts, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import coded_words, cut, discard, empty_if_null, fresh, join_groups, slices, stored, tidy, word_hashes

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
FEW_DOCS, FEW_PLACES = 300_000, 4_000_000  # documents whose lists of places may be broadcast, and places of all of these


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Lines:
    """The lines of some texts, and hashes of any run of their words."""

    def __init__(self, texts: pa.Array):
        parted = pc.split_pattern(texts, "\n")
        self.of_text = np.asarray(parted.offsets).astype(np.int64) - parted.offsets[0].as_py()
        lines = parted.flatten()
        words, codes, ends = coded_words(pc.utf8_split_whitespace(pc.utf8_lower(lines)))
        filled = (np.asarray(pc.binary_length(words)) > 0)[codes]
        before = np.concatenate([[0], np.cumsum(filled)])
        self.starts = before[ends]  # of each line's words
        self.n = np.diff(self.starts)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.of_text))
        self.place = np.arange(len(self.n)) - self.of_text[self.text]
        with np.errstate(over="ignore"):
            h = word_hashes(words)[codes[filled]]
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(BASE, len(h)), dtype=np.uint64)])
            self.back = _powers(INVERSE, len(h) + 1)

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Polynomial of the words from a to b."""
        with np.errstate(over="ignore"):
            return (self.sums[b] - self.sums[a]) * self.back[a]


def _key(value: np.ndarray, n: np.ndarray, kind: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(value + n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(kind)).view(np.int64)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), values)


def line_hashes(texts: DataFrame, min_words: int) -> DataFrame:
    """(doc, place, h, halves) of every line with words: h is a hash of its words and their number, halves are keys of the
    halves that one edit can leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                lines = Lines(part)
                own = np.flatnonzero(lines.n)
                n, a, b = lines.n[own], lines.starts[own], lines.starts[own + 1]
                halves = []
                for longer in (0, 1):  # the pair's longer line has n or n + 1 words
                    half = np.maximum(n + longer - 1, 0) // 2
                    halves += [_key(lines.run(a, a + half), n + longer, 1), _key(lines.run(b - half, b), n + longer, 2)]
                some = np.stack([n >= min_words, n >= min_words, n >= min_words - 1, n >= min_words - 1], axis=1)
                ids = batch.column(0).slice(first, len(part)).take(pa.array(lines.text[own]))
                columns = [ids, pa.array(lines.place[own].astype(np.int32)), pa.array(_key(lines.run(a, b), n)), _lists(np.stack(halves, axis=1)[some], some.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "place", "h", "halves"])

    return texts.mapInArrow(tidy(run), "doc long, place int, h long, halves array<long>")


def _with_places(texts: DataFrame, places: DataFrame) -> DataFrame:
    """texts (doc, text) that have places, with the list of them. The lists are broadcast if they are few and hold few places."""
    lists = cut(places.groupBy("doc").agg(F.collect_set("place").alias("places")))
    return texts.join(_if_few(lists), "doc").select("doc", "text", "places")


def _if_few(lists: DataFrame) -> DataFrame:
    n, places = lists.agg(F.count("*"), F.sum(F.size("places"))).first()
    return F.broadcast(lists) if n <= FEW_DOCS and (places or 0) <= FEW_PLACES else lists


def _chosen(lines: Lines, lists: pa.Array) -> np.ndarray:
    """Numbers of the listed lines."""
    wanted = [lines.of_text[k] + np.asarray(x.values) for k, x in enumerate(lists)]
    return np.concatenate([*wanted, np.zeros(0, np.int64)]).astype(np.int64)


def neighbourhoods(texts: DataFrame, places: DataFrame, min_words: int) -> DataFrame:
    """(h, key, gone) for every word that is left out of the lines at these places, of min_words words at least: the line's
    hash, that of the rest, and the place of the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                lines = Lines(part)
                own = _chosen(lines, batch.column(2).slice(first, len(part)))
                own = own[lines.n[own] >= min_words]
                n, a = lines.n[own], lines.starts[own]
                line = np.repeat(np.arange(len(own)), n)
                gone = np.arange(n.sum()) - (np.cumsum(n) - n)[line]
                start, stop = a[line], (a + n)[line]
                with np.errstate(over="ignore"):  # what follows the gap moves up by one
                    value = lines.run(start, start + gone) + (lines.sums[stop] - lines.sums[start + gone + 1]) * lines.back[start + 1]
                columns = [_key(lines.run(a, a + n), n)[line], _key(value, (n - 1)[line]), gone.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "key", "gone"])

    return _with_places(texts, places).mapInArrow(tidy(run), "h long, key long, gone int")


def near_words(a: list[str], b: list[str], min_words: int) -> bool:
    """Whether one word edit at most makes them equal."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or max(len(a), len(b)) < min_words:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def _verified(pairs: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """pairs (h, first, partner) whose lines are near indeed: (h, partner)."""
    places = pairs.select("first.doc", "first.place").union(pairs.select("partner.doc", "partner.place")).distinct()

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ats, found = [], [], []
            for doc, text, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                parts = text.as_py().split("\n")
                docs += [doc] * len(at)
                ats += at
                found += [parts[k] for k in at]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ats, pa.int32()), pa.array(found, pa.string())], names=["doc", "place", "line"])

    lines = stored(_with_places(texts, places).mapInArrow(tidy(lines_of), "doc long, place int, line string"))
    one, two = (lines.select(F.struct("doc", "place").alias(c), F.col("line").alias(f"line_{c}")) for c in ("first", "partner"))
    both = pairs.join(one, "first").join(two, "partner").select("h", "partner", "line_first", "line_partner")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [pc.utf8_lower(batch.column(c)).to_pylist() for c in (2, 3)]
            keep = [near_words(a.split(), b.split(), min_words) for a, b in zip(*sides, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    out = cut(both.mapInArrow(tidy(check), "h long, partner struct<doc:long,place:int>"))
    discard(lines)
    return out


def dropped_lines(texts: DataFrame, min_words: int = 5) -> DataFrame:
    """(doc, place) of every line that an earlier one is near to. texts: (doc, text)."""
    lines = stored(line_hashes(texts, min_words))
    classes = stored(lines.groupBy("h").agg(F.min(F.struct("doc", "place")).alias("first"), F.count("*").alias("times"), F.first("halves").alias("halves")))
    # classes that share a half with another one
    halved = classes.select("h", F.explode("halves").alias("half"))
    shared = stored(_of_several(halved, "half"))
    sharing = join_groups(halved, shared, ["half"], "size").select("h").distinct()
    some = stored(classes.select("h", "first").join(sharing, "h"))
    around = stored(neighbourhoods(texts, some.select("first.doc", "first.place"), min_words))
    # keys that several classes have; a class's own hash is a key without a gap
    keys = around.union(some.select("h", F.col("h").alias("key"), F.lit(-1)))
    live = stored(_of_several(keys, "key"))
    met = stored(join_groups(keys, live, ["key"], "size").select("key", "gone", "h").join(some, "h"))
    discard(around, live, shared)
    gaps = met.where("gone >= 0")
    # a word changed: all that lose a word at one place to the same rest
    changed = cut(gaps.groupBy("key", "gone").agg(F.min("first").alias("partner"), F.count("*").alias("size")))
    changed = join_groups(gaps, changed, ["key", "gone"], "size").select("h", "partner")
    # a word added or left out: the rest is a line itself
    whole = met.where("gone < 0").select("key", F.col("h").alias("short"), F.col("first").alias("of_short"))
    longer = cut(gaps.groupBy("key").agg(F.min("first").alias("earliest"), F.count("*").alias("size")).join(whole, "key"))
    added = join_groups(gaps.select("key", "h"), longer, ["key"], "size").select("h", "of_short").union(longer.select("short", "earliest"))
    partners = changed.union(added).groupBy("h").agg(F.min("partner").alias("partner"))
    near = _verified(cut(partners.join(some, "h").where("partner < first")), texts, min_words)
    # of a class with an earlier partner all lines go, of others all but the first
    marked = classes.where("times > 1").select("h", "first", "times").join(near, "h", "full_outer")
    marked = stored(marked.select("h", F.coalesce("partner", "first").alias("kept"), F.coalesce("times", F.lit(1)).alias("times")))
    gone = join_groups(lines.select("doc", "place", "h"), marked, ["h"], "times").where(F.struct("doc", "place") > F.col("kept"))
    out = cut(gone.select("doc", "place"))
    discard(lines, classes, some, met, marked)
    return out


def _of_several(keys: DataFrame, key: str) -> DataFrame:
    """(key, size): keys that lines of several classes have, and how many rows have each."""
    return keys.groupBy(key).agg(F.min("h").alias("low"), F.max("h").alias("high"), F.count("*").alias("size")).where("low <> high").select(key, "size")


def dedup_lines(docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text", lines_col: str = "n_lines", dropped_col: str = "n_dropped") -> DataFrame:
    """docs with the text less its dropped lines, and the numbers of lines and dropped lines. A text of which nothing goes is as it was."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    doc, places = fresh("doc", docs), fresh("places", docs)
    lists = cut(dropped_lines(texts.where("doc is not null"), min_words).groupBy("doc").agg(F.collect_set("place").alias("places")))
    lists = _if_few(lists).withColumnsRenamed({"doc": doc, "places": places})
    joined = docs.join(lists, F.col(f"`{id_col}`").cast("long") == F.col(doc), "left")
    text = F.col(f"`{text_col}`")
    parts = F.split(empty_if_null(text), "\n", -1)
    # places that stay, by a hash set; the lines are bound once, so that a text takes time in proportion to its lines
    staying = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
    kept = F.transform(F.array(parts), lambda lines: F.array_join(F.transform(staying(lines), lambda k: F.get(lines, k)), "\n"))
    named = {c: F.col(f"`{c}`") for c in docs.columns if c not in (lines_col, dropped_col)}
    named[text_col] = F.when(F.col(places).isNull(), text).otherwise(F.get(kept, F.lit(0))).alias(text_col)
    return joined.select(*named.values(), F.size(parts).cast("long").alias(lines_col), F.coalesce(F.size(places), F.lit(0)).cast("long").alias(dropped_col))
