"""Ranked lexical search of many queries at once, by common-subexpression evaluation.

A document's score for an item sums, over the item's terms, w * ((1000000000 * tf) div (1000 * tf + 8 * m)): w is the term's weight
floor(1000 * ln((2 * N + 2) / (2 * df + 1))), m the document's 10 + (90 * n * N) div L; N documents have terms, L is all their
terms with repeats, n one document's. Terms are runs of ASCII letters, digits and all code points beyond ASCII, only A-Z lower-cased.

1. The items' terms are few and go to all tasks in blocks of about BLOCK_TERMS (item, term) rows. One pass over the documents
   counts N, L and each term's documents.
2. Shared sets of terms are mined among a block's items: terms that the same items have are one set; then the two sets that most
   items have both become one, again and again. So items are the roots of a graph in which every set that several items share
   stands once.
3. A second pass scores. For some documents at a time each term gets its values, then each set, in the graph's order, its partial
   sums, made once of two smaller ones, and each item the sum of the few sets left of it. All items come from these.
4. A task keeps each item's k best documents so far and gives those only; the k best of all tasks are the answer.

Integers are 64-bit; scores are exact whatever the order of sums. Null and empty texts have no terms. A row is a document: rows that
share an id are ranked each by itself, a null id comes after the others of a score. Rows of one item id (null among them) are one
item, with the terms of all. Items without terms, or none that a document has, give no rows; so do empty tables. Terms are looked
up by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.llm.common import cut, empty_if_null, slices, stored, tidy
from rillgrid.llm.text_bytes import Rolling, bytes_of, lowered, runs

BLOCK_TERMS = 100_000  # (item, term) rows that tasks hold at once: some 20 MB with what is made of them
MINED = 64  # sets of an item, the most shared first, of which pairs are looked for; the others are added one by one
CELLS = 2_000_000  # sums that a task holds at once
SPAN = 3_000_000  # bytes of a text that are hashed at once

#: A byte of a term: a digit, a letter, or part of a code point beyond ASCII.
IN_TERM = np.zeros(256, bool)
IN_TERM[48:58] = IN_TERM[65:91] = IN_TERM[97:123] = IN_TERM[128:] = True


@dataclass
class Plan:
    """A block's items as a graph of term sets."""

    hashes: np.ndarray  # of the terms, ascending
    longest: int  # bytes of a term
    by_set: np.ndarray  # terms in the order of their first sets
    firsts: np.ndarray  # where in that order each first set begins
    pairs: list[tuple[int, int]]  # further sets, each the union of two before it
    parts: np.ndarray  # the sets of all items, item by item
    begins: np.ndarray  # where in parts each item begins


def shared_sets(items: list[set[int]]) -> tuple[list[list[int]], list[tuple[int, int]], list[list[int]]]:
    """(first sets of terms, pairs of sets that are further sets, sets of each item) of items' terms."""
    holders: dict[int, list[int]] = defaultdict(list)
    for k, terms in enumerate(items):
        for t in terms:
            holders[t].append(k)
    alike: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for t in sorted(holders):
        alike[tuple(holders[t])].append(t)
    firsts = list(alike.values())
    own: list[set[int]] = [set() for _ in items]
    for s, who in enumerate(alike):
        for k in who:
            own[k].add(s)
    having = {s: set(who) for s, who in enumerate(alike)}
    together: Counter = Counter()
    mined: list[set[int]] = []
    for sets in own:
        some = sorted((s for s in sets if len(having[s]) > 1), key=lambda s: (-len(having[s]), s))[:MINED]
        mined.append(set(some))
        together.update((a, b) if a < b else (b, a) for i, a in enumerate(some) for b in some[i + 1 :])
    heap = [(-n, pair) for pair, n in together.items() if n > 1]
    heapify(heap)
    pairs = []
    while heap:
        n, (a, b) = heappop(heap)
        if together[a, b] != -n:
            continue
        new = len(firsts) + len(pairs)
        pairs.append((a, b))
        for k in [k for k in (having[a] & having[b]) if a in mined[k] and b in mined[k]]:
            mined[k] -= {a, b}
            own[k] -= {a, b}
            having[a].discard(k)
            having[b].discard(k)
            for c in mined[k]:
                for old in (a, b):
                    pair = (old, c) if old < c else (c, old)
                    together[pair] -= 1
                    if together[pair] > 1:
                        heappush(heap, (-together[pair], pair))
                together[c, new] += 1
                if together[c, new] > 1:
                    heappush(heap, (-together[c, new], (c, new)))
            mined[k].add(new)
            own[k].add(new)
            having.setdefault(new, set()).add(k)
        together[a, b] = 0
    return firsts, pairs, [sorted(sets) for sets in own]


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(IN_TERM[data], bounds)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the lower-cased terms, over spans of the bytes at a time."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(end, start[at] + SPAN, side="right")))
        base, last = start[at], end[upto - 1]
        out[at:upto] = Rolling(lowered(data[base:last])).of(start[at:upto] - base, end[at:upto] - base)
        at = upto
    return out


def hashes_of(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return _hashes(data, ends - [len(w) for w in words], ends)


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term) of all items, each term once."""
    kind = items.schema[item_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, some in slices(batch.column("text")):
                data, bounds = bytes_of(some)
                start, end, row = _terms(data, bounds)
                low = lowered(data)
                terms = [low[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(row + at)), pa.array(terms, pa.binary())], names=["item", "term"])

    texts = items.select(F.col(f"`{item_col}`").alias("item"), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    return texts.mapInArrow(tidy(run), f"item {kind}, term binary").distinct()


def plan_of(rows: list[tuple[object, bytes]]) -> tuple[list[object], Plan]:
    """(items, their graph) of a block's (item, term) rows."""
    ids: dict[object, int] = {}
    words = sorted({bytes(t) for _, t in rows})
    hashes = hashes_of(words)
    order = np.argsort(hashes)
    place = {words[k]: i for i, k in enumerate(order.tolist())}
    sets: list[set[int]] = []
    for item, term in rows:
        k = ids.setdefault(item, len(ids))
        if k == len(sets):
            sets.append(set())
        sets[k].add(place[bytes(term)])
    firsts, pairs, own = shared_sets(sets)
    sizes, n_own = [len(s) for s in firsts], [len(s) for s in own]
    return list(ids), Plan(
        hashes[order], max(map(len, words)), np.concatenate(firsts), np.cumsum([0, *sizes[:-1]]), pairs, np.concatenate(own), np.cumsum([0, *n_own[:-1]])
    )


def _found(texts: pa.Array, plan: Plan) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, terms of each text, and of the texts' terms that items have: text, term, times) for runs of texts."""
    for at, some in slices(texts):
        data, bounds = bytes_of(some)
        start, end, text = _terms(data, bounds)
        n = np.bincount(text, minlength=len(some))
        short = end - start <= plan.longest
        start, end, text = start[short], end[short], text[short]
        h = _hashes(data, start, end)
        term = np.minimum(np.searchsorted(plan.hashes, h), len(plan.hashes) - 1)
        known = plan.hashes[term] == h
        key, times = np.unique(text[known] * len(plan.hashes) + term[known], return_counts=True)
        yield at, n, key // len(plan.hashes), key % len(plan.hashes), times


def counts(docs: DataFrame, plan: Plan) -> tuple[int, int, np.ndarray]:
    """(N, L, documents of each term). docs: text. A task gives one row for each term it has met."""
    width = len(plan.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total, length = np.zeros(width, np.int64), 0, 0
        for batch in batches:
            for _, n, _, term, _ in _found(batch.column("text"), plan):
                df += np.bincount(term, minlength=width)
                total += int((n > 0).sum())
                length += int(n.sum())
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([met, [-1, -2]])), pa.array(np.concatenate([df[met], [total, length]]))], names=["term", "n"])

    got = {r.term: r.n for r in docs.select("text").mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return got.get(-1, 0), got.get(-2, 0), np.array([got.get(t, 0) for t in range(width)], np.int64)


def scores(plan: Plan, weight: np.ndarray, norm: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
    """items x documents; (doc, term, times) are the terms found, norm each document's m."""
    value = np.zeros((len(plan.hashes), len(norm)), np.int64)
    value[term, doc] = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * norm[doc]))
    sums = np.empty((len(plan.firsts) + len(plan.pairs), len(norm)), np.int64)
    np.add.reduceat(value[plan.by_set], plan.firsts, axis=0, out=sums[: len(plan.firsts)])
    for k, (a, b) in enumerate(plan.pairs, len(plan.firsts)):
        np.add(sums[a], sums[b], out=sums[k])
    return np.add.reduceat(sums[plan.parts], plan.begins, axis=0)


class Best:
    """The k best (score, document) of each item so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.rows, self.least = k, [[] for _ in range(items)], np.ones(items, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        item, d = np.nonzero(score >= self.least[:, None])
        if not len(item):
            return
        value = score[item, d]
        by = np.lexsort((ids[d], unknown[d], -value, item))
        item, d, value = item[by], d[by], value[by]
        first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        for i, j, v in zip(item[rank < self.k].tolist(), d[rank < self.k].tolist(), value[rank < self.k].tolist(), strict=True):
            self.rows[i].append((-v, bool(unknown[j]), int(ids[j])))
        for i in np.unique(item).tolist():
            self.rows[i] = sorted(self.rows[i])[: self.k]
            if len(self.rows[i]) == self.k:
                self.least[i] = -self.rows[i][-1][0]


def _best_of_tasks(docs: DataFrame, plan: Plan, weight: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    """(item number, doc_id, unknown, score): each task's k best of each item. docs: doc, text."""
    step = max(1, CELLS // (len(plan.hashes) + len(plan.firsts) + len(plan.pairs) + len(plan.parts)))
    n_items = len(plan.begins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, k)
        for batch in batches:
            ids = batch.column("doc").fill_null(0).to_numpy()
            unknown = batch.column("doc").is_null().to_numpy(zero_copy_only=False)
            for at, n, doc, term, times in _found(batch.column("text"), plan):
                norm = np.array([10 + 90 * v * n_docs // length for v in n.tolist()], np.int64)
                for low in range(0, len(n), step):
                    high = min(low + step, len(n))
                    a, b = np.searchsorted(doc, [low, high])
                    got = scores(plan, weight, norm[low:high], doc[a:b] - low, term[a:b], times[a:b])
                    best.add(got, ids[at + low : at + high], unknown[at + low : at + high])
        flat = [(i, None if no else d, -v) for i, rows in enumerate(best.rows) for v, no, d in rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in flat], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])

    return docs.mapInArrow(tidy(run), "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0; see the module's text."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    terms = stored(item_terms(items, item_col, item_text_col))
    kind = dict(terms.dtypes)["item"]
    blocks = terms.count() // BLOCK_TERMS + 1
    terms = terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    out = spark.createDataFrame([], f"{item_col} {kind}, doc_id long, score long")
    for block in range(blocks):
        rows = [(r.item, r.term) for r in terms.where(F.col("block") == block).orderBy("item", "term").collect()]
        if not rows:
            continue
        ids, plan = plan_of(rows)
        n_docs, length, df = counts(texts, plan)
        if not length:
            break
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, `{item_col}` {kind}")
        best = _best_of_tasks(texts, plan, weight, n_docs, length, k).join(F.broadcast(names), "item")
        best = best.select(F.col(f"`{item_col}`"), "doc_id", "score")
        out = out.unionByName(cut(best) if blocks > 1 else best)
    order = Window.partitionBy(item_col).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(item_col, "rank", "doc_id", "score")
