"""Toxicity by subword-bag embeddings, averaged into a linear softmax and trained jointly.

A word is the bag of its hashed character n-grams, 4 and 5 long, with marks at both ends. A document is the mean of its
distinct words, times the root of their number (so that a few words of many still show), a word the mean of its n-grams'
embeddings; a linear softmax on it gives the two classes. Embeddings and softmax are trained together in numpy on a bounded,
documented sample of labelled rows (``teaching_rows``), in which a row of the rarer class weighs as the root of how much rarer it is. A word never met shares
n-grams with those that were, so misspellings score like the words they come from.

As everything is linear up to the softmax, a document's score needs one number an n-gram.

Null texts count as empty; an empty text has the score of no words at all. Repeated rows give repeated results; ties cannot
arise; other columns are ignored; an empty table gives no rows. If one class has no labelled row, every score is that
class's share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import byte_offsets, coded_words, empty_if_null, slices, tidy
from rillgrid.llm.labelled import held_out, teaching_rows

SAMPLE = 6000  # labelled rows, at most, that it is trained on
BUCKETS = 1 << 17  # of n-gram hashes
DIM = 2
BATCH, EPOCHS, RATE, FLOOR, DECAY = 200, 20, 0.1, 0.9998, 1e-4
BLANK = 30  # words without a meaning that each mean takes in, so that a few words alone decide nothing
SLICE_BYTES = 3_000_000  # text that a task holds as words at once
ROWS = 1000  # documents that are filtered at once


def ngrams(words: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of every word."""
    sizes = np.asarray(pc.utf8_length(words)).astype(np.int64) + 2
    data, offsets = byte_offsets(pc.binary_join_element_wise("<", words, ">", ""))
    text = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    left = np.cumsum(sizes)[word] - np.arange(len(text)) if len(text) else np.zeros(0, np.int64)
    rows, found = [], []
    with np.errstate(over="ignore"):
        h = np.full(len(text), np.uint64(0xCBF29CE484222325))
        for n in range(1, 6):
            h = h[: len(text) - n + 1] if n > 1 else h
            h = (h ^ text[n - 1 :]) * np.uint64(0x100000001B3) if len(text) >= n else h[:0]
            if n >= 4:
                ok = np.flatnonzero(left[: len(h)] >= n)
                x = h[ok]
                rows.append(word[ok])
                found.append((((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32))
    return np.concatenate(rows), np.concatenate(found)


def bags(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-case words parted by white space, each once a text: (distinct words, code of each, bounds of each text)."""
    words, codes, ends = coded_words(pc.utf8_split_whitespace(pc.utf8_lower(texts)))
    each = np.repeat(np.arange(len(texts)), np.diff(ends)) * max(1, len(words)) + codes
    each.sort()
    each = each[np.concatenate([[True], each[1:] != each[:-1]])] if len(each) else each
    return words, each % max(1, len(words)), np.searchsorted(each, np.arange(len(texts) + 1) * max(1, len(words)))


def _bag_batches(rows: list[tuple[str, int]], seed: int) -> list[tuple[np.ndarray, ...]]:
    """Per batch of documents: (document number in it, bucket, weight) of every n-gram, and the labels."""
    order = np.random.default_rng(seed).permutation(len(rows))
    out = []
    for at in range(0, len(rows), BATCH):
        chosen = [rows[k] for k in order[at : at + BATCH]]
        words, codes, ends = bags(pa.array([text for text, _ in chosen], pa.string()))
        doc = np.repeat(np.arange(len(chosen)), np.diff(ends))
        row, gram = ngrams(words)
        each = np.bincount(row, minlength=len(words))
        first = np.cumsum(each) - each
        by_word = gram[np.argsort(row, kind="stable")]
        size = each[codes]
        upto = np.cumsum(size)
        grams = by_word[np.repeat(first[codes] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]
        weight = np.repeat(1 / np.maximum(size, 1) / np.sqrt(np.diff(ends) + BLANK)[doc], size)
        key, at_key = np.unique(np.repeat(doc, size) * BUCKETS + grams, return_inverse=True)
        out.append(((key // BUCKETS).astype(np.int32), (key % BUCKETS).astype(np.int32), np.bincount(at_key, weight, len(key)).astype(np.float32), np.array([y for _, y in chosen])))
    return out


def train(rows: list[tuple[str, int]], seed: int = 11) -> tuple[np.ndarray, float]:
    """One number a bucket, and the bias: the difference of the two classes' logits is linear in a document's n-grams."""
    share = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
    if len({y for _, y in rows}) < 2:
        return np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    batches = _bag_batches(rows, seed)
    weights = np.sqrt(np.maximum(1.0, np.array([share, 1 - share]) / np.array([1 - share, share])))
    # how far an n-gram's share in a document usually goes, with a floor: those met in a few documents must not weigh as those met in many
    square = sum(np.bincount(bucket, weight**2, BUCKETS) for _, bucket, weight, _ in batches) / len(rows)
    scale = 1 / (np.sqrt(square) + np.quantile(np.sqrt(square[square > 0]), FLOOR))
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.01, (BUCKETS, DIM)), rng.normal(0, 1.0, (DIM, 2)), np.array([np.log(1 - share), np.log(share)])]
    speed = [np.zeros_like(p) for p in params]
    for epoch in range(EPOCHS):
        for doc, bucket, weight, y in batches:
            embed, out, bias = params
            x = weight * scale[bucket]
            n = len(y)
            of_doc = np.stack([np.bincount(doc, x * embed[bucket, d], n) for d in range(DIM)], axis=1)
            logit = of_doc @ out + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p *= weights[y][:, None] / n
            to_doc = p @ out.T
            grads = [np.stack([np.bincount(bucket, x * to_doc[doc, d], BUCKETS) for d in range(DIM)], axis=1) + DECAY * embed, of_doc.T @ p + DECAY * out, p.sum(axis=0)]
            for k, g in enumerate(grads):
                speed[k] = 0.9 * speed[k] - RATE / (1 + epoch) * g
                params[k] = params[k] + speed[k]
    embed, out, bias = params
    return scale * (embed @ (out[:, 1] - out[:, 0])), float(bias[1] - bias[0])


def logits(texts: pa.Array, values: np.ndarray, bias: float) -> np.ndarray:
    """The logit of each text: the sum of its words, each the mean of its n-grams' values, by the root of their number."""
    out = [np.zeros(0)]
    for _, part in slices(texts, SLICE_BYTES):
        words, codes, ends = bags(part)
        row, gram = ngrams(words)
        word = np.bincount(row, values[gram], len(words)) / np.maximum(np.bincount(row, minlength=len(words)), 1)
        scan = np.concatenate([[0.0], np.cumsum(word[codes])])
        out.append((scan[ends[1:]] - scan[ends[:-1]]) / np.sqrt(np.diff(ends) + BLANK) + bias)
    return np.concatenate(out)


def _score(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """id, held_out, score, predicted."""
    values, bias = train(teaching_rows(docs, labels, label_col, sample, id_col, text_col))
    model = docs.sparkSession.sparkContext.broadcast((values, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_score(logits(batch.column(1), *model.value)))], names=[id_col, "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    out = rows.mapInArrow(tidy(run), f"`{id_col}` long, score double")
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """docs, with all their columns, less the rows that score the threshold or more."""
    model = docs.sparkSession.sparkContext.broadcast(train(teaching_rows(docs, labels, label_col, sample, id_col, text_col)))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):  # a part of a batch at a time, so that no copy of a whole batch is made
                part = batch.slice(k, ROWS)
                yield part.filter(pa.array(_score(logits(pc.fill_null(part.column(at), ""), *model.value)) < threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
