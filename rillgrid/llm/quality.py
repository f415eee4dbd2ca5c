"""Quality by naive Bayes support vectors.

Features are indicators of hashed n-grams (1 to 3) over the text's tokens. A token is a word's shape (letters of either
case, digits and signs, runs shortened), marked when the word repeats the one before it; words themselves, in lower case,
are features of their own. A word of more than PIECE characters (text without white space) is dealt into pieces of PIECE,
which are tokens and words like others; the whole word stays a feature too. Each indicator is scaled by its log-count ratio between the two classes (naive Bayes), and a
linear hinge-loss model is fitted to the scaled indicators by dual coordinate descent. A logistic curve fitted to margins
of rows that a first fit did not see turns margins into scores.

The model is fitted in numpy on a bounded, documented sample of labelled rows (``teaching_rows``); scoring covers whole
texts. White space at an end of a text parts an empty word from it. Null texts count as empty; an empty text is one empty word. Repeated rows give repeated results; other
columns are ignored; an empty table gives no rows. If one class has no labelled row, every score is that class's share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import coded, empty_if_null, slices, tidy
from rillgrid.llm.labelled import held_out, teaching_rows

SAMPLE = 6000  # labelled rows, at most, that it is fitted on
BUCKETS = 1 << 18  # of n-gram hashes
ALPHA = 1.0  # added to each count
PENALTY = 0.01  # C of the hinge loss
PASSES = 12  # of dual coordinate descent
MEMO_WORDS = 200_000
PIECE = 64  # characters of a token at most; words up to it are remembered

_RUNS = re.compile(r"([^\W\d_]+)|(\d+)|(.)\3*", re.DOTALL)


def _shape(word: str) -> str:
    def one(m: re.Match) -> str:
        if m[1]:
            w = m[1]
            return ("a" if w.islower() else "A" if len(w) > 1 and w.isupper() else "Aa" if w[1:].islower() or len(w) == 1 else "aA")
        return "0" if m[2] else m[3] + ("+" if len(m[0]) > 1 else "")

    return _RUNS.sub(one, word)


class Shapes(dict):
    """Hash of each word's shape."""

    def __missing__(self, word: str) -> int:
        import zlib

        got = zlib.crc32(_shape(word).encode("utf-8", "surrogatepass"))
        if len(self) < MEMO_WORDS and len(word) <= PIECE:
            self[word] = got
        return got


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _pieces(words: list[str], codes: np.ndarray, ends: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """coded()'s lists with each word of more than PIECE characters dealt into pieces."""
    number: dict[str, int] = {}
    parts = [[number.setdefault(w[k : k + PIECE], len(number)) for k in range(0, max(len(w), 1), PIECE)] for w in words]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.fromiter((c for p in parts for c in p), np.int64, size.sum())
    many = size[codes]
    at = np.concatenate([[0], np.cumsum(many)])
    start = (np.cumsum(size) - size)[codes]
    return list(number), flat[np.repeat(start - at[:-1], many) + np.arange(at[-1])], at[ends]


def features(texts: pa.Array, shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of each text's distinct features, in order."""
    words, codes, ends = coded(pc.utf8_split_whitespace(texts))
    import xxhash

    def lowered(words: list[str]) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(w.lower().encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))

    found, rows = [], []
    is_long = np.fromiter((len(w) > PIECE for w in words), bool, len(words))
    if is_long.any():
        own = is_long[codes]
        found.append(lowered(words)[codes[own]] ^ np.uint64(0x5BD1E995))
        rows.append(np.repeat(np.arange(len(texts)), np.diff(ends)).astype(np.uint64)[own])
        words, codes, ends = _pieces(words, codes, ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(ends)).astype(np.uint64)
    shape = np.fromiter(map(shapes.__getitem__, words), np.uint64, len(words))
    lower = lowered(words)
    with np.errstate(over="ignore"):
        token = shape[codes] * np.uint64(2)
        if len(codes) > 1:
            token[1:] += ((codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])).astype(np.uint64)
        found.append(lower[codes] ^ np.uint64(0x5BD1E995))
        rows.append(doc)
        h = token + np.uint64(1)
        for n in (1, 2, 3):
            if n > 1:
                h = _mix(h[:-1]) + token[n - 1 :] if len(h) else h
                same = doc[: len(h)] == doc[n - 1 :]
                found.append(_mix(h[same] + np.uint64(n)))
                rows.append(doc[: len(h)][same])
            else:
                found.append(_mix(h))
                rows.append(doc)
        bucket = _mix(np.concatenate(found)) >> np.uint64(20)
        key = np.unique(np.concatenate(rows) * np.uint64(BUCKETS) + bucket % np.uint64(BUCKETS))
    return (key // np.uint64(BUCKETS)).astype(np.int64), (key % np.uint64(BUCKETS)).astype(np.int64)


def descend(starts: np.ndarray, bucket: np.ndarray, value: np.ndarray, sign: np.ndarray, cost: np.ndarray, buckets: int, passes: int = PASSES, seed: int = 5) -> np.ndarray:
    """Weights (the last is the bias) of the linear hinge-loss model, by dual coordinate descent over rows in random order."""
    w = np.zeros(buckets + 1)
    alpha = np.zeros(len(sign))
    norm = np.array([1.0 + (value[a:b] ** 2).sum() for a, b in zip(starts[:-1], starts[1:], strict=True)])
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(sign)):
            own, x = bucket[starts[i] : starts[i + 1]], value[starts[i] : starts[i + 1]]
            g = sign[i] * (w[own] @ x + w[-1]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                alpha[i] = new
                w[own] += step * x
                w[-1] += step
    return w


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits y best, by Newton's method."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))
        d, h = p - y, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(d * margin).sum() + 1e-3 * a, d.sum()])
        hess = np.array([[(h * margin**2).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, grad)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return float(a), float(b)


def train(rows: list[tuple[str, int]]) -> tuple[np.ndarray, float, float, float]:
    """Weight of each bucket's indicator, bias, and the logistic curve's slope and offset."""
    y = np.array([label for _, label in rows], int)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(set(y.tolist())) < 2:
        return np.zeros(BUCKETS), 0.0, 1.0, float(np.log(share / (1 - share)))
    parts = [features(pa.array([t for t, _ in rows[k : k + 500]], pa.string()), shapes) for shapes in [Shapes()] for k in range(0, len(rows), 500)]
    doc = np.concatenate([d + 500 * k for k, (d, _) in enumerate(parts)])
    bucket = np.concatenate([b for _, b in parts])
    starts = np.searchsorted(doc, np.arange(len(rows) + 1))

    def fit(use: np.ndarray) -> tuple[np.ndarray, float]:
        chosen = use[doc]
        counts = [ALPHA + np.bincount(bucket[chosen & (y[doc] == c)], minlength=BUCKETS) for c in (0, 1)]
        ratio = np.log(counts[1] / ((y == 1) & use).sum()) - np.log(counts[0] / ((y == 0) & use).sum())
        own = np.flatnonzero(use)
        size = np.diff(starts)[own]
        at = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(starts[own] - at[:-1], size) + np.arange(at[-1])
        b = bucket[index]
        w = descend(at, b, ratio[b], np.where(y[own] == 1, 1.0, -1.0), np.full(len(own), PENALTY), BUCKETS)
        return w[:-1] * ratio, w[-1]

    def margins(w: np.ndarray, bias: float, which: np.ndarray) -> np.ndarray:
        return np.bincount(doc, w[bucket], len(rows))[which] + bias

    fold = np.random.default_rng(3).permutation(len(rows)) % 4 == 0
    w, bias = fit(~fold)
    slope, offset = _logistic(margins(w, bias, fold), y[fold])
    w, bias = fit(np.ones(len(rows), bool))
    return w, float(bias), slope, offset


def scores(texts: pa.Array, shapes: Shapes, model: tuple[np.ndarray, float, float, float]) -> np.ndarray:
    w, bias, slope, offset = model
    doc, bucket = features(texts, shapes)
    margin = np.bincount(doc, w[bucket], len(texts)) + bias
    return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -500, 500)))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(teaching_rows(docs, labels, label_col, sample, id_col, text_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            out = [scores(texts, shapes, model.value) for _, texts in slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *out]))], names=[id_col, "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    out = rows.mapInArrow(tidy(run), f"`{id_col}` long, score double")
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
