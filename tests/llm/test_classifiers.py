"""The two text classifiers word by word in plain Python, what teaches them, and empty tables."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillgrid.llm import quality, toxicity
from rillgrid.llm.embeddings import near_vectors
from rillgrid.llm.labelled import teaching_rows
from rillgrid.llm.minhash import near_duplicates
from tests.llm.test_llm_texts import table

MASK = (1 << 64) - 1
SPACE = re.compile(r"\s+")
TEXTS = ["", " a  b ", "a", "The the THE cat", "ｗｉｄｅ naïve Σas 😀 日本語", "x" * 500, " ".join(f"w{k % 700}" for k in range(9000)), "tab\tand\nline", "ab abc abcd abcde"]


def bucket_of(gram):
    h = 0xCBF29CE484222325
    for sign in gram:
        h = ((h ^ ord(sign)) * 0x100000001B3) & MASK
    return ((((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & MASK) >> 40) % toxicity.BUCKETS


def plain_logit(text, values, bias):
    total, words = 0.0, set(text.lower().split())
    for w in words:
        marked = f"<{w}>"
        grams = [values[bucket_of(marked[k : k + n])] for n in (4, 5) for k in range(len(marked) - n + 1)]
        total += sum(grams) / max(len(grams), 1)
    return total / (len(words) + toxicity.BLANK) ** 0.5 + bias


def test_toxicity_scores_are_those_of_words_taken_one_by_one():
    values = np.random.default_rng(1).normal(0, 1, toxicity.BUCKETS)
    texts = [*TEXTS, "   "]
    got = toxicity.logits(pa.array(texts), values, 0.25)
    assert np.allclose(got, [plain_logit(t, values, 0.25) for t in texts], rtol=0, atol=1e-9)


def test_toxicity_finds_misspellings_and_few_words_of_many():
    rnd = random.Random(4)
    syllables = ["ba", "ko", "li", "mer", "nu", "ra", "set", "tor", "vi", "wen"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 4)))
    bad = ["grumpfart", "zoxxling"]
    rows = []
    for k in range(600):
        w = [word() for _ in range(rnd.randint(20, 400))]
        if k % 9 == 0:
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        rows.append((" ".join(w), int(k % 9 == 0)))
    model = toxicity.train(rows)
    clean = " ".join(word() for _ in range(300))
    seen, misspelt, none, empty = toxicity._score(toxicity.logits(pa.array([f"{clean} grumpfart", f"{clean} grumpffart zoxling", clean, ""]), *model))
    assert seen >= 0.3 and misspelt >= 0.3 and none < 0.3 and empty < 0.3
    assert np.array_equal(toxicity.train(rows)[0], model[0])


def test_one_class_scores_its_share():
    values, bias = toxicity.train([("a b", 1)] * 8)
    assert not values.any() and np.isclose(toxicity._score(np.array([bias]))[0], 0.9)


def test_dual_coordinate_descent_reaches_the_least_hinge_loss():
    rnd = np.random.default_rng(2)
    n, buckets, cost = 60, 12, 0.3
    x = (rnd.random((n, buckets)) < 0.4) * rnd.normal(0, 1, buckets)
    sign = np.where(x @ rnd.normal(0, 1, buckets) + 0.5 * rnd.normal(0, 1, n) > 0, 1.0, -1.0)
    rows = [np.flatnonzero(r) for r in x]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    w = quality.descend(starts, np.concatenate(rows), np.concatenate([x[i][r] for i, r in enumerate(rows)]), sign, np.full(n, cost), buckets, passes=3000)
    loss = lambda v: 0.5 * v @ v + cost * np.maximum(0, 1 - sign * (x @ v[:-1] + v[-1])).sum()
    least = loss(w)
    assert all(loss(w + size * rnd.normal(0, 1, len(w))) >= least - 1e-6 for size in (1e-4, 1e-3, 1e-2, 0.1, 1.0) for _ in range(300))


def plain_tokens(text):
    words = [w[k : k + quality.PIECE] for w in SPACE.split(text) for k in range(0, max(len(w), 1), quality.PIECE)]
    shapes = [zlib.crc32(quality._shape(w).encode()) for w in words]
    return words, [2 * s + (k > 0 and words[k] == words[k - 1]) for k, s in enumerate(shapes)]


def mix(x):
    x = ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15) & MASK
    return x ^ (x >> 29)


def plain_features(text):
    import xxhash

    words, tokens = plain_tokens(text)
    low = lambda w: xxhash.xxh3_64_intdigest(w.lower().encode()) ^ 0x5BD1E995
    found = [low(w) for w in words] + [low(w) for w in SPACE.split(text) if len(w) > quality.PIECE]
    for k in range(len(tokens)):
        h = tokens[k] + 1
        for n in (1, 2, 3):
            if k + n > len(tokens):
                break
            if n > 1:
                h = (mix(h) + tokens[k + n - 1]) & MASK
            found.append(mix((h + n) & MASK) if n > 1 else mix(h))
    return {(mix(f) >> 20) % quality.BUCKETS for f in found}


def test_quality_features_and_scores_are_those_of_tokens_taken_one_by_one():
    doc, bucket = quality.features(pa.array(TEXTS), quality.Shapes())
    got = {k: set(bucket[doc == k].tolist()) for k in range(len(TEXTS))}
    want = {k: plain_features(t) for k, t in enumerate(TEXTS)}
    assert got == want
    w = np.random.default_rng(3).normal(0, 0.1, quality.BUCKETS)
    scores = quality.scores(pa.array(TEXTS), quality.Shapes(), (w, 0.1, 1.5, -0.2))
    plain = [1 / (1 + np.exp(-np.clip(1.5 * (sum(w[b] for b in want[k]) + 0.1) - 0.2, -500, 500))) for k in range(len(TEXTS))]
    assert np.allclose(scores, plain, rtol=0, atol=1e-9)


def test_an_id_of_both_labels_has_the_larger_and_null_labels_do_not_teach(spark):
    docs = table(spark, [(k, f"text {k}") for k in range(40)] + [(None, "no id")])
    labels = [(k, 0) for k in range(40)] + [(k, 1) for k in range(0, 40, 4)] + [(1, None), (None, 1), (99, 1), (2, 7)]
    said = spark.createDataFrame(labels, "doc_id long, toxic int")
    want = sorted((f"text {k}", int(k % 4 == 0)) for k in range(40) if zlib.crc32(str(k).encode()) % 4 != 2)
    assert sorted(teaching_rows(docs, said, "toxic", 100)) == want
    assert len(teaching_rows(docs, said, "toxic", 8)) == 8


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_classifiers_on_empty_tables(spark, score):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert score(table(spark, []), labels).collect() == []
    rows = score(table(spark, [(1, "a"), (2, None)]), labels.where("doc_id < 0")).collect()
    assert len(rows) == 2 and all(r.score == 0.5 for r in rows)


def test_copies_on_empty_tables(spark):
    assert near_duplicates(table(spark, [])).collect() == []
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert near_vectors(empty).collect() == []


def test_pipeline_on_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars int, n_lines int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.count("*").alias("n")).first().n == 0
