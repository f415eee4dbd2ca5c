"""The corpus pipeline, each stage on its own input against a brute-force version."""

import random
import struct
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rillgrid.llm.common import tokenizer_path
from rillgrid.llm.decontamination import leaks
from rillgrid.llm.line_dedup import near_words
from rillgrid.llm.toxicity import score_toxicity
from tests.llm.test_llm_texts import components_of, shingles

ITEM = "A train leaves at 9 and travels 120 km in 2 hours before Anna meets Ben at the old station gate"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    rnd = random.Random(12)
    words = [a + b for a in ("ri", "sto", "clo", "gre", "wa", "ta", "li", "pa", "no", "mu") for b in ("ver", "ne", "ud", "en", "lk", "ble", "ght", "per", "rth", "sic")]
    text = lambda n: "\n".join(" ".join(rnd.choice(words) for _ in range(12)) for _ in range(n))
    rows, labels = [], []
    for k in range(400):
        t = text(rnd.randint(1, 5))
        if k % 8 == 0:
            w = t.split(" ")
            for _ in range(4):
                w[rnd.randrange(len(w))] = "snarf" + rnd.choice(["", "ed", "ing", "y"])
            t = " ".join(w)
        rows.append((k, t))
        labels.append((k, 1, int(k % 8 == 0)))
    long = text(40)
    rows += [(1000, long), (1001, long.replace(long.split()[5], "other", 1)), (1002, f"{text(1)} {ITEM} {text(1)}"), (1003, rows[3][1]), (1004, None), (1005, ""), (1006, "river " * 9000), (None, "no id at all"), (7, rows[7][1])]
    docs = spark.createDataFrame([(k, t, "en", "s", None if t is None else len(t), 5) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars int, n_lines int")
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def by_id(df):
    return sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "", r.text is None) for r in df.collect())


def test_each_stage_equals_brute_force(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    clean = stages["toxicity"](spark, docs, folder).cache()
    assert clean.columns == docs.columns
    scores = {(r.doc_id, r.predicted) for r in score_toxicity(docs, labels, threshold=0.3).collect()}
    assert {r.doc_id for r in clean.collect()} == {k for k, p in scores if p == 0}
    kept_ids = {r.doc_id for r in clean.collect()}
    assert sum((k in kept_ids) == (k % 8 != 0) for k in range(400)) > 380

    lined = stages["line dedup"](spark, clean, folder).cache()
    assert lined.columns == docs.columns
    seen, want = [], []
    rows = sorted({(r.doc_id, r.text) for r in clean.collect() if r.doc_id is not None}, key=lambda r: r[0])
    for k, t in rows:
        lines = (t or "").split("\n")
        words = [line.lower().split() for line in lines]
        kept = []
        for line, w in zip(lines, words, strict=True):  # an equal or near line inside the same text counts too
            if not w or not any(near_words(w, o, 5) for o in seen):
                kept.append(line)
            seen += [w] if w else []
        if len(kept) == len(lines) or "".join(kept).strip():
            want.append((k, "\n".join(kept)))
    assert sorted((r.doc_id, r.text or "") for r in lined.collect() if r.doc_id is not None and r.doc_id != 7) == [w for w in want if w[0] != 7]
    assert all(r.n_chars == len(r.text) for r in lined.collect() if r.text is not None)
    assert {r.n_lines for r in lined.collect()} == {5}

    single = stages["MinHash near-dedup"](spark, lined, folder).cache()
    sets = {r.doc_id: shingles(r.text, 5) for r in lined.collect() if r.doc_id is not None}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = components_of(links, ids)
    assert {r.doc_id for r in single.collect() if r.doc_id is not None} == {k for k in ids if root[k] == k}

    fresh = stages["benchmark decontamination"](spark, single, folder).cache()
    found = {r.doc_id for r in leaks(single, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert found == {1002}
    assert by_id(fresh) == [r for r in by_id(single) if r[0] != 1002]

    packed = stages["best-fit packing"](spark, fresh, folder)
    tokens = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("upto"))
    assert tokens.where("n > 4096 or n <> upto").isEmpty()
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces = []
    for r in fresh.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            pieces.append((-1 if r.doc_id is None else r.doc_id, piece, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed.collect()) == sorted(pieces)
    total = packed.agg(F.sum("length")).first()[0]
    assert tokens.count() <= total / 4096 * 1.5 + 1

    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id or -1, r.piece, r.ids_crc32) for r in whole.collect()) == sorted((r.doc_id or -1, r.piece, r.ids_crc32) for r in packed.collect())


def test_texts_go_to_python_a_few_at_a_time(spark, folder, monkeypatch):
    """A partition's texts used to be one Arrow batch, up to 64 MB."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    monkeypatch.setattr(corpus_pipeline, "drop_toxic", lambda docs, labels, threshold: docs.mapInArrow(sizes, "n long"))
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("river "), 700).alias("text"))
    seen = [r.n for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, folder).collect()]
    assert sum(seen) > 12_000_000 and max(seen) < 2 * corpus_pipeline.BATCH_BYTES
