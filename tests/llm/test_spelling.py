"""Spelling variants against comparing all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from rillgrid.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, slips=True, least=6, often=5, times=5):
    counts: Counter = Counter()
    for k, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if k is None else k}:{word}".encode())
            if slips and h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    counts = Counter({w: n for w, n in counts.items() if len(w) >= least and n >= often})
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        if vs:
            best = min(vs, key=lambda v: (-counts[v], v))
            if counts[best] >= times * counts[w]:
                form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form.get(w), counts[form[w]] if w in form else None, root))
    return sorted(out)


def found(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(3)
    return sorted(tuple(r) for r in spelling.spelling_variants(docs, slips=True, **more).select("word", "n", "n_near", "form", "form_n", "root").collect())


def made(seed):
    rng = random.Random(seed)
    letters = "abcdé×"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 10))) for _ in range(25)]
    for w in list(words) * 3:
        at = rng.randrange(len(w))
        words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]]))
    weights = [rng.choice([1, 5, 30, 200]) for _ in words]
    rows = []
    for k in range(120):
        run = [rng.choice([str.lower, str.upper, str.title])(w) if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=60)]
        rows.append((k, rng.choice([" ", "1", "Ā", "-"]).join(run)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_words(spark, seed):
    rows = made(seed)
    want = brute(rows)
    assert found(spark, rows) == want
    assert any(r[3] for r in want)


def test_crowded_chunks(spark, monkeypatch):
    """Chunks that many words share are cut on, to single code points."""
    monkeypatch.setattr(spelling, "CROWDED", 2)
    rng = random.Random(3)
    words = ["commonstart" + "".join(rng.choice("ab") for _ in range(n)) + end for n in (3, 4, 5) for end in ("", "commonend") for _ in range(25)]
    rows = [(k, " ".join(words * 6)) for k in range(3)] + made(4)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "1 2 3"), (4, "q" * 2500 + " " + "r" * 1500), (None, "WORDÉS wordÉs wordés wordés word"), (5, "wordes " * 40 + "wördeŸs"), (5, "wordes " * 40)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, min_count=1) == brute(rows, often=1)
    assert found(spark, rows[:3]) == [] and found(spark, []) == []


def test_chain_of_forms(spark):
    words = ["chaine" + "s" * k for k in range(6)]
    rows = [(1, " ".join(w for k, w in enumerate(words) for _ in range(5 ** (k + 1))))]
    want = brute(rows)
    assert found(spark, rows) == want
    assert {r[5] for r in want if r[0] == words[0]} == {words[-1]}


def test_slips():
    runs = [f"letters{k}".replace("1", "x") for k in range(2000)]
    changed = [r for r in runs if spelling.slipped(zlib.crc32(b"7:"), r.encode()).decode() != r]
    assert changed == [r for r in runs if zlib.crc32(f"7:{r}".encode()) % 199 == 0] and changed


def test_grams_are_not_broadcast(spark, monkeypatch):
    """Grams are many times their words, which the planner doesn't see; so neither side of pairs goes by a broadcast (F1)."""
    words = spark.createDataFrame([(w, 9) for w in ("banana", "bananas", "banan\u00e4", "cherry")], "word string, n long")
    plans = []
    monkeypatch.setattr(spelling, "cut", lambda df, was=spelling.cut: (plans.append(df), was(df))[1])
    monkeypatch.setattr(spelling, "CROWDED", 1)
    found = spelling._pairs(words, 6)
    assert sorted((r.word, r.near) for r in found.collect()) == sorted((a, b) for a in ("banana", "bananas", "banan\u00e4") for b in ("banana", "bananas", "banan\u00e4") if one_edit(a, b))
    spelling._roots(words.select("word", spelling.F.lit("cherry").alias("form")).where("word = 'banana'")).collect()
    joins = [line for df in [*plans, found] for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in line]
    assert not [j for j in joins if "LeftAnti" not in j and "LeftSemi" not in j]
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
