"""Ranked search against plain scoring, and the graph of shared sets."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rillgrid.llm import shared_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    by_item: dict = {}
    for i, t in items:
        by_item.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in by_item.items():
        scored = []
        for (doc, c), size in zip(counts, sizes, strict=True):
            m = 10 + 90 * size * n // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, r, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, doc string, score int").repartition(3)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, block int")
    return sorted([tuple(r) for r in S.search(d, i, k).collect()], key=str)


def made(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ünï", "ABC", "x1", "été"]
    text = lambda n: "".join(rng.choice(words[: rng.randrange(5, 64)]) + rng.choice([" ", ", ", "\n", "- "]) for _ in range(n))
    docs = [(k, text(rng.randrange(60))) for k in range(150)]
    docs += [(200 + k, docs[3][1]) for k in range(15)] + [(300, None), (301, ""), (302, " .,"), (5, docs[9][1]), (None, docs[3][1])]
    return docs, [(k, text(rng.randrange(12))) for k in range(25)] + [(3, "w1 w2"), (90, None), (91, "zzz"), (None, "w5 w6")]


@pytest.mark.parametrize("k", [1, 10])
def test_against_plain_scoring(spark, k):
    docs, items = made(k)
    assert found(spark, docs, items, k) == brute(docs, items, k)


def test_blocks_of_items_and_of_texts(spark, monkeypatch):
    docs, items = made(7)
    monkeypatch.setattr(S, "BLOCK_TERMS", 20)
    assert found(spark, docs, items, 4) == brute(docs, items, 4)
    monkeypatch.undo()
    plan = S.plan_of([(1, b"ab"), (1, b"c")])[1]
    words = np.frombuffer(b"AB c " + b"q" * 50 + b" ab", np.uint8)
    start, end, _ = S._terms(words, np.array([0, len(words)]))
    whole = S._hashes(words, start, end)
    monkeypatch.setattr(S, "SPAN", 3)
    assert (S._hashes(words, start, end) == whole).all() and whole[0] == whole[3] and set(plan.hashes) == {whole[0], whole[1]}


def test_empty(spark):
    docs, items = made(2)
    assert found(spark, [], items, 3) == [] and found(spark, docs, [], 3) == []
    assert found(spark, [(1, None), (2, "--")], items, 3) == []


def test_sets_are_shared_and_whole():
    rng = random.Random(5)
    groups = [{rng.randrange(200) for _ in range(8)} for _ in range(6)]
    items = [set().union(*rng.sample(groups, 3), {300 + k}) for k in range(30)]
    firsts, pairs, own = S.shared_sets(items)
    sets = [set(f) for f in firsts]
    for a, b in pairs:
        assert not sets[a] & sets[b]
        sets.append(sets[a] | sets[b])
    for item, parts in zip(items, own, strict=True):
        assert set().union(*(sets[p] for p in parts)) == item and sum(len(sets[p]) for p in parts) == len(item)
    adds = len(pairs) + sum(len(p) - 1 for p in own) + sum(len(f) - 1 for f in firsts)
    assert adds < sum(len(i) - 1 for i in items) / 4


def test_partial_sums_are_what_scores_come_from(monkeypatch):
    """Without the sums of the pairs the scores are others."""
    plan = S.plan_of([(k, w) for k in range(4) for w in (b"a", b"b") if k != 1 or w == b"a"] + [(2, b"c"), (3, b"c"), (4, b"b")])[1]
    assert plan.pairs
    args = np.array([5, 7, 9]), np.array([10, 10]), np.array([0, 0, 1]), np.array([0, 1, 2]), np.array([1, 2, 1])
    right = S.scores(plan, *args)
    plan.pairs = [(0, 0) for _ in plan.pairs]
    assert (S.scores(plan, *args) != right).any()
