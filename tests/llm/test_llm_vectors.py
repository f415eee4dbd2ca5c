import math
import random

import numpy as np
import pytest

from rillgrid.llm.components import components
from rillgrid.llm.embeddings import CODES, codes_for, decode, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, filter string, part int"


def make(spark, rows):
    return spark.createDataFrame([(i, v, y, "f", 9) for i, v, y in rows], SCHEMA)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(12):
        c = rng.standard_normal(32)
        for _ in range(12):
            rows.append((len(rows), (c + rng.standard_normal(32) * 0.15).astype(np.float32), int(k % 3)))
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 1), (502, rows[0][1], None), (503, None, 0), (504, np.zeros(32), 0), (505, np.array([math.nan] * 32), 0), (506, rows[0][1] * 1e-20, 0), (507, np.array([math.inf] + [0.0] * 31), 0), (508, np.array([1.0, 2.0]), 0)]
    rows = [(i, None if v is None else [float(x) for x in v], y) for i, v, y in rows]
    rows.append((509, [1.0, None], 0))
    got = {r.vec_id: r for r in near_vectors(make(spark, rows)).collect()}
    good = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, y in rows if v is not None and y is not None and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: y for i, _, y in rows}
    links = {i: set() for i, *_ in rows}
    for a in good:
        for b in good:
            if a < b and label[a] == label[b] and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.93:
                links[a].add(b)
                links[b].add(a)
    assert {i: got[i].n_links for i in links} == {i: len(s) for i, s in links.items()}
    root = {}
    for i in sorted(links):
        stack = [i]
        while stack:
            j = stack.pop()
            if j not in root:
                root[j] = i
                stack += links[j]
    assert {i: got[i].component_id for i in links} == root
    assert near_vectors(make(spark, [])).collect() == []


@pytest.mark.parametrize("dim, codes", [(32, 16), (64, 16), (128, 16), (768, 16), (64, 64), (768, 64), (32, 256), (128, 256), (128, 1024), (128, 2048)])
def test_recall_at_the_threshold(dim, codes):
    rng = np.random.default_rng(1)
    n = 1500 if codes <= 256 else 400
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((n, dim))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    met, passed = np.zeros(n, bool), 0
    for t in range(8):
        one, two = (set(zip(*(v.tolist() for v in decode(v, t, codes=codes)), strict=True)) for v in (x, y))
        met[[r for r, _ in one & two]] = True
        passed += len(one)
    assert met.mean() > 0.994 and passed / n < 80


def test_codes_grow_with_rows(spark):
    assert codes_for(0, 128) == codes_for(50_000, 128) == CODES and codes_for(10_000_000, 128) == 256
    rng = np.random.default_rng(3)
    x = np.repeat(rng.standard_normal((30, 32)), 4, axis=0) + rng.standard_normal((120, 32)) * 0.18
    rows = [(k, [float(f) for f in v], 0) for k, v in enumerate(x.astype(np.float32))]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    for codes in (16, 32):
        assert [r[1] for r in sorted(map(tuple, near_vectors(make(spark, rows), codes=codes).collect()))] == want.tolist()


def test_components_of_chains_and_rings(spark):
    rnd = random.Random(0)
    ids = list(range(200))
    rnd.shuffle(ids)
    links = list(zip(ids[:100], ids[1:100], strict=False)) + [(ids[k], ids[100 + (k + 1) % 50]) for k in range(100, 150)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: min(ids[:100]) for i in ids[:100]}
    assert all(got[i] == want[i] for i in want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
