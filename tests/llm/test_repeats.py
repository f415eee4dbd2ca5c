"""Repeated strings against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from rillgrid.llm import common, repeats


def brute(rows: list[tuple[int | None, str | None]], size: int) -> dict[tuple, tuple[bytes, list[tuple[int, int]]]]:
    """(id, text) -> what is kept, and the runs removed; equal rows are one."""
    order = {(repeats.LAST_ID if k is None else k, t or "") for k, t in rows}
    order = sorted((k, repeats.text_key(t.encode()), t) for k, t in order)
    seen: set[bytes] = set()
    out = {}
    for k, _, t in order:
        data = t.encode()
        gone = bytearray(len(data))
        for a in range(len(data) - size + 1):
            if data[a : a + size] in seen:
                gone[a : a + size] = b"\1" * size
            seen.add(data[a : a + size])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]]).astype(int)))
        out[k, t] = bytes(b for b, g in zip(data, gone, strict=True) if not g), [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return out


def check(spark, rows, size):
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, kept string").repartition(3)
    found = repeats.remove_repeats(docs, size).collect()
    assert len(found) == len(rows)
    want = brute(rows, size)
    for r in found:
        kept, runs = want[repeats.LAST_ID if r.doc_id is None else r.doc_id, r.text or ""]
        assert bytes(r.kept) == kept
        assert [(s.start, s.end) for s in r.removed] == runs


def made(rng: random.Random, n: int, letters: str) -> list[tuple[int, str]]:
    """Texts of pieces that they share, some of them changed by a letter."""
    parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(20, 160))) for _ in range(12)]
    rows = []
    for k in range(n):
        text = ""
        for _ in range(rng.randrange(6)):
            part = rng.choice(parts)
            at = rng.randrange(len(part))
            text += rng.choice([part, part[at:], part[:at] + rng.choice(letters) + part[at + 1 :], "".join(rng.choice(letters) for _ in range(rng.randrange(60)))])
        rows.append((k, text))
    return rows


@pytest.mark.parametrize(("letters", "size"), [("abcdefgh", 100), ("ab", 24), ("aé", 30)])
def test_against_every_string(spark, letters, size):
    check(spark, made(random.Random(size), 60, letters), size)


def test_odd_rows(spark):
    long = "".join(random.Random(4).choice("abcdef") for _ in range(400))
    rows = [(1, None), (2, ""), (3, long), (3, long), (3, "x" + long[50:]), (4, "a" * 500), (5, "a" * 99), (None, long), (None, "q" + long), (7, long[:150] + "é" * 80)]
    check(spark, rows, 100)
    check(spark, rows[:2], 100)
    empty = spark.createDataFrame([], "doc_id long, text string, a int, doc int, _marks int")
    assert repeats.remove_repeats(empty).collect() == []


def test_common_phrase_in_other_surroundings(spark, monkeypatch):
    """Anchors with many pieces are cut to single strings; texts longer than a block are hashed in blocks."""
    monkeypatch.setattr(repeats, "MANY", 3)
    rng = random.Random(9)
    rows = [(k, "".join(rng.choice("abc") for _ in range(30)) + "THE COMMON PHRASE OF ALL" + "".join(rng.choice("ab") for _ in range(6))) for k in range(200)]
    check(spark, rows, 30)


def test_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    monkeypatch.setattr(repeats, "BLOCK", 700)
    start, end, anchor, _ = repeats.pieces(data, 100)
    assert start[0] == 0 and end[-1] == 5000 and (start[1:] == end[:-1] - 99).all()
    monkeypatch.setattr(repeats, "BLOCK", 3_000_000)
    begin, _, whole, _ = repeats.pieces(data, 100)
    assert set(whole.tolist()) == set(anchor.tolist()) and set(begin) <= set(start)


def test_common_prefixes_by_increasing_value():
    rng = random.Random(2)
    for depth in (1, 5, 12):
        symbols = np.array([rng.choice([1, 2, 2, 3]) for _ in range(400)] + [0], np.int64)
        order = repeats.suffix_order(symbols, 450)
        rotated = [tuple(np.roll(symbols, -k)) for k in order]
        assert rotated == sorted(rotated)
        shared = [next(i for i in range(401) if a[i] != b[i]) for a, b in zip(rotated, rotated[1:], strict=False)]
        got = repeats.borders(symbols[order - 1].astype(np.uint16), depth)
        assert got.tolist() == [True] + [s < depth for s in shared]


def test_pieces_are_shuffled_once(spark, monkeypatch):
    """Beyond what was broadcast, anchors, pieces, kinds and marks used to be shuffled one after another."""
    monkeypatch.setattr(common, "FEW_GROUPS", 100)
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 12))) for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=350)) for _ in range(700)]
    rows = [(k, texts[k % 700] if k % 3 else texts[(k * 7) % 700][:1200] + texts[k % 700][900:]) for k in range(1400)]
    store = spark.sparkContext._jsc.sc().statusStore()

    def written() -> int:
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8).cache()
    docs.count()
    before = written()
    assert repeats.remove_repeats(docs, 100).where("size(removed) > 0").count() > 600
    docs.unpersist()
    assert written() - before < 2.8 * sum(len(t) for _, t in rows)


def test_earliest_of_a_batch():
    doc, at = np.array([5, 5, 2, 7, 7, 7, 7]), np.array([0, 40, 9, 0, 60, 300, 300])
    size, whole = np.array([140, 120, 140, 140, 120, 110, 110]), np.array([1, 2, 1, 1, 2, 3, 3])
    stay, late = repeats.earliest(doc, at, size, whole)
    assert whole[stay].tolist() in ([2, 1, 3], [2, 1, 3]) and doc[stay].tolist() == [5, 2, 7]
    assert [x.tolist() for x in late] == [[5, 7], [0, 0], [140, 180]]
