"""Operators on texts against brute force, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillgrid.llm import common, line_dedup, minhash, packing, quality, token_counts
from rillgrid.llm.common import tokenizer_path
from rillgrid.llm.decontamination import leaks
from rillgrid.llm.line_dedup import dedup_lines, near_words
from rillgrid.llm.minhash import near_duplicates
from rillgrid.llm.pii import find_pii
from rillgrid.llm.quality import score_quality
from rillgrid.llm.toxicity import drop_toxic, score_toxicity
from rillgrid.llm.url_filter import BLOCK_WORDS, RULES, judge

SCHEMA = "doc_id long, text string, lang string, score double, key string, place int"  # with names that operators use inside


def table(spark, texts):
    return spark.createDataFrame([(k, t, "en", 1.0, "x", 3) for k, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(1)
    words = ["the", "and", "Σa", "é", "naïve", "日本", "<s>", "<|endoftext|>", "12.5", "!!", "...", "it's", "x" * 300, "▁", "\t", "a  b", " ", "", "\u3000", "😀"]
    texts = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))).replace(" the ", "\n")) for k in range(120)]
    return [*texts, (200, None), (201, ""), (202, "word " * 30000), (203, "y" * 20000), (204, "\n\n"), (5, texts[5][1])]


def test_token_counts_are_the_librarys(spark, odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(table(spark, odd)).collect())
    want = sorted((k, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for k, t in odd)
    assert got == want
    assert token_counts.count_tokens(table(spark, [])).collect() == []


def test_chunk_maps_compose_in_any_order():
    t = token_counts.BpeTransducer(tokenizer_path("piece_bpe_32k.model"))
    rnd = random.Random(2)
    for _ in range(200):
        text = token_counts.MARK + "".join(rnd.choice(["th", "e", "ing", token_counts.MARK, "\n", "é", "日", "a"]) for _ in range(40))
        cuts = sorted(rnd.randint(0, len(text)) for _ in range(5))
        maps = [t.chunk_map(text[i:j]) for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        left = maps[0]
        for m in maps[1:]:
            left = left.then(m, t.run)
        right = maps[-1]
        for m in reversed(maps[:-1]):
            right = m.then(right, t.run)
        for m in (left, right):
            assert t.run(m.head)[0] + m.count == t.run(text)[0]


def test_packing_is_whole_and_gapless(spark, odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = packing.pack(table(spark, odd)).collect()
    want = []
    for k, t in odd:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((k, p, at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(table(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_number_once(seed):
    rnd = random.Random(seed)
    lengths = [min(100, max(1, int(rnd.lognormvariate(3, 1)))) for _ in range(rnd.choice([1, 7, 400]))]
    counts = {n: lengths.count(n) for n in lengths}
    for setting in packing.SETTINGS:
        runs = packing.plan(counts, 100, *setting)
        for n in counts:
            at = 0
            for _, k, many, _, _ in sorted(r for r in runs if r[0] == n):
                assert k == at
                at += many
            assert at == counts[n]


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components_of(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    rnd = random.Random(words)
    vocab = [f"w{k}" for k in range(60)]
    base = [" ".join(rnd.choice(vocab) for _ in range(n)) for n in (3, 12, 40, 90, 400)]
    texts = []
    for k in range(150):
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        texts.append((k, " ".join(w).upper() if k % 3 else "\n".join(w)))
    texts += [(900, None), (901, ""), (902, " \n"), (903, "w1"), (904, "W1"), (7, texts[7][1])]
    got = {r.doc_id: r for r in near_duplicates(table(spark, texts), words=words).collect()}
    sets = {k: shingles(t, words) for k, t in texts}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components_of(links, ids)
    assert len(got) == len(ids)
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {k: (len(sets[k]), want[k], want[k] == k) for k in ids}


@pytest.mark.parametrize("size", [5, 9, 40, 148, 900, 5000, 40000])
def test_sketch_limit_lets_links_through_and_rules_others_out(size):
    rng = np.random.default_rng(size)
    bits = lambda h: np.frombuffer(minhash.odd_sketch(np.sort(h)), np.uint8)
    for similarity, most in ((0.8, 0), (0.9, 0), (0.6, None)):
        over = 0
        rounds = 300 if size < 5000 else 40
        for _ in range(rounds):
            h = rng.integers(0, 2**64, size, np.uint64)
            union, common = size, int(np.ceil(similarity * size))
            more = (union - common) // 2
            x, y = h[: common + more], np.concatenate([h[:common], h[common + more :]])
            n = np.array([len(x) + len(y)])
            over += int(np.bitwise_count(bits(x) ^ bits(y)).sum() > minhash.sketch_limit(n, 80)[0])
        if most is None:
            assert over > 0.9 * rounds or size < 100
        else:
            assert over == 0


@pytest.mark.parametrize("few", [None, 0])
def test_a_large_group_of_near_copies_gives_few_links(spark, monkeypatch, few):
    """Copies of one text that are near to it, but mostly not to each other: what is written grows with them, not with their pairs."""
    monkeypatch.setattr(minhash, "BLOCK", 700)
    if few is not None:
        monkeypatch.setattr(minhash, "FEW_IDS", few)
        monkeypatch.setattr(minhash, "FEW_BUCKETS", few)
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(4000)}" for _ in range(120)]
    n = 5000 if few is None else 1500
    texts = []
    for k in range(n):
        w = list(base)
        for _ in range(rnd.choice([5, 6, 7, 8, 9, 10])):
            w[rnd.randrange(len(w))] = f"v{rnd.randrange(10**6)}"
        texts.append((k, " ".join(w)))
    written = []
    joined = minhash._joined

    def counted(*given):
        out = minhash.cut(joined(*given))
        written.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_joined", counted)
    got = {r.doc_id: r.component_id for r in near_duplicates(table(spark, texts), words=2).collect()}
    assert sum(written) <= 32 * n
    sets = [shingles(t, 2) for _, t in texts]
    index = {}
    for k, own in enumerate(sets):
        for x in own:
            index.setdefault(x, []).append(k)
    shared = {x: j for j, x in enumerate(x for x, ks in index.items() if len(ks) > 1)}
    there = np.zeros((n, len(shared)), np.float32)
    for x, j in shared.items():
        there[index[x], j] = 1
    size = np.array([len(x) for x in sets])
    common = there @ there.T
    a, b = np.nonzero(100 * common >= 80 * (size[:, None] + size[None, :] - common))
    want = components_of([(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if x < y and got[x] != got[y]], range(n))
    assert all(want[k] == k for k in range(n))  # no link between two components
    pairs = {(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if x < y}
    assert len({got[k] for k in range(n)}) == len(set(components_of(pairs, range(n)).values()))


@pytest.mark.parametrize("large", [False, True])
def test_line_dedup_equals_brute_force(spark, monkeypatch, large):
    if large:  # as on tables too large for broadcasts, with hot keys
        monkeypatch.setattr(common, "FEW_GROUPS", 0)
        monkeypatch.setattr(common, "HOT_ROWS", 3)
        monkeypatch.setattr(line_dedup, "FEW_DOCS", 0)
    rnd = random.Random(3)
    vocab = ["alpha", "beta", "gamma", "delta", "eps"]
    base = [[rnd.choice(vocab) for _ in range(n)] for n in (1, 3, 4, 5, 6, 9)]
    texts = []
    for k in range(60):
        lines = []
        for _ in range(rnd.randint(0, 5)):
            w = list(rnd.choice(base))
            what = rnd.choice("same change add drop blank".split())
            if what == "change":
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            elif what == "add":
                w.insert(rnd.randrange(len(w) + 1), rnd.choice(vocab))
            elif what == "drop":
                w.pop(rnd.randrange(len(w)))
            lines.append("" if what == "blank" else " ".join(w))
        texts.append((k, "\n".join(lines)))
    texts += [(100, None), (101, "z " * 5000), (102, "Z " * 4999)]
    got = {r.doc_id: r for r in dedup_lines(table(spark, texts)).collect()}
    seen = []
    for k, t in texts:
        kept = []
        for line in (t or "").split("\n"):
            w = line.lower().split()
            if not w or not any(near_words(w, o, 5) for o in seen):
                kept.append(line)
            if w:
                seen.append(w)
        assert (got[k].text or "") == "\n".join(kept)
    assert got[100].text is None and got[101].key == "x"
    assert dedup_lines(table(spark, [])).collect() == []
    clash = table(spark, [(1, "a b c d e"), (2, "a b c d e\nf"), (None, "a b c d e")]).selectExpr("*", "'n' as n_lines", "1 as doc", "2 as places", "3 as n_dropped")
    assert sorted((r.doc_id or 0, r.text, r.n_lines, r.n_dropped, r.doc, r.places) for r in dedup_lines(clash).collect()) == [(0, "a b c d e", 1, 0, 1, 2), (1, "a b c d e", 1, 0, 1, 2), (2, "f", 2, 1, 1, 2)]


def test_a_text_of_many_equal_lines_takes_time_in_proportion(spark):
    line = "one two three four five six"
    docs = spark.createDataFrame([(1, "\n".join([line, ""] * 40_000)), (2, f"head\n{line}\ntail")], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert time.time() - began < 40
    assert got[1].text == line + "\n" + "\n" * 39_999 and got[1].n_dropped == 39_999
    assert got[2].text == "head\ntail"


def test_leaks_find_new_numbers_but_not_the_frame(spark):
    bench = spark.createDataFrame([(1, "A train leaves at 9 and travels 120 km in 2 hours before Anna meets Ben at the old station gate"), (2, "short one"), (3, None)], "item_id long, text string")
    twin = "Intro words here. A train leaves at 7 and travels 340 km in 5 hours before Eva meets Tom at the old station gate. More."
    same = "A train leaves at 9 and travels 120 km in 2 hours before Anna meets Ben at the old station gate"
    part = "A train leaves at 9 and travels far away from here"
    rows = [(1, twin), (2, same), (3, part), (4, None), (5, ""), (6, "short one"), (7, "word " * 20000), (2, same)]
    got = {(r.doc_id, r.item_id) for r in leaks(table(spark, rows), bench).collect()}
    assert got == {(1, 1), (2, 1)}
    assert leaks(table(spark, []), bench).collect() == []


def test_leaks_judge_each_occurrence_by_itself(spark):
    item = "A train leaves at 9 and travels 120 km in 2 hours before Anna meets Ben at the old station gate"
    again = "The red box holds 3 pens and the red box holds 8 pens and the red box holds 5 pens in all"
    bench = spark.createDataFrame([(1, item), (2, again)], "item_id long, text string")
    twin = "A train leaves at 7 and travels 340 km in 5 hours before Eva meets Tom at the old station gate"
    other = "A train leaves at 4 and travels 77 km in 8 hours before Ida meets Max at the old station gate"
    longer = other.replace("before", "and many slow minutes before")
    mixed = twin.replace("before Eva", "before Ida").replace("in 5 hours", "in 6 hours")
    frames = " and then ".join(f"A train leaves at {n} and travels far before {a} meets nobody at the old station gate" for n, a in enumerate(["Eva", "Tom", "Ida", "Max"]))
    rows = [(1, item), (2, twin), (3, f"{item} . {twin}"), (4, f"{twin} . {other}"), (5, f"{other} some words here {twin} and {item}"), (6, f"{twin} . {longer}"), (7, again), (8, " and ".join([other] + [f"{p} {item}" for p in "xy"])), (9, frames), (10, f"{other} filler text {' filler' * 300} {mixed}")]
    got = {(r.doc_id, r.item_id): r for r in leaks(table(spark, rows), bench).collect()}
    assert set(got) == {(k, 1) for k in (1, 2, 3, 4, 5, 6, 8, 10)} | {(7, 2)}
    assert all(r.slot_agreement == 1.0 for r in got.values())
    assert all(r.n_windows == r.n_item_windows for r in got.values())


@pytest.mark.parametrize("few", [2_000_000, 0])
def test_leaks_of_items_that_are_mostly_slots(spark, monkeypatch, few):
    """Items without literal windows are found by value; joins are the same whether benchmark windows are broadcast or not."""
    monkeypatch.setattr("rillgrid.llm.decontamination.FEW_WINDOWS", few)
    dense, plain = "what is 12 km 7 m 3 kg 4 h 5 km 9 s 8 m 2 kg", "A train leaves at 9 and travels 120 km in 2 hours before Anna meets Ben at the old station gate"
    bench = spark.createDataFrame([(1, dense), (2, plain), (2, plain), (3, "1 2 3 4"), (4, dense)], "item_id long, text string")
    other = "what is 13 km 6 m 2 kg 5 h 4 km 8 s 7 m 3 kg"
    rows = [(1, f"some words {dense} and more"), (2, other), (3, plain.replace("9", "7")), (4, None), (5, f"{dense} {dense} {plain}"), (6, dense[: len(dense) // 2])]
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_item_windows) for r in leaks(table(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (1, 4), (3, 2), (5, 1), (5, 4), (5, 2)}
    assert got[1, 1] == (14, 14) == got[5, 4]


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum((x := int(c) * (1 + i % 2)) - 9 * (x > 9) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def test_base_spans_equal_the_plain_patterns(spark):
    rnd = random.Random(4)
    parts = ["a@b.c", "_", "@", "a.b", "1", "12", "...", "-", " ", "  ", "+", "(", "555", ")", "256", ".", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "😀", "é", "\n", "+1 (555) 555-1234", "call 555-123-4567 "]
    rows = [(k, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))) for k in range(600)] + [(900, None), (901, "1" * 5000), (902, "a" * 5000 + "@"), (903, "+1" + " " * 5000), (904, "1-" * 3000)]
    got = find_pii(table(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        assert r.base_spans == base_spans(text)
        added = set(filter(None, r.spans.split(","))) - set(filter(None, r.base_spans.split(",")))
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))
        assert all(int(a.split(":")[2]) <= len(text) for a in added)


def test_trees_add_disguised_spans_and_leave_others(spark):
    said = [
        ("write to ann.lee (at) mail (dot) org today", "email:9:34"), ("reach sales[at]corp[dot]com", "email:6:27"), ("the host 10[.]0[.]3[.]77 is up", "ip:9:24"),
        ("my card 4111.1111.1111.1111 here", "card:8:27"), ("call (555) 212-1234 now", "phone:5:19"), ("Wir sind da, 212-555-7777", "phone:13:25"),
        ("we meet at noon dot then", ""), ("the build 999[.]1[.]2[.]3 came", ""), ("my card 4111.1111.1111.1112 here", ""), ("order 555-212-1234 came", ""), (None, ""), ("", ""),
    ]
    got = {r.doc_id: r.spans for r in find_pii(table(spark, [(k, t) for k, (t, _) in enumerate(said)])).collect()}
    right = sum(got[k] == want for k, (_, want) in enumerate(said))
    assert right >= len(said) - 1, got
    assert find_pii(table(spark, [])).collect() == []


def test_url_parts_equal_a_plain_reading(spark):
    rnd = random.Random(7)
    parts = ["http", "://", "/", "?", "#", "Example.com", "a.net", "net", ".", "en/", "es/", "fr/", "www.", "com", "É", " ", ""]
    rows = [(k, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))) for k in range(400)]
    got = {r.page_id: r for r in judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    for k, url in rows:
        _, sign, rest = url.partition("://")
        host = re.match("[^/?#]*", rest)[0] if sign else ""
        path = re.match("[^?#]*", rest[len(host) :])[0] if sign else ""
        host = host.translate(upper)
        fits = [(r, v) for r, v in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, got[k].verdict))
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, rule, verdict)
    assert judge(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_url_words_in_hosts_that_were_not_taught(spark):
    """Taught words beside others than in the labelled table, against hosts of such others alone; words that were not taught are let
    through."""
    others = ("ocean", "winter", "castle", "orange", "pepper", "salmon", "falcon", "violet", "meadow", "threads", "roads", "adulthood", "alphabets", "studies")
    bad = [f"https://{a}-{b}.example.org/en/{k}" for k, (a, b) in enumerate((a, b) for a in BLOCK_WORDS[::3] for b in others[::2])]
    good = [f"https://{a}-{b}.example.org/en/{k}" for k, (a, b) in enumerate((a, b) for a in others for b in others)]
    rows = [(k, u) for k, u in enumerate(bad + good)]
    blocked = {r.page_id for r in judge(spark.createDataFrame(rows, "page_id long, url string")).where("verdict = 'block'").collect()}
    found = sum(k < len(bad) for k in blocked)
    assert found >= 0.8 * len(bad) and found >= 0.8 * len(blocked)


def test_rules_and_parts_of_urls(spark):
    rows = [(1, "https://WWW.Example.com/en/1?x#y"), (2, "http://example.com/en/1"), (3, "http://a.net/es/"), (4, "no url"), (5, None), (6, "http://net/fr/x"), (7, "x://h.com?/en/"), (8, "https://free-poker.example.org/en/9"), (9, "http://news.example.org/en/1"), (10, "http://notnet/fr/"), (11, "http://h.com")]
    got = {r.page_id: r for r in judge(spark.createDataFrame([(k, u, "x") for k, u in rows], "page_id long, url string, host string")).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert [got[k].rule for k in (2, 3, 4, 5, 6, 7, 10, 11)] == ["example.com/en/", "net/es/", None, None, "net/fr/", None, None, None]
    assert [(got[k].host, got[k].path) for k in (4, 5, 7, 11)] == [("", ""), ("", ""), ("h.com", ""), ("h.com", "")]
    assert got[8].verdict == "block" and got[9].verdict == "allow"
    assert {r.verdict for r in got.values()} <= {"allow", "block"}


def labelled(spark):
    rnd = random.Random(5)
    words = ["house", "river", "stone", "cloud", "green", "walk", "table", "light", "paper", "north"]
    docs, labels = [], []
    for k in range(900):
        w = [rnd.choice(words) + rnd.choice(["", "er", "ing", "s"]) for _ in range(40)]
        bad, low = k % 7 == 0, k % 5 == 0
        if bad:
            for _ in range(3):
                w[rnd.randrange(40)] = "snarf" + rnd.choice(["", "ed", "ing", "y", "le"])
        docs.append((k, " ".join(f"{x}!!".upper() for x in w) if low else " ".join(w)))
        labels.append((k, int(not low), int(bad)))
    extra = [(5000, None), (5001, ""), (5002, "river " * 5000), (5003, "snarfish"), (3, docs[3][1])]
    return table(spark, docs + extra), spark.createDataFrame([*labels, (None, 1, None)], "doc_id long, quality int, toxic int"), {k: (q, t) for k, q, t in labels}


@pytest.mark.parametrize("score, place, threshold", [(score_quality, 0, 0.7), (score_toxicity, 1, 0.3)])
def test_classifiers_are_right_on_held_out_rows(spark, score, place, threshold):
    docs, labels, truth = labelled(spark)
    rows = score(docs, labels, threshold=threshold).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [(r.predicted, truth[r.doc_id][place]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == y for p, y in tested) / len(tested) > 0.95
    none = labels.where("doc_id < 0")
    assert {r.predicted for r in score(docs, none, threshold=threshold).collect()} <= {0, 1}


def test_quality_sees_the_whole_of_a_long_word():
    rnd = random.Random(6)
    signs = "ABCDEFGHabcdefgh0123456789+/"
    junk = lambda n: "".join(rnd.choice(signs) for _ in range(n))
    clean = lambda n: "".join(rnd.choice(["naturaleza", "lluvia", "puente", "ciudad"]) for _ in range(n))
    model = quality.train([(junk(rnd.randint(200, 900)) if k % 2 else clean(rnd.randint(20, 90)), 1 - k % 2) for k in range(200)])
    head = clean(20)[:64]
    texts = pa.array([head + junk(20000), head + clean(2000), junk(20000)], pa.string())
    bad, good, worse = quality.scores(texts, quality.Shapes(), model)
    assert bad < 0.1 and worse < 0.1 and good > 0.9
    parts, _ = quality.features(pa.array([head + "A1" * 400, None, "x y " + "b" * 200], pa.string()).fill_null(""), quality.Shapes())
    assert set(parts.tolist()) == {0, 1, 2}


def test_drop_toxic_keeps_columns_and_clean_rows(spark):
    docs, labels, truth = labelled(spark)
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum((k in ids) == (t == 0) for k, (_, t) in truth.items()) / len(truth) > 0.95
    assert 5000 in ids


def test_digest_columns(spark):
    assert spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0] == hashlib.sha256(b"").hexdigest()
