"""LM scores: counts and shares against brute force, packing, probabilities, and the gain on held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sievecraft.llm import context_mixing as cm

SCHEMA = "doc_id long, text string, part string"
held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
low = lambda t: (t or "").translate({i: i + 32 for i in range(65, 91)}).encode().split() + [b"\n"]


def corpus(rng, n=220):
    """Texts of a small grammar, so that words tell the next ones, with words of their own."""
    names = ["".join(rng.choices("abdeilnorst", k=rng.randint(2, 7))) for _ in range(150)]
    after = {w: rng.choices(names, k=4) for w in names}
    rows = []
    for i in range(n):
        w, words = rng.choice(names), []
        for _ in range(rng.randint(0, 120)):
            words.append(w if rng.random() > 0.05 else "".join(rng.choices("abdeilnorsté", k=6)))
            w = rng.choice(after[w])
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(rng.choice([str.upper, str])(x) for x in words), "k"))
    return rows


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(cm, "CHUNK_BYTES", 3000)
    rows = corpus(random.Random(4)) + [(300, None, "k"), (301, "", "k"), (None, "tone line", "k"), (302, "sel " * 40_000, "k")]
    rows += [(7, rows[7][1], "k"), (400, rows[9][1], "k")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = cm.score(df).collect()
    count = Counter(w for i, t, _ in rows if not held(i) for w in low(t))
    n, v = sum(count.values()), len(count)
    want = sorted(((i if i is not None else -1, held(i), len(low(t)), sum(w in count for w in low(t)), n, len((t or "").encode()), sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in low(t))) for i, t, _ in rows), key=str)
    mine = sorted(((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.n_bytes, r.base_score) for r in got), key=str)
    assert [x[:6] for x in mine] == [x[:6] for x in want]
    assert np.allclose([x[6] for x in mine], [x[6] for x in want])
    out = [r for r in got if r.held_out and r.doc_id < 300]
    assert sum(r.score for r in out) > 0.8 * sum(r.base_score for r in out)  # both are negative
    assert all(r.score < 0 and math.isclose(r.bits, -r.score / math.log10(2)) and math.isclose(r.bits_per_byte, r.bits / (r.n_bytes + 1)) for r in got)
    # a text that stands twice is told by its other copy, one that stands once is not told by itself
    each = {r.doc_id: r.bits_per_byte for r in got if r.n_tokens > 30}
    assert each[7] < 0.5 * np.median(list(each.values()))
    again = cm.score(df.repartition(7)).collect()
    key = lambda r: str((r.doc_id, r.n_bytes))
    assert np.allclose([r.score for r in sorted(got, key=key)], [r.score for r in sorted(again, key=key)], rtol=2e-3)
    assert cm.score(df.limit(0)).count() == 0
    alone = cm.score(df.filter("doc_id = 302")).first()
    assert alone.train_tokens in (0, 40_001)
    assert cm.score(spark.createDataFrame([(i, "a b", "k") for i in range(300) if held(i)], SCHEMA)).filter("train_tokens = 0 AND n_known = 0 AND score < 0").count() > 10


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counts_are_packed_without_loss(seed):
    rng = np.random.default_rng(seed)
    for top in (3, 10**4, 10**7, 2**40):
        x = np.unique(rng.integers(0, top, 500).astype(np.uint64))
        assert (cm._from_steps(cm._steps(x)) == x).all()
        n = rng.integers(0, top, 300)
        assert (cm._from_small(cm._small(n)) == n).all()
    for parts, bits in ((8, 24), (7, 46), (53, 35), (1000, 60)):
        h = rng.integers(0, 1 << bits, 2000, dtype=np.uint64)
        part = cm._part_of(h, bits, parts)
        lows = np.array([cm._low_of(p, bits, parts) for p in range(parts)], np.uint64)
        assert (part == np.searchsorted(lows, h, "right") - 1).all()
    texts = pa.array([" a b a", None, "", "C c " * 50])
    t = cm.Tokens([5, None, 7, 1 << 40], texts)
    u = cm.Tokens.unpack(t.pack())
    assert all((getattr(t, k) == getattr(u, k)).all() for k in ("flat", "size", "hash", "doc_id", "known_id", "held", "n_bytes"))


def test_decisions_against_brute_force():
    rng = random.Random(5)
    texts = [b" ".join(rng.choices([b"a", b"b", b"c", b"d", b"e"], k=rng.randint(0, 30))) for _ in range(40)]
    ids = list(range(40))
    t = cm.Tokens(ids, pa.array([x.decode() for x in texts]))
    docs = [low(x.decode()) for x in texts]
    ones, twos, threes = Counter(), Counter(), Counter()
    for i, d in zip(ids, docs, strict=True):
        if not held(i):
            for k, w in enumerate(d):
                p, q = d[k - 1] if k else b"\n", d[k - 2] if k > 1 else b"\n"
                ones[w], twos[p, w], threes[q, p, w] = ones[w] + 1, twos[p, w] + 1, threes[q, p, w] + 1
    flat = [(i, d, k) for i, d in zip(ids, docs, strict=True) for k in range(len(d))]
    context = lambda d, k: (d[k - 2] if k > 1 else b"\n", d[k - 1] if k else b"\n", d[k])
    count = np.array([ones[w] for w in t.words])
    pair, triple = (np.array([c[context(d, k)[s:]] for _, d, k in flat]) for c, s in ((twos, 1), (threes, 0)))
    told, made, share = cm.decisions(t, count, pair, triple)
    for at, (i, d, k) in enumerate(flat):
        q, p, w = context(d, k)
        own = 0 if held(i) else 1
        earlier = [d[j + 2] for j in range(k - 2) if d[j : j + 2] == d[k - 2 : k]] if k > 1 else []
        n2 = (twos[context(d, k - 1)[1:]] if k else ones[b"\n"]) - own
        tests = [(bool(earlier), earlier[-1:] == [w]), (n2 > 0, threes[q, p, w] > own), (ones[p] > own, twos[p, w] > own), (True, ones[w] > own)]
        falls = []
        for there, holds in tests:
            if there:
                falls.append(holds)
            if there and holds:
                break
        assert [bool(y[list(x).index(at)]) for x, _, y in made if at in x] == falls, (at, d, k)
        want = next((x for x, (there, holds) in enumerate(tests) if there and holds), cm.SPELLED)
        shares = [0.0, (threes[q, p, w] - own) / max(n2, 1), (twos[p, w] - own) / max(ones[p] - own, 1), ones[w] - own]
        assert told[at] == want and (want == cm.SPELLED or math.isclose(10 ** share[at], min(1.0, shares[want]) if 0 < want < 3 else max(1, shares[want])))


def test_cells_learn_what_came_of_them():
    rng = np.random.default_rng(6)
    n = np.zeros((cm.N_CELLS, 2))
    some = rng.choice(cm.N_CELLS, 3000, replace=False)
    true = 1 / (1 + np.exp(-(np.unravel_index(some, cm._SHAPE)[2] - 8) / 2.0))  # depends on one of the contexts alone
    total = rng.integers(1, 400, 3000)
    n[some, 1] = rng.binomial(total, true)
    n[some, 0] = total - n[some, 1]
    p = 10 ** cm.mix_cells(n)
    assert np.allclose(p.sum(axis=1), 1)
    loss = lambda q: -(total * (true * np.log(q) + (1 - true) * np.log(1 - q))).sum() / total.sum()
    assert loss(p[some, 1]) < loss(true) + 0.02
    assert np.allclose(cm.mix_cells(np.zeros((cm.N_CELLS, 2))), math.log10(0.5))


def test_spelled_probabilities_sum_to_one():
    counters = np.zeros(2 * cm._STARTS[-1], np.float32)
    words = [b"ab", b"abc", b"b", b"\n"]
    d = cm.Decisions(words)
    for s in d.slots:
        np.add.at(counters, 2 * s.astype(np.int64) + d.bit, 3)
    speller = cm.Speller(counters.reshape(-1, 2))
    before = speller.log10(words, np.ones(4, bool)).sum()
    for _ in range(20):
        speller.train(words)
    assert speller.log10(words, np.ones(4, bool)).sum() > before
    # over all possible first bytes, the mass of a token's first byte is one
    total = 0.0
    for byte in range(256):
        d = cm.Decisions([bytes([byte])])
        first = np.arange(8) * (1 if byte == 10 else 2)  # the byte itself, then the blank
        _, _, z = speller._mixed(d, False)
        p = 0.5 / (1 + np.exp(-z)) + 0.5 * speller._refined(z, d.node)[2]
        total += np.prod(np.where(d.bit == 1, p, 1 - p)[first])
    assert abs(total - 1) < 1e-3


def test_known_tokens_are_told_by_bits_of_their_class():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    docs = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randint(1, 40))) for _ in range(60)]
    t = cm.Tokens(list(range(60)), pa.array(docs))
    ones = Counter(w for i, d in enumerate(docs) if not held(i) for w in low(d))
    count = np.array([ones[w] for w in t.words])
    masses = np.zeros(32, np.int64)
    np.add.at(masses, cm.class_of(count[count > 0]), count[count > 0])
    own = np.repeat(t.held == 0, t.size)
    told = np.where(count[t.flat] - own > 0, cm.KNOWN, cm.SPELLED).astype(np.int8)
    at, made, share = cm.classes(t, count, told, masses)
    assert (at == np.flatnonzero(told == cm.KNOWN)).all() and len(made) == 5
    kind = sum(y.astype(int) << (4 - j) for j, (_, _, y) in enumerate(made))
    for i, k, s in zip(at, kind, share, strict=True):
        left = ones - Counter([t.words[t.flat[i]]] if own[i] else [])  # as if this token had not been counted
        alike = {w: n for w, n in left.items() if n > 0 and n.bit_length() - 1 == k}
        assert math.isclose(10**s, alike[t.words[t.flat[i]]] / sum(alike.values()))
    # the cells tell the bits before and the tokens before, and the probabilities of all classes add up to one
    n = np.zeros((cm.ALL_CELLS - cm.N_CELLS, 2))
    for _, cell, y in made:
        np.add.at(n, (cell - cm.N_CELLS, y.astype(int)), 1)
    p = 10 ** cm.mix_cells(n, classed=True)
    wide, total = len(p) // 32, 0.0
    for k in range(32):
        path = [(1 << j | k >> (5 - j), k >> (4 - j) & 1) for j in range(5)]
        total += math.prod(p[node * wide + 7, y] for node, y in path)
    assert math.isclose(total, 1.0)
    assert sum(np.log10(p[c - cm.N_CELLS, y.astype(int)]).sum() for _, c, y in made) > np.log10(masses[kind] / masses.sum()).sum()
