"""Substring dedup against a brute force over all positions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np

from sievecraft.llm import substring_dedup as sd


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) > 0).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng):
    text = lambda n: "".join(rng.choices("abcdé fgh", k=n))
    shared = [text(rng.randint(30, 300)) for _ in range(6)]
    rows = [text(rng.randint(0, 400)) for _ in range(30)]
    rows += [text(rng.randint(0, 50)) + rng.choice(shared)[rng.randint(0, 20) :] + text(rng.randint(0, 50)) + rng.choice(shared) for _ in range(40)]
    rows += ["a" * 500, "a" * 90, "ab" * 120, "abc" * 70 + "x" + "abc" * 30, None, "", "é" * 100, shared[0], shared[0], shared[0] + "tail"]
    rows += [shared[1] + text(5) for _ in range(30)]
    return rows


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "RANGE_BYTES", 1 << 11)
    for seed, length in ((1, 40), (2, 64)):
        texts = corpus(random.Random(seed))
        rows = [(i, t, "k") for i, t in enumerate(texts)] + [(3, texts[3], "k"), (None, texts[40], "k")]
        df = spark.createDataFrame(rows, "doc_id long, text string, k1 string").repartition(3)
        got = sd.dedup(df, length).collect()
        want = sorted(str((r[0], *x)) for r, x in zip(rows, brute([r[1] for r in rows], length), strict=True))
        assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == want
    assert sd.dedup(df.limit(0), 40).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 256)
    data = np.frombuffer(random.Random(4).randbytes(3000), np.uint8)
    _, _, start, n = sd.anchors(sd.bs.byte_values(data), 40)
    windows = sorted(x for s, k in zip(start, n, strict=True) for x in range(s, s + k))
    assert windows == list(range(3000 - 40 + 1))


def test_words_of_a_text_in_pieces(monkeypatch):
    data = np.frombuffer(" ".join("".join(random.Random(i).choices("abcéD-", k=i % 40)) for i in range(300)).encode(), np.uint8)
    whole = sd.word_symbols(data)
    monkeypatch.setattr(sd, "PIECE", 256)
    assert all((a == b).all() for a, b in zip(whole, sd.word_symbols(data), strict=True))


def brute_words(texts, length):
    """Words in runs that repeat, the number of runs, and the text without them."""
    found = [[(m.start(), m.end()) for m in re.finditer(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").encode())] for t in texts]
    data = [(t or "").encode() for t in texts]
    names = [[d[a:b].lower() for a, b in own] for d, own in zip(data, found, strict=True)]
    seen = Counter(tuple(w[p : p + length]) for w in names for p in range(len(w) - length + 1))
    out = []
    for d, own, w in zip(data, found, names, strict=True):
        gone = np.zeros(len(w) + 1, bool)
        for p in range(len(w) - length + 1):
            if seen[tuple(w[p : p + length])] > 1:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone))))
        kept, at = b"", 0
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            kept, at = kept + d[at : own[a][0]], own[b - 1][1]
        out.append((int(gone.sum()), len(edges) // 2, (kept + d[at:]).decode()))
    return out


def test_runs_of_words(spark, monkeypatch):
    monkeypatch.setattr(sd, "RANGE_BYTES", 1 << 11)
    rng = random.Random(6)
    word = lambda k=8: "".join(rng.choices("abcdé", k=rng.randint(1, k)))
    text = lambda n, k=8: " ".join(word(k) for _ in range(n))
    passages = [text(51, 2), text(51, 30), text(50), text(90), "x " * 70]
    docs = [f"{text(40)} {p}{end} {text(40)}" for p in passages for end in ("", ".", "! ")] + [text(30) for _ in range(10)]
    docs += [None, "", passages[0], passages[3].replace(" ", ",\n").upper().replace("É", "é"), text(60) + passages[3], "no word here but one"]
    want = brute_words(docs, 51)
    df = spark.createDataFrame([(i, t, "other") for i, t in enumerate(docs)], "doc_id long, text string, ranges string").repartition(3)
    got = {r.doc_id: r for r in sd.dedup(df, length=None, words=51, with_text=True, keep=("ranges",)).collect()}
    assert [(got[i].n_run_words, got[i].n_runs, got[i].kept) for i in range(len(docs))] == want
    assert sum(w[0] > 0 for w in want) >= 14 and all(r.n_removed == 0 and r.ranges == "other" for r in got.values())
    both = {r.doc_id: r for r in sd.dedup(df, 40, words=51).collect()}
    assert [(both[i].n_bytes, both[i].n_removed, both[i].n_spans, both[i].kept_sha256) for i in range(len(docs))] == brute(docs, 40)
    assert [(both[i].n_run_words, both[i].n_runs) for i in range(len(docs))] == [w[:2] for w in want]


def test_limits_of_the_contract(spark):
    # 399, 400 and 401 shared bytes, at the start, in the middle and at the end of texts
    rng = random.Random(9)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    texts = []
    for size in (399, 400, 401):
        for where in range(3):
            shared = text(size)
            for _ in range(2):
                a, b = ("" if where == 0 else "<" + text(70) + chr(65 + len(texts)), "" if where == 2 else chr(97 + len(texts)) + text(70))
                texts.append(a + shared + b)
    got = {r.doc_id: r for r in sd.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [(got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) for i in range(18)] == brute(texts, 400)
    assert [got[i].n_removed for i in range(18)] == [0] * 6 + [400] * 6 + [401] * 6
