"""FM-index search against brute force over words."""

import hashlib
import random
import re

import numpy as np

from sievecraft.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, window):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            b = words(text)
            for at in range(max(1, len(b) - window + 1) if b else 0):
                gram = b[at : at + window]
                for p in range(len(w) - len(gram) + 1):
                    if w[p : p + len(gram)] == gram:
                        hit.update(range(p, p + len(gram)))
                        found.add(item)
        found = sorted(str(x) for x in found if x is not None)
        out.append(str((i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit))))
    return sorted(out)


def test_index_finds_and_locates():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 5, 600)
    index = dc.FMIndex(text, 9)
    for n in (1, 2, 5):
        patterns = np.stack([text[i : i + n] for i in range(0, 500, 7)] + [np.full(n, 8)])
        low, high = index.search(patterns, np.full(len(patterns), n))
        for p, a, b in zip(patterns, low, high, strict=True):
            want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dc, "SHARD_BYTES", 4000)
    rng = random.Random(9)
    vocabulary = ["a", "B", "cc", "dé", "x1", "the", "of"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "_"]) for _ in range(n))
    items = [(k, text(rng.randint(5, 14))) for k in range(12)] + [(50, "lonely"), (51, None), (52, " .. "), (None, "nobody's item"), (3, "second text of three, quite long, is here for sure today ok")]
    docs = [(i, text(rng.randint(0, 120)) + rng.choice([t or "" for _, t in items]).upper() + " zz " + text(9)) for i in range(80)]
    docs += [(900, None), (901, ""), (902, "lonely"), (903, "word " * 50_000 + items[0][1]), (4, docs[4][1]), (None, "Nobody's item"), (905, "lone"), (906, "ly")]
    df = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, items string").repartition(3)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items] + [(0, items[0][1], 2)], "item_id long, text string, doc_id int")
    for window in (3, 10):
        want = brute(docs, items, window)
        for block in (1 << 21, 40):
            got = dc.summary(dc.scan(df, bench, window, block_words=block)).collect()
            assert sorted(str(tuple(r)) for r in got) == want
    spans = {r.doc_id: r for r in dc.scan(df, bench, 10, keep=("items",)).collect()}
    data = docs[-5][1].encode()
    s = spans[903].spans[-1]
    assert words(data[s.first_byte : s.end_byte].decode()) == words(data.decode())[s.first_word : s.end_word]
    assert dc.scan(df.limit(0), bench).count() == 0
    assert dc.summary(dc.scan(df, bench.limit(0))).filter("contaminated").count() == 0
