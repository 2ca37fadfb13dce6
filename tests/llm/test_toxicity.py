"""The field's inference against plain forward-backward, and held-out accuracy."""

import math
import random

import numpy as np

from sievecraft.llm import toxicity as tx


def test_marginals_equal_the_plain_recursion():
    rng = np.random.default_rng(1)
    model = tx.Field({}, rng.normal(size=2), rng.normal(size=(2, 2)), -0.7, np.zeros(3))
    for n, at in ((1, [0]), (6, [0, 3]), (9, [8]), (12, [1, 2, 3, 11]), (200, [50, 51, 190])):
        e = rng.normal(size=len(at))
        full = np.full(n, model.bias)
        full[at] += e
        p = np.stack((np.ones(n), np.exp(full)), axis=1)
        a, b, step = np.empty((n, 2)), np.ones((n, 2)), np.exp(model.step)
        a[0] = np.exp(model.start) * p[0]
        for t in range(1, n):
            a[t] = (a[t - 1] @ step) * p[t]
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = step @ (p[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        want = (a * b)[:, 1] / (a * b).sum(axis=1)
        assert np.allclose(model.marginals(n, at, e.tolist()), want[at], atol=1e-9)


def test_held_out_documents(spark):
    rng = random.Random(2)
    common = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    bad = ["wretch", "foolish", "vermin"]

    def doc(toxic):
        words = rng.choices(common, k=rng.randint(10, 120))
        for _ in range(rng.randint(2, 5) * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad).upper() + rng.choice(["", "er", "est"])
        return " ".join(words)

    marks = [int(rng.random() < 0.25) for _ in range(500)]
    texts = [doc(y) for y in marks]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(900, None, "x"), (901, "", "x"), (902, "a " * 100_000 + "vermin! vermin", "x"), (3, texts[3], "x"), (None, "wretch", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, y in enumerate(marks)] + [(5, marks[5], 1), (7, None, 0), (None, 1, 0)], "doc_id long, toxic int, text int")
    model = tx.train(docs, labels)
    got = tx.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    held = [i for i in range(500) if __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    right = sum((by[i].score >= tx.THRESHOLD) == bool(marks[i]) for i in held)
    assert right >= 0.97 * len(held)
    assert by[900].score == by[901].score < 0.3 < by[902].score
    assert [(s.start, s.end) for s in by[902].spans] == [(200_000, 200_006), (200_008, 200_014)]
    assert math.isclose(by[3].score, tx.score(docs.filter("doc_id = 3"), model).first().score)
    assert tx.train(docs, labels.limit(0)) is None and tx.score(docs, None).filter("score > 0").count() == 0
    assert tx.score(docs.limit(0), model).count() == 0
