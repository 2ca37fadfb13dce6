"""SimHash groups against brute force over all pairs."""

import random
from itertools import combinations

import numpy as np
import xxhash

from sievecraft.llm import components, simhash


def brute_fingerprint(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(codes):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(codes)), 2):
        if (codes[a][1] ^ codes[b][1]).bit_count() <= 4:
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(codes):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(find(i)) for i in range(len(codes))]


def test_triples_meet_every_four_positions():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


def test_groups(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgéH\xa0", k=rng.randint(1, 6)))
    base = [[word() for _ in range(rng.randint(1, 300))] for _ in range(12)]
    texts = []
    for _ in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = word()
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    texts += [None, "", " \n\t", "a", "A", "a b", "x " * 60_000] + ["same words here"] * 5
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(5, texts[5], 1), (None, texts[6], 1), (None, "lone words in a null row", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint long")
    codes = [(i, brute_fingerprint(t)) for i, t, _ in rows]
    want = sorted(str((i, c, g)) for (i, c), g in zip(codes, brute_groups(codes), strict=True))
    for list_rows in (20_000, 6):
        got = simhash.near_duplicates(df, list_rows=list_rows).collect()
        assert sorted(str((r.doc_id, r.fingerprint % 2**64, r.component_id)) for r in got) == want
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 299)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 160)) and got[300] == got[299] == 299 and 200 not in got


def test_spark_hash_agrees(spark):
    # hashes of the first and last texts by the engine's own XXH64, for reference
    got = spark.sql("SELECT xxhash64('a b c d') AS h").first().h
    assert got % 2**64 == xxhash.xxh64(b"a b c d", seed=42).intdigest()


def reach(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(int(a)), find(int(b))))
        root[b] = a
    return [find(i) for i in range(n)]


def test_lists_join_all_that_is_near():
    rng = np.random.default_rng(3)
    for size in (30, 400):  # compared place by place, and searched
        key = np.sort(rng.integers(0, 2 if size > 100 else 3, size)).astype(np.uint32)
        code = rng.integers(0, 2**64, (12, 2), dtype=np.uint64)[rng.integers(0, 12, size)] ^ (np.uint64(1) << rng.integers(0, 64, (size, 2), dtype=np.uint64))
        want = [(i, j) for i, j in combinations(range(size), 2) if key[i] == key[j] and np.bitwise_count(code[i] ^ code[j]).sum() <= 4]
        assert reach(size, simhash.near_pairs(key, code, 4)) == reach(size, want)
        a, b = np.array(want).T
        moved, least = simhash.stars(a, b)
        assert reach(size, zip(moved, least, strict=True)) == reach(size, want) and len(moved) < size


def test_blocks_of_a_long_list_meet(spark):
    texts = template_family(random.Random(5), 60, 3, 20)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = {r.doc_id: r.component_id for r in simhash.similar(df, list_rows=10).collect()}
    assert cut == {r.doc_id: r.component_id for r in simhash.similar(df).collect()} and cut[60] == cut[0]


def test_one_of_each_on_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " more"
    rows = [(5, text, 1, True), (5, "another text under the same id as before", 2, True), (7, near, 3, None), (8, text, 4, True), (8, text, 4, True), (None, "no id here at all", 5, True), (None, near, 6, True), (9, None, 7, True), (10, " ", 8, True), (11, None, 9, True), (12, "alone in the world of words", 0, False), (12, "alone in the world of words", 0, False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k1 long, maybe boolean")
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "", r.k1) for r in got.collect()) == sorted([(5, text, 1), (5, rows[1][1], 2), (0, "no id here at all", 5), (9, "", 7), (12, rows[-1][1], 0)])
    assert simhash.one_of_each(df.limit(0)).count() == 0


def template_family(rng, size, varied, pairs, words=300):
    """Texts of one template with ``varied`` words of their own each; ``pairs`` of them have a near copy."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    texts = []
    for _ in range(size):
        own = list(base)
        for k in rng.sample(range(words), varied):
            own[k] = f"v{rng.randrange(10**6)}"
        texts.append(own)
    copies = []
    for own in texts[:pairs]:
        near = list(own)
        for k in rng.sample(range(words), 5):
            near[k] = f"u{rng.randrange(10**6)}"
        copies.append(near)
    return [" ".join(t) for t in texts + copies]


def test_near_copies_within_a_template_family(spark):
    texts = template_family(random.Random(8), 1500, 8, 40)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar(df).collect()}
    assert all(got[1500 + i] == got[i] for i in range(40))


def test_only_near_copies_are_linked(spark):
    # a template family of J = 0.62, texts dominated by one repeated line, and shared prose in another order
    texts = template_family(random.Random(9), 400, 8, 10)
    line = "all rights reserved by the owner of this page and its parts "
    texts += [line * 60 + f"some words of the {i} text that {i} differ {i}" + f" tail{i}" * 3 for i in range(6)]
    rng = random.Random(10)
    long = [[f"p{rng.randrange(400)}" for _ in range(rng.randint(100, 400))] for _ in range(20)]
    texts += [" ".join(t) for t in long] + [" ".join(t[:-3] + ["end"]) for t in long]
    df = spark.createDataFrame([*enumerate(texts), (9000, None), (9001, " "), (9002, "one two"), (9003, "one two three")], "doc_id long, text string")
    shingles = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if len(shared := shingles[a] & shingles[b]) / (len(shingles[a]) + len(shingles[b]) - len(shared)) >= 0.8:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    want = {i: find(i) for i in range(len(texts))} | {9000: 9000, 9001: 9000, 9002: 9002, 9003: 9003}
    got = {r.doc_id: r.component_id for r in simhash.similar(df).collect()}
    assert all(got[i] in (c, i) for i, c in want.items()) and sum(got[i] == c for i, c in want.items()) >= len(want) - 1
    assert sum(c != i for i, c in want.items()) >= 30
