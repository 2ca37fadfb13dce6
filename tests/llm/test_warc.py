"""Archives: exact round trip, revisits and globally ordered captures."""

import base64
import hashlib
import random

from sievecraft.llm import hamming_search, warc


def test_loser_tree_merges():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_round_trip(spark):
    odd = "a\r\n\r\nb\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(i, f"http://www.h{i % 3}.example.org/p{i % 5}?q#f", ["x", "", None, odd, "é" * 50_000, f"own {i}"][i % 6], "k") for i in range(60)]
    rows += [(3, "https://a.example.com", odd, "k"), (None, None, odd, "k"), (None, "u", "alone", "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, run string")
    got = warc.round_trip(df).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    order = [(r.url_key, r.date, r.page_id is None, r.page_id or 0) for r in got]
    assert order == sorted(order)
    groups = {}
    for i, _, html, _ in rows:
        groups.setdefault(html or "", []).append(i)
    want = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        first = min((x for x in groups[html or ""] if x is not None), default=None)
        own = i == first
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if own else "revisit", None if own else first))
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_url_keys():
    assert warc.url_key("HTTP://WWW.Example.com:8080?b=1#x") == "com,example)/?b=1"
    assert warc.url_key("") == ")/"


def test_hamming_matches_brute_force(spark):
    rng = random.Random(5)
    base = [[rng.gauss(0, 1) for _ in range(70)] for _ in range(40)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in base[i % 40]], "q") for i in range(400)] + [(1000 + i, base[0], "q") for i in range(60)]
    rows += [(7, None, "q"), (None, base[0], "q"), (100, base[1][:10], "q"), (200, [], "q"), (300, [None, float("nan"), 1.0], "q")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id string")
    got = {}
    for r in hamming_search.top_k(df, df.filter("vec_id % 100 = 0"), "vec_id", "embedding", k=7, query_block=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.distance, r.neighbour_id))
    code = lambda v: [int(i < len(v) and v[i] is not None and v[i] > 0) for i in range(128)]
    table = [(i, code(v)) for i, v, _ in rows if i is not None and v is not None]
    want = {}
    for a, (i, c) in enumerate(table):
        if i % 100 == 0:
            near = sorted((sum(x != y for x, y in zip(c, d, strict=True)), j) for b, (j, d) in enumerate(table) if b != a)[:7]
            want.setdefault(i, []).extend((n + 1, d, j) for n, (d, j) in enumerate(near))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert hamming_search.top_k(df.limit(0), df.limit(0), "vec_id", "embedding").count() == 0


def test_pages_that_end_in_line_ends(spark):
    ends = ["a\r\n", "\r\n", "b\r\n\r\n\r\n", "\r\n\r\n", "c\r", "d\r\n\r", "\n", "\r\ne", "f\n\r\n", "\r\n" * 7]
    rows = [(i, "http://x.org", html, None) for i, html in enumerate(ends + ends[:3])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, run string")
    for parts in (1, 20):  # in the middle and at the end of archives
        got = {r.page_id: r for r in warc.round_trip(df.repartition(parts)).collect()}
        assert len(got) == len(rows) and all(r.intact for r in got.values())
        for i, _, html, _ in rows:
            assert (got[i].payload_bytes, got[i].payload_digest) == (len(html), base64.b32encode(hashlib.sha1(html.encode()).digest()).decode())
            assert got[i].record_type == ("response" if i < len(ends) else "revisit")
