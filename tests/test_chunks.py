"""Size-bounded files against a plain cut, lists that can't be cut, and lists of many files."""

import json
import random
import time

from pyspark.sql import functions as F

from sievecraft.operators import output, publish
from sievecraft.profile import BUCKET, Profile

SCHEMA = "list_id string, bucket int, k1 long, k2 long, k3 long, atomic boolean"


def plain(rows, max_rules, least):
    """(list, bucket, k1, k2, chunk) by one walk over each list; no chunk for a list that can't be cut."""
    out = []
    for name in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == name)
        body, tail = [r for r in own if r[1] < 8], [r for r in own if r[1] >= 8]
        room, start, inside = max_rules - len(tail), {}, {}
        for i, r in enumerate(body):
            if r[5] or r[1] <= 1:
                key = -1 if r[1] <= 1 else r[2]
                inside[i] = start.setdefault(key, i)
        if len(own) <= max_rules:
            out += [(*r[:4], 1) for r in own]
        elif room < least:
            out += [(*r[:4], None) for r in own]
        else:
            i, chunk = 0, 1
            while i < len(body):
                j = min(i + room, len(body))
                if j < len(body) and inside.get(j, j) < j:
                    j = max(inside[j], i + 1)
                out += [(*r[:4], chunk) for r in body[i:j] + tail]
                i, chunk = j, chunk + 1
    return sorted(out, key=str)


def made(rng, name, body, tail, width):
    rows = []
    for k in range(body):
        atomic = rng.random() < 0.4
        rows += [(name, BUCKET["block"], k, j, 0, atomic) for j in range(rng.randint(1, width))]
    return rows + [(name, BUCKET["generichide"], k, 0, 0, False) for k in range(rng.randint(0, 9))] + [(name, BUCKET["exception"], k, 0, 0, False) for k in range(tail)]


def test_cuts_and_lists_without_room(spark):
    rng = random.Random(8)
    rows = made(rng, "a", 300, 3, 6) + made(rng, "wide", 40, 2, 60) + made(rng, "small", 4, 2, 2) + made(rng, "none", 90, 40, 3) + made(rng, "little", 60, 14, 2) + made(rng, "tail", 0, 50, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for least in (None, 1):
        got = output.chunks(df, 20, least).select("list_id", "bucket", "k1", "k2", "chunk").collect()
        assert sorted(map(tuple, got), key=str) == plain(rows, 20, least or 10)


def test_a_list_without_room_leaves_the_others(spark, tmp_path):
    blocks = "".join(f"||h{i}.net^$script\n" for i in range(30))
    texts = spark.createDataFrame([("good", blocks), ("odd", blocks + "".join(f"@@||ok{i}.net^\n" for i in range(25)))], "list_id string, content string")
    publish.publish(spark, texts, str(tmp_path / "out"), Profile(max_rules=20))
    index = json.loads((tmp_path / "out/index.json").read_text())
    assert [x["id"] for x in index["lists"]] == ["good"] and [(x["id"], x["reason"].split(" leave")[0]) for x in index["unpublished"]] == [("odd", "25 exceptions")]
    assert not list((tmp_path / "out").glob("odd*.json"))


def many_files(spark, atomic):
    rows = spark.range(1_200_000).select(F.lit("l").alias("list_id"), F.lit(2).alias("bucket"), F.shiftright("id", 1).alias("k1"), (F.col("id") % 2).alias("k2"), F.lit(0).cast("long").alias("k3"), F.lit(atomic).alias("atomic"))
    began = time.monotonic()
    got = output.chunks(rows, 21 if atomic else 20).groupBy("chunk").agg(F.count("*").alias("n"), F.count_distinct("k1").alias("k")).groupBy("n", "k").count().collect()
    assert [(r.n, r.k, r["count"]) for r in got] == [(20, 10, 60_000)] and time.monotonic() - began < 60


def test_many_files(spark):
    """What a row costs must not grow with the files of its list."""
    many_files(spark, False)


def test_many_atomic_files(spark):
    """The same where all rules stand in atomic ranges."""
    many_files(spark, True)


def test_only_split_lines_are_sorted(spark):
    """Rules of lines that lie in one file as a whole are met by units of lines, unsorted: one window is left, of the few lines that are split."""
    df = spark.createDataFrame([("l", BUCKET["block"], k, j, 0, True) for k in range(9) for j in range(3)], SCHEMA)
    told = output.chunks(df, 10).groupBy("list_id", "k1").agg(F.min("chunk"), F.max("chunk"))
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert "SortMergeJoin" not in told._jdf.queryExecution().executedPlan().toString()
    assert sum("row_number" in x and "k2" in x for x in plan.splitlines()) == 1
    assert sorted((r.k1, *r[2:]) for r in told.collect()) == [(k, k // 3 + 1, k // 3 + 1) for k in range(9)]


def test_long_lines_wide_heads_and_far_keys(spark):
    """Lines of many places, a head that no file holds, units with many files, keys too far apart to be counted together; rows in any order."""
    rows = [("long", BUCKET["block"], k, j, 0, False) for k, n in ((3, 700), (4, 1), (300, 900), (1 << 61, 2), (-(1 << 61), 40)) for j in range(n)]
    rows += [("whole", BUCKET["block"], k, j, 0, k % 2 == 0) for k, n in ((1, 5), (2, 600), (3, 300), (520, 30), (521, 90)) for j in range(n)] + [("whole", BUCKET["exception"], 9, 0, 0, False)]
    rows += [("head", BUCKET["generic_css"], 0, 0, j, False) for j in range(70)] + [("head", BUCKET["generichide"], k, 0, 0, False) for k in range(9)] + [("head", BUCKET["block"], k, 0, 0, False) for k in range(60)]
    random.Random(5).shuffle(rows)
    got = output.chunks(spark.createDataFrame(rows, SCHEMA).repartition(3), 50, 1)
    told = got.select("list_id", "bucket", "k1", "k2", "k3", "position", "chunk").collect()
    assert sorted((r.list_id, r.bucket, r.k1, r.k2, r.chunk) for r in told) == sorted((r[0], r[1], r[2], r[3], r[4]) for r in plain(rows, 50, 1))
    for name in ("long", "whole", "head"):
        own = sorted({(r.bucket, r.k1, r.k2, r.k3, r.position) for r in told if r.list_id == name})
        assert [x[4] for x in own] == list(range(1, len(own) + 1))
