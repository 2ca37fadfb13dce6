"""Fetching by a made-up transport, and everything a run writes."""

import json

from sievecraft.operators import output, publish
from sievecraft.profile import Profile
from sievecraft.sources import catalogue as cat
from sievecraft.sources import fetch, lists

TEXT = "! Title: One\n||a.net^\n||b.net^\n! a comment that makes the text long enough\n"


def server():
    """A transport of known answers; made in a function, as workers do not know this module."""

    def served(url, headers, seconds):
        """A server of known answers."""
        answers = {
            "https://l.org/ok.txt": lambda: fetch.Response(200, url, TEXT.encode(), {"ETag": "e1"}),
            "https://l.org/same.txt": lambda: fetch.Response(304 if headers.get("If-None-Match") == "e0" else 200, url, b"x" * 50, {}),
            "https://l.org/gone.txt": lambda: fetch.Response(404, url),
            "https://l.org/moved.txt": lambda: fetch.Response(200, "http://l.org/plain.txt", TEXT.encode()),
            "https://l.org/large.txt": lambda: fetch.Response(200, url, b"x" * 5000),
            "https://mirror.org/gone.txt": lambda: fetch.Response(200, url, TEXT.encode()),
            "https://l.org/parts/a.txt": lambda: fetch.Response(200, url, b"||part.net^\n!#include b.txt\n"),
            "https://l.org/parts/b.txt": lambda: fetch.Response(200, url, b"||deep.net^\n"),
        }
        if url not in answers:
            raise OSError("no route")
        return answers[url]()

    return served


served = server()
POLICY = fetch.Policy(retries=2, wait=0.0, max_bytes=4000)


def test_one_address_at_a_time():
    tried = []

    def flaky(url, headers, seconds):
        tried.append(url)
        return fetch.Response(503 if len(tried) < 2 else 200, url, b"fine")

    assert fetch.get(flaky, "https://x.org/l", POLICY).body == b"fine" and len(tried) == 2
    for url, why, n in (("http://x.org/l", "not a secure", 0), ("https://l.org/gone.txt", "HTTP 404", 1), ("https://l.org/moved.txt", "redirected", 1), ("https://l.org/large.txt", "more than 4000", 1), ("https://l.org/none", "no route", 2)):
        calls = []
        try:
            fetch.get(lambda u, h, s, calls=calls: calls.append(u) or served(u, h, s), url, POLICY)
            raise AssertionError(url)
        except fetch.FetchError as e:
            assert why in str(e) and len(calls) == n


def test_refresh_from_fetch_to_index(spark, tmp_path):
    rows = spark.createDataFrame([(k, i, f"https://l.org/{i}.txt", f"N {i}", f"{i}.txt", 100, "https://mirror.org/gone.txt" if i == "gone" else None) for k, i in enumerate(["ok", "same", "gone", "moved", "fresh"])], "pos long, id string, url string, name string, file string, expires long, mirror_url string")
    path = tmp_path / "index.json"
    path.write_text(json.dumps({"lists": {i: {"etag": "e0", "sha256": "s", "fetched_at": at, "rules": 7, "title": "old", "rules_sha256": f"r{i}"} for i, at in (("same", "2026-01-01T00:00:00Z"), ("moved", "2026-01-01T00:00:00Z"), ("fresh", "2026-01-02T00:00:00Z"))}}))
    state, now = cat.read_state(spark, str(path)), "2026-01-02T00:00:30Z"
    plan = cat.refresh_plan(rows, state, now)
    got = fetch.fetch(plan, served, POLICY, 2).persist()
    assert {r.id: (r.code, r.kind) for r in got.collect()} == {"ok": (200, "source"), "same": (304, "source"), "gone": (200, "mirror"), "moved": (None, "mirror")}
    done = cat.refresh_state(plan, got, now)
    assert {r.id: r.status for r in done.collect()} == {"ok": "updated", "same": "unchanged", "gone": "updated", "moved": "failed", "fresh": "fresh"}
    texts = got.join(done.filter("status = 'updated'").select("id"), "id").selectExpr("id AS list_id", "content", "0 AS includes", "0 AS preproc_dropped")
    text = cat.index_json(cat.index_entries(rows, state, done, got, texts), now)
    index = json.loads(text)["lists"]
    assert list(index) == ["ok", "same", "gone", "moved", "fresh"] and json.loads(text)["summary"]["updated"] == 2
    assert index["ok"]["rules"] == 2 and index["ok"]["title"] == "One" and index["ok"]["etag"] == "e1" and index["gone"]["duplicate_of"] == "ok"
    assert index["moved"]["status"] == "failed" and "redirected" in index["moved"]["error"] and index["moved"]["rules"] == 7 and index["same"]["fetched_at"] == now
    output.write_text(spark, str(path), text)
    again = {r.id: r for r in cat.read_state(spark, str(path)).collect()}
    assert again["gone"].duplicate_of == "ok" and again["ok"].rules_sha256 == index["ok"]["rules_sha256"]


def test_included_texts_are_fetched(spark):
    lines = spark.createDataFrame([("l", 1, "||top.net^"), ("l", 2, "!#include parts/a.txt"), ("l", 3, "!#include https://else.org/x.txt")], "list_id string, line_no long, raw string")
    urls = spark.createDataFrame([("l", "https://l.org/list.txt")], "list_id string, url string")
    library = fetch.fetch_library(spark, lines, urls, served, POLICY)
    whole = lists.resolve_includes(lines, urls, library)
    assert [r.raw for r in whole.orderBy("line_no").collect() if r.raw.startswith("||")] == ["||top.net^", "||part.net^", "||deep.net^"]


def test_publish(spark, tmp_path):
    out = str(tmp_path / "out")
    blocks = "".join(f"||h{i}.net^$script\n" for i in range(30))
    texts = spark.createDataFrame([("full", blocks + "@@||ok.net^\na.net##+js(log, u, 1)\n"), ("poor", "||one.net^\n" + "x.net#%#run()\n" * 120), ("copy", blocks), ("hosts", "0.0.0.0 t.net\n" * 3)], "list_id string, content string")
    state = spark.createDataFrame([("full.txt", "Full list", None), ("copy.txt", "Copy", "full"), ("gone.txt", "Gone", None)], "file string, name string, duplicate_of string")
    said = publish.publish(spark, texts, out, Profile(max_rules=20), state)
    index = json.loads((tmp_path / "out/index.json").read_text())
    assert [x["id"] for x in index["lists"]] == ["full", "hosts"] and [x["id"] for x in index["unpublished"]] == ["poor"] and "2 lists" in said and "not published" in said
    full = index["lists"][0]
    assert full["name"] == "Full list" and [f["file"] for f in full["files"]] == ["full-1.json", "full-2.json"] and full["rules_unique"] == 32 and full["rules_emitted"] == 33
    rules = [json.loads((tmp_path / "out" / f["file"]).read_text()) for f in full["files"]]
    assert [len(r) for r in rules] == [f["rules"] for f in full["files"]] and all(r[-1]["action"]["type"] == "ignore-previous-rules" for r in rules) and all((tmp_path / "out" / f["file"]).stat().st_size == f["bytes"] for f in full["files"])
    side = json.loads((tmp_path / "out" / full["extended_file"]).read_text())
    assert side["counts"] == {"scriptlets": 1} and side["scriptlets"][0]["args"] == ["u", "1"] and side["sha256"] == full["extended_sha256"]
    assert json.loads((tmp_path / "out/reports/poor.report.json").read_text())["published"] is False and "| full | 32 | 32 |" in (tmp_path / "out/reports/CONVERSION.md").read_text()
    # a run of some lists leaves the others' files, a full one takes them away
    publish.publish(spark, texts.filter("list_id = 'hosts'"), out, Profile(), state, full=False)
    assert (tmp_path / "out/full-1.json").exists()
    publish.publish(spark, texts.filter("list_id = 'hosts'"), out, Profile(), state)
    left = {p.name for p in (tmp_path / "out").rglob("*.json")}
    assert left == {"hosts.json", "index.json", "hosts.report.json"}
