"""Golden cases of whole compilations, their outputs and invariants."""

import json

from pyspark.sql import functions as F

from sievecraft.operators import compile as cp
from sievecraft.operators import output, overlap, validate
from sievecraft.profile import BUCKET, Profile
from sievecraft.sources import catalogue as cat
from sievecraft.sources import lists

HEAD, END = r"^[htpsw]+://([a-z0-9-]+\.)*", "[/:&?=,;]"


def rows(spark, lines, name="l"):
    return spark.createDataFrame([(name, i, x) for i, x in enumerate(lines)], "list_id string, line_no long, raw string")


def compiled(spark, lines, **profile):
    made = cp.compile_lists(rows(spark, lines), Profile(**profile))
    rules = [(r.bucket, {k: v for k, v in r.trigger.asDict().items() if v is not None}, r.action, r.selector) for r in cp.assemble(made.rules).orderBy("position").collect()]
    return made, rules


def test_order_of_sections(spark):
    _, got = compiled(spark, ["##.ad", "||ads.net^", "shop.net##.promo", "@@||shop.net^$generichide"])
    assert [r[0] for r in got] == [BUCKET[x] for x in ("generic_css", "generichide", "block", "guard", "specific_css")]
    assert got[1][1]["if-top-url"] and "resource-type" not in got[1][1]
    _, got = compiled(spark, ["shop.net,else.net##.promo", "sub.shop.net##.x", "@@||shop.net^$specifichide"])
    assert [r[1]["url-filter"] for r in got] == [HEAD + r"else\.net" + END]
    _, got = compiled(spark, ["@@||a.com^$document", "||ads.net^$script", "@@||b.com/x^", "||c.com^$document", "||d.com^$cookie", "@@||e.com^$urlblock"])
    assert [r[0] for r in got] == [BUCKET[x] for x in ("block", "guard", "block_document", "cookie", "urlblock", "exception", "page_exception")]


def test_lines_act_on_lines(spark):
    made, got = compiled(spark, ["||trk.net^$third-party", "||trk.net^$third-party,badfilter", "||x.com^", "||x.com^", "##.ad", "#@#.ad", "a.com,b.fr##.x", "a.com#@#.x", "brand.*##.ad2", "[$path=/app]blog.net##.y"])
    assert [r[1].get("url-filter") for r in got if r[2] == "block"] == [HEAD + r"x\.com" + END]
    assert [r[3] for r in got if r[3]] == [".x", ".ad2", ".y"]
    reasons = {r.line_no: r.reason for r in made.lines.collect()}
    assert reasons[0] == "badfilter_retracted" and reasons[1] == "badfilter_directive" and reasons[4] == "cos_excepted_global" and reasons[5] is None
    assert {r.note: r.n for r in made.notes.collect()}["duplicate_merged"] == 1
    _, old = compiled(spark, ["brand.*##.ad"], safari_version=15)
    assert len(old) > 20


def test_costly_selectors_and_packets(spark):
    made, got = compiled(spark, ["##.ok", "###trap ~ *", "##.board > *, .fine"])
    assert [r[3] for r in got] == [".ok, .fine"]
    assert sorted(r.entry.selector for r in made.annex.collect()) == ["#trap ~ *", ".board > *"]
    _, got = compiled(spark, [f"##.s{i}" for i in range(7)], css_group_size=3)
    assert [r[3].count(",") + 1 for r in got] == [3, 3, 1]


def test_every_line_is_counted_once(spark):
    lines = ["! c", "", "||a.com^", "b.com##.x", "b.com#?#.x:has-text(a)", "||c^$foo", "[$path=/a]b.com##.z", "[$broken", "# note", "@@||d.com^", "/[/", "||e.com^$domain=/(/", " ||f.com^ "]
    made, _ = compiled(spark, lines)
    got = made.lines.collect()
    assert sorted(r.line_no for r in got) == list(range(len(lines)))
    assert not any((r.reason or "").startswith("parse_error") for r in got)
    assert cp.compile_lists(rows(spark, []), Profile()).rules.count() == 0


def test_partitions_do_not_matter(spark):
    lines = [f"||h{i % 50}.com^" for i in range(200)] + [f"s{i % 9}.com##.a{i % 30}" for i in range(200)] + [f"##.g{i % 20}" for i in range(100)]
    one = cp.assemble(cp.compile_lists(rows(spark, lines).coalesce(1)).rules)
    many = cp.assemble(cp.compile_lists(rows(spark, lines).repartition(7)).rules)
    show = lambda df: [str(r) for r in df.orderBy("list_id", "position").collect()]
    assert show(one) == show(many)


def test_files_are_valid_arrays(spark, tmp_path):
    lines = [f"||h{i}.com^$script" for i in range(30)] + ["*$image,denyallow=a.com|b.com|c.com,domain=s.org", "@@||ok.com^", "##.x", "a.com##+js(set, a, 1)"]
    made = cp.compile_lists(rows(spark, lines))
    done = output.write_rules(output.chunks(made.rules, 20), str(tmp_path))
    assert sum(d["rules"] for d in done) == 1 + 30 + 4 + 1 + len(done) and all(d["rules"] <= 20 for d in done) and len(done) == 2
    files = [json.loads((tmp_path / d["file"]).read_text()) for d in done]
    assert all(f[-1] == {"trigger": {"url-filter": HEAD + r"ok\.com" + END}, "action": {"type": "ignore-previous-rules"}} for f in files)
    where = {r["trigger"]["url-filter"]: k for k, f in enumerate(files) for r in f if r["trigger"].get("resource-type") == ["image"]}
    assert len(set(where.values())) == 1
    raw = spark.createDataFrame([(d["file"], (tmp_path / d["file"]).read_text()) for d in done], "file string, content string")
    assert validate.faults(validate.parse_files(raw)).count() == 0
    (side,) = output.write_annex(made.annex, str(tmp_path / "annex"))
    assert side["scriptlets"] == 1
    again = cp.compile_lists(rows(spark, lines))
    assert json.loads((tmp_path / "annex" / side["file"]).read_text()) == {"counts": {"scriptlets": 1}, "sha256": side["sha256"], "scriptlets": [{"domains": ["a.com"], "name": "set", "args": ["a", "1"], "syntax": "ubo"}]}
    digest = lambda m: output.annex_digest(m.annex).first().digest
    assert digest(made) == digest(again) != digest(cp.compile_lists(rows(spark, [*lines[:-1], "a.com##+js(set, a, 2)"])))


def test_reports(spark):
    made = cp.compile_lists(rows(spark, ["||a.com^", "||b.com^$csp=x", "##.x", "! c", "||c^$foo"]))
    r = output.report(made).first()
    assert (r.lines_total, r.rules_in, r.comments, r.skipped, r.converted, r.coverage_pct, r.published) == (5, 4, 1, 2, 2, 50.0, True)
    assert r.reasons == {"mod_unsupported:csp": 1, "mod_unknown:foo": 1} and r.familys == {"csp": 1}
    assert "| l | 4 | 3 | 50.0 % |" in output.markdown(output.report(made), made.lines)
    both = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "list_id string, url_filter string")
    assert {(r.a, r.b, r.pct) for r in overlap.coverage(both).collect()} == {("a", "b", 50), ("b", "a", 100)}


def test_list_texts(spark, tmp_path):
    (tmp_path / "one.txt").write_bytes(b"! Title: T\r\na\x0bb\xff\n\n")
    got = lists.split_lines(lists.read_texts(spark, str(tmp_path)))
    assert [(r.line_no, r.raw) for r in got.orderBy("line_no").collect()] == [(1, "! Title: T"), (2, "a"), (3, "b�"), (4, "")]
    assert lists.headers(got).first().value == "T"
    path = tmp_path / "sources.json"
    path.write_text('{"defaults": {"format": "adblock"}, "groups": [{"id": "g", "maintainer": "M", "lists": [{"id": "a", "name": "A", "url": "https://x.org/a"},]}]}')
    try:
        cat.read_catalogue(spark, str(path))
        raise AssertionError
    except cat.CatalogueError as e:
        assert "comma" in str(e)
    path.write_text(path.read_text().replace(",]", "]"))
    assert cat.unfold(cat.read_catalogue(spark, str(path))).first().file == "a.txt"


def test_stream_of_lists(spark, tmp_path):
    from sievecraft.streaming.refresh import refresh

    folder = tmp_path / "in"
    folder.mkdir()
    seen = []
    for k, text in enumerate(("||a.com^\n||b.com^", "##.x\n! c")):
        (folder / f"l{k}.txt").write_text(text)
        refresh(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "cp"), done=lambda r: seen.append(sorted(x.list_id for x in r.collect()))).awaitTermination()
    assert seen == [["l0"], ["l1"]]
    reports = spark.read.parquet(str(tmp_path / "out"))
    assert {r.list_id: r.rules_out for r in reports.collect()} == {"l0": 3, "l1": 1}


def test_state_machine_and_order(spark):
    plan = cat.refresh_plan(spark.createDataFrame([("a", 10)], "id string, expires long"), spark.createDataFrame([], "id string, etag string, last_modified string, sha256 string, fetched_at string"), "2026-01-01T00:00:00Z")
    got = cat.refresh_state(plan, spark.createDataFrame([("a", 200, "x" * 40)], "id string, code int, content string"), "2026-01-01T00:00:00Z").first()
    assert got.status == "updated" and got.bytes == 40
    assert F is not None
