"""Verdicts of rules on requests, against trying every rule on every request."""

import random
import re

from pyspark.sql import functions as F

from sievecraft.operators import compile as cp
from sievecraft.operators import evaluate
from sievecraft.profile import Profile


def test_literals_stand_in_every_match(spark):
    rng = random.Random(1)
    pieces = ["abc", "x", r"\.", r"\?", "[0-9]", "(ad)", "(ad)?", "(u(vw)?)", "(kk)*", "b*", "c?", "d+", ".*", r"\(", "/img/", "[a-z]+", "((pq)r)", r"\\"]
    rows = []
    for i in range(300):
        rx = "".join(rng.choices(pieces, k=rng.randint(1, 6)))
        rows.append((i, rng.choice(["", r"^[htpsw]+://([a-z0-9-]+\.)*", "^"]) + rx + rng.choice(["", "[/:&?=,;]", "$"])))
    found = spark.createDataFrame(rows, "i int, rx string").withColumn("l", evaluate.literals(F.col("rx"))).collect()
    example = {"[0-9]": "7", "[a-z]+": "z", ".*": "", "b*": "", "c?": "", "d+": "d", "(ad)?": "", "(kk)*": "", "(u(vw)?)": "u", "(ad)": "ad", "((pq)r)": "pqr", r"\.": ".", r"\?": "?", r"\(": "(", r"\\": "\\"}
    some = 0
    for r in found:
        core = r.rx.removeprefix(r"^[htpsw]+://([a-z0-9-]+\.)*")
        text, head = core.removeprefix("^").removesuffix("$").replace("[/:&?=,;]", "/"), "http://" if core != r.rx else ""
        for piece in sorted(example, key=len, reverse=True):
            text = text.replace(piece, example[piece]) if piece != r"\\" else text
        text = head + text.replace("\\\\", "\\")
        if re.search(r.rx, text):  # a shortest text that matches has every run in it
            some += 1
            assert all(x in text.lower() for x in r.l), (r.rx, text, r.l)
    assert some > 200


def python_matches(rules, q):
    out = []
    host = lambda url: re.match(r"[a-z]+://([^/?#:]+)", url)[1]
    within = lambda ds, h: any(h == d.lstrip("*") or h.endswith("." + d.lstrip("*")) for d in ds)
    for r in rules:
        t = {k: v for k, v in r.trigger.asDict().items() if v is not None}
        if not re.search(t["url-filter"], q["url"], 0 if t.get("url-filter-is-case-sensitive") else re.I):
            continue
        tests = {
            "resource-type": lambda v: q["type"] in v, "load-type": lambda v: q["party"] in v, "load-context": lambda v: q["context"] in v, "request-method": lambda v: v == q["method"],
            "if-domain": lambda v: within(v, host(q["top_url"])), "unless-domain": lambda v: not within(v, host(q["top_url"])),
            "if-top-url": lambda v: any(re.search(x, q["top_url"]) for x in v), "if-frame-url": lambda v: any(re.search(x, q["frame_url"]) for x in v), "unless-frame-url": lambda v: not any(re.search(x, q["frame_url"]) for x in v),
        }
        if all(tests[k](v) for k, v in t.items() if k in tests):
            out.append((q["req_id"], r.list_id, r.position, r.action))
    return out


def test_matches_against_all_pairs(spark):
    rng = random.Random(2)
    hosts = [f"{w}.{t}" for w in ("shop", "cdn.shop", "ads", "news", "img.ads", "k") for t in ("net", "org")]
    lines = []
    for i in range(160):
        h, top = rng.choice(hosts), rng.choice(hosts)
        pattern = rng.choice([f"||{h}^", f"||{h}/img/", "/banner", "*", "/pix(1|2)/", "|https://", "ad*js", "/p?x=", f"||{h}^$third-party", "-", "/Img/"])
        option = rng.choice(["", "", "script", f"domain={top}", f"domain={top}|shop.org|cdn.shop.org", f"domain=~{top}", "image", "match-case", "domain=news.*", "method=get"])
        lines.append(rng.choice(["", "", "@@"]) + pattern + (("," if "$" in pattern else "$") + option if option else ""))
    lines += ["shop.net##.x", "##.y", "@@||shop.net^$generichide", "news.*##.z"]
    raw = spark.createDataFrame([(f"l{i % 3}", i, x) for i, x in enumerate(lines)], "list_id string, line_no long, raw string")
    rules = cp.assemble(cp.compile_lists(raw, Profile()).rules).cache()
    asked = []
    for i in range(80):
        url = f"{rng.choice(['https', 'http'])}://{rng.choice(hosts)}/{rng.choice(['img/a.js', 'banner.png', 'p?x=1', 'ad-1.js', 'Img/q', 'pix2', ''])}"
        asked.append({"req_id": i, "url": url, "type": rng.choice(["script", "image"]), "party": rng.choice(["third-party", "first-party"]), "context": "child-frame", "method": rng.choice(["get", "post"]), "top_url": f"https://{rng.choice(hosts)}/", "frame_url": f"https://{rng.choice(hosts)}/f"})
    requests = spark.createDataFrame([tuple(q.values()) for q in asked], "req_id long, url string, type string, party string, context string, method string, top_url string, frame_url string")
    local = rules.collect()
    want = sorted(x for q in asked for x in python_matches(local, q))
    found = evaluate.matches(requests, rules)
    assert sorted((r.req_id, r.list_id, r.position, r.action) for r in found.collect()) == want and len(want) > 500
    plan = evaluate.decide(requests, rules)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    last = {}
    for q, name, position, action in want:
        if action in ("block", "ignore-previous-rules"):
            last[q, name] = max(last.get((q, name), (0, "")), (position, action))
    by = {q: min((n for (i, n), (_, a) in last.items() if i == q and a == "block"), default=None) for q in range(80)}
    assert {r.req_id: r.by for r in evaluate.decide(requests, rules).collect()} == by
