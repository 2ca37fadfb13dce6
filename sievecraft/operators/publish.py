"""From list texts to everything that is published: rule files, side tables, reports, catalogue; and no more than that."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.operators import output
from sievecraft.operators.compile import compile_lists, detect_hosts
from sievecraft.profile import Profile
from sievecraft.sources.lists import split_lines

#: What the catalogue takes over from the state of a list.
META = ("name", "version", "group", "homepage", "license", "sha256", "format", "duplicate_of")


def with_metadata(texts: DataFrame, state: DataFrame | None) -> DataFrame:
    """(list_id, content, and META) of texts; ``state`` names its lists by ``file``.  Texts without a state have none; lists that repeat another one are left out."""
    given = [] if state is None else [c for c in META if c in state.columns]
    rows = texts.withColumn("file", F.concat("list_id", F.lit(".txt")))
    rows = rows.join(state.select("file", *given), "file", "left") if given else rows
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in META if c not in given})
    return rows.filter("duplicate_of IS NULL").select("list_id", "content", *META)


def gated(chunked: DataFrame, reports: DataFrame) -> DataFrame:
    """Rules of the lists that pass the publication gate."""
    return chunked.join(reports.filter("published").select("list_id"), "list_id", "left_semi")


def publish(spark: SparkSession, texts: DataFrame, out: str, profile: Profile | None = None, state: DataFrame | None = None, full: bool = True) -> str:
    """Compile ``texts`` (list_id, content) and write what comes of them to ``out``; returns the summary.

    Rule files are written for published lists only, side tables for all that have one, a report for each list, and the catalogue and
    the readers' report over all.  ``full``: these are all lists there are, so files of an earlier run that are not made again go.
    """
    profile = profile or Profile()
    known = with_metadata(texts, state).persist()
    lines = split_lines(known.select("list_id", "content"))
    hosts = detect_hosts(lines).join(known.select("list_id", "format"), "list_id").select("list_id", (F.col("hosts") | F.coalesce(F.col("format") == "hosts", F.lit(False))).alias("hosts"))
    made = compile_lists(lines, profile, hosts)
    # Exceptions stand in every file; a list that they leave no room in is left out, the others are published.
    reports = output.report(made, profile).withColumn("uncut", output.uncut(F.col("rules_out"), F.col("exception") + F.col("page_exception"), profile.max_rules))
    reports = reports.withColumn("published", F.col("published") & ~F.col("uncut")).join(known.drop("content"), "list_id").persist()
    try:
        now = output.now_iso()
        files = output.write_rules(gated(output.chunks(made.rules, profile.max_rules), reports), out)
        side = output.write_annex(made.annex.join(made.annex.filter("entry.family <> 'raw_js'").select("list_id").distinct(), "list_id", "left_semi"), f"{out}/extended")
        texts_ = output.report_json(reports).select(F.concat("list_id", F.lit(".report.json")).alias("file"), F.lit(0).alias("place"), F.col("json").alias("line"))
        told = output.write_named(texts_, f"{out}/reports")
        # A row a list from here on.
        rows = [r.asDict(recursive=True) for r in reports.join(output.capabilities(reports).drop("cookies"), "list_id").orderBy("list_id").collect()]
        output.write_text(spark, f"{out}/index.json", json.dumps(catalogue(rows, files, side, profile, now), indent=1, ensure_ascii=False) + "\n")
        output.write_text(spark, f"{out}/reports/CONVERSION.md", output.markdown(reports, made.lines))
        if full:
            output.purge(spark, out, [f["file"] for f in files])
            output.purge(spark, f"{out}/extended", [s["file"] for s in side])
            output.purge(spark, f"{out}/reports", [t["file"] for t in told], ".report.json")
        return output.summary(reports)
    finally:
        made.release()
        reports.unpersist()
        known.unpersist()


def catalogue(rows: list[dict], files: list[dict], side: list[dict], profile: Profile, now: str) -> dict:
    """The output catalogue: totals, published lists with their files, and the others with the reason."""
    own = {r["list_id"]: [{k: f[k] for k in ("file", "rules", "bytes")} for f in files if f["list_id"] == r["list_id"]] for r in rows}
    extended, emitted = {s["list_id"]: s for s in side}, {k: sum(f["rules"] for f in v) for k, v in own.items()}
    base = lambda r: {"id": r["list_id"], "name": r["name"] or r["list_id"], "source": f"{r['list_id']}.txt", "rules_in": r["rules_in"], "rules_unique": r["rules_out"]}
    shown, rest = [r for r in rows if r["published"]], [r for r in rows if not r["published"]]
    total = lambda x, k: sum(r[k] for r in x)
    why = lambda r: f"{r['exception'] + r['page_exception']} exceptions leave too little room in files of {profile.max_rules} rules" if r["uncut"] else f"{r['rules_out']} rules from {r['rules_in']} entries"
    lists = [
        base(r) | {"source_sha256": r["sha256"] or "", "version": r["version"] or "", "group": r["group"] or "", "homepage": r["homepage"] or "", "license": r["license"] or "", "converted_at": now,
                   "rules_emitted": emitted[r["list_id"]], "skipped": r["skipped"], "coverage_pct": r["coverage_pct"], "capabilities": {k: r[k] for k in ("network", "cosmetic", "exceptions", "extended")}, "files": own[r["list_id"]],
                   "extended_file": f"extended/{r['list_id']}.json" if r["list_id"] in extended else None, "extended_sha256": extended.get(r["list_id"], {}).get("sha256") or ""}
        for r in shown
    ]
    return {
        "generated_at": now, "schema": 2, "profile": "legacy" if profile.legacy else f"Safari {profile.safari_version}+",
        "totals": {"lists": len(shown), "lists_unpublished": len(rest), "files": len(files), "rules_in": total(shown, "rules_in"), "rules_unique": total(shown, "rules_out"), "rules_emitted": sum(emitted.values()), "skipped": total(rows, "skipped"), "extended": total(rows, "extended")},
        "lists": lists, "unpublished": [base(r) | {"reason": why(r)} for r in rest],
    }
