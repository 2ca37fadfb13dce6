"""The catalogue of lists: reading, unfolding, filters, state of refreshes, and making one from an asset map."""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.functions import columns as c
from sievecraft.sources.lists import content_digest, headers, split_lines

LIST_DDL = "struct<id: string, name: string, url: string, file: string, ubo: string, homepage: string, languages: array<string>, tags: array<string>, note: string, format: string, expires: bigint, enabled: boolean, covered_by: array<struct<id: string, name: string, pct: int>>>"
GROUP_DDL = f"struct<id: string, maintainer: string, homepage: string, base: string, enabled: boolean, lists: array<{LIST_DDL}>>"
CATALOGUE_DDL = f"defaults struct<format: string, expires: bigint, enabled: boolean>, groups array<{GROUP_DDL}>"


class CatalogueError(ValueError):
    """A catalogue that is no JSON, with the place of the fault."""


def check_syntax(text: str) -> None:
    """Fail with the lines around the fault and a hint for trailing commas."""
    try:
        json.loads(text)
    except json.JSONDecodeError as e:
        lines = text.splitlines()
        near = [f"{'>' if n == e.lineno else ' '} {n:4d} {lines[n - 1]}" for n in range(max(1, e.lineno - 3), min(len(lines), e.lineno + 3) + 1)]
        hint = "\na comma before a closing bracket is not allowed" if re.search(r",\s*[\]}]", text) else ""
        raise CatalogueError(f"line {e.lineno}, column {e.colno}: {e.msg}\n" + "\n".join(near) + hint) from None


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """One row with ``defaults`` and ``groups``."""
    text = spark.read.text(path, wholetext=True).first()[0]  # one document that a maintainer writes by hand
    check_syntax(text)
    return spark.createDataFrame([(text,)], "j string").select(F.from_json("j", CATALOGUE_DDL, {"mode": "FAILFAST"}).alias("c")).select("c.*")


def slug(name: str | None) -> str:
    plain = "".join(ch for ch in unicodedata.normalize("NFKD", (name or "").replace("&", " and ")) if not unicodedata.combining(ch))
    return re.sub(r"[^a-z0-9]+", "-", plain.lower()).strip("-") or "list"


def unfold(catalogue: DataFrame) -> DataFrame:
    """One row per enabled list, in order (``pos``), with inherited defaults; repeated ids and then repeated addresses are dropped.

    A list whose address stood before never takes its id, so the next list of that id
    still counts: duplicates are found by address among all first.
    """
    groups = catalogue.select("defaults", F.posexplode("groups").alias("gp", "g")).filter(F.coalesce("g.enabled", F.lit(True)))
    rows = groups.select("defaults", "gp", "g", F.posexplode("g.lists").alias("lp", "l")).filter(F.coalesce("l.enabled", "defaults.enabled", F.lit(True)))
    url = F.coalesce("l.url", F.concat(F.rtrim("g.base", F.lit("/")), F.lit("/"), F.ltrim("l.file", F.lit("/"))))
    rows = rows.select(
        (F.col("gp") * 100_000 + F.col("lp")).cast("long").alias("pos"), "l.id", F.col("l.name").alias("name"), url.alias("url"), F.coalesce("l.homepage", "g.homepage").alias("homepage"),
        F.col("g.maintainer").alias("group"), F.col("g.id").alias("group_id"), F.coalesce("l.tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("l.languages", F.array().cast("array<string>")).alias("languages"), F.coalesce("l.expires", "defaults.expires").alias("expires"), F.coalesce("l.format", "defaults.format").alias("format"),
    )
    rows = rows.filter(F.col("url").isNotNull())
    first = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy("pos"))
    rows = rows.withColumn("n", first(c.url_key(F.col("url")))).filter("n = 1").withColumn("n", first("id")).filter("n = 1").drop("n")
    made = F.udf(slug, "string", useArrow=True)
    rows = rows.withColumn("slug", made("name")).withColumn("n", first("slug"))
    return rows.withColumn("slug", F.when(F.col("n") > 1, F.concat("slug", F.lit("-"), "id")).otherwise(F.col("slug"))).drop("n").withColumn("file", F.concat("slug", F.lit(".txt")))


def select_lists(rows: DataFrame, groups: list[str] | None = None, only: list[str] | None = None) -> DataFrame:
    """Lists of given groups (id or label) and with a given text in id or name."""
    if groups:
        wanted = [g.lower() for g in groups]
        rows = rows.filter(F.lower("group_id").isin(*wanted) | F.lower("group").isin(*wanted))
    if only:
        name = F.lower(F.concat_ws(" ", "id", "name"))
        cond = F.lit(False)
        for text in only:
            cond = cond | name.contains(text.lower())
        rows = rows.filter(cond)
    return rows


STATE_DDL = "struct<file: string, name: string, etag: string, last_modified: string, sha256: string, bytes: bigint, lines: bigint, rules: bigint, rules_sha256: string, title: string, version: string, list_updated: string, license: string, fetched_at: string, includes: int, preproc_dropped: int, status: string, error: string, duplicate_of: string>"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """(id, state fields) of an index; nothing where it can't be read."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", f"lists map<string, {STATE_DDL}>").alias("s"))
    return rows.select(F.explode("s.lists").alias("id", "v")).select("id", "v.*")


def refresh_plan(rows: DataFrame, state: DataFrame, now: str, max_age: int = 86_400, force: bool = False) -> DataFrame:
    """Adds ``due``: lists whose state is older than the lesser of their expiry and ``max_age`` seconds, or that have none."""
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.try_to_timestamp("fetched_at"))
    joined = rows.join(state.select("id", "etag", "last_modified", "sha256", "fetched_at"), "id", "left")
    fresh = F.coalesce(age < F.least(F.coalesce("expires", F.lit(max_age)), F.lit(max_age)), F.lit(False))
    return joined.withColumn("due", F.lit(force) | ~fresh)


def refresh_state(plan: DataFrame, fetched: DataFrame, now: str, least: int = 32) -> DataFrame:
    """Status of each list after a refresh, and its new state.

    ``fetched``: (id, code, content) of the lists that were asked for; code 304 says that
    nothing changed.  A text of under ``least`` characters is a failure, and a failure
    keeps the state that was there.
    """
    joined = plan.join(fetched, "id", "left")
    digest = F.sha2(F.col("content").cast("binary"), 256)
    failed = F.col("code").isNull() | ~F.col("code").isin(200, 304) | ((F.col("code") == 200) & (F.length(F.trim(F.coalesce("content", F.lit("")))) < least))
    status = F.when(~F.col("due"), "fresh").when(failed, "failed").when((F.col("code") == 304) | (digest == F.col("sha256")), "unchanged").otherwise("updated")
    taken = F.col("status") == "updated"
    return joined.withColumn("status", status).select(
        "id", "status", F.when(taken, digest).otherwise(F.col("sha256")).alias("sha256"),
        F.when(F.col("status").isin("updated", "unchanged"), F.lit(now)).otherwise(F.col("fetched_at")).alias("fetched_at"), F.when(taken, F.octet_length("content").cast("long")).alias("bytes"),
    )


#: Names under which lists give their version and date.
_TITLE, _VERSION, _UPDATED = ("title",), ("version",), ("timeupdated", "time_updated", "last_modified")


def index_entries(rows: DataFrame, state: DataFrame, refreshed: DataFrame, fetched: DataFrame, texts: DataFrame) -> DataFrame:
    """(id and the fields of STATE_DDL) of all lists after a refresh; what did not change keeps its state.

    ``rows``: the catalogue (id, name, file, pos); ``refreshed``: what ``refresh_state`` gives; ``fetched``: etag, last_modified, error
    by id; ``texts``: (list_id, content, includes, preproc_dropped) of the lists that were updated.
    """
    lines = split_lines(texts.select("list_id", "content"))
    said = headers(lines).groupBy("list_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("said"))
    value = lambda names: F.coalesce(*[F.col("said")[n] for n in names])
    numbers = lines.groupBy("list_id").agg(F.count("*").alias("lines")).join(content_digest(lines), "list_id", "left").join(said, "list_id", "left").join(texts.select("list_id", "includes", "preproc_dropped"), "list_id")
    new = numbers.select(
        F.col("list_id").alias("id"), "lines", F.coalesce("rules", F.lit(0)).alias("rules"), F.col("digest").alias("rules_sha256"), value(_TITLE).alias("title"), value(_VERSION).alias("version"),
        value(_UPDATED).alias("list_updated"), F.col("said")["license"].alias("license"), F.col("includes").cast("int").alias("includes"), F.col("preproc_dropped").cast("int").alias("preproc_dropped"),
    )
    old = state.select("id", *[F.col(c).alias(f"old_{c}") for c in state.columns if c != "id"])
    joined = rows.select("id", "name", "file", "pos").join(old, "id", "left").join(refreshed, "id").join(new, "id", "left").join(fetched.select("id", "etag", F.col("last_modified").alias("modified"), "error"), "id", "left")
    taken = F.col("status") == "updated"
    either = lambda c: F.when(taken, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
    out = joined.select(
        "id", "pos", "file", "name", either("etag"), F.when(taken, F.col("modified")).otherwise(F.col("old_last_modified")).alias("last_modified"), "sha256", either("bytes"), either("lines"), either("rules"), either("rules_sha256"),
        F.when(taken, F.coalesce("title", "name")).otherwise(F.col("old_title")).alias("title"), either("version"), either("list_updated"), either("license"), "fetched_at", either("includes"), either("preproc_dropped"), "status",
        F.when(F.col("status") == "failed", F.coalesce("error", F.lit("empty or cut short"))).alias("error"),
    )
    # The first list, in the catalogue's order, of some content counts; failed ones neither count nor repeat.
    same = out.filter("rules_sha256 IS NOT NULL AND status <> 'failed'").groupBy("rules_sha256").agg(F.min_by("id", "pos").alias("first"))
    again = F.when((F.col("first") != F.col("id")) & (F.col("status") != "failed"), F.col("first")).alias("duplicate_of")
    return out.join(same, "rules_sha256", "left").select(*out.columns, again)


def index_json(entries: DataFrame, now: str) -> str:
    """The index that ``read_state`` reads, lists in the catalogue's order; as long as there are lists."""
    lists = {r["id"]: {k: v for k, v in r.asDict().items() if v is not None and k != "pos"} for r in entries.orderBy("pos").collect()}
    summary: dict[str, int] = {}
    for entry in lists.values():
        summary[entry["status"]] = summary.get(entry["status"], 0) + 1
    return json.dumps({"generated_at": now, "count": len(lists), "summary": summary, "lists": lists}, indent=1, ensure_ascii=False) + "\n"


def status_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


ASSET_DDL = "map<string, struct<content: string, group: string, contentURL: string, title: string, supportURL: string, lang: string, off: boolean>>"


def from_assets(assets: DataFrame, ids: DataFrame, groups: DataFrame) -> DataFrame:
    """Catalogue lists from an asset map (one row, column ``json``).

    Filter assets only; the first secure address of each (plain ones are upgraded); ids by
    the lookup ``ids`` (key, id), groups by ``groups`` (group, pos); one list an address.
    """
    rows = assets.select(F.explode(F.from_json("json", ASSET_DDL)).alias("key", "a")).filter("a.content = 'filters'")
    listed = F.from_json("a.contentURL", "array<string>")
    urls = F.when(F.col("a.contentURL").startswith("["), listed).otherwise(F.array("a.contentURL"))
    url = F.regexp_replace(F.get(F.filter(urls, lambda u: u.rlike("^https?://")), F.lit(0)), "^http://", "https://")
    rows = rows.select("key", "a.title", "a.group", "a.supportURL", "a.lang", F.when(~F.coalesce("a.off", F.lit(False)), F.array(F.lit("default"))).otherwise(F.array().cast("array<string>")).alias("tags"), url.alias("url")).filter("url IS NOT NULL")
    rows = rows.join(ids, "key", "left").join(groups, "group").withColumn("id", F.coalesce("id", "key"))
    n = F.row_number().over(W.partitionBy(c.url_key(F.col("url"))).orderBy("pos", "key"))
    rows = rows.withColumn("n", n).filter("n = 1")
    return rows.select("pos", "group", "id", F.col("title").alias("name"), "url", F.col("supportURL").alias("homepage"), F.when(F.coalesce("lang", F.lit("")) != "", F.split("lang", r"\s+")).otherwise(F.array().cast("array<string>")).alias("languages"), "tags").orderBy("pos", "name")
