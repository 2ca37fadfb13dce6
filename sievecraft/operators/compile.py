"""Lists of rule lines to ordered target rules, side-table entries and diagnostics.

What one line says is read line by line; what lines do to each other is relational:
retractions are an anti-join, lifted selectors a left join and set subtraction, lifted
sites an equi-join on host suffixes, duplicates a minimum per rule, merged selectors an
ordered aggregation, and the order of an output a sort by (section, line, part).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from sievecraft import profile as fixed
from sievecraft.functions import annex
from sievecraft.functions import columns as c
from sievecraft.functions import grammar as g
from sievecraft.functions import translate
from sievecraft.functions.ranks import block, ranked
from sievecraft.profile import BUCKET, TRIGGER_DDL, Profile
from sievecraft.tables import discard, materialise

RULES_DDL = f"array<struct<bucket: int, trigger: {TRIGGER_DDL}, action: string>>"
NETWORK_DDL = f"rules: {RULES_DDL}, lifted: array<string>, annex: array<{annex.DDL}>, notes: array<string>, reason: string, atomic: boolean, key: struct<exception: boolean, pattern: string, modifiers: string>, drops: struct<exception: boolean, pattern: string, modifiers: string>"
COSMETIC_DDL = f"selector: string, included: array<string>, excluded: array<string>, special: boolean, frames: array<string>, path: string, lifts: boolean, entry: {annex.DDL}, to_annex: boolean, reason: string, notes: array<string>"


@dataclass(frozen=True)
class Compiled:
    """All that comes out of a compilation."""

    rules: DataFrame  # list_id, bucket, k1, k2, k3, atomic, trigger, action, selector
    annex: DataFrame  # list_id, line_no, sub, entry
    lines: DataFrame  # list_id, line_no, kind, reason
    notes: DataFrame  # list_id, note, n
    selectors: DataFrame  # list_id, trigger, selector, first, copies
    kept: tuple[DataFrame, ...] = ()  # written tables that all of these are made from

    def release(self) -> None:
        """Delete the tables; nothing of the compilation can be read any more."""
        discard(*self.kept)


def read_with(rows: DataFrame, inputs: list[str], function: Callable[..., dict], ddl: str) -> DataFrame:
    """Rows with a struct column ``got``, read by ``function`` from their ``inputs`` in Arrow batches."""
    kind = T._parse_datatype_string(f"struct<{ddl}>")
    arrow, schema = to_arrow_type(kind), T.StructType([*rows.schema.fields, T.StructField("got", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [function(*x) for x in zip(*(b.column(i).to_pylist() for i in inputs), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, arrow)], names=[*b.schema.names, "got"])

    return rows.mapInArrow(run, schema)


# ---------------------------------------------------------------------- classify


def detect_hosts(lines: DataFrame, sample: int = 300, share: float = 0.6) -> DataFrame:
    """(list_id, hosts): whether most of a list's first lines are host lines."""
    line = c.strip(F.col("raw"))
    rows = lines.select("list_id", "line_no", line.alias("line")).filter(~F.col("line").rlike("^$|^[!#]"))
    first = rows.withColumn("n", F.row_number().over(W.partitionBy("list_id").orderBy("line_no"))).filter(F.col("n") <= sample)
    return first.groupBy("list_id").agg((F.avg(F.col("line").rlike(fixed.HOSTS_LINE).cast("int")) >= share).alias("hosts"))


def classify(lines: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """Adds ``kind`` (blank, comment, loopback, network, cosmetic, prefixed), ``text``, and the parts of plain cosmetic lines."""
    rows = lines.select("list_id", "line_no", c.strip(F.coalesce("raw", F.lit(""))).alias("line"))
    rows = rows.join(hosts, "list_id", "left") if hosts is not None else rows.withColumn("hosts", F.lit(False))
    line, hosts_mode = F.col("line"), F.coalesce("hosts", F.lit(False))
    host = F.when(line.rlike(fixed.HOSTS_LINE), c.host_of(line)).when(F.lower(line).rlike(fixed.DOMAIN), F.lower(line))
    domains = F.regexp_extract(line, c.COSMETIC, 1)
    cosmetic = line.rlike(c.COSMETIC) & (~domains.rlike(r"[/$\s\"']") | domains.rlike(r"^~?/\S+/$"))
    kind = (
        F.when(line == "", "blank").when(line.startswith("!") | line.startswith("[Adblock"), "comment")
        .when(hosts_mode & (line.startswith("#") | host.isNull()), "comment").when(hosts_mode & line.rlike(fixed.HOSTS_LINE) & host.isin(*fixed.LOOPBACK), "loopback")
        .when(hosts_mode, "network").when(line.startswith("[$"), "prefixed").when(cosmetic, "cosmetic").when(line.startswith("#"), "comment").otherwise("network")
    )
    part = lambda i: F.when(F.col("kind") == "cosmetic", F.regexp_extract("line", c.COSMETIC, i))
    return rows.withColumn("kind", kind).select(
        "list_id", "line_no", "kind", F.when(hosts_mode & (F.col("kind") == "network"), F.concat(F.lit("||"), host, F.lit("^"))).otherwise(line).alias("text"),
        part(1).alias("domains"), part(2).alias("marker"), part(3).alias("body"),
    )


def _split_prefixed(text: str) -> dict:
    found = translate.split_cosmetic(text)
    return dict(zip(("domains", "marker", "body", "prefix"), found, strict=True)) if found else {}


# ----------------------------------------------------------------------- network


def _network_reader(profile: Profile):
    def read(text: str) -> dict:
        out = translate.network(text, profile)
        names = ("exception", "pattern", "modifiers")
        out["key"] = dict(zip(names, translate.rule_key(text), strict=True))
        if "badfilter" in text:
            out["drops"] = dict(zip(names, translate.rule_key(text, "badfilter"), strict=True))
        return out

    return read


def network_rows(classified: DataFrame, profile: Profile) -> DataFrame:
    """(list_id, line_no, rules, lifted, annex, notes, reason, atomic) of network lines; retracted lines have a reason and nothing else."""
    lines = classified.filter("kind = 'network'").select("list_id", "line_no", "text")
    plain = F.col("text").rlike(c.PLAIN_HOST) & ~F.col("text").contains("badfilter")
    types = [t for t in profile.all_types if t != "document"] if profile.policy == "enumerate" else None
    trigger = F.struct(
        c.plain_filter(F.regexp_extract("text", c.PLAIN_HOST, 1)).alias("url-filter"),
        *[
            (F.array(*map(F.lit, types)) if types and k == "resource-type" else F.lit(None).cast("boolean" if k.endswith("sensitive") else "string" if k == "request-method" else "array<string>")).alias(k)
            for k in fixed.TRIGGER_KEYS[1:]
        ],
    ).cast(TRIGGER_DDL)
    empty = F.array().cast("array<string>")
    key = F.struct(F.lit(False).alias("exception"), F.col("text").alias("pattern"), F.lit("").alias("modifiers"))
    fast = lines.filter(plain).select(
        "list_id", "line_no", F.array(F.struct(F.lit(BUCKET["block"]).alias("bucket"), trigger.alias("trigger"), F.lit("block").alias("action"))).alias("rules"),
        empty.alias("lifted"), F.array().cast(f"array<{annex.DDL}>").alias("annex"), empty.alias("notes"), F.lit(None).cast("string").alias("reason"), F.lit(False).alias("atomic"), key.alias("key"),
        F.lit(None).cast("struct<exception: boolean, pattern: string, modifiers: string>").alias("drops"),
    )
    slow = read_with(lines.filter(~plain), ["text"], _network_reader(profile), NETWORK_DDL).select("list_id", "line_no", "got.*")
    rows = fast.unionByName(slow)
    bad = slow.filter(F.col("drops").isNotNull()).select("list_id", "drops.*").distinct().withColumn("retracted", F.lit(True))
    joined = rows.select("*", "key.*").join(bad, ["list_id", "exception", "pattern", "modifiers"], "left")
    gone = F.col("retracted").isNotNull()
    keep = lambda name: F.when(~gone, F.col(name)).alias(name)
    return joined.select("list_id", "line_no", *[keep(n) for n in ("rules", "lifted", "annex", "notes")], F.when(gone, "badfilter_retracted").otherwise(F.col("reason")).alias("reason"), "atomic")


# ---------------------------------------------------------------------- cosmetic


def cosmetic_rows(classified: DataFrame, profile: Profile) -> DataFrame:
    """Cosmetic lines with their parts, selectors lifted by other lines taken out, and a trigger or a reason."""
    plain = classified.filter("kind = 'cosmetic'").select("list_id", "line_no", "domains", "marker", "body", F.lit("").alias("prefix"))
    prefixed = read_with(classified.filter("kind = 'prefixed'").select("list_id", "line_no", "text"), ["text"], _split_prefixed, "domains: string, marker: string, body: string, prefix: string")
    lines = plain.unionByName(prefixed.filter("got.marker IS NOT NULL").select("list_id", "line_no", "got.*"))
    read = read_with(lines, ["domains", "marker", "body", "prefix"], lambda *x: translate.cosmetic(*x, profile), COSMETIC_DDL).select("list_id", "line_no", "marker", "got.*")
    lifting = read.filter("lifts")
    everywhere = lifting.filter("special").select("list_id", "selector").distinct().withColumn("everywhere", F.lit(True))
    on_sites = lifting.select("list_id", "selector", F.explode("included").alias("d")).groupBy("list_id", "selector").agg(F.collect_set("d").alias("lifted"))
    rows = read.join(everywhere, ["list_id", "selector"], "left").join(on_sites, ["list_id", "selector"], "left")
    open_ = F.col("reason").isNull()
    gone = F.col("selector").isNotNull() & F.col("everywhere").isNotNull() & (F.col("marker") == "##")
    some = F.coalesce("lifted", F.array().cast("array<string>"))
    left = F.filter("included", lambda d: ~F.array_contains(some, d))
    excluded = F.when(F.size("included") > 0, F.col("excluded")).otherwise(F.array_union("excluded", some))
    rows = rows.withColumns({"left": left, "without": F.array_sort(F.array_distinct(excluded))})
    pos = F.array_sort(F.array_distinct(F.concat("frames", F.transform("left", c.frame_filter))))
    special, path = F.col("special"), F.col("path").isNotNull()
    reason = (
        F.when(gone, "cos_excepted_global").when(~open_, F.col("reason")).when((F.size("included") > 0) & (F.size("left") == 0), "cos_excepted_all")
        .when(path, None).when(special & (F.size(pos) == 0), "cos_domain").when(special & (F.size("without") > 0), "cos_wild_excl")
        .when(~special & (F.size("left") > 0) & (F.size("without") > 0), "cos_incl_excl")
    )
    rows = rows.withColumn("why", reason)
    late = open_ & F.col("why").isin("cos_domain", "cos_wild_excl", "cos_incl_excl")
    sites = F.array_sort(F.array_distinct("left"))
    tops = F.transform(F.when(F.size("left") > 0, F.transform(sites, lambda d: F.substring(d, 2, 1 << 20))).otherwise(F.array(F.lit(""))), lambda d: c.top_filter(d, F.col("path")))
    value = {
        "url-filter": F.lit(".*"), "if-top-url": F.when(path, tops), "if-frame-url": F.when(~path & special, pos),
        "if-domain": F.when(~path & ~special & (F.size("left") > 0), sites), "unless-domain": F.when(~path & ~special & (F.size("left") == 0) & (F.size("without") > 0), F.col("without")),
    }
    trigger = F.struct(*[value.get(k, F.lit(None)).alias(k) for k in fixed.TRIGGER_KEYS]).cast(TRIGGER_DDL)
    kept = F.col("entry").isNotNull() & (F.col("to_annex") & ~gone | late)
    note = F.when(F.col("why").isNull() & path, F.array(F.lit("path_top_url"))).when(F.col("why").isNull() & special, F.array(F.lit("frame_url")))
    extra = F.when(late & kept & (F.col("entry.family") != "raw_js"), F.array(F.concat(F.lit("to_annex:"), "why")))
    none = F.array().cast("array<string>")
    return rows.select(
        "list_id", "line_no", "marker", "selector", F.col("why").alias("reason"), F.when(F.col("why").isNull(), trigger).alias("trigger"), F.when(kept, F.col("entry")).alias("entry"),
        F.when(gone, none).otherwise(F.concat("notes", F.coalesce(note, none), F.coalesce(extra, none))).alias("notes"),
    )


def merge_selectors(cosmetics: DataFrame) -> DataFrame:
    """(list_id, trigger, selector, first, copies): selectors of one trigger, each at its first line."""
    open_ = cosmetics.filter("reason IS NULL")
    return open_.groupBy("list_id", "trigger", "selector").agg(F.min("line_no").alias("first"), F.count("*").alias("copies"))


def is_generic(trigger: Column) -> Column:
    return trigger["if-domain"].isNull() & trigger["if-frame-url"].isNull() & trigger["if-top-url"].isNull()


def lift_sites(selectors: DataFrame, lifted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Selectors with the lifted sites and all below them taken out of their condition; and (list_id, trigger) of those left without any."""
    own = selectors.filter(F.col("trigger")["if-domain"].isNotNull())
    triggers = own.select("list_id", "trigger").distinct()
    sites = triggers.select("list_id", "trigger", F.explode(F.col("trigger")["if-domain"]).alias("site"))
    above = sites.select("list_id", "trigger", "site", F.explode(c.suffixes(F.ltrim("site", F.lit("*")))).alias("host"))
    hit = above.join(lifted, ["list_id", "host"], "left_semi").groupBy("list_id", "trigger").agg(F.collect_set("site").alias("gone"))
    joined = selectors.join(hit, ["list_id", "trigger"], "left")
    left = F.array_except(F.col("trigger")["if-domain"], "gone")
    changed = F.when(F.col("gone").isNotNull(), F.col("trigger").withField("`if-domain`", left)).otherwise(F.col("trigger"))
    bare = F.col("gone").isNotNull() & (F.size(left) == 0)
    return joined.filter(~bare).select("list_id", "trigger", changed.alias("shown"), "selector", "first"), joined.filter(bare).select("list_id", "trigger").distinct()


def _part_costly(selector: str) -> dict:
    parts = g.split_selectors(selector)
    costly = [p for p in parts if g.costly_selector(p)]
    return {"costly": costly, "rest": ", ".join(p for p in parts if not g.costly_selector(p))}


def css_rules(selectors: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """Rules in packets of selectors, and the costly generic selectors that go to the side table instead."""
    rows = selectors.withColumn("generic", is_generic(F.col("shown")))
    generic = read_with(rows.filter("generic"), ["selector"], _part_costly, "costly: array<string>, rest: string").select(*rows.columns, "got.*")
    moved = generic.filter(F.size("costly") > 0) if profile.keep_extended else generic.limit(0)
    stay = generic.withColumn("selector", F.when((F.size("costly") > 0) & F.lit(profile.keep_extended), F.col("rest")).otherwise(F.col("selector"))).filter("selector <> ''").drop("costly", "rest")
    rows = stay.unionByName(rows.filter("NOT generic"))
    # All generic selectors of a list share one trigger, so places come from blocks of lines.
    rows = ranked(rows.withColumn("_of", F.xxhash64("trigger")), ["list_id", "_of", "trigger"], [block("first")], ["first", "selector"], "n", least="first")
    rows = rows.drop("_of").withColumnRenamed("least", "slot").withColumn("packet", F.floor(F.col("n") / profile.css_group_size))
    packets = rows.groupBy("list_id", "trigger", "shown", "generic", "slot", "packet").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "selector"))), lambda x: x["selector"]), ", ").alias("css"))
    domains = F.col("shown")["if-domain"]
    others = [F.col("shown")[k].isNull() for k in fixed.TRIGGER_KEYS if k not in ("url-filter", "if-domain")]
    alone = ~F.col("generic") & domains.isNotNull() & (F.col("shown")["url-filter"] == ".*") & F.forall(domains, lambda d: d.rlike(r"^\*?[a-z0-9.-]+$"))
    for o in others:
        alone = alone & o
    blank = F.struct(*[F.lit(None).alias(k) for k in fixed.TRIGGER_KEYS]).cast(TRIGGER_DDL)
    each = F.when(alone, F.transform(domains, lambda d: blank.withField("`url-filter`", c.site_filter(d)))).otherwise(F.array("shown"))
    out = packets.select("list_id", "generic", "slot", "packet", "css", F.posexplode(each).alias("place", "t"))
    rules = out.select(
        "list_id", F.when(F.col("generic"), BUCKET["generic_css"]).otherwise(BUCKET["specific_css"]).alias("bucket"), F.col("slot").alias("k1"), F.col("place").cast("long").alias("k2"),
        F.col("packet").cast("long").alias("k3"), F.lit(False).alias("atomic"), F.col("t").alias("trigger"), F.lit("css-display-none").alias("action"), F.col("css").alias("selector"),
    )
    costly = moved.select("list_id", F.col("first").alias("line_no"), F.coalesce(F.col("shown")["unless-domain"], F.array().cast("array<string>")).alias("x"), F.explode("costly").alias("selector"))
    costly = costly.groupBy("list_id", "selector", "x").agg(F.min("line_no").alias("line_no"))
    empty = F.array().cast("array<string>")
    given = {"family": F.lit("procedural"), "domains": empty, "excluded": F.transform("x", lambda d: F.ltrim(d, F.lit("*"))), "selector": F.col("selector"), "exception": F.lit(False)}
    entry = F.struct(*[given.get(k, F.lit(None)).alias(k) for k in annex.FIELDS]).cast(annex.DDL)
    return rules, costly.select("list_id", "line_no", F.lit(1 << 20).alias("sub"), entry.alias("entry"))


# ----------------------------------------------------------------------- compile


def keep_first(rules: DataFrame) -> DataFrame:
    """Each rule of a list once, in the section and at the place where it comes first; ``copies`` counts all."""
    place = F.struct("k1", "k2", "k3", "bucket", "atomic")
    return rules.groupBy("list_id", "trigger", "action").agg(F.min(place).alias("_place"), F.count("*").alias("copies")).select("list_id", "_place.*", "trigger", "action", "copies")


def compile_lists(lines: DataFrame, profile: Profile | None = None, hosts: DataFrame | None = None) -> Compiled:
    """``lines``: list_id, line_no, raw.  ``hosts``: the dialect of each list; found by sampling if it is not given.

    Lines are read once: what they say is written as tables in the shared folder, and rules, reports,
    side table and overlap are made from these.
    """
    profile = profile or Profile()
    classified = materialise(classify(lines, detect_hosts(lines) if hosts is None else hosts), "classified")
    net, cos = materialise(network_rows(classified, profile), "network"), materialise(cosmetic_rows(classified, profile), "cosmetic")
    exploded = net.select("list_id", F.col("line_no").alias("k1"), "atomic", F.posexplode("rules").alias("k2", "_rule")).select(
        "list_id", "_rule.bucket", "k1", F.col("k2").cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"), "atomic", "_rule.trigger", "_rule.action"
    )
    once = keep_first(exploded)
    selectors = merge_selectors(cos)
    lifted = net.select("list_id", F.explode("lifted").alias("host")).distinct()
    shown, bare = lift_sites(selectors, lifted)
    css, costly = css_rules(shown, profile)
    network = once.withColumn("selector", F.lit(None).cast("string")).drop("copies")
    rules = network.unionByName(css).unionByName(document_guards(network, profile))
    rules = materialise(rules, "rules")
    entries = net.select("list_id", "line_no", F.posexplode("annex").alias("sub", "entry")).unionByName(cos.filter("entry IS NOT NULL").select("list_id", "line_no", F.lit(0).alias("sub"), "entry")).unionByName(costly)
    status = net.select("list_id", "line_no", F.lit("network").alias("kind"), "reason").unionByName(cos.select("list_id", "line_no", F.lit("cosmetic").alias("kind"), F.when(F.col("marker") != "#@#", F.col("reason")).alias("reason")))
    lost = classified.filter("kind = 'prefixed'").join(cos.select("list_id", "line_no"), ["list_id", "line_no"], "left_anti")
    status = status.unionByName(lost.select("list_id", "line_no", F.lit("network").alias("kind"), F.lit("mod_unknown:prefix").alias("reason")))
    status = status.unionByName(classified.filter("kind IN ('comment', 'blank', 'loopback')").select("list_id", "line_no", "kind", F.lit(None).cast("string").alias("reason")))
    said = net.select("list_id", F.explode("notes").alias("note")).unionByName(cos.select("list_id", F.explode("notes").alias("note")))
    counted = said.groupBy("list_id", "note").agg(F.count("*").alias("n"))
    merged = once.select("list_id", (F.col("copies") - 1).alias("n")).unionByName(selectors.select("list_id", (F.col("copies") - 1).alias("n")))
    counted = counted.unionByName(merged.groupBy("list_id").agg(F.sum("n").alias("n")).filter("n > 0").select("list_id", F.lit("duplicate_merged").alias("note"), "n"))
    counted = counted.unionByName(bare.groupBy("list_id").agg(F.count("*").alias("n")).select("list_id", F.lit("site_lifted").alias("note"), "n"))
    return Compiled(rules, entries, status, counted, selectors, (classified, net, cos, rules))


def document_guards(rules: DataFrame, profile: Profile) -> DataFrame:
    """One rule per list with blocks that lets main documents load, right after the blocks."""
    given = {"url-filter": F.lit(".*"), "resource-type": F.array(F.lit("document")), "load-context": F.array(F.lit("top-frame"))}
    guard = F.struct(*[given.get(k, F.lit(None)).alias(k) for k in fixed.TRIGGER_KEYS]).cast(TRIGGER_DDL)
    lists = rules.filter(F.col("bucket") == BUCKET["block"]).select("list_id").distinct().filter(F.lit(profile.policy == "guard"))
    zero = F.lit(0).cast("long")
    return lists.select("list_id", F.lit(BUCKET["guard"]).alias("bucket"), zero.alias("k1"), zero.alias("k2"), zero.alias("k3"), F.lit(False).alias("atomic"), guard.alias("trigger"), F.lit("ignore-previous-rules").alias("action"), F.lit(None).cast("string").alias("selector"))


def assemble(rules: DataFrame) -> DataFrame:
    """Adds ``position``, the place of a rule in its list's output, from 1.

    Order is by section, line, part and packet.  Rules are numbered in blocks of a section's lines, so a list is never sorted by one task.
    """
    placed = ranked(rules, ["list_id"], [F.col("bucket"), block("k1")], ["k1", "k2", "k3"], "position")
    return placed.withColumn("position", F.col("position") + 1)
