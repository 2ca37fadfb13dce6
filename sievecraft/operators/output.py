"""Outputs of compiled lists: size-bounded files, publication gate, reports, catalogue, side-table files."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.functions import annex as annex_fields
from sievecraft.functions.ranks import block, digest
from sievecraft.operators.compile import Compiled
from sievecraft.profile import BUCKET, BUCKETS, TAIL, Profile

# ---------------------------------------------------------------------- chunking

#: Lines of a section that make a unit, and places of a line that share an array of the files that go on there, as powers of two.
UNIT_BITS = PLACE_BITS = 8
#: Files that may begin in a unit for its lines to be told by them; else each line has its own row.
BEGUN = 3
#: A section's number is that of its list, shifted by so many bits, plus its bucket.
SECTION_BITS = 4
#: Rules that a task counts by line at once.
COUNTED = 1 << 21


def least_room(max_rules: int) -> int:
    """Rules that a file must have left beside the exceptions."""
    return max(1, min(1000, max_rules // 2))


def _blobs(values: np.ndarray, heads: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut before each of ``heads``."""
    offsets = (np.append(heads, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _flat(blobs: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``_blobs`` packed: all values, and where each blob begins and the last ends."""
    ends, width = np.frombuffer(blobs.buffers()[1], np.int32, len(blobs) + 1, blobs.offset * 4).astype(np.int64), np.dtype(kind).itemsize
    return np.frombuffer(blobs.buffers()[2], kind, int(ends[-1] - ends[0]) // width, int(ends[0])), (ends - ends[0]) // width


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_unit, _section, lines, sizes) of rules (k1, tag) in any order, ``tag`` being twice the section, plus one where the line's rules stand together:
    the lines of a unit, a byte each, and their sizes, eight bytes each, times two, plus that one.  A unit may come more than once.
    """

    def packed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        k1, tag, values = rows.column("k1").to_numpy(), rows.column("tag").to_numpy(), None
        section = tag >> 1
        lowest, least, span = int(section.min()), int(k1.min()), int(k1.max()) - int(k1.min()) + 1
        if (int(section.max()) - lowest + 1) * span >= 1 << 61:
            values, k1 = np.unique(k1, return_inverse=True)
            least, span = 0, len(values)
        rules = np.sort(((section - lowest) * span + (k1 - least)) * 2 + (tag & 1))
        heads = np.flatnonzero(np.diff(rules >> 1, prepend=-1))
        sizes = np.diff(np.append(heads, len(rules))) * 2 + (rules[np.append(heads[1:], len(rules)) - 1] & 1)
        section, k1 = np.divmod(rules[heads] >> 1, span)
        k1 = k1 + least if values is None else values[k1]
        unit = k1 >> UNIT_BITS
        begins = np.flatnonzero((np.diff(section, prepend=-1) != 0) | (np.diff(unit, prepend=unit[0]) != 0))
        keys = [pa.array(unit[begins]), pa.array((section[begins] + lowest).astype(np.int32))]
        done = pa.RecordBatch.from_arrays([*keys, _blobs((k1 & 255).astype(np.uint8), begins), _blobs(sizes, begins)], ["_unit", "_section", "lines", "sizes"])
        yield from (done.slice(i, 10_000) for i in range(0, done.num_rows, 10_000))

    held, n = [], 0
    for b in batches:
        held, n = [*held, b], n + b.num_rows
        if n >= COUNTED:
            yield from packed(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield from packed(pa.Table.from_batches(held))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each unit once, from rows of ``_counted`` sorted by unit and section.  A task holds a batch and the unit before it."""

    def heads(rows: pa.RecordBatch) -> np.ndarray:
        unit, section = rows.column("_unit").to_numpy(), rows.column("_section").to_numpy()
        return np.flatnonzero((np.diff(unit, prepend=unit[0]) != 0) | (np.diff(section, prepend=-1) != 0))

    def merged(rows: pa.RecordBatch, first: np.ndarray) -> pa.RecordBatch:
        (lines, ends), (sizes, _) = _flat(rows.column("lines"), np.uint8), _flat(rows.column("sizes"), np.int64)
        unit = np.repeat(np.arange(len(first)), np.diff(np.append(ends[first], ends[-1])))
        line = unit << UNIT_BITS | lines
        order = np.argsort(line, kind="stable")
        line, sizes = line[order], sizes[order]
        at = np.flatnonzero(np.diff(line, prepend=-1))
        sizes = np.add.reduceat(sizes >> 1, at) * 2 + np.maximum.reduceat(sizes & 1, at)
        begins = np.searchsorted(line[at] >> UNIT_BITS, np.arange(len(first)))
        keys = [rows.column(c).take(pa.array(first)) for c in ("_unit", "_section")]
        return pa.RecordBatch.from_arrays([*keys, _blobs((line[at] & 255).astype(np.uint8), begins), _blobs(sizes, begins)], rows.schema.names)

    held = None
    for b in batches:
        rows = b if held is None else pa.concat_batches([held, b])
        if rows.num_rows:
            first = heads(rows)
            last = int(first[-1])
            if last:
                yield merged(rows.slice(0, last), first[:-1])
            held = rows.slice(last)
    if held is not None:
        yield merged(held, np.zeros(1, np.int64))


def _lists(values: np.ndarray | pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values) if isinstance(values, np.ndarray) else values)


def _parts(places: np.ndarray, sizes: np.ndarray, cuts: np.ndarray, chunk: int) -> pa.ListArray:
    """For each run of places an array for each 2**PLACE_BITS of them: the places in it from which on another file holds, times 2**32, plus that file."""
    arrays = (sizes - 1 >> PLACE_BITS) + 1
    outer = np.append(0, np.cumsum(arrays))
    begins = np.repeat(places, arrays) + ((np.arange(outer[-1]) - np.repeat(outer[:-1], arrays)) << PLACE_BITS)
    inside = np.searchsorted(places, cuts, "right") - 1
    ok = inside >= 0
    ok[ok] = cuts[ok] < (places + sizes)[inside[ok]]
    told = np.union1d(begins, cuts[ok])
    spot = told - begins[np.searchsorted(begins, told, "right") - 1]
    return _lists(_lists(spot << 32 | chunk + np.searchsorted(cuts, told, "right"), np.append(np.searchsorted(told, begins), len(told))), outer)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_unit, _section, place, files, split, last) of units (_unit, _section, lines, sizes, head, body, room, chunk), sorted by section and unit.

    ``place`` is that of the unit's first rule, from 0, ``last`` the file of its last rule.  ``files`` has the file of its first rule, and for each line that a file
    begins in, the line times 2**33, plus 2**32 if one begins after the line's first rule, plus the file of its last rule.  ``split`` has the lines of
    the second kind (k1) with their ``_parts``.  A unit with more than BEGUN of such lines has all its lines there, and -1 in ``files``.  A list begins with file ``chunk``; without ``room`` it has no other.

    The first ``head`` rules of a list stand together.  A cut that falls inside rules that stand together moves to their start, but by a
    rule at least.  A task holds one batch, so neither the lines of a list nor its files meet in memory.
    """
    now, at, chunk, pos = None, 0, 1, 0
    for b in batches:
        code = b.column("_section").to_numpy() >> SECTION_BITS
        (lines, ends), (sizes, _) = _flat(b.column("lines"), np.uint8), _flat(b.column("sizes"), np.int64)
        firsts = np.flatnonzero(np.diff(code, prepend=-1)).tolist()
        for a, z in zip(firsts, [*firsts[1:], len(code)], strict=True):
            head, body, room, begin = (b.column(c)[a].as_py() for c in ("head", "body", "room", "chunk"))
            if code[a] != now:
                now, at, chunk, pos = code[a], 0, begin, 0
            unit, n, whole = b.column("_unit").slice(a, z - a), sizes[ends[a] : ends[z]] >> 1, sizes[ends[a] : ends[z]] & 1
            first, starts = ends[a:z] - ends[a], pos + np.append(0, np.cumsum(n))
            stop, places, cuts = int(starts[-1]), starts[first], []
            if room is not None:
                cuts = list(range(max(pos, 1), min(stop, head - room + 1)))  # a head that no file holds, rule by rule
                at = cuts[-1] if cuts else at
                while (end := at + room) < min(stop, body):
                    i = int(np.searchsorted(starts, end, "right")) - 1
                    at = max(int(starts[i]), at + 1) if whole[i] else end
                    cuts.append(at)
            cuts = np.array(cuts, np.int64)
            file = lambda place: chunk + np.searchsorted(cuts, place, "right")  # noqa: B023, E731
            line = np.searchsorted(starts, cuts, "right") - 1
            begun, later = np.unique(line), np.unique(line[cuts > starts[line]])
            here = lambda i: lines[ends[a] + i].astype(np.int64)  # noqa: B023, E731
            of = np.searchsorted(first, begun, "right") - 1
            many = np.bincount(of, minlength=z - a) > BEGUN
            told = here(begun) << 33 | np.isin(begun, later).astype(np.int64) << 32 | file(starts[begun + 1] - 1)
            told = np.concatenate([np.where(many, -1, file(places)), told[~many[of]]])
            of = np.concatenate([np.arange(z - a), of[~many[of]]])
            later = np.union1d(later, np.flatnonzero(np.repeat(many, np.diff(np.append(first, len(n))))))
            order = np.lexsort((told, of))
            files = _lists(told[order], np.searchsorted(of[order], np.arange(z - a + 1)))
            owner = np.searchsorted(first, later, "right") - 1
            k1 = unit.to_numpy()[owner] << UNIT_BITS | here(later)
            split = pa.StructArray.from_arrays([pa.array(k1), _parts(starts[later], n[later], cuts, chunk)], ["k1", "parts"])
            arrays = [unit, b.column("_section").slice(a, z - a), pa.array(places), files]
            arrays += [_lists(split, np.searchsorted(owner, np.arange(z - a + 1))), pa.array(file(np.append(places[1:], stop) - 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["_unit", "_section", "place", "files", "split", "last"])
            chunk, pos = chunk + len(cuts), stop


def uncut(total: Column, tail: Column, max_rules: int, least: int | None = None) -> Column:
    """Whether a list of ``total`` rules has so many exceptions (``tail``) that it can't be cut into files."""
    return (total > max_rules) & (F.lit(max_rules) - tail < (least_room(max_rules) if least is None else max(1, least)))


def units(rules: DataFrame, lists: DataFrame) -> DataFrame:
    """Where each unit of a section's lines stands and which files begin in it, as ``_cut`` tells it.

    ``rules`` has (_section, k1, atomic) and ``lists`` (_list, head, body, room, chunk), one row a list.  Rules are counted where they are read;
    only units, a row and their lines' sizes each, are dealt and sorted, and one task a list streams its own.
    """
    keys, kind = ["_unit", "_section"], "_unit long, _section int"
    counted = rules.select("k1", (F.col("_section").cast("long") * 2 + F.col("atomic").cast("long")).alias("tag")).mapInArrow(_counted, f"{kind}, lines binary, sizes binary")
    merged = counted.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merged, f"{kind}, lines binary, sizes binary")
    rows = merged.withColumn("_list", F.shiftright("_section", SECTION_BITS)).join(F.broadcast(lists), "_list").repartition("_list").sortWithinPartitions("_section", "_unit")
    told = "place long, files array<long>, split array<struct<k1: long, parts: array<array<long>>>>, last int"
    return rows.select(*keys, "lines", "sizes", "head", "body", "room", "chunk").mapInArrow(_cut, f"{kind}, {told}")


def chunks(rules: DataFrame, max_rules: int, least: int | None = None) -> DataFrame:
    """Adds ``position``, the place of a rule in its list's output, from 1, and ``chunk`` (from 1); the exceptions at the end stand in every chunk.

    A list whose exceptions leave room for fewer than ``least`` rules a file can't be cut: its rules have no chunk (null), other lists are cut.
    Rules are sorted only for lines that a file begins in after their first rule, and where many files begin; other lines lie in one file as a whole.
    """
    tail, keys, line = F.col("bucket") >= TAIL, ["_unit", "_section"], ["_section", "k1"]
    lists = rules.groupBy("list_id").agg(F.count("*").alias("total"), F.count_if(tail).alias("tail"), F.count_if(F.col("bucket") <= BUCKET["generichide"]).alias("head"))
    none = uncut(F.col("total"), F.col("tail"), max_rules, least)
    room = F.when((F.col("total") > max_rules) & ~none, F.lit(max_rules) - F.col("tail"))
    number = F.row_number().over(W.orderBy("list_id")).alias("_list")  # a row a list
    lists = lists.select("list_id", number, "head", (F.col("total") - F.col("tail")).alias("body"), room.alias("room"), F.when(none, 0).otherwise(1).alias("chunk"))
    rows = rules.join(F.broadcast(lists.select("list_id", "_list")), "list_id")
    rows = rows.withColumn("_section", F.shiftleft("_list", SECTION_BITS) + F.col("bucket").cast("int")).drop("_list").withColumn("_unit", block("k1", UNIT_BITS))
    cut = units(rows, lists.drop("list_id"))
    rows = rows.withColumn("_at", F.row_number().over(W.partitionBy(*keys).orderBy("k1", "k2", "k3")))  # pruned where nobody asks for positions
    placed = rows.join(cut.select(*keys, "place", "files").hint("shuffle_hash"), keys).withColumn("position", F.col("place") + F.col("_at"))
    chunk = lambda x: F.nullif(x.bitwiseAND((1 << 31) - 1).cast("int"), F.lit(0))
    own = F.col("k1").bitwiseAND((1 << UNIT_BITS) - 1)
    told = [F.get("files", F.lit(i)) for i in range(BEGUN + 1)]  # a lambda would keep this out of the generated code
    met = F.greatest(told[0], *[F.when(x < F.shiftleft(own + 1, 33), x) for x in told[1:]])
    apart = (met < 0) | (F.shiftright(met, 32) == F.shiftleft(own, 1) + 1)
    body = placed.filter(~tail & ~apart).withColumn("chunk", chunk(met))
    split = cut.select("_section", "place", F.explode("split").alias("_line")).select("_section", "place", "_line.*")
    few = rows.filter(~tail).join(split.select(*line).hint("shuffle_hash"), line, "left_semi")
    few = few.withColumn("_spot", F.row_number().over(W.partitionBy(*line).orderBy("k2", "k3")) - 1).withColumn("_part", F.shiftright("_spot", PLACE_BITS))
    few = few.join(split.select(*line, "place", F.posexplode("parts").alias("_part", "_begun")).hint("shuffle_hash"), [*line, "_part"]).withColumn("position", F.col("place") + F.col("_at"))
    after = F.shiftleft((F.col("_spot").bitwiseAND((1 << PLACE_BITS) - 1) + 1).cast("long"), 32)
    few = few.withColumn("chunk", chunk(F.array_max(F.filter("_begun", lambda x: x < after))))
    files = cut.groupBy(F.shiftright("_section", SECTION_BITS).alias("_list")).agg(F.max("last").alias("_files"))
    ends = placed.filter(tail).withColumn("_list", F.shiftright("_section", SECTION_BITS)).join(F.broadcast(files), "_list")  # a row a list
    ends = ends.withColumn("chunk", F.explode(F.when(F.col("_files") == 0, F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(1), F.col("_files")))))
    columns = [*rules.columns, "position", "chunk"]
    return body.select(columns).unionByName(few.select(columns)).unionByName(ends.select(columns))


# ----------------------------------------------------------------------- reports


def rule_json(with_selector: bool = True) -> Column:
    """A rule as the target reads it: absent keys are left out, keys in a fixed order."""
    action = F.struct(F.col("action").alias("type"), F.col("selector")) if with_selector else F.struct(F.col("action").alias("type"))
    return F.to_json(F.struct(F.col("trigger"), action.alias("action")))


_CSS = (BUCKET["generic_css"], BUCKET["specific_css"])


def tally(compiled: Compiled) -> DataFrame:
    """One row per list: numbers of lines, rules by section, and maps of reasons, notes and side-table families.

    All that is counted goes through one aggregation by (list, what, key), and the few rows of it through one by list.
    """
    one, what = F.lit(1).cast("long").alias("n"), lambda name: F.lit(name).alias("what")
    lines = compiled.lines
    facts = lines.select("list_id", what("line"), F.col("kind").alias("key"), one)
    facts = facts.unionByName(lines.filter("reason IS NOT NULL").select("list_id", what("reason"), F.col("reason").alias("key"), one))
    facts = facts.unionByName(compiled.rules.select("list_id", what("rule"), F.col("bucket").cast("string").alias("key"), one))
    facts = facts.unionByName(compiled.selectors.select("list_id", what("selector"), F.lit("").alias("key"), one))
    facts = facts.unionByName(compiled.notes.select("list_id", what("note"), F.col("note").alias("key"), F.col("n").cast("long").alias("n")))
    facts = facts.unionByName(compiled.annex.select("list_id", what("family"), F.col("entry.family").alias("key"), one))
    rows = facts.groupBy("list_id", "what", "key").agg(F.sum("n").alias("n"))
    number = lambda name, *keys: F.coalesce(F.sum(F.when((F.col("what") == name) & (F.col("key").isin(*keys) if keys else F.lit(True)), F.col("n"))), F.lit(0).cast("long"))
    mapped = lambda name: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("what") == name, F.struct("key", "n"))))).alias(f"{name}s")
    own = [number("rule", str(i)).alias(name) for i, name in enumerate(BUCKETS)]
    network = [str(i) for i in range(len(BUCKETS)) if i not in (*_CSS, BUCKET["guard"])]
    converted = number("rule", *network) + number("selector")
    out = rows.groupBy("list_id").agg(
        number("line").alias("lines_total"), number("line", "network", "cosmetic").alias("rules_in"), number("line", "comment").alias("comments"), number("reason").alias("skipped"),
        converted.alias("converted"), number("rule").alias("rules_out"), *own, mapped("reason"), mapped("note"), mapped("family"),
    )
    share = F.when(F.col("rules_in") > 0, F.bround(100.0 * F.col("converted") / F.col("rules_in"), 2)).otherwise(F.lit(0.0))
    return out.filter("lines_total > 0").withColumn("coverage_pct", share)


def counts(compiled: Compiled) -> DataFrame:
    """(list_id, lines_total, rules_in, comments, skipped, converted, coverage_pct)."""
    return tally(compiled).select("list_id", "lines_total", "rules_in", "comments", "skipped", "converted", "coverage_pct")


def breakdown(rules: DataFrame) -> DataFrame:
    """Rules of each list by section."""
    own = [F.count_if(F.col("bucket") == i).alias(name) for i, name in enumerate(BUCKETS)]
    return rules.groupBy("list_id").agg(F.count("*").alias("rules_out"), *own)


def reasons(lines: DataFrame) -> DataFrame:
    """(list_id, reason, n) of rejected lines, by number and first appearance."""
    own = lines.filter("reason IS NOT NULL").groupBy("list_id", "reason").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    return own.orderBy("list_id", F.desc("n"), "first").select("list_id", "reason", "n")


def top_reasons(lines: DataFrame, n: int = 40) -> DataFrame:
    return lines.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(n)


def published(report: DataFrame, profile: Profile) -> DataFrame:
    """Adds ``published``: lists that give nearly nothing for their size are left out."""
    least = F.greatest(F.lit(profile.min_rules), F.floor(F.col("rules_in") * F.lit(profile.min_yield)))
    return report.withColumn("published", (F.col("rules_out") > 0) & ((F.col("rules_in") < 100) | (F.col("rules_out") >= least)))


def report(compiled: Compiled, profile: Profile | None = None) -> DataFrame:
    """One row per list: counts, sections, side-table families, reasons, notes and the publication gate."""
    return published(tally(compiled), profile or Profile())


def _totals() -> list[Column]:
    shown = lambda col: F.sum(F.when(F.col("published"), F.col(col)).otherwise(0))
    return [
        F.count("*").alias("lists_"), F.count_if("published").alias("lists_published"), F.sum("rules_in").alias("rules_in"), F.sum("rules_out").alias("rules_out"),
        shown("rules_in").alias("published_in"), shown("rules_out").alias("published_out"), F.sum("skipped").alias("skipped"),
    ]


def totals(reports: DataFrame) -> DataFrame:
    """One row over all lists and over the published ones."""
    return reports.agg(*_totals()).withColumnRenamed("lists_", "lists")


def capabilities(reports: DataFrame) -> DataFrame:
    """What each list does: network and cosmetic rules, exceptions, side-table entries."""
    b = lambda *names: sum((F.col(n) for n in names), F.lit(0))
    extended = F.aggregate(F.map_values("familys"), F.lit(0).cast("long"), lambda a, x: a + x)
    return reports.select(
        "list_id", b("block", "block_document").alias("network"), b("generic_css", "specific_css").alias("cosmetic"), b("cookie").alias("cookies"),
        b("generichide", "urlblock", "exception", "page_exception").alias("exceptions"), extended.alias("extended"),
    )


def catalogue_json(reports: DataFrame) -> DataFrame:
    """The output catalogue as one JSON document of totals, published and unpublished lists."""
    row = F.struct("list_id", "rules_in", "rules_out", "coverage_pct")
    listed = lambda cond, name: F.array_sort(F.collect_list(F.when(cond, row))).alias(name)
    whole = reports.agg(*_totals(), listed(F.col("published"), "lists"), listed(~F.col("published"), "unpublished"))
    return whole.select(F.to_json(F.struct(F.lit(2).alias("schema"), F.struct("lists_published", "rules_in", "rules_out", "published_in", "published_out", "skipped").alias("totals"), whole["lists_"].alias("lists_total"), "lists", "unpublished")).alias("json"))


def markdown(reports: DataFrame, lines: DataFrame) -> str:
    """The report for readers: lists by output, then the most frequent reasons; both tables are bounded by lists and codes."""
    rows = reports.orderBy(F.desc("rules_out"), "list_id").select("list_id", "rules_in", "rules_out", "coverage_pct").toLocalIterator()
    out = ["| list | in | out | coverage |", "|---|---:|---:|---:|", *(f"| {r.list_id} | {r.rules_in} | {r.rules_out} | {r.coverage_pct} % |" for r in rows), "", "| reason | lines |", "|---|---:|"]
    return "\n".join([*out, *(f"| {r.reason} | {r.n} |" for r in top_reasons(lines).collect())]) + "\n"


# -------------------------------------------------------------------- side table


def compact_entry() -> Column:
    """An entry without what its reader assumes: false flags and no exclusions."""
    named = {"cookie_name": "name"}
    fields = []
    for name, kind in annex_fields.FIELDS.items():
        if name in ("family",):
            continue
        value = F.col("entry")[name]
        value = F.nullif(value, F.lit(False)) if kind == "boolean" else F.when(F.size(value) > 0, value) if name == "excluded" else value
        if name == "name":
            value = F.coalesce(value, F.col("entry")["cookie_name"])
        if name not in named:
            fields.append(value.alias(name))
    return F.to_json(F.struct(*fields))


def annex_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("list_id", F.col("entry.family").alias("family")).agg(F.count("*").alias("n"))


def annex_digest(entries: DataFrame) -> DataFrame:
    """A digest of each list's entries in their order; the same list always has the same."""
    rows = entries.filter("entry.family <> 'raw_js'").select("list_id", "line_no", "sub", F.concat("entry.family", F.lit(":"), compact_entry(), F.lit("\n")).alias("j"))
    return digest(rows, "list_id", ["line_no", "sub"], "j").select("list_id", "digest")


# ------------------------------------------------------------------------- files


def now_iso() -> str:
    """The time in UTC, to the second."""
    return datetime.now(UTC).isoformat(timespec="seconds")


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def file_names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = _fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text in any store, under a temporary name until it is whole."""
    fs, where = _fs(spark, path)
    part = where.suffix(".tmp")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(where, False)
    if not fs.rename(part, where):
        raise OSError(f"{part} could not be renamed")


def write_named(rows: DataFrame, folder: str) -> list[dict]:
    """Write each ``file`` of ``rows`` (file, place, line) to ``folder`` by that name, its lines in order; (file, lines, bytes) of each.

    A task writes whole files, to a folder beside; the driver only renames them.
    """
    spark, staging = rows.sparkSession, f"{folder}/.staging-{datetime.now(UTC):%Y%m%d%H%M%S%f}"
    rows.select("file", "place", "line").repartition("file").sortWithinPartitions("file", "place").select("file", F.col("line").alias("value")).write.partitionBy("file").text(staging)
    fs, root = _fs(spark, staging)
    unescape, done = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName, []
    for own in fs.listStatus(root):
        if not own.isDirectory():
            continue
        name = unescape(own.getPath().getName().split("=", 1)[1])
        parts = [f for f in fs.listStatus(own.getPath()) if f.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise OSError(f"{name} was written in {len(parts)} parts")
        target = _fs(spark, f"{folder}/{name}")[1]
        fs.delete(target, False)
        if not fs.rename(parts[0].getPath(), target):
            raise OSError(f"{name} could not be renamed")
        done.append({"file": name, "bytes": parts[0].getLen()})
    fs.delete(root, True)
    return sorted(done, key=lambda d: d["file"])


def write_rules(chunked: DataFrame, folder: str) -> list[dict]:
    """One file per list and chunk, each a JSON array with a rule a line; (file, list_id, rules, bytes) of each, a row a file.

    Rules without a chunk are in no file.
    """
    chunked = chunked.filter("chunk IS NOT NULL")
    many = chunked.groupBy("list_id").agg((F.max("chunk") > 1).alias("many"))
    sizes = chunked.groupBy("list_id", "chunk").agg(F.count("*").alias("rules"), F.min("position").alias("_first"), F.max("position").alias("_last"))
    named = sizes.join(many, "list_id").withColumn("file", F.concat("list_id", F.when(F.col("many"), F.concat(F.lit("-"), "chunk")).otherwise(F.lit("")), F.lit(".json")))
    rows = chunked.select("list_id", "chunk", "position", rule_json().alias("j")).join(named, ["list_id", "chunk"])
    line = F.concat(F.when(F.col("position") == F.col("_first"), "[").otherwise(","), "j", F.when(F.col("position") == F.col("_last"), "]").otherwise(""))
    written = {d["file"]: d["bytes"] for d in write_named(rows.select("file", F.col("position").alias("place"), line.alias("line")), folder)}
    return [{"file": r.file, "list_id": r.list_id, "rules": r.rules, "bytes": written[r.file]} for r in named.orderBy("list_id", "chunk").collect()]


def write_annex(entries: DataFrame, folder: str) -> list[dict]:
    """One file per list: counts, digest, and the entries by family; counts and digest of each, a row a list."""
    per = entries.groupBy("list_id", F.col("entry.family").alias("family")).agg(F.count("*").alias("n"), F.min(F.struct("line_no", "sub")).alias("_first"))
    counts = per.groupBy("list_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("family", "n")))).alias("counts"), F.max(F.when(F.col("family") != "raw_js", F.col("family"))).alias("_end"))
    heads = counts.join(annex_digest(entries), "list_id", "left")
    name = F.concat("list_id", F.lit(".json"))
    begin = heads.select(name.alias("file"), F.struct(F.lit("").alias("family"), F.lit(0).cast("long").alias("line_no"), F.lit(0).alias("sub")).alias("place"), F.concat(F.lit('{"counts":'), F.to_json("counts"), F.lit(',"sha256":'), F.coalesce(F.concat(F.lit('"'), "digest", F.lit('"')), F.lit("null")), F.when(F.col("_end").isNull(), "}").otherwise("")).alias("line"))
    own = entries.filter("entry.family <> 'raw_js'").select("list_id", F.col("entry.family").alias("family"), "line_no", "sub", compact_entry().alias("j"))
    own = own.join(per.select("list_id", "family", "_first", "n"), ["list_id", "family"])
    opens = (F.col("line_no") == F.col("_first.line_no")) & (F.col("sub") == F.col("_first.sub"))
    line = F.concat(F.when(opens, F.concat(F.lit(',"'), "family", F.lit('":['))).otherwise(","), "j")
    closing = per.filter("family <> 'raw_js'").join(heads.select("list_id", "_end"), "list_id")
    closing = closing.select(name.alias("file"), F.struct("family", F.lit(1 << 62).alias("line_no"), F.lit(0).alias("sub")).alias("place"), F.when(F.col("family") == F.col("_end"), "]}").otherwise("]").alias("line"))
    rows = own.select(name.alias("file"), F.struct("family", "line_no", F.col("sub").cast("int").alias("sub")).alias("place"), line.alias("line"))
    written = {d["file"]: d["bytes"] for d in write_named(begin.unionByName(rows).unionByName(closing), folder)}
    return [{"file": f"{r.list_id}.json", "list_id": r.list_id, "bytes": written[f"{r.list_id}.json"], "sha256": r.digest, **r.counts} for r in heads.orderBy("list_id").collect()]


def stale(existing: DataFrame, produced: DataFrame, key: str = "file") -> DataFrame:
    """Files that nothing produces any more."""
    return existing.join(produced, key, "left_anti")


def purge(spark: SparkSession, folder: str, produced: list[str], suffix: str = ".json", keep: tuple[str, ...] = ("index.json",)) -> list[str]:
    """Delete the files of an earlier run that this one, a full one, has not made; their names."""
    names = [x for x in file_names(spark, folder) if x.endswith(suffix) and x not in keep]
    if not names:
        return []
    listed = lambda x: spark.createDataFrame([(n,) for n in x], "file string")
    gone = sorted(r.file for r in stale(listed(names), listed(produced)).collect())
    for name in gone:
        fs, where = _fs(spark, f"{folder}/{name}")
        fs.delete(where, False)
    return gone


def report_json(reports: DataFrame) -> DataFrame:
    """(list_id, json): the report of each list as one document."""
    return reports.select("list_id", F.to_json(F.struct(*reports.columns)).alias("json"))


def summary(reports: DataFrame) -> str:
    """What a run has done, for a terminal: a line for all lists and one for those that are left out."""
    t = totals(reports).first()
    out = [f"{t.lists_published} lists, {t.published_out} rules of {t.published_in} entries; {t.skipped} entries left out"]
    if t.lists > t.lists_published:
        out.append(f"{t.lists - t.lists_published} lists are not published, as they give too little")
    return "\n".join(out) + "\n"
