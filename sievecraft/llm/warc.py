"""WARC archives with revisit records, read back and indexed by a loser-tree merge of sorted runs.

Writing.  Each page becomes one record: ``response`` with its payload, or
``revisit`` of the page with the smallest id among those of equal payload (from
``least`` bytes up).  Records are composed by SQL functions and written through
Spark's own file writer as gzipped text with ``CR LF CR LF`` as separator, which is
byte for byte the WARC layout (header, blank line, block, two line ends).  So
archives can go to any store Spark can write, by committed tasks only; they are
gzipped whole, so a file is read by one task from its start.  Files hold at most
``RECORDS_PER_FILE`` records.

Reading.  A task streams its files through a parser that takes blocks by their
Content-Length, so separators within a payload do no harm; it recomputes the
digests of payloads and yields its captures as *sorted runs* of at most
``RUN_ROWS`` entries (an external sort: a run is all that is held at a time).

Merging.  Runs are dealt into ranges of (URL key, time, page); each range merges
the runs that reach into it with a loser tree.  The ranges are cut by all three
parts of the key, so one URL with most captures is spread too.

Defined cases: a null html is an empty payload, a null url the empty URL; rows
that repeat a page id are records of their own (if it is the smallest id of equal
payloads, each of them is a response); rows without page id revisit the page with
the smallest id of their payload, and are responses if there is none.  Times are
not in the table, so they are made from the page id.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.llm.common import no_clash, shared_folder, table

SEPARATOR = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
RUN_ROWS = 50_000
CAPTURES = "page_id long, url string, url_key string, date string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean"
#: RFC 4648 base32 against the digits that conv() writes in base 32.
CONV_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four parts of 40 bits, 8 digits each."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32)


def url_key(url: str) -> str:
    """Host labels reversed, then path and query: com,example)/path?query."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", url.lower()).partition("#")[0]
    host, tail = re.fullmatch(r"(?s)([^/?]*)(.*)", rest).groups()
    host = re.sub(r"^www\.|:\d+$", "", host)
    return f"{','.join(reversed(host.split('.')))}){tail if tail.startswith('/') else '/' + tail}"


def plan_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Adds payload_bytes, payload_digest, record_type and refers_to."""
    rows = no_clash(pages, "page_id", "url", "html").select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": base32_sha1(F.col("html").cast("binary"))})
    thin = rows.select("page_id", "payload_digest", "payload_bytes")
    groups = thin.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("first_id"), F.count("*").alias("in_group"))
    groups = groups.filter((F.col("in_group") > 1) & (F.col("payload_bytes") >= least)).drop("in_group")
    joined = rows.join(groups, ["payload_digest", "payload_bytes"], "left")
    first = F.col("first_id").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.withColumns({"record_type": F.when(first, "response").otherwise("revisit"), "refers_to": F.when(~first, F.col("first_id"))}).drop("first_id")


def _record() -> Column:
    instant = F.timestamp_seconds(F.lit(1_577_836_800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 31)))
    date = F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")  # dates are in UTC, whatever the session's zone
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))).otherwise(F.lit("")),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        line("WARC-Date", date),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(header, block)


def write(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write one WARC record per page under ``path``."""
    records = plan_records(pages, least).select(_record().alias("value"))
    records.write.options(lineSep=SEPARATOR, compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE).text(path)


class _Parser:
    """Puts records together again from the pieces between separators."""

    def __init__(self):
        self.header: dict[str, str] | None = None
        self.need, self.got, self.parts = 0, 0, []

    def feed(self, piece: bytes) -> tuple[dict[str, str], bytes] | None:
        if self.header is None:
            lines = piece.decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no record starts with {lines[0][:40]!r}")
            self.header = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            self.need, self.got, self.parts = int(self.header["Content-Length"]), -len(SEPARATOR), []
            return None
        self.parts.append(piece)
        self.got += len(SEPARATOR) + len(piece)
        if self.got < self.need:
            return None
        # A block that ends in a line end is split two bytes early, so the next piece begins with the rest of it.
        whole, separator = SEPARATOR.encode().join(self.parts), SEPARATOR.encode()
        out, rest, self.header = (self.header, whole[: self.need]), whole[self.need :], None
        if rest:
            if not rest.startswith(separator):
                raise ValueError("a block is longer than its Content-Length")
            if rest := rest[len(separator) :]:  # the next header; none at the end of an archive
                self.feed(rest)
        return out


def _page(urn: str | None) -> int | None:
    return int(x) if urn and (x := urn.removeprefix("<urn:page:").removesuffix(">")) else None


_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("url_key", pa.string()), ("date", pa.string()), ("record_type", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_()),
])


def _order(capture: tuple) -> tuple:
    """URL key, time, page (null last), URL."""
    return capture[2], capture[3], capture[0] is None, capture[0] or 0, capture[1]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parser, run = _Parser(), []

    def done() -> pa.RecordBatch:
        run.sort(key=_order)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*run, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    for batch in batches:
        for value in batch.column(0):
            record = parser.feed(value.as_buffer().to_pybytes())
            if record is None:
                continue
            head, block = record
            told = head["WARC-Payload-Digest"].removeprefix("sha1:")
            if head["WARC-Type"] == "response":
                length, digest = len(block), base64.b32encode(hashlib.sha1(block).digest()).decode()
            else:
                length, digest = int(head["X-Payload-Length"]), told
            url = head["WARC-Target-URI"]
            run.append((_page(head["WARC-Record-ID"]), url, url_key(url), head["WARC-Date"], head["WARC-Type"], length, digest, _page(head.get("WARC-Refers-To")), digest == told))
            if len(run) >= RUN_ROWS:
                yield done()
                run = []
    if parser.header is not None:
        raise ValueError("an archive ends within a record")
    if run:
        yield done()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under ``path``, each task's in sorted runs."""
    pieces = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary"))
    return pieces.mapInArrow(_parse, CAPTURES)


class LoserTree:
    """Merges sorted lists: inner nodes hold the loser of each match, the root the winner."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.at = [0] * len(runs)
        self.heads = [self._head(i) for i in range(len(runs))]
        self.losers = [-1] * self.k
        for i in range(len(runs)):
            self._play(i, build=True)

    def _head(self, i: int):
        return (self.key(self.runs[i][self.at[i]]), i) if self.at[i] < len(self.runs[i]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _play(self, i: int, build: bool = False) -> None:
        node, winner = (i + self.k) // 2, i
        while node > 0:
            other = self.losers[node]
            if other < 0 and build:  # the first to arrive waits for its opponent
                self.losers[node] = winner
                return
            if other >= 0 and not self._beats(winner, other):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.runs and self.heads[w := self.losers[0]] is not None:
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.heads[w] = self._head(w)
            self._play(w)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one range.  A shuffle hands over each map task's rows in their order, so runs are
    found where the order falls; however the blocks arrive, what is merged are ascending runs."""
    runs: list[list] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if not runs or _order(row) < _order(runs[-1][-1]):
                runs.append([])
            runs[-1].append(row)
    merged = iter(LoserTree(runs, _order))
    while part := list(itertools.islice(merged, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def capture_histories(captures: DataFrame) -> DataFrame:
    """All captures in the order of URL key, time and page: partitions are ranges, each merged from sorted runs."""
    ranges = captures.repartitionByRange("url_key", "date", F.col("page_id").asc_nulls_last())
    return ranges.mapInArrow(_merge, CAPTURES)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write archives into the shared folder, read them back, and return the merged index."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/tables/warc-{uuid.uuid4().hex}"
    write(pages, path, least)
    return capture_histories(read(spark, path))


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_DIGIT = " || ".join(f"substr('{BASE32}', CAST(((CAST(('0x' || substr(h, {10 * i + 1}, 10)) AS BIGINT) >> {35 - 5 * j}) & 31) AS INTEGER) + 1, 1)" for i in range(4) for j in range(8))
SQL = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first_id FROM p)
SELECT page_id, payload_bytes, {_DIGIT} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM g
"""

QUERIES = {"op7_warc_round_trip": op7_warc_round_trip}
ORACLES = {"op7_warc_round_trip": SQL}
