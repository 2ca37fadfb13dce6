"""Fetching lists: conditional, over secure addresses only, with retries, limits and mirrors.

The transport is the caller's: anything that maps (address, headers, seconds) to a ``Response``.
Lists are fetched by executors, a few addresses a task; what comes back has one row per list.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.sources import lists


@dataclass(frozen=True)
class Response:
    """What a server has answered, and the address that it came from in the end."""

    code: int
    url: str
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)


Transport = Callable[[str, dict[str, str], float], Response]
#: Codes after which another attempt is of no use.
FINAL = (400, 401, 403, 404, 410)
UNCHANGED = 304
MAX_BYTES = 200 << 20


def over_http(url: str, headers: dict[str, str], seconds: float) -> Response:
    """The transport of the standard library."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=seconds) as r:  # noqa: S310 - only secure addresses get here
            return Response(r.status, r.geturl(), r.read(MAX_BYTES + 1), dict(r.headers))
    except urllib.error.HTTPError as e:
        return Response(e.code, e.url or url, b"", dict(e.headers or {}))


class FetchError(OSError):
    """Why a list could not be had."""


@dataclass(frozen=True)
class Policy:
    retries: int = 3
    seconds: float = 60.0
    wait: float = 1.5
    max_bytes: int = MAX_BYTES
    agent: str = "sievecraft"


def get(transport: Transport, url: str, policy: Policy, etag: str | None = None, modified: str | None = None) -> Response:
    """One conditional request, repeated while that may help."""
    headers = {"User-Agent": policy.agent, "Accept": "text/plain,*/*"} | ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": modified} if modified else {})
    why = "no attempt was made"
    for attempt in range(policy.retries):
        if attempt:
            time.sleep(policy.wait * attempt)
        if not url.startswith("https://"):
            raise FetchError(f"not a secure address: {url}")
        try:
            got = transport(url, headers, policy.seconds)
        except OSError as e:
            why = f"{type(e).__name__}: {e}"
            continue
        if got.code == UNCHANGED:
            return got
        if not got.url.startswith("https://"):
            raise FetchError(f"redirected to an address that is not secure: {got.url}")
        if got.code == 200:
            if len(got.body) > policy.max_bytes:
                raise FetchError(f"more than {policy.max_bytes} bytes")
            return got
        why = f"HTTP {got.code}"
        if got.code in FINAL:
            break
    raise FetchError(why)


_FETCHED = pa.schema([("id", pa.string()), ("code", pa.int32()), *[(x, pa.string()) for x in ("content", "etag", "last_modified", "error", "kind")]])


def _header(got: Response, name: str) -> str | None:
    return next((v for k, v in got.headers.items() if k.lower() == name), None)


def _one(transport: Transport, policy: Policy, id_: str, url: str, mirror: str | None, etag: str | None, modified: str | None) -> tuple:
    kind, first = "source", None
    for address, tag, since in ((url, etag, modified), (mirror, None, None)):
        if address is None:
            break
        try:
            got = get(transport, address, policy, tag, since)
            return id_, got.code, None if got.code == UNCHANGED else got.body.decode("utf-8", "replace"), _header(got, "etag"), _header(got, "last-modified"), None, kind
        except FetchError as e:
            first, kind = f"{first}; mirror: {e}" if first else str(e), "mirror"
    return id_, None, None, None, None, first, kind


def fetch(plan: DataFrame, transport: Transport = over_http, policy: Policy | None = None, tasks: int = 8) -> DataFrame:
    """(id, code, content, etag, last_modified, error, kind) of the lists of ``plan`` that are due.

    ``plan``: id, url, due, etag, last_modified, and perhaps mirror_url and conditional (false where no text is there to keep).
    """
    policy = policy or Policy()
    may = F.col("conditional") if "conditional" in plan.columns else F.lit(True)
    rows = plan.filter("due").select("id", "url", F.col("mirror_url") if "mirror_url" in plan.columns else F.lit(None).cast("string").alias("mirror_url"), F.when(may, F.col("etag")).alias("etag"), F.when(may, F.col("last_modified")).alias("last_modified"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(_one(transport, policy, *row), _FETCHED, strict=True)], schema=_FETCHED)

    # Written down once by the caller: a second reading would ask the servers again.
    return rows.repartition(tasks, "url").mapInArrow(run, "id string, code int, content string, etag string, last_modified string, error string, kind string")


def fetch_library(spark: SparkSession, lines: DataFrame, urls: DataFrame, transport: Transport = over_http, policy: Policy | None = None, depth: int = 5) -> DataFrame:
    """(url, content) of all texts that lists include, level by level; only those of a list's own origin.  ``urls``: (list_id, url)."""
    target = F.udf(lists._same_origin, "string", useArrow=True)
    library = spark.createDataFrame([], "url string, content string")
    now = lines.join(urls, "list_id").select("url", "raw")
    for _ in range(depth):
        include = F.regexp_extract("raw", lists.INCLUDE, 1)
        asked = now.filter(include != "").select(target("url", include).alias("url")).filter("url IS NOT NULL").distinct().join(library, "url", "left_anti")
        none = F.lit(None).cast("string")
        got = fetch(asked.select(F.col("url").alias("id"), "url", F.lit(True).alias("due"), none.alias("etag"), none.alias("last_modified")), transport, policy).filter("code = 200").select(F.col("id").alias("url"), "content").persist()
        if got.isEmpty():
            break
        library = library.unionByName(got)
        now = lists.split_lines(got.withColumnRenamed("url", "list_id")).select(F.col("list_id").alias("url"), "raw")
    return library
