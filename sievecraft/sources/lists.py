"""Reading list texts: lines, headers, directives, includes, content digests."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.functions import columns as c
from sievecraft.functions import grammar as g
from sievecraft.functions.ranks import carried, digest

#: Everything that ends a line in Python's text model.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def read_texts(spark: SparkSession, folder: str, only: str | None = None) -> DataFrame:
    """(list_id, content) of the ``.txt`` files of a folder; broken UTF-8 is replaced."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    rows = files.select(name.alias("list_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))
    return rows if only is None else rows.filter(F.lower("list_id").contains(only.lower()))


def split_lines(texts: DataFrame) -> DataFrame:
    """(list_id, line_no, raw), numbered from 1; an end of line at the end of the text ends no further line."""
    parts = F.split(F.regexp_replace("content", f"(?:{LINE_END})\\z", ""), LINE_END)
    return texts.filter("content <> ''").select("list_id", F.posexplode(parts).alias("n", "raw")).select("list_id", (F.col("n") + 1).cast("long").alias("line_no"), "raw")


def headers(lines: DataFrame, most: int = 60) -> DataFrame:
    """(list_id, key, value) of the comments that open a list; the first of a key counts."""
    first = lines.filter(F.col("line_no") <= most).withColumn("s", c.strip(F.col("raw")))
    breaks = (F.col("s") != "") & ~F.col("s").rlike(r"^[!\[#]")
    head = first.withColumn("over", F.max(breaks.cast("int")).over(W.partitionBy("list_id").orderBy("line_no"))).filter("over = 0")
    key, value = F.regexp_extract("s", r"^[!#]\s*([A-Za-z][\w -]*?)\s*:\s*(.+)$", 1), F.regexp_extract("s", r"^[!#]\s*([A-Za-z][\w -]*?)\s*:\s*(.+)$", 2)
    rows = head.select("list_id", "line_no", F.regexp_replace(F.lower(key), r"[\s-]+", "_").alias("key"), c.strip(value).alias("value")).filter("key <> ''")
    return rows.groupBy("list_id", "key").agg(F.min_by("value", "line_no").alias("value"))


def preprocess(lines: DataFrame) -> DataFrame:
    """(list_id, line_no, raw, dropped): lines of directive branches that hold; ``dropped`` counts the list's other lines.

    Conditions are few, so each distinct one is evaluated once.  Branches nest, so a list's
    directives are folded in order; the lines between them only look up their branch.
    """
    word = r"^\s*!#(if|else|endif)\b\s*(.*)"
    marks = lines.filter(F.col("raw").rlike(word)).select("list_id", "line_no", F.regexp_extract("raw", word, 1).alias("word"), F.regexp_extract("raw", word, 2).alias("cond"))
    holds = F.udf(g.directive_holds, "boolean", useArrow=True)
    known = marks.filter("word = 'if'").select("cond").distinct().withColumn("holds", holds("cond"))
    rows = marks.join(known, "cond", "left")

    def fold(pdf):
        pdf = pdf.sort_values("line_no")
        stack, out = [], []
        for word_, holds_ in zip(pdf.word, pdf.holds, strict=True):
            if word_ == "if":
                stack.append(bool(holds_))
            elif stack and word_ == "else":
                stack[-1] = not stack[-1]
            elif stack:
                stack.pop()
            out.append(all(stack))
        return pdf.assign(live=out)[["list_id", "line_no", "live"]]

    # Only a list's directives meet in one task; what they say is carried to the lines block by block.
    states = rows.groupBy("list_id").applyInPandas(fold, f"list_id {lines.schema['list_id'].dataType.simpleString()}, line_no long, live boolean")
    joined = carried(lines, states, "list_id", "line_no", "live").withColumns({"directive": F.col("_marked").isNotNull(), "live": F.coalesce("live", F.lit(True))}).drop("_marked")
    rule = ~F.col("live") & ~F.col("directive") & ~F.col("raw").rlike(r"^\s*(!|$)")
    dropped = joined.filter(rule).groupBy("list_id").agg(F.count("*").alias("dropped"))
    kept = joined.filter("live AND NOT directive").join(dropped, "list_id", "left")
    return kept.select("list_id", "line_no", "raw", F.coalesce("dropped", F.lit(0).cast("long")).alias("dropped"))


INCLUDE = r"^!#include\s+(\S+)"


def _same_origin(base: str | None, path: str | None) -> str | None:
    """The address of an include, if it is at the same secure origin."""
    if not base or not path:
        return None
    target = urljoin(base, path)
    a, b = urlsplit(base), urlsplit(target)
    return target if b.scheme == "https" and a.netloc == b.netloc else None


def resolve_includes(lines: DataFrame, urls: DataFrame, library: DataFrame, depth: int = 5) -> DataFrame:
    """Lines with includes put in their place.  ``urls``: (list_id, url) of the lists; ``library``: (url, content).

    One join a level.  The place of a line is the path of line numbers that leads to it, so
    order needs no counter; an address that was already taken for the list is left out.
    """
    target = F.udf(_same_origin, "string", useArrow=True)
    text = split_lines(library.withColumnRenamed("url", "list_id")).select(F.col("list_id").alias("target"), F.col("line_no").alias("n"), F.col("raw").alias("inner"))
    now = lines.join(urls, "list_id", "left").select("list_id", F.array("line_no").alias("place"), "raw", "url", F.array("url").alias("seen"))
    done = None
    for level in range(depth):
        include = F.regexp_extract("raw", INCLUDE, 1)
        marked = now.withColumn("target", F.when(include != "", target("url", include)))
        taken = F.row_number().over(W.partitionBy("list_id", "target").orderBy("place")) == 1
        fresh = F.col("target").isNotNull() & ~F.array_contains("seen", F.col("target")) & taken
        marked = marked.withColumn("open", F.coalesce(fresh, F.lit(False)))
        flat = marked.filter("NOT open").select("list_id", "place", F.when(include != "", F.concat(F.lit("! not included: "), include)).otherwise(F.col("raw")).alias("raw"))
        done = flat if done is None else done.unionByName(flat)
        inside = marked.filter("open")
        if level == depth - 1:
            done = done.unionByName(inside.select("list_id", "place", F.concat(F.lit("! not included: "), include).alias("raw")))
            break
        begin = inside.select("list_id", F.concat("place", F.array(F.lit(0).cast("long"))).alias("place"), F.concat(F.lit("! begin include "), "target").alias("raw"))
        end = inside.select("list_id", F.concat("place", F.array(F.lit(1 << 40))).alias("place"), F.concat(F.lit("! end include "), "target").alias("raw"))
        done = done.unionByName(begin).unionByName(end)
        now = inside.join(text, "target").select("list_id", F.concat("place", F.array("n")).alias("place"), F.col("inner").alias("raw"), F.col("target").alias("url"), F.concat("seen", F.array("target")).alias("seen"))
    return done.select("list_id", F.row_number().over(W.partitionBy("list_id").orderBy("place")).cast("long").alias("line_no"), "raw")


def content_digest(lines: DataFrame) -> DataFrame:
    """(list_id, rules, digest): number and digest (of blocks of lines) of a list's lines that are neither empty nor comments, in order."""
    rows = lines.select("list_id", "line_no", c.strip(F.col("raw")).alias("s")).filter(~F.col("s").rlike(r"^$|^[!#\[]"))
    return digest(rows.withColumn("s", F.concat("s", F.lit("\n"))), "list_id", ["line_no"], "s").withColumnRenamed("n", "rules")


def mark_duplicates(digests: DataFrame, order: DataFrame) -> DataFrame:
    """Adds ``duplicate_of``: the first list, in the catalogue's order (list_id, pos), of the same content."""
    rows = digests.join(order, "list_id")
    first = rows.groupBy("digest").agg(F.min_by("list_id", "pos").alias("first"))
    return rows.join(first, "digest").withColumn("duplicate_of", F.when(F.col("first") != F.col("list_id"), F.col("first"))).drop("first")


def arrow_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For readers that hand over whole texts as Arrow batches: the same lines as ``split_lines``."""
    for b in batches:
        rows = [(i, n + 1, raw) for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for n, raw in enumerate((text or "").splitlines())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((b.schema.field(0).type, pa.int64(), pa.string()))], names=["list_id", "line_no", "raw"])
