"""Places within a group that no task has to number alone.

A group (all rules of a list, all lines of a text) may hold a third of all rows.  Rows are put into blocks by the
leading columns of their order; each block is numbered by itself, and the blocks' sizes, one small
row each, give the number that it begins with.  The same blocks carry a value from line to line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Values of the leading order column in a block, as a power of two.
BLOCK_BITS = 16


def block(col: str, bits: int = BLOCK_BITS) -> Column:
    return F.shiftright(F.col(col).cast("long"), bits)


def ranked(rows: DataFrame, by: list[str], blocks: list[Column], order: list[str], name: str = "rank", least: str | None = None) -> DataFrame:
    """Adds ``name``, the place from 0 of each row in its group ``by``.

    Rows come in the order of ``blocks``, and within a block of ``order``.  With ``least``, that column's least
    value in the group is added as ``least``.  Group columns must not be null.
    """
    keys = [f"_block{i}" for i in range(len(blocks))]
    rows = rows.withColumns(dict(zip(keys, blocks, strict=True)))
    sizes = rows.groupBy(*by, *keys).agg(F.count("*").alias("_size"), *([F.min(least).alias("_least")] if least else []))
    before = W.partitionBy(*by).orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    given = {"_begin": F.coalesce(F.sum("_size").over(before), F.lit(0))} | ({"least": F.min("_least").over(W.partitionBy(*by))} if least else {})
    begins = sizes.withColumns(given).drop("_size", "_least")
    own = F.row_number().over(W.partitionBy(*by, *keys).orderBy(*order)) - 1
    return rows.join(begins, [*by, *keys]).withColumn(name, (F.col("_begin") + own).cast("long")).drop("_begin", *keys)


def carried(rows: DataFrame, marks: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """``rows`` with the ``value`` of the last of ``marks`` (by, order, value) at or before each row; null before the first."""
    both = rows.withColumn("_at", block(order)).join(marks.withColumn("_marked", F.lit(True)), [by, order], "left")
    last = marks.withColumn("_at", block(order)).groupBy(by, "_at").agg(F.max_by(value, order).alias("_last"))
    blocks = rows.join(marks.select(by).distinct(), by, "left_semi").select(by, block(order).alias("_at")).distinct().join(last, [by, "_at"], "left")
    begin = F.last("_last", ignorenulls=True).over(W.partitionBy(by).orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
    begins = blocks.select(by, "_at", begin.alias("_begin"))
    inside = F.last(value, ignorenulls=True).over(W.partitionBy(by, "_at").orderBy(order))
    return both.join(begins, [by, "_at"], "left").withColumn(value, F.coalesce(inside, "_begin")).drop("_at", "_begin")


def digest(rows: DataFrame, by: str, order: list[str], text: str, bits: int = BLOCK_BITS) -> DataFrame:
    """(by, n, digest) of the texts of a group in their order: the digest of the digests of blocks of 2**bits texts.

    Blocks go by place, so equal texts in equal order have equal digests wherever they stand.
    """
    first, *rest = order
    placed = ranked(rows.select(by, *order, F.col(text).alias("_text")), [by], [block(first, bits)], [first, *rest], "_place")
    placed = placed.withColumn("_block", F.shiftright("_place", bits))
    whole = lambda structs: F.array_join(F.transform(F.array_sort(F.collect_list(structs)), lambda x: x["_text"]), "")
    blocks = placed.groupBy(by, "_block").agg(F.count("*").alias("n"), F.sha2(whole(F.struct("_place", "_text")), 256).alias("_text"))
    return blocks.groupBy(by).agg(F.sum("n").alias("n"), F.sha2(whole(F.struct("_block", "_text")), 256).alias("digest"))
