"""How much of a list's blocks another list has, too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def block_filters(rules: DataFrame) -> DataFrame:
    """(list_id, url_filter): distinct expressions of blocks."""
    return rules.filter("action = 'block'").select("list_id", F.col("trigger")["url-filter"].alias("url_filter")).distinct()


def pairs(filters: DataFrame) -> DataFrame:
    """(a, b, shared, size, pct): each list against each other one with which it shares an expression."""
    sizes = filters.groupBy(F.col("list_id").alias("a")).agg(F.count("*").alias("size"))
    left, right = filters.withColumnRenamed("list_id", "a"), filters.withColumnRenamed("list_id", "b")
    shared = left.join(right, "url_filter").filter("a <> b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    return shared.join(sizes, "a").select("a", "b", "shared", "size", F.bround(100.0 * F.col("shared") / F.col("size")).cast("int").alias("pct"))


def coverage(filters: DataFrame, order: DataFrame | None = None, threshold: int = 50, most: int = 3) -> DataFrame:
    """The most covering lists of each list, from ``threshold`` per cent; ties in the order of the catalogue (list_id, pos)."""
    rows = pairs(filters).filter(F.col("pct") >= threshold)
    rows = rows.join(order.select(F.col("list_id").alias("b"), "pos"), "b", "left") if order is not None else rows.withColumn("pos", F.lit(0))
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc("pct"), "pos", "b"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= most).select("a", "b", "shared", "size", "pct", "rank")


def annotate(catalogue: DataFrame, covered: DataFrame) -> DataFrame:
    """The catalogue with ``covered_by`` (best first), null where nothing covers a list."""
    own = covered.groupBy(F.col("a").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col("b").alias("id"), "pct"))), lambda x: F.struct(x["id"].alias("id"), x["pct"].alias("pct"))).alias("covered_by"))
    return catalogue.drop("covered_by").join(own, "id", "left")
