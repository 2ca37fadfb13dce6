"""Rule lists, requests and catalogues made from the driver's tables by expressions that both engines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
LIST = "coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1), ''), 'xx')"

#: A line of a list for each page; the same text is SQL for both engines.
LINE = """CASE page_id % 12
 WHEN 0 THEN '||' || host || '^'
 WHEN 1 THEN '||' || host || '^$script,third-party'
 WHEN 2 THEN host || '##.ad-' || CAST(page_id % 7 AS VARCHAR(9))
 WHEN 3 THEN '! comment ' || host
 WHEN 4 THEN '##.box' || CAST(page_id % 5 AS VARCHAR(9))
 WHEN 5 THEN '@@||' || host || '^$generichide'
 WHEN 6 THEN '||' || host || '/img/$image,domain=site' || CAST(page_id % 3 AS VARCHAR(9)) || '.org'
 WHEN 7 THEN '||' || host || '^$badfilter'
 WHEN 8 THEN host || '#@#.ad-' || CAST(page_id % 7 AS VARCHAR(9))
 WHEN 9 THEN '@@||' || host || '/ok^$script'
 WHEN 10 THEN '||' || host || '^$csp=x'
 ELSE '||' || host || '^$unheard' END"""

PAGES = f"SELECT page_id, url, {HOST} AS host, {LIST} AS list_id FROM pages"
LINES = f"SELECT list_id, page_id AS line_no, host, page_id % 12 AS k, {LINE} AS raw FROM ({PAGES}) p"

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run SQL over the tables of a folder that it names."""
    args = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"FROM {t}" in text or f"JOIN {t}" in text}
    for t in args:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **args)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(list_id, line_no, raw)."""
    return sql(spark, sf_dir, spark_text(LINES)).select("list_id", "line_no", "raw")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, spark_text(PAGES))


def spark_text(text: str) -> str:
    """The same SQL for Spark, whose braces and casts differ."""
    return text.replace("VARCHAR(9)", "STRING")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as requests: scripts of third parties on a page of the same host."""
    rows = pages(spark, sf_dir)
    return rows.select(
        F.col("page_id").alias("req_id"), "url", F.lit("script").alias("type"), F.lit("third-party").alias("party"), F.lit("child-frame").alias("context"), F.lit("get").alias("method"),
        F.concat(F.lit("https://"), "host", F.lit("/")).alias("top_url"), F.concat(F.lit("https://"), "host", F.lit("/frame")).alias("frame_url"),
    )
