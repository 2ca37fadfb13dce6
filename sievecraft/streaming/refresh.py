"""Lists as a stream of files: each new or changed text is compiled once, results are upserted by list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievecraft.operators.compile import compile_lists
from sievecraft.operators.output import report
from sievecraft.profile import Profile
from sievecraft.sources.lists import split_lines


def list_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(list_id, content, modified) of the ``.txt`` files that come into a folder."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.txt").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("list_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"), F.col("modificationTime").alias("modified"))


def refresh(spark: SparkSession, folder: str, out: str, checkpoint: str, profile: Profile | None = None, done: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Compile what is there and new, then stop.  Each batch writes its reports under its own number, so a batch that is run again replaces itself."""

    def batch(texts: DataFrame, number: int) -> None:
        latest = texts.groupBy("list_id").agg(F.max_by("content", "modified").alias("content"))
        made = compile_lists(split_lines(latest), profile)
        reports = report(made, profile).persist()
        try:
            reports.write.mode("overwrite").parquet(f"{out}/batch={number}")
            if done is not None:
                done(reports)
        finally:
            reports.unpersist()
            made.release()

    return list_stream(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
