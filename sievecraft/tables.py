"""Tables in the folder that all executors see: written once, read as often as needed, deleted when nothing reads them.

A written table cuts the lineage (a lost executor costs a re-read, not a re-run), keeps columns
prunable, and gives the planner a short plan.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables that nobody has deleted yet, oldest first.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: the session's checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset and
    everything runs on one machine, as in tests, a temporary folder is made and set.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="sievecraft-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialise(df: DataFrame, name: str, partition_by: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder, in one folder for each value of ``partition_by``, and read it back."""
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.options(**{"compression": "zstd"} | options).parquet(path, partitionBy=partition_by)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more."""
    for t in tables:
        if t._written_at in _written:
            _written.remove(t._written_at)
            delete(t.sparkSession, t._written_at)


def written() -> list[str]:
    """The tables that nobody has deleted yet, oldest first."""
    return list(_written)


def sweep(spark: SparkSession, paths: list[str]) -> None:
    """Delete those of the tables that still stand, once no result that is still wanted reads them."""
    for path in {*paths} & {*_written}:
        _written.remove(path)
        delete(spark, path)
