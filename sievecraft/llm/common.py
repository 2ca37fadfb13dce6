"""What the operators of this subpackage share: text rules, the shared folder and row keys.

Two token rules are used throughout.  *Words* are runs of ASCII letters, digits
and non-ASCII characters after lower-casing A-Z only; *tokens* are runs of
anything but ASCII white space.  On UTF-8 bytes both rules are byte rules, so
the Python operators work on ``bytes`` and the native ones on Java patterns.
"""

from __future__ import annotations

import ctypes
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.tables import delete, discard, materialise, shared_folder, sweep, written

__all__ = ["delete", "discard", "materialise", "shared_folder", "sweep", "written"]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = b" \t\n\r\x0b\x0c"


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes the empty text."""
    return F.translate(F.coalesce(col, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deal(df: DataFrame, parts: int, by: str | Column) -> DataFrame:
    """Rows by a number that already spreads them: the number itself tells the partition, so partitions are even."""
    return df.repartitionById(parts, F.pmod(F.col(by) if isinstance(by, str) else by, F.lit(parts)).cast("int"))


#: Bits of the filter of ``maybe_in``, as a power of two: its table has at most 2**19 rows.
FILTER_BITS = 25


def maybe_in(rows: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """``rows`` and whether their key may be in ``keys``: ``maybe`` is true for all that are, and for few others.

    A bitmap of hashes, one bit each, in words of 64 bits.  It is broadcast, 2**19 rows at any size of either
    table.  Where ``keys`` fill it, more rows pass, so whoever joins what passes gets the same result.
    """
    place = F.pmod(F.xxhash64(*columns, F.lit(FILTER_BITS)), F.lit(1 << FILTER_BITS))
    mask = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    words = keys.select(place.alias("_place")).select(F.shiftright("_place", 6).alias("_word"), mask.alias("_mask"))
    words = words.groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    placed = rows.withColumn("_place", place).withColumn("_word", F.shiftright("_place", 6))
    hit = F.coalesce(F.col("_bits").bitwiseAND(mask) != 0, F.lit(False))
    return placed.join(F.broadcast(words), "_word", "left").withColumn("maybe", hit).drop("_word", "_place", "_bits")


def row_key(id_col: str, text_col: str) -> dict[str, Column]:
    """128 bits that name a row by its id and text, for ids of any type and nulls in either."""
    return {"k1": F.xxhash64(id_col, F.lit(1)), "k2": F.xxhash64(text_col, F.lit(2), id_col)}


#: Rows of a batch between the engine and Python, below the bytes that the engine itself allows one (64 MB unless set otherwise).
BATCH_ROWS = 1500


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in smaller batches from now on; results are the same."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def release() -> None:
    """Give memory that a finished task no longer uses back to the system, as workers live on beside the engine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def releasing(function):
    """A function for mapInArrow that releases memory when it ends."""

    def run(batches):
        yield from function(batches)
        release()

    return run


def no_clash(df: DataFrame, *needed: str) -> DataFrame:
    """Only the columns an operator reads, so extra columns can't clash with its own names."""
    return df.select(*[F.col(f"`{c}`") for c in needed])
