"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code holds one bit per component (set where it is above zero), packed
into 64-bit words.  Codes are cut into 16-bit segments with one table each.  If
no segment differs in more than ``s`` bits from the query's, everything within
Hamming distance ``m * (s + 1) - 1`` of the query has been met (``m`` segments:
by the pigeonhole principle one of them differs in at most ``s`` bits).  So the
segments' radius grows until the k-th verified distance lies within that bound;
all ties at that distance are then known too, and go by the smaller id.

The index is dealt over shards of at most ``SHARD_ROWS`` rows; each shard builds
its tables over its *distinct* codes (a code keeps only its smallest k + 1 ids:
no other of its rows can be among the k nearest) and answers every query exactly
for its rows.  The shards' answers, at most k + 1 a query and shard, are then merged.
Queries are sent to the shards in blocks of at most ``QUERY_BLOCK`` distinct codes,
one pass over the shards per block, so what is broadcast has a fixed bound.

Defined cases: a row with a null vector or a null id, which no answer could name, is neither indexed nor asked; null
and NaN components give 0 bits, shorter vectors are padded with 0 bits; a row is not its
own neighbour, but another row of the same id is; ties go by id; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.llm.common import materialise, no_clash, table

K = 10
SHARD_ROWS = 1 << 20
QUERY_BLOCK = 1 << 16
SEGMENT = 16


def code_of(vector: Column, words: int) -> Column:
    """The code as ``words`` longs, most significant bit first."""
    bits = F.array_join(F.transform(vector, lambda x: F.when(F.coalesce(x, F.lit(0.0)) > 0, F.when(F.isnan(x), "0").otherwise("1")).otherwise("0")), "")
    padded = F.rpad(bits, 64 * words, "0")
    half = lambda i: F.conv(F.substring(padded, 32 * i + 1, 32), 2, 10).cast("long")
    return F.array(*[F.shiftleft(half(2 * i), 32).bitwiseOR(half(2 * i + 1)) for i in range(words)])


def _segments(codes: np.ndarray) -> np.ndarray:
    return codes.view(np.uint16).reshape(len(codes), -1)


def _masks(weight: int) -> np.ndarray:
    every = np.arange(1 << SEGMENT, dtype=np.uint16)
    return every[np.bitwise_count(every) == weight]


class MultiIndex:
    """Tables over distinct codes: for each segment the rows in order of its value."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.segments = codes, _segments(codes)
        self.order = [np.argsort(col, kind="stable") for col in self.segments.T]
        self.bounds = [np.searchsorted(col[o], np.arange((1 << SEGMENT) + 1)) for col, o in zip(self.segments.T, self.order, strict=True)]
        self.masks: dict[int, np.ndarray] = {}

    def search(self, code: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances that hold the k nearest and all that tie with the k-th; ``weight``: ids that each row stands for."""
        query, m = _segments(code[None])[0], self.segments.shape[1]
        seen = np.zeros(len(self.codes), bool)
        rows, dist = np.empty(0, np.int64), np.empty(0, np.int64)
        for s in range(SEGMENT + 1):
            masks = self.masks.setdefault(s, _masks(s))
            new = []
            for order, bounds, value in zip(self.order, self.bounds, query, strict=True):
                probes = (value ^ masks).astype(np.int64)
                start, n = bounds[probes], bounds[probes + 1] - bounds[probes]
                start, n = start[n > 0], n[n > 0]
                if len(n):
                    at = np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                    new.append(order[at])
            if new:
                found = np.unique(np.concatenate(new))
                found = found[~seen[found]]
                seen[found] = True
                rows = np.concatenate((rows, found))
                dist = np.concatenate((dist, np.bitwise_count(self.codes[found] ^ code).sum(axis=1, dtype=np.int64)))
            by = np.argsort(dist, kind="stable")
            total = np.cumsum(weight[rows[by]])
            if (total >= k).any() and dist[by][np.argmax(total >= k)] <= m * (s + 1) - 1:
                break
        kth = dist[by][np.argmax(total >= k)] if (total >= k).any() else dist.max(initial=0)
        return rows[dist <= kth], dist[dist <= kth]


def _answer(queries: np.ndarray, k: int, words: int):
    """Function for mapInArrow over one shard: for each query code its k + 1 nearest rows, by distance and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, codes = [], []
        for b in batches:
            ids.append(b.column("id").to_numpy(zero_copy_only=False).astype(np.int64))
            codes.append(b.column("code").flatten().to_numpy().reshape(-1, words).view(np.uint64))
        if not ids or not sum(map(len, ids)):
            return
        id_, code = np.concatenate(ids), np.ascontiguousarray(np.concatenate(codes))
        distinct, at = np.unique(code, axis=0, return_inverse=True)
        at = at.reshape(-1)
        order = np.lexsort((id_, at))
        first = np.searchsorted(at[order], np.arange(len(distinct)))
        place = np.arange(len(order)) - first[at[order]]
        kept = order[place <= k]  # the smallest k + 1 ids of each code, still in order of code and id
        starts = np.searchsorted(at[kept], np.arange(len(distinct) + 1))
        weight = np.diff(starts)
        index = MultiIndex(np.ascontiguousarray(distinct))
        for part in range(0, len(queries), 1024):
            out: list[tuple] = []
            for q, code_q in enumerate(queries[part : part + 1024], part):
                rows, dist = index.search(code_q, weight, k + 1)
                own = [(int(d), int(i)) for r, d in zip(rows, dist, strict=True) for i in id_[kept[starts[r] : starts[r + 1]]]]
                out += [(q, i, d) for d, i in sorted(own)[: k + 1]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query", "id", "distance"])

    return run


def top_k(index: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = K, query_block: int = QUERY_BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, neighbour_id, distance, rank) of the k nearest other rows for each row of ``queries``."""
    spark = index.sparkSession
    plain = lambda df: no_clash(df, id_col, vector_col).toDF("id", "vector").filter(F.col("vector").isNotNull() & F.col("id").isNotNull())
    n, longest = plain(index).agg(F.count("*"), F.max(F.size("vector"))).first()
    words = max(1, -(-(longest or 1) // 64))
    coded = materialise(plain(index).select("id", code_of(F.col("vector"), words).alias("code")), "codes")
    asked = materialise(plain(queries).select("id", code_of(F.col("vector"), words).alias("code")), "queries")
    shards = max(min(spark.sparkContext.defaultParallelism, -(-n // 4096)), -(-n // shard_rows), 1)
    dealt = coded.repartition(shards, F.xxhash64("id", F.lit(1)))
    blocks = max(1, -(-asked.count() // (query_block // 2)))  # hashing is uneven: half full on average
    answers, codes = None, None
    for b in range(blocks):
        own = asked.select("code").filter(F.pmod(F.xxhash64("code"), F.lit(blocks)) == b).distinct().toArrow().column("code")
        flat = own.combine_chunks().flatten().to_numpy() if len(own) else np.empty(0, np.int64)
        block = np.ascontiguousarray(flat.reshape(-1, words)).view(np.uint64)
        found = dealt.mapInArrow(_answer(block, k, words), "query long, id long, distance long").select(F.lit(b).alias("block"), "*")
        known = spark.createDataFrame([(b, q, [int(x) for x in c.view(np.int64)]) for q, c in enumerate(block)], "block int, query long, code array<long>")
        answers, codes = (found, known) if answers is None else (answers.unionByName(found), codes.unionByName(known))
    nearest = W.partitionBy("block", "query").orderBy("distance", "id")
    merged = answers.withColumn("r", F.row_number().over(nearest)).filter(F.col("r") <= k + 1).join(codes, ["block", "query"]).select("code", "id", "distance")
    listed = merged.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("distance", F.col("id").alias("neighbour_id")))).alias("near"))
    # Each query takes its code's list without itself (one such entry, if there is one).
    hits = asked.join(listed, "code").select(F.col("id").alias("query_id"), F.posexplode("near").alias("pos", "x"), F.array_position("near", F.struct(F.lit(0).cast("long").alias("distance"), F.col("id").alias("neighbour_id"))).alias("own"))
    hits = hits.filter(F.col("own") != F.col("pos") + 1)
    rank = F.col("pos") + 1 - F.when((F.col("own") > 0) & (F.col("own") <= F.col("pos")), 1).otherwise(0)
    return hits.select("query_id", "x.neighbour_id", "x.distance", rank.cast("long").alias("rank")).filter(F.col("rank") <= k)


def op8_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter("vec_id % 100 = 0"), "vec_id", "embedding")


#: Bits are compared as text here: as many places differ as the Hamming distance says.
SQL = f"""
WITH c AS (SELECT vec_id, row_number() OVER () AS row_no, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN '1' ELSE '0' END), '') AS code FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id, CAST(hamming(q.code, c.code) AS BIGINT) AS distance FROM c AS q JOIN c ON q.row_no <> c.row_no WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM p)
SELECT query_id, neighbour_id, distance, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= {K}
"""

QUERIES = {"op8_hamming_top_k": op8_hamming_top_k}
ORACLES = {"op8_hamming_top_k": SQL}
