"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.  Native.

A document's size is its number of tokens.  Sources, ordered by code point with
null last, carry the given weights in turn.  All sources together are to give
``share`` of all tokens: source ``i`` gets ``min(epochs * size_i, level *
weight_i)``, where the level is the one at which the targets sum to the whole.
Clamping at the cap and resharing the excess by weight until no source is above
ends at that level; it is found in one pass over the sources ordered by
``epochs * size / weight``, the order in which they hit their caps.

A source whose target is ``e`` times its size gives every document ``floor(e)``
times.  For the fractional rest, its documents stand in the order of a seeded
hash, and those before the cut are taken once more; the document at the cut gives
just the words that are still missing.  So a source's words are its target
rounded down, and a rerun takes the same words.  The cut is found in sums over
16 ** ``DIGITS`` hash ranges per source, so no source is ever in one task; only
the one range that holds the cut is put in order.

Defined cases: a null text has size 0 and is never taken; a source without words
has target 0; repeated rows are documents of their own; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.llm.common import TOKEN, materialise, table

WEIGHTS, EPOCHS, SHARE, SEED = (5.0, 2.0, 1.0), 3.0, 1.0, 42
#: Hex digits of the hash that make a range: 4,096 ranges a source.
DIGITS = 3


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def order_of(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def water_fill(sources: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, share: float = SHARE) -> DataFrame:
    """Adds ``weight`` and ``target`` to (source, source_size); one row a source, so windows over all are small."""
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    cap = epochs * F.col("source_size")
    by_cap = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.partitionBy(F.lit(1))
    capped = weighted.select(
        "*", cap.alias("cap"), F.sum(cap).over(by_cap).alias("caps"), F.sum("weight").over(by_cap).alias("weights"),
        F.sum("weight").over(everything).alias("weight_all"), (share * F.sum("source_size").over(everything)).alias("whole"),
    )
    # The level if exactly the sources before this one were capped; the first that stays below its cap has the true level.
    level = (F.col("whole") - (F.col("caps") - F.col("cap"))) / (F.col("weight_all") - (F.col("weights") - F.col("weight")))
    fits = F.when(level * F.col("weight") <= F.col("cap"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", level.alias("level")))
    leveled = capped.withColumn("level", F.min(fits).over(everything)["level"])
    return leveled.select("source", "source_size", "weight", F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def mix(sized: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, share: float = SHARE, seed: int = SEED, digits: int = DIGITS) -> DataFrame:
    """Adds source_size, target and taken to rows that have doc_id, source and size; other columns stay."""
    rows = sized.withColumn("_h", order_of(F.col("doc_id"), seed)).withColumn("_range", F.substring("_h", 1, digits))
    ranges = rows.groupBy("source", "_range").agg(F.sum("size").alias("_in"))
    plan = water_fill(ranges.groupBy("source").agg(F.sum("_in").alias("source_size")), weights, epochs, share)
    # (source, whole, rest): floor(e) and the words beyond the whole repetitions
    plan = plan.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("_rest", (F.floor("target") - F.col("_whole") * F.col("source_size")).cast("long"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    up_to = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranges = ranges.withColumn("_before", F.sum("_in").over(up_to) - F.col("_in"))
    ranges = ranges.join(plan, same(ranges, plan)).select(ranges["*"], *[c for c in plan.columns if c not in ("source", "weight")])
    # Rows meet their plan by source and range, so no source is in one task.
    both = same(rows, ranges) & (rows["_range"] == ranges["_range"])
    joined = rows.join(ranges, both).select(rows["*"], *[c for c in ranges.columns if c not in ("source", "_range")])
    # Rows of the range with the cut stand in order; for all others the range decides.
    at_cut = (F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_in"))
    place = W.partitionBy("source", "_range").orderBy("_h", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    left = F.col("_rest") - F.col("_before") - (F.sum("size").over(place) - F.col("size"))
    inside = joined.filter(at_cut).withColumn("_more", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    outside = joined.filter(~at_cut).withColumn("_more", F.when(F.col("_before") < F.col("_rest"), F.col("size")).otherwise(F.lit(0)))
    taken = (F.col("_whole") * F.col("size") + F.col("_more")).cast("long")
    return inside.unionByName(outside).withColumn("taken", taken).select(*sized.columns, "source_size", "target", "taken")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", size_of(F.col("text")).alias("size"))
    return mix(materialise(docs, "mixing")).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) AS BIGINT) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
c AS (SELECT *, source_size / weight AS ratio, sum(cap) OVER o AS caps, sum(weight) OVER o AS weights, sum(weight) OVER () AS weight_all, sum(source_size) OVER () AS whole
    FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, (whole - (caps - cap)) / (weight_all - (weights - weight)) AS level FROM c),
f AS (SELECT level AS found FROM l WHERE level * weight <= cap ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(cap, (SELECT found FROM f) * weight), cap) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
q AS (SELECT d.doc_id, d.size, r.source_size, r.target, r.times, CAST(floor(r.target) AS BIGINT) - r.times * r.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, CAST(times * size + greatest(0, least(size, rest - ahead)) AS BIGINT) AS taken FROM q
"""

QUERIES = {"op3_mix_sources": op3_mix_sources}
ORACLES = {"op3_mix_sources": SQL}
