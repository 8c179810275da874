"""Exact percentiles of groups of any size, in bounded memory: selection by histograms that get finer.

Every rank that is asked for has an interval that holds its value. A pass over the rows counts the values within it in BINS
bins, and the bin of the rank, with the least and largest value that occurs there, is the next interval; equal values end it.
Counts are combined before they are shuffled, so a group is never in one place, and a double is found within a few passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.similar import few
from weekloom.session import stored

BINS = 1024


def percentiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float], bins: int = BINS) -> DataFrame:
    """keys and a column for each point (0 to 1), interpolated between the two nearest ranks. Nulls and no numbers don't count."""
    rows = stored(df.select(*keys, F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)"), "values")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    rank = lambda p, up: (F.ceil if up else F.floor)((F.col("n") - 1) * F.lit(p)).cast("long")
    every = F.array_distinct(F.array(*(rank(p, up) for p in points.values() for up in (False, True))))
    left = stored(sizes.select(*keys, F.explode(every).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below")), "ranks")
    done = left.where("lo = hi")
    left = left.where("lo < hi")
    while left.limit(1).count():
        inside = rows.join(few(left), keys) if keys else rows.crossJoin(few(left))  # a few rows where there are no keys
        inside = inside.where("v BETWEEN lo AND hi")
        # Halves keep a range that is wider than a double from being infinite.
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        at = F.when(F.col("v") >= F.col("hi"), bins - 1).otherwise(F.least(F.floor(share * bins), F.lit(bins - 2)))
        counted = inside.groupBy(*keys, "rank", "below", at.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(*keys, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("below")
        own = counted.withColumn("_before", before).where("_before <= rank AND rank < _before + n")
        step = stored(own.select(*keys, "rank", "lo", "hi", F.col("_before").alias("below")), "ranks")
        done, left = done.unionByName(step.where("lo = hi")), step.where("lo < hi")
    found = stored(done.select(*keys, "rank", F.col("lo").alias("x")), "found")
    whole = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("m"))  # two for each point
    joined = sizes.join(whole, keys) if keys else sizes.crossJoin(whole)

    def point(p: float):
        low, high = F.element_at("m", rank(p, False)), F.element_at("m", rank(p, True))
        return low + (high - low) * ((F.col("n") - 1) * F.lit(p) - rank(p, False))

    return joined.select(*keys, *(point(p).alias(name) for name, p in points.items()))
