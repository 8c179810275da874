"""Vector functions over array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine over the common length; 0 where a vector is zero."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def mean_vector(df: DataFrame, keys: list[str], vector: str, name: str = "centroid") -> DataFrame:
    """Mean of the vectors of each group. Partial sums are combined before the shuffle, whatever a group's size."""
    placed = df.select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("_at", "_x"))
    means = placed.groupBy(*keys, "_at").agg(F.avg("_x").alias("_m"))
    return means.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_m"))), lambda s: s["_m"]).alias(name))
