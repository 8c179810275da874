"""Vector groups: centroids, cohesion, nearest centroids, exact search and trimming."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions import vectors
from weekloom.session import stored


def cohesion(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Mean cosine of all pairs of a group, from the length of the sum of its unit vectors: no pair is ever made."""
    unit = df.withColumn("_n", vectors.norm(F.col(vector))).where("_n > 0").select(*keys, F.posexplode(F.transform(F.col(vector).cast("array<double>"), lambda x: x / F.col("_n"))).alias("_at", "_x"))
    sums = unit.groupBy(*keys, "_at").agg(F.sum("_x").alias("_s"), F.count("*").alias("n"))
    whole = sums.groupBy(*keys).agg(F.sum(F.col("_s") * F.col("_s")).alias("q"), F.max("n").alias("n"))
    return whole.select(*keys, "n", F.when(F.col("n") > 1, (F.col("q") - F.col("n")) / (F.col("n") * (F.col("n") - 1))).otherwise(1.0).alias("cohesion"))


#: So many rows of centroids are broadcast at most; more of them are joined by a shuffle.
FEW = 10_000


def few(df: DataFrame) -> DataFrame:
    """df marked for a broadcast if a count shows that it is small, which a table of classes is."""
    df = stored(df, "few")
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def to_centroids(df: DataFrame, centroids: DataFrame, vector: str, name: str) -> DataFrame:
    """df with its best and second-best of some named centroids and the margin between them. centroids: name, centroid.

    A row meets every centroid, as the classifier asks: up to FEW of them come as one broadcast array, so nothing is
    shuffled. More of them are a table that rows search in blocks.
    """
    centroids = stored(centroids, "centroids")
    if centroids.limit(FEW + 1).count() > FEW:
        return _to_many(df, centroids, vector, name)
    every = centroids.agg(F.collect_list(F.struct(F.col(name).alias("name"), "centroid")).alias("_all"))
    sims = F.transform("_all", lambda c: F.struct((-vectors.cosine(F.col(vector), c["centroid"])).alias("o"), c["name"].alias("name")))
    best = df.crossJoin(F.broadcast(every)).withColumn("b", F.slice(F.array_sort(sims), 1, 2))
    first, second = F.try_element_at("b", F.lit(1)), F.try_element_at("b", F.lit(2))
    return best.select(*(c for c in df.columns if c != vector), first["name"].alias("best"), (-first["o"]).alias("sim"), second["name"].alias("runner_up"), (second["o"] - first["o"]).alias("margin"))


def _to_many(df: DataFrame, centroids: DataFrame, vector: str, name: str) -> DataFrame:
    """The same for any number of centroids: the two nearest by an exact search in blocks. Rows without a vector have none."""
    from weekloom.operators import blocked

    place = F.monotonically_increasing_id()
    order = stored(centroids.select(F.col(name).alias("name"), "centroid").withColumn("id", -1 - place), "named")  # never an id of a row
    rows = stored(df.withColumn("_row", place), "rows")
    near = blocked.nearest(order.select("id", F.col("centroid").alias(vector)), rows.select(F.col("_row").alias("id"), vector), [], vector, 2)
    pairs = near.join(order.select("id", "name"), "id").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "name", "score"))).alias("b"))
    first, second = F.try_element_at("b", F.lit(1)), F.try_element_at("b", F.lit(2))
    found = rows.join(pairs, F.col("_row") == F.col("query_id"), "left")
    return found.select(*(c for c in df.columns if c != vector), first["name"].alias("best"), first["score"].alias("sim"), second["name"].alias("runner_up"), (first["score"] - second["score"]).alias("margin"))


def links_within(df: DataFrame, keys: list[str], node: str, vector: str, least: float, block: int = 512) -> DataFrame:
    """(a, b): links between rows of a group whose cosine is `least` or more, as many as their components need.

    Rows of a group are dealt by a hash into blocks; two blocks meet in one task, which multiplies two small matrices and
    names each row's links by the first row of its component there. No pair of rows is ever a row of a table, and no task
    holds more than two blocks.
    """
    kind = df.schema[node].dataType.simpleString()
    rows = df.select(*keys, F.col(node).alias("node"), F.col(vector).cast("array<double>").alias("v"))
    blocks = F.ceil(F.count("*") / block).alias("blocks")
    dealt = rows.join(few(rows.groupBy(*keys).agg(blocks)), keys) if keys else rows.withColumn("blocks", F.lit(rows.agg(blocks).first()[0]).cast("long"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(*keys, "node", "v", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        x = np.stack(group["v"].to_numpy())
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        near, first = x @ x.T >= least, np.full(len(x), -1)
        for k in range(len(x)):
            if first[k] < 0:
                front = np.array([k])
                while len(front):
                    first[front] = k
                    front = np.flatnonzero(near[front].any(axis=0) & (first < 0))
        name = group["node"].to_numpy()
        return pd.DataFrame({"a": name, "b": name[first]})

    return dealt.groupBy(*keys, "lo", "hi").applyInPandas(link, f"a {kind}, b {kind}").where("a <> b")


def links_above(df: DataFrame, node: str, vector: str, least: float, block: int = 512) -> DataFrame:
    """The same for all rows as one group."""
    return links_within(df, [], node, vector, least, block)
