"""Average linkage by cosine, within groups of any size.

With unit vectors, the mean distance of two clusters is one less the product of their mean vectors, so clusters are kept as
means and sizes. Two clusters that are each other's nearest merge at once, wherever else there is work to do: linkage of
means can only grow when others merge, so such merges come in any order to what one-by-one linkage gives. Ties (scores that
agree in nine places) go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import vectors
from weekloom.operators import blocked, graph
from weekloom.operators.similar import few, links_within
from weekloom.session import stored

#: So many clusters of a component at most are linked in one task; more of them in rounds, until so many are left.
SMALL = 2500


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def average_linkage(x: np.ndarray, threshold: float, weights: np.ndarray | None = None) -> np.ndarray:
    """Labels of agglomerative clustering by mean cosine distance, merged while the nearest two are below the threshold.

    weights: how many equal rows each row stands for; larger clusters have smaller labels.
    """
    return linked(unit_rows(x), threshold, np.ones(len(x)) if weights is None else weights)


def linked(means: np.ndarray, threshold: float, weights: np.ndarray) -> np.ndarray:
    """The same for clusters: rows are means of unit vectors, weights how many vectors each one has."""
    n = len(means)
    size = np.array(weights, float)
    far = means @ means.T
    np.subtract(1, far, out=far)
    np.fill_diagonal(far, np.inf)
    members = {k: [k] for k in range(n)}
    nearest, least = far.argmin(axis=1), far.min(axis=1)
    while len(members) > 1:
        a = int(np.argmin(least))
        b = int(np.argmin(far[a]))
        if far[a, b] >= threshold:
            break
        far[a] = far[:, a] = (size[a] * far[a] + size[b] * far[b]) / (size[a] + size[b])
        far[a, a] = np.inf
        far[b], far[:, b] = np.inf, np.inf
        size[a] += size[b]
        members[a] += members.pop(b)
        # A mean of two distances is no less than the smaller one, so only rows that were nearest to these two change.
        stale = np.flatnonzero((nearest == a) | (nearest == b) | (np.arange(n) == a) | (np.arange(n) == b))
        nearest[stale], least[stale] = far[stale].argmin(axis=1), far[stale].min(axis=1)
    labels = np.zeros(n, int)
    for k, (_, rows) in enumerate(sorted(members.items(), key=lambda m: (-size[m[0]], min(m[1])))):
        labels[rows] = k
    return labels


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a @ b.T


def in_rounds(rows: DataFrame, threshold: float, block: int = blocked.BLOCK, small: int = 0) -> DataFrame:
    """(node, first): the smallest node of each node's cluster. rows: group, node (long), v, n (how many rows it stands for).

    Each round finds every cluster's nearest other one of its group in blocks, and merges the pairs that chose each other.
    A cluster without another one below the threshold never gets one, so it takes no part in later rounds. A group of up to
    `small` clusters is linked to its end in one task: what has merged by then would have merged there as well.
    """

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        label = linked(np.stack(group["v"].to_numpy()), threshold, group["n"].to_numpy())
        return pd.DataFrame({"was": group["id"], "to": group["id"].groupby(label).transform("min")}).query("was != to")

    def led(goes: DataFrame) -> DataFrame:
        return stored(homes.join(goes, F.col("first") == F.col("was"), "left").select("node", F.coalesce("to", "first").alias("first")), "homes")

    size = vectors.norm(F.col("v"))
    unit = F.transform(F.col("v").cast("array<double>"), lambda x: x / F.greatest(F.col("_size"), F.lit(1e-12)))
    open_ = stored(rows.withColumn("_size", size).select("group", F.col("node").alias("id"), unit.alias("v"), F.col("n").cast("double").alias("n")), "clusters")
    homes = stored(rows.select("node", F.col("node").alias("first")), "homes")
    while True:
        counted = open_.join(few(open_.groupBy("group").agg(F.count("*").alias("_many"))), "group")
        done = counted.where(F.col("_many") <= small)
        if done.limit(1).count():
            homes = led(done.groupBy("group").applyInPandas(finish, "was long, to long"))
            open_ = stored(counted.where(F.col("_many") > small).drop("_many"), "clusters")
            if not open_.limit(1).count():
                return homes
        near = blocked.nearest(open_, open_, ["group"], "v", 1, inner, block=block).where(F.round(F.col("score"), blocked.PLACES) > 1 - threshold)
        near = stored(near.select("query_id", "id"), "near")
        other = near.select(F.col("id").alias("query_id"), F.col("query_id").alias("id"))
        pairs = stored(near.join(other, ["query_id", "id"]).where("query_id < id"), "pairs")
        if not pairs.limit(1).count():
            return homes
        goes = pairs.select(F.col("id").alias("was"), F.col("query_id").alias("to"))
        homes = led(goes)
        live = open_.join(near.select(F.col("query_id").alias("id")), "id", "left_semi")
        moved = live.join(goes, F.col("id") == F.col("was"))
        kept = live.join(goes.select(F.col("was").alias("id")), "id", "left_anti")
        came = moved.select(F.col("to").alias("id"), F.col("v").alias("_v"), F.col("n").alias("_n"))
        whole = F.col("n") + F.coalesce("_n", F.lit(0.0))
        mean = F.when(F.col("_v").isNull(), F.col("v")).otherwise(F.zip_with("v", "_v", lambda x, y: (x * F.col("n") + y * F.col("_n")) / (F.col("n") + F.col("_n"))))
        open_ = stored(kept.join(came, "id", "left").select("group", "id", mean.alias("v"), whole.alias("n")), "clusters")


def split_senses(df: DataFrame, keys: list[str], id_col: str, vector: str, threshold: float = 0.45, block: int = 1024, small: int = SMALL) -> DataFrame:
    """The sense of each context of a keyword: average linkage, the largest sense first. Ids are distinct longs.

    Equal vectors of a keyword are one weighted vector. Two clusters never merge unless some pair of their vectors is
    below the threshold, so linkage runs within components of such pairs. These are found between blocks of about
    `block` vectors; a component of up to `small` distinct vectors is then one task, and a larger one goes in rounds.
    """
    rows = df.select(*keys, F.col(id_col).cast("long").alias("_id"), F.col(vector).alias("_v"))
    distinct = stored(rows.groupBy(*keys, "_v").agg(F.min("_id").alias("node"), F.count("*").alias("n")), "distinct")
    parts = graph.components(distinct.select("node"), links_within(distinct, keys, "node", "_v", 1 - threshold - 1e-9, block))
    placed = stored(distinct.join(parts, "node").withColumn("_many", F.count("*").over(Window.partitionBy("component"))), "components")

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        label = average_linkage(np.stack(group["_v"].to_numpy()), threshold, group["n"].to_numpy())
        return group[["node"]].assign(first=group["node"].groupby(label).transform("min"))

    few_rows = placed.where(F.col("_many") <= small).groupBy("component").applyInPandas(cluster, "node long, first long")
    large = placed.where(F.col("_many") > small).select(F.col("component").alias("group"), "node", F.col("_v").alias("v"), "n")
    firsts = few_rows.unionByName(in_rounds(large, threshold, block, small)) if large.limit(1).count() else few_rows
    clustered = stored(distinct.join(firsts, "node"), "senses")
    nr = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("size"), "first"))
    ranked = clustered.groupBy(*keys, "first").agg(F.sum("n").alias("size")).withColumn("sense_id", nr - 1).drop("size")
    sense = clustered.join(few(ranked), [*keys, "first"]).select(*keys, "_v", "sense_id")
    return rows.join(sense, [*keys, "_v"]).select(*keys, F.col("_id").alias(id_col), "sense_id")
