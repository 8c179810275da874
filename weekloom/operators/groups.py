"""Groups of a week's keywords that mean the same, their scores, and the slots that they keep from week to week.

features: week, node (a long, distinct), keyword, z, count, ctx (mean score of its contexts), v (its vector).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import vectors
from weekloom.operators import graph, similar
from weekloom.session import stored

#: Least cosine within a group, groups of a week, least cosine to last week's group, weights of the score.
TOGETHER, PER_WEEK, LINKED = 0.72, 5, 0.75
WEIGHTS = {"z_sum": 1.0, "count_log": 1.2, "ctx_mean": 1.0, "cohesion": 1.0}


def grouped(features: DataFrame, least: float = TOGETHER) -> DataFrame:
    """features with component, the smallest node that a keyword is linked to by cosines of `least` or more in its week."""
    found = graph.components(features.select("node"), similar.links_within(features, ["week"], "node", "v", least))
    return features.join(found, "node")


def scored(members: DataFrame, per_week: int = PER_WEEK, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """The best groups of each week: week, component, rank, keywords (highest z first), the parts of the score, centroid.

    members: as from grouped(). What is scored: the positive z, the root of the counts, contexts, and how close members are.
    """
    sums = members.groupBy("week", "component").agg(
        F.sum(F.greatest(F.col("z"), F.lit(0.0))).alias("sum_z"), F.sum("count").cast("long").alias("sum_count"), F.avg("ctx").alias("mean_ctx"),
        F.transform(F.sort_array(F.collect_list(F.struct((-F.round("z", 9)).alias("z"), "keyword"))), lambda s: s["keyword"]).alias("keywords"),
    )
    close = similar.cohesion(members, ["week", "component"], "v").drop("n")
    rows = sums.join(close, ["week", "component"]).join(vectors.mean_vector(members, ["week", "component"], "v"), ["week", "component"])
    score = weights["z_sum"] * F.col("sum_z") + weights["count_log"] * F.sqrt(F.col("sum_count") + 1) + weights["ctx_mean"] * F.col("mean_ctx") + weights["cohesion"] * F.col("cohesion")
    rank = F.row_number().over(Window.partitionBy("week").orderBy(F.desc(F.round("score", 9)), "component"))
    return rows.withColumn("score", score).withColumn("rank", rank).where(F.col("rank") <= per_week)


def linked(groups: DataFrame, least: float = LINKED) -> DataFrame:
    """groups with nr (of the week among those that have any) and prev, prev_sim: last week's nearest group, if near enough.

    Several groups may go on from one. Groups of neighbouring weeks meet by the week's number, a few of each.
    """
    weeks = stored(groups.select("week").distinct().select("week", F.row_number().over(Window.orderBy("week")).alias("nr")), "weeks")
    rows = stored(groups.join(F.broadcast(weeks), "week"), "groups")
    was = rows.select((F.col("nr") + 1).alias("nr"), F.col("component").alias("prev"), F.col("rank").alias("_rank"), F.col("centroid").alias("_c"))
    pairs = rows.select("nr", "component", "centroid").join(was, "nr").withColumn("sim", vectors.cosine(F.col("centroid"), F.col("_c")))
    best = pairs.groupBy("component").agg(F.max_by(F.struct("prev", "sim"), F.struct(F.round("sim", 9), -F.col("_rank"))).alias("b")).where(F.col("b.sim") >= least)
    return rows.join(best.select("component", "b.prev", F.col("b.sim").alias("prev_sim")), "component", "left")


def slotted(groups: DataFrame) -> DataFrame:
    """groups with slot_id: that of the group they go on from, or a new one, numbered by week and rank.

    groups: as from linked(). Pointer doubling: every group points at the one before it, then at that one's, so chains of n
    weeks need log n joins.
    """
    at = stored(groups.select("component", F.coalesce("prev", "component").alias("up")), "pointers")
    while True:
        onward = at.select(F.col("component").alias("up"), F.col("up").alias("root"))
        step = stored(at.join(onward, "up").select("component", F.col("root").alias("up"), (F.col("up") != F.col("root")).alias("moved")), "pointers")
        at = step.select("component", "up")
        if not step.where("moved").limit(1).count():
            break
    new = groups.where("prev IS NULL").select("component", "nr", "rank")
    start = F.coalesce(F.sum("n").over(Window.orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = new.groupBy("nr").agg(F.count("*").alias("n")).select("nr", start.alias("start"))  # a row for each week
    within = F.row_number().over(Window.partitionBy("nr").orderBy("rank"))
    ids = new.withColumn("within", within).join(F.broadcast(starts), "nr").select(F.col("component").alias("up"), F.format_string("trendgrp_%06d", F.col("start") + F.col("within")).alias("slot_id"))
    return groups.join(at, "component").join(ids, "up").drop("up")
