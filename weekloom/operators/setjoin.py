"""Pairs of sets by their overlap, found by their rarest items.

Two sets whose Jaccard share is t or more have an item in common among the first n - ceil(t * n) + 1 of each, when items are
ordered by how rarely they occur; so only those few items are joined, and a common item joins nothing unless all of a set's
items are common. Candidates of unfit sizes are left out before their sets are compared. No pair is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import text
from weekloom.session import stored


def ranked(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, id, n, items: sets with their items from rare to frequent, ties by the item."""
    each = rows.select(*keys, "id", F.explode(F.array_distinct("items")).alias("item")).join(counts, [*keys, "item"])
    return each.groupBy(*keys, "id").agg(F.count("*").cast("int").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("held", "item"))), lambda s: s["item"]).alias("items"))


def prepared(a: DataFrame, b: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables of sets (keys, id, items), stored with their items in one order of rarity. Empty sets have no pair."""
    both = a.select(*keys, "items").unionByName(b.select(*keys, "items"))
    counts = stored(both.select(*keys, F.explode(F.array_distinct("items")).alias("item")).where("item IS NOT NULL").groupBy(*keys, "item").agg(F.count("*").alias("held")), "items")
    return stored(ranked(a, counts, keys), "sets"), stored(ranked(b, counts, keys), "sets")


def _pairs(a: DataFrame, b: DataFrame, keys: list[str], least: float) -> DataFrame:
    first = F.col("n") - F.greatest(F.ceil(F.col("n") * least - 1e-9), F.lit(1)) + 1
    cut = lambda rows, own, size: rows.select(*keys, F.col("id").alias(own), F.col("n").alias(size), F.explode(F.slice("items", 1, first.cast("int"))).alias("item"))
    fit = (F.col("_m") >= F.col("_n") * least - 1e-9) & (F.col("_n") >= F.col("_m") * least - 1e-9)
    near = cut(a, "a", "_n").join(cut(b, "b", "_m"), [*keys, "item"]).where(fit).select(*keys, "a", "b").distinct()
    sets = near.join(a.select(*keys, F.col("id").alias("a"), F.col("items").alias("_x")), [*keys, "a"]).join(b.select(*keys, F.col("id").alias("b"), F.col("items").alias("_y")), [*keys, "b"])
    return sets.select(*keys, "a", "b", text.jaccard(F.col("_x"), F.col("_y")).alias("jaccard")).where(F.col("jaccard") >= least - 1e-9)


def similar_sets(a: DataFrame, b: DataFrame, least: float, keys: list[str] | None = None) -> DataFrame:
    """(keys, a, b, jaccard) of all pairs of the same keys with a share of `least` or more, which is above 0."""
    keys = keys or []
    return _pairs(*prepared(a, b, keys), keys, least)


def best_match(a: DataFrame, b: DataFrame, steps: tuple[float, ...] = (0.75, 0.4, 0.0)) -> DataFrame:
    """(a, b, jaccard): for each set of a the nearest one of b, ties to the smaller id; sets that share nothing have none.

    Falling bounds: who has a match at one bound has its best one, so only the rest goes on to the next, whose longer
    prefixes are dearer. The last bound is any shared item.
    """
    left, there = prepared(a, b, [])
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc(F.round("jaccard", 9)), "b"))
    out = None
    for k, least in enumerate(steps):
        found = stored(_pairs(left, there, [], least).withColumn("_r", rank).where("_r = 1").drop("_r"), "matches")
        out = found if out is None else out.unionByName(found)
        if k + 1 < len(steps):
            left = stored(left.join(found.select(F.col("a").alias("id")), "id", "left_anti"), "left")
            if not left.limit(1).count():
                break
    return out
