"""Stage 1b: clusters of successive weeks linked to threads, and what a thread looks like.

Linking is a walk through the weeks. Up to SMALL clusters (two hundred weeks of a hundred, as a count shows) go through one
task, which holds the open threads under their keywords. More go by joins, week after week: what a week needs of those
before it is a table of open threads, with those that had a member in the last GAP weeks. Within a week all is joins: candidates share a keyword, and clusters and threads that are
each other's best are linked until none is left, which gives what clusters would take one by one, heaviest first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import dates, text, vectors
from weekloom.session import stored

#: Weights of cosine and overlap, least scores and overlaps for the next week and beyond, longest gap.
ALPHA, BETA, NEAR, FAR, GAP, FAR_OVERLAP, NEAR_OVERLAP = 0.15, 0.85, 0.42, 0.47, 30, 0.25, 0.10
REPEATED = 0.88
#: So many clusters at most are linked in one task.
SMALL = 20_000


@dataclass(frozen=True)
class Gates:
    """Weights of cosine and overlap, least scores and overlaps for the next week and beyond, longest gap."""

    alpha: float = ALPHA
    beta: float = BETA
    near: float = NEAR
    far: float = FAR
    near_overlap: float = NEAR_OVERLAP
    far_overlap: float = FAR_OVERLAP
    gap: int = GAP


_STATE = ("seed_week", "seed_cluster", "seed_weight", "n", "last_week", "words", "centroid")


def _candidates(now: DataFrame, state: DataFrame, gates: Gates) -> DataFrame:
    """Edges (cluster_id, weight, seed_week, seed_cluster, seed_weight, n, score, link_type) that pass the gates."""
    ours = now.select("week", "cluster_id", F.explode(F.array_distinct("keywords")).alias("word"))
    theirs = state.select("seed_week", "seed_cluster", F.explode("words").alias("word"))
    shared = ours.join(theirs, "word").groupBy("week", "cluster_id", "seed_week", "seed_cluster").agg(F.count("*").alias("shared"))
    rows = shared.join(now, ["week", "cluster_id"]).join(state.withColumnRenamed("centroid", "_c"), ["seed_week", "seed_cluster"])
    gap = dates.gap_weeks(F.col("week"), F.col("last_week"))
    overlap = F.col("shared") / (F.size(F.array_distinct("keywords")) + F.size("words") - F.col("shared"))
    score = gates.alpha * vectors.cosine(F.col("centroid"), F.col("_c")) + gates.beta * F.col("overlap")
    rows = rows.withColumns({"gap": gap, "overlap": overlap}).withColumn("score", score)
    near = (F.col("gap") == 1) & (F.col("overlap") >= gates.near_overlap) & (F.col("score") >= gates.near)
    far = F.col("gap").between(2, gates.gap) & (F.col("overlap") >= gates.far_overlap) & (F.col("score") >= gates.far)
    kept = rows.where(near | far).withColumn("link_type", F.when(F.col("gap") == 1, "near").otherwise("gap"))
    return kept.select("cluster_id", "weight", "seed_week", "seed_cluster", "seed_weight", "n", "score", "link_type")


def _matched(edges: DataFrame) -> DataFrame:
    """The edges that clusters would take, heavier clusters first, each its best thread that is free; of threads with one
    score the older one. Each round takes all pairs that are each other's first choice."""
    best = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("score"), "seed_week", F.desc("seed_weight"), "seed_cluster"))
    first = F.row_number().over(Window.partitionBy("seed_week", "seed_cluster").orderBy(F.desc("weight"), "cluster_id"))
    out = None
    while True:
        pairs = stored(edges.withColumn("_b", best).withColumn("_f", first).where("_b = 1 AND _f = 1").drop("_b", "_f"), "pairs")
        if not pairs.limit(1).count():
            return pairs if out is None else out
        out = pairs if out is None else out.unionByName(pairs)
        edges = stored(edges.join(pairs.select("cluster_id"), "cluster_id", "left_anti").join(pairs.select("seed_week", "seed_cluster"), ["seed_week", "seed_cluster"], "left_anti"), "edges")


LINKS = "week string, cluster_id int, seed_week string, seed_cluster int, seq int, link_score double, link_type string"


def walk(clusters: pd.DataFrame, gates: Gates) -> list[tuple]:
    """Rows of LINKS for clusters (week, day, cluster_id, weight, keywords, centroid) of any number of weeks, one by one."""
    out, index = [], {}
    words, centres, sizes, days, counts, seeds = [], [], [], [], [], []
    for (day, week), rows in clusters.sort_values(["day", "weight", "cluster_id"], ascending=[True, False, True]).groupby(["day", "week"], sort=True):
        used: set[int] = set()
        for row in rows.itertuples(index=False):
            own, centre = set(row.keywords), np.asarray(row.centroid, float)
            length = float(np.linalg.norm(centre))
            shared: dict[int, int] = {}
            for w in own:
                for t in index.get(w, ()):
                    shared[t] = shared.get(t, 0) + 1
            best, most, kind = -1, 0.0, ""
            for t in sorted(shared):
                gap = (day - days[t]) // 7
                if t in used or not 1 <= gap <= gates.gap:
                    continue
                overlap = shared[t] / (len(own) + len(words[t]) - shared[t])
                if overlap < (gates.near_overlap if gap == 1 else gates.far_overlap):
                    continue
                score = gates.alpha * (float(centre @ centres[t]) / (length * sizes[t]) if length * sizes[t] else 0.0) + gates.beta * overlap
                if score >= (gates.near if gap == 1 else gates.far) and (best < 0 or score > most):
                    best, most, kind = t, score, "near" if gap == 1 else "gap"
            if best < 0:
                best = len(words)
                for values, new in ((words, set()), (centres, None), (sizes, 0.0), (days, 0), (counts, 0), (seeds, (week, row.cluster_id))):
                    values.append(new)
                kind = "seed"
            out.append((week, row.cluster_id, *seeds[best], counts[best], most, kind))
            for w in own - words[best]:
                index.setdefault(w, set()).add(best)
            used.add(best)
            words[best] |= own
            centres[best], sizes[best], days[best], counts[best] = centre, length, day, counts[best] + 1
        for w, there in list(index.items()):  # threads that are over
            there -= {t for t in there if (day - days[t]) // 7 >= gates.gap}
            if not there:
                del index[w]
    return out


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.datediff(dates.monday(F.col("week")), F.lit("1970-01-01")))


def link(clusters: DataFrame, gates: Gates = Gates(), small: int = SMALL) -> DataFrame:
    """(thread_id, week, cluster_id, seq, link_score, link_type). clusters: week, cluster_id, weight, keywords, centroid.

    Threads are numbered by the week, weight and id of their first cluster.
    """
    rows = clusters.select("week", F.col("cluster_id").cast("int").alias("cluster_id"), F.col("weight").cast("long").alias("weight"), "keywords", F.col("centroid").cast("array<double>").alias("centroid"))
    if rows.limit(small + 1).count() <= small:
        columns = [c.split(" ")[0] for c in LINKS.split(", ")]
        linked = _timed(rows).groupBy(F.lit(0).alias("all")).applyInPandas(lambda group: pd.DataFrame(walk(group, gates), columns=columns), LINKS)
        return numbered(stored(linked, "links"), rows)
    return by_weeks(rows, gates)


def by_weeks(rows: DataFrame, gates: Gates) -> DataFrame:
    """The same by joins: a round of jobs a week, as large as its clusters and the open threads that share a keyword."""
    weeks = sorted(r["week"] for r in rows.select("week").distinct().collect())
    state, linked = None, None
    for week in weeks:
        now = rows.where(F.col("week") == week)
        fresh = now.select(F.col("week").alias("seed_week"), F.col("cluster_id").alias("seed_cluster"), F.col("weight").alias("seed_weight"), F.lit(1).alias("n"), F.col("week").alias("last_week"), F.array_distinct("keywords").alias("words"), "centroid")
        if state is None:
            part = fresh.select(F.lit(week).alias("week"), F.col("seed_cluster").alias("cluster_id"), "seed_week", "seed_cluster", F.lit(0).alias("seq"), F.lit(0.0).alias("link_score"), F.lit("seed").alias("link_type"))
            state = stored(fresh, "open-threads")
        else:
            taken = _matched(stored(_candidates(now, state, gates), "edges"))
            opened = fresh.join(taken.select(F.col("cluster_id").alias("seed_cluster")), "seed_cluster", "left_anti")
            part = taken.select(F.lit(week).alias("week"), "cluster_id", "seed_week", "seed_cluster", F.col("n").alias("seq"), F.col("score").alias("link_score"), "link_type")
            part = part.union(opened.select(F.lit(week).alias("week"), F.col("seed_cluster").alias("cluster_id"), "seed_week", "seed_cluster", F.lit(0).alias("seq"), F.lit(0.0).alias("link_score"), F.lit("seed").alias("link_type")))
            went = taken.select("seed_week", "seed_cluster", "cluster_id").join(now.select("cluster_id", F.col("keywords").alias("_k"), F.col("centroid").alias("_c")), "cluster_id")
            old = state.join(went, ["seed_week", "seed_cluster"], "left").where(dates.gap_weeks(F.lit(week), F.coalesce(F.when(F.col("_k").isNotNull(), F.lit(week)), "last_week")) < gates.gap)
            moved = F.col("_k").isNotNull()
            old = old.select("seed_week", "seed_cluster", "seed_weight", F.when(moved, F.col("n") + 1).otherwise(F.col("n")).alias("n"), F.when(moved, F.lit(week)).otherwise(F.col("last_week")).alias("last_week"), F.when(moved, F.array_union("words", "_k")).otherwise(F.col("words")).alias("words"), F.when(moved, F.col("_c")).otherwise(F.col("centroid")).alias("centroid"))
            state = stored(old.unionByName(opened.select(*_STATE)), "open-threads")
        linked = part if linked is None else linked.union(part)
    if linked is None:
        return rows.select(F.lit(0).alias("thread_id"), "week", "cluster_id", F.lit(0).alias("seq"), F.lit(0.0).alias("link_score"), F.lit("").alias("link_type"))
    return numbered(stored(linked, "links"), rows)


def numbered(linked: DataFrame, rows: DataFrame) -> DataFrame:
    """Links with the number of their thread instead of its first cluster."""
    seeds = linked.where("seq = 0").select("seed_week", "seed_cluster").join(rows.select(F.col("week").alias("seed_week"), F.col("cluster_id").alias("seed_cluster"), "weight"), ["seed_week", "seed_cluster"])
    # Numbers by week first and then within the week, so that no task sorts all threads.
    per_week = seeds.groupBy("seed_week").count()
    start = F.coalesce(F.sum("count").over(Window.orderBy("seed_week").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("seed_week").orderBy(F.desc("weight"), "seed_cluster")) - 1
    numbered = seeds.withColumn("within", within).join(F.broadcast(per_week.select("seed_week", start.alias("start"))), "seed_week")
    ids = numbered.select("seed_week", "seed_cluster", (F.col("start") + F.col("within")).cast("int").alias("thread_id"))
    return linked.join(ids, ["seed_week", "seed_cluster"]).select("thread_id", "week", "cluster_id", "seq", "link_score", "link_type")


def describe(members: DataFrame) -> DataFrame:
    """A row for each thread: its span, how its centroid drifts, its peak and its labels.

    members: thread_id, week, weight, label, keywords, centroid. Keywords are sorted, so that the first eight are the
    same on every run.
    """
    by = Window.partitionBy("thread_id").orderBy("week")
    step = members.withColumn("_cos", vectors.cosine(F.lag("centroid").over(by), F.col("centroid"))).withColumn("_first", F.row_number().over(by) == 1)
    rows = step.groupBy("thread_id").agg(
        F.count("*").alias("n_weeks"), F.min("week").alias("start_week"), F.max("week").alias("end_week"),
        F.coalesce(F.avg(F.when(~F.col("_first"), F.col("_cos"))), F.lit(1.0)).alias("drift"), F.max("weight").alias("peak_weight"),
        F.max_by("label", F.struct("weight", F.negative(F.datediff(dates.monday(F.col("week")), F.lit("1970-01-01"))))).alias("label"),
        F.concat_ws(" → ", F.transform(F.sort_array(F.collect_list(F.struct("week", "label"))), lambda s: F.coalesce(F.nullif(s["label"], F.lit("")), F.lit("?")))).alias("label_path"),
        F.concat_ws(", ", F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("keywords")))), 1, 8)).alias("top_keywords"),
    )
    kind = F.when(F.col("n_weeks") == 1, "single").when(F.col("drift") >= REPEATED, "repeated").otherwise("evolving")
    return rows.withColumn("span_weeks", dates.gap_weeks(F.col("start_week"), F.col("end_week")) + 1).withColumn("kind", kind)


#: Fixed values of the search: alpha, the least scores and the two least overlaps that are tried; 36 settings in all.
GRID = [Gates(a, round(1 - a, 2), near, max(near + 0.05, 0.40), first, later, GAP) for a in (0.2, 0.3, 0.4) for near in (0.30, 0.38) for first in (0.12, 0.18, 0.25) for later in (0.30, 0.40)]


def grid_search(clusters: DataFrame, anchors: list[str], settings: list[Gates] = GRID) -> DataFrame:
    """A row for each setting of the linker, the best first: nr, its values, and the quality of the threads it makes.

    All settings are linked at once, each in a task of its own: clusters are few enough for that, as a count shows (SMALL).
    clusters: as for link(), and label.
    """
    rows = stored(clusters.select("week", F.col("cluster_id").cast("int").alias("cluster_id"), F.col("weight").cast("long").alias("weight"), "keywords", F.col("centroid").cast("array<double>").alias("centroid"), "label"), "clusters")
    if rows.limit(SMALL + 1).count() > SMALL:
        raise ValueError(f"a search over settings takes {SMALL} clusters at most")
    tried = rows.sparkSession.createDataFrame([(k, g.alpha, g.near, g.near_overlap, g.far_overlap) for k, g in enumerate(settings)], "nr int, alpha double, near double, near_overlap double, far_overlap double")
    columns = ["nr", *(c.split(" ")[0] for c in LINKS.split(", "))]

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *row) for row in walk(group, settings[key[0]])], columns=columns)

    copies = _timed(rows.drop("label")).withColumn("nr", F.explode(F.sequence(F.lit(0), F.lit(len(settings) - 1))))
    linked = copies.groupBy("nr").applyInPandas(run, f"nr int, {LINKS}")
    members = linked.join(rows.select("week", "cluster_id", "keywords", "weight"), ["week", "cluster_id"]).withColumn("thread_id", F.concat_ws(":", "seed_week", "seed_cluster"))
    return tried.join(F.broadcast(quality(stored(members, "members"), rows.select("label"), anchors, ["nr"])), "nr").orderBy(F.desc("overall"), "nr")


def quality(members: DataFrame, labels: DataFrame, anchors: list[str], keys: list[str] | None = None) -> DataFrame:
    """One row, or one for each of the keys: how coherent threads are, how pure those with an anchor keyword, how varied labels, and all in one.

    members: thread_id, seq, weight, keywords. labels: label of every cluster.
    """
    keys = keys or []
    was = F.lag("keywords").over(Window.partitionBy(*keys, "thread_id").orderBy("seq"))
    rows = members.withColumn("was", was).withColumn("j", F.when(F.col("was").isNotNull(), text.jaccard(F.col("keywords"), F.col("was"))))
    anchored = F.arrays_overlap("keywords", F.array(*map(F.lit, anchors)))
    per = rows.groupBy(*keys, "thread_id").agg(F.count("*").alias("n"), F.avg("j").alias("j"), F.max("weight").alias("peak"), F.count_if(anchored).alias("anchored"))
    multi, pure = F.col("n") > 1, (F.col("anchored") > 0) & (F.col("n") > 1)
    whole = per.groupBy(*keys).agg(
        F.count("*").alias("threads"), F.count_if(multi).alias("multi_threads"),
        F.coalesce(F.sum(F.when(multi, F.col("j") * F.col("peak"))) / F.sum(F.when(multi, F.col("peak"))), F.lit(0.0)).alias("coherence"),
        F.coalesce(F.avg(F.when(pure, F.col("anchored") / F.col("n"))), F.lit(0.0)).alias("anchor_purity"),
        F.count_if(F.col("anchored") > 0).alias("anchor_threads"), (F.count_if(F.col("n") == 1) / F.count("*")).alias("single_rate"),
    )
    described = labels.agg((F.count_distinct("label") / F.count("*")).alias("label_div"), F.avg(F.size(F.split("label", " "))).alias("avg_label_tokens"))
    both = whole.crossJoin(F.broadcast(described))  # one row
    overall = 0.45 * F.col("coherence") + 0.35 * F.col("anchor_purity") + 0.2 * F.col("label_div") - F.greatest(F.lit(0.0), F.col("single_rate") - 0.6) * 0.2
    four = ("coherence", "anchor_purity", "label_div", "single_rate", "overall", "avg_label_tokens")
    both = both.withColumn("overall", overall)
    return both.select(*keys, "threads", "multi_threads", "anchor_threads", *(F.round(c, 4).alias(c) for c in four))
