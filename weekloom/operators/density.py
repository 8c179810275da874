"""Density clustering of vectors: mutual reachability, a minimum spanning tree by rounds, a condensed tree with stabilities.

A row's core distance is that to its `samples`-th nearest other row; two rows are as far as their distance and both core
distances at least. In each round every component finds its nearest other one, between blocks of rows (blocked.py), so no
pair is a row; components at least halve. Rows that merge at one distance merge at once, so the result doesn't depend on
which of several equal edges a round has taken. Of the clusters of the tree that have `least` rows or more, those whose rows
stay longest (the largest excess of mass) are taken; what leaves a cluster's ancestors before is noise.

The tree of a group is made in one task from its edges, 24 bytes for each row, not from its vectors. Groups with fewer than
`least` rows, or without a split into two clusters, are all noise. Rows without id or vector are left out, as in blocked.py.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom import session
from weekloom.operators import blocked, graph
from weekloom.operators.similar import FEW

#: No distance counts as less, so that equal rows have a finite density.
LEAST_DISTANCE = 1e-6


def core_distances(rows: DataFrame, keys: list[str], vector: str, samples: int, block: int = blocked.BLOCK) -> DataFrame:
    """rows with core, the distance to the samples-th nearest other row of its group (or the farthest, if there are fewer)."""
    near = blocked.nearest(rows, rows, keys, vector, samples, blocked.nearness, block=block)
    core = near.groupBy("query_id").agg(F.max(-F.col("score")).alias("core"))
    return rows.join(core, rows["id"] == core["query_id"], "left").drop("query_id").withColumn("core", F.coalesce("core", F.lit(0.0)))


def _joined(edges: list[tuple[int, int]]) -> dict[int, int]:
    """The smallest node that each node of some edges reaches."""
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while root.setdefault(a, a) != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {a: find(a) for a in list(root)}


def spanning_edges(rows: DataFrame, keys: list[str], vector: str, block: int = blocked.BLOCK) -> DataFrame:
    """keys, a, b, w: edges with the components that all pairs have under any bound on their mutual reachability.

    rows: keys, id, the vector, core. They are a minimum spanning tree, and perhaps some edges more where distances are equal.
    """
    spark = rows.sparkSession
    there = session.stored(blocked.prepared(rows, keys, vector, extra="core"), "rows")
    counts = session.stored(blocked.sizes(there, keys, block), "sizes")
    images = session.stored(blocked.packed(there, keys, counts).drop("tags"), "blocks")
    at = [*keys, "dim", "block"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.select(*at).schema)
    dealt = session.stored(there.join(blocked.few(counts), [*keys, "dim"]).select(*keys, "dim", F.pmod(F.xxhash64("id", F.lit(3)), "blocks").cast("int").alias("block"), "id", F.col("id").alias("component")), "labels")
    many, found = dealt.count(), []

    def line_up(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        image = pa.array([table.column("component").to_numpy()[order].astype("<i8").tobytes()], pa.binary())
        return pa.table([*(table.column(c).slice(0, 1).combine_chunks() for c in at), image], names=[*at, "tags"])

    def nearest_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one, two = blocked.Image(batch, row), blocked.Image(batch, row, "o_")
                far = np.maximum(np.maximum(blocked.distances(one.x, two.x), one.extra[:, None]), two.extra[None, :])
                far[one.tags[:, None] == two.tags[None, :]] = np.inf
                for here, other, table in ((one, two, far), (two, one, far.T)):
                    if not table.size:
                        continue
                    near = table.argmin(axis=1)
                    w = table[np.arange(len(near)), near]
                    order = np.lexsort((here.ids, w, here.tags))
                    heads = order[np.concatenate([[True], here.tags[order][1:] != here.tags[order][:-1]])]
                    heads = heads[w[heads] < np.inf]
                    columns = [here.tags[heads], other.tags[near[heads]], here.ids[heads], other.ids[near[heads]], w[heads]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["component", "other", "a", "b", "w"])

    while True:
        tags = dealt.groupBy(*at).applyInArrow(line_up, f"{kinds}, tags binary")
        now = images.join(tags, at)
        left = now.withColumn("hi", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
        right = now.select(*keys, "dim", F.col("block").alias("hi"), *(F.col(c).alias(f"o_{c}") for c in ("ids", "tags", "extra", "x")))
        met = left.join(right.hint("shuffle_merge"), [*keys, "dim", "hi"]).select("ids", "tags", "extra", "x", "o_ids", "o_tags", "o_extra", "o_x")
        edges = met.mapInArrow(nearest_others, "component long, other long, a long, b long, w double")
        best = edges.groupBy("component").agg(F.min_by(F.struct("other", "a", "b", "w"), F.struct("w", "a", "b")).alias("e")).select("component", "e.*")
        best = session.stored(best, "edges")
        if not best.limit(1).count():
            break
        found.append(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w"))
        if many <= FEW:
            joined = _joined([(r[0], r[1]) for r in best.select("component", "other").collect()])  # FEW at most
            roots = spark.createDataFrame(list(joined.items()), "component long, root long")
        else:
            roots = graph.components(best.select(F.col("component").alias("node")), best.select(F.col("component").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("root"))
        dealt = session.stored(dealt.join(roots, "component", "left").select(*at, "id", F.coalesce("root", "component").alias("component")), "labels")
        many = dealt.select("component").distinct().count()
    if not found:
        return there.select(*keys, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0.0).alias("w")).limit(0)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.distinct().join(there.select(*keys, F.col("id").alias("a")), "a").select(*keys, "a", "b", "w")


def condensed(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int, least: int) -> np.ndarray:
    """Cluster numbers of n rows (0 to n - 1) from the edges of a spanning tree; -1 is noise. Numbers follow the first row."""
    density = 1 / np.maximum(w, LEAST_DISTANCE)
    order = np.argsort(w, kind="stable")
    parent, size = np.arange(n), np.ones(n, int)
    loose: list[list[int] | None] = [[k] for k in range(n)]  # rows of components that are too small for a cluster
    cluster = np.full(n, -1)  # of a component, by its root
    home = np.full(n, -1)  # the first cluster that a row belongs to
    mass, born, rows_of, above = [], [], [], []  # of clusters: sum of densities at which rows leave, its own, size, parent

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return int(k)

    at = 0
    while at < len(order):
        end = at
        while end < len(order) and w[order[end]] == w[order[at]]:
            end += 1
        d = density[order[at]]
        ends = [(find(a[e]), find(b[e])) for e in order[at:end]]
        joined = _joined([e for e in ends if e[0] != e[1]])
        merging: dict[int, list[int]] = {}
        for node, root in joined.items():
            merging.setdefault(root, []).append(node)
        for root, parts in merging.items():
            whole = sum(int(size[p]) for p in parts)
            big = [p for p in parts if cluster[p] >= 0]
            small = [r for p in parts if cluster[p] < 0 for r in loose[p]]
            if len(big) == 1:
                own = int(cluster[big[0]])
                mass[own] += d * len(small)
                rows_of[own] += len(small)
            elif big or whole >= least:
                own = len(mass)
                mass.append(d * whole)
                rows_of.append(whole)
                born.append(0.0)
                above.append(-1)
                for p in big:
                    above[cluster[p]], born[cluster[p]] = own, d
            else:
                own = -1
            if own >= 0:
                home[small] = own
            for p in parts:
                parent[p], loose[p] = root, None
            loose[root] = small if own < 0 else None
            size[root], cluster[root] = whole, own
        at = end
    m = len(mass)
    stable = [mass[c] - rows_of[c] * born[c] for c in range(m)]
    below = np.zeros(m)
    parents = {c for c in above if c >= 0}
    take = np.zeros(m, bool)
    for c in range(m):  # a cluster's number is larger than those of the clusters within it
        if above[c] < 0:
            continue  # all of a group is no cluster
        take[c] = c not in parents or stable[c] >= below[c]
        below[above[c]] += stable[c] if take[c] else below[c]
    final = np.full(m, -1)
    for c in range(m - 1, -1, -1):
        outer = final[above[c]] if above[c] >= 0 else -1
        final[c] = outer if outer >= 0 else c if take[c] else -1
    label = np.where(home >= 0, final[home] if m else -1, -1)
    return _numbered(label)


def _numbered(label: np.ndarray) -> np.ndarray:
    """Labels as 0, 1, ... in the order of their first rows."""
    seen: dict[int, int] = {}
    return np.array([-1 if x < 0 else seen.setdefault(int(x), len(seen)) for x in label], int)


def clusters(rows: DataFrame, keys: list[str], vector: str, least: int = 5, samples: int = 1, block: int = blocked.BLOCK) -> DataFrame:
    """keys, id, cluster_id of every row: its cluster within its group, numbered by their smallest ids, or -1."""
    if least < 2 or samples < 1:
        raise ValueError("a cluster has two rows at least, and a row a neighbour")
    cored = session.stored(core_distances(rows.select(*keys, "id", vector), keys, vector, samples, block), "cores")
    edges = session.stored(spanning_edges(cored, keys, vector, block), "tree")
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema), "id long, cluster_id int"])
    nodes = blocked.usable(cored, vector).select(*keys, F.col("id").cast("long").alias("a"), F.lit(-1).cast("long").alias("b"), F.lit(-1.0).alias("w"))

    def label(group: pd.DataFrame) -> pd.DataFrame:
        ids = np.sort(group["a"][group["b"] == -1].to_numpy())
        tree = group[group["b"] != -1]
        found = condensed(np.searchsorted(ids, tree["a"]), np.searchsorted(ids, tree["b"]), tree["w"].to_numpy(), len(ids), least)
        out = pd.DataFrame({k: group[k].iloc[0] for k in keys} | {"id": ids, "cluster_id": found})
        return out[[*keys, "id", "cluster_id"]]

    return nodes.unionByName(edges).groupBy(*keys).applyInPandas(label, kinds)
