"""Mini-batch k-means over tables of any size, with several starts at once.

A step draws a batch by a hash of the ids and the step, so that every run draws the same rows, assigns it to the centres of
all starts in the tasks that read it, and moves each centre to the mean of all rows that it was ever given. What comes to
the driver is a sum and a count for each centre and start; the centres are what it keeps (MOST numbers at most, which is
checked). The start with the least sum of squared distances over all rows is taken, and then every row is labelled.

Rows without an id, without a vector, or with a component that is no number are left out. Fewer rows than clusters make as
many clusters as there are rows. Clusters are numbered by size, the largest first, ties by the start's own number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators import blocked
from weekloom.session import stored

STARTS, STEPS, BATCH = 3, 20, 1024
#: Numbers that centres may be in all, as they are in every task.
MOST = 4_000_000


def clamp(n: int, least: int, most: int, rows_each: int) -> int:
    """How many clusters so many rows are to have: one for every `rows_each`, within bounds, and no more than rows."""
    return max(min(least, n), min(most, n // rows_each, n)) if n else 0


def drawn(rows: DataFrame, n: int, step: int, batch: int, seed: int) -> DataFrame:
    """About `batch` of n rows, another draw for each step."""
    share = int(min(1.0, batch / max(1, n)) * (1 << 31))
    return rows.where(F.pmod(F.xxhash64("id", F.lit(step), F.lit(seed)), F.lit(1 << 31)) < share)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("v")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    far = np.square(x).sum(1)[:, None] + np.square(centres).sum(1)[None, :] - 2 * x @ centres.T
    own = far.argmin(axis=1)
    return own, np.maximum(far[np.arange(len(x)), own], 0.0)


def _sums(rows: DataFrame, centres: np.ndarray) -> list[tuple[int, int, int, list[float]]]:
    """start, centre, rows, sum of the rows that each centre is nearest to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centres.shape)
        count = np.zeros(centres.shape[:2], np.int64)
        for batch in batches:
            x = _matrix(batch)
            for s in range(len(centres)):
                own, _ = _nearest(x, centres[s])
                np.add.at(total[s], own, x)
                count[s] += np.bincount(own, minlength=centres.shape[1])
        s, c = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(count[s, c]), pa.array(list(total[s, c]), pa.list_(pa.float64()))], names=["s", "c", "n", "x"])

    parts = rows.select("v").mapInArrow(run, "s int, c int, n long, x array<double>").select("s", "c", "n", F.posexplode("x").alias("i", "x"))
    whole = parts.groupBy("s", "c", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    return whole.groupBy("s", "c").agg(F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda v: v["x"]).alias("x")).collect()


def clusters(df: DataFrame, vector: str, k: int, starts: int = STARTS, steps: int = STEPS, batch: int = BATCH, seed: int = 0) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster_id, distance) of all rows, and the centres in the order of cluster_id. df: id, and vectors of one length."""
    rows = stored(blocked.usable(df.select(F.col("id").cast("long").alias("id"), F.col(vector).alias("v")), "v"), "vectors")
    n = rows.count()
    k = min(k, n)
    if not k:
        return rows.select("id", F.lit(0).alias("cluster_id"), F.lit(0.0).alias("distance")), np.zeros((0, 0))
    first = [np.array([r["v"] for r in rows.orderBy(F.xxhash64("id", F.lit(-1 - s), F.lit(seed)), "id").limit(k).collect()]) for s in range(starts)]
    centres = np.stack(first)
    if centres.size > MOST:
        raise ValueError(f"{k} centres of {centres.shape[2]} numbers and {starts} starts are more than {MOST} numbers")
    given = np.zeros(centres.shape[:2])
    for step in range(steps):
        for s, c, many, x in _sums(drawn(rows, n, step, batch, seed), centres):
            given[s, c] += many
            centres[s, c] += (np.array(x) - many * centres[s, c]) / given[s, c]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(centres))
        for b in batches:
            x = _matrix(b)
            out += [_nearest(x, c)[1].sum() for c in centres]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centres), dtype=np.int32)), pa.array(out)], names=["s", "far"])

    far = {r["s"]: r["far"] for r in rows.select("v").mapInArrow(measure, "s int, far double").groupBy("s").agg(F.sum("far").alias("far")).collect()}
    best = centres[min(far, key=lambda s: (round(far[s], 9), s))]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, square = _nearest(_matrix(b), best)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(own.astype(np.int32)), pa.array(np.sqrt(square))], names=["id", "c", "distance"])

    labelled = stored(rows.mapInArrow(label, "id long, c int, distance double"), "labels")
    sizes = {r["c"]: r["n"] for r in labelled.groupBy("c").agg(F.count("*").alias("n")).collect()}  # k at most
    order = sorted(range(k), key=lambda c: (-sizes.get(c, 0), c))
    place = np.empty(k, int)
    place[order] = np.arange(k)
    table = df.sparkSession.createDataFrame([(c, int(p)) for c, p in enumerate(place)], "c int, cluster_id int")
    return labelled.join(F.broadcast(table), "c").select("id", "cluster_id", "distance"), best[order]
