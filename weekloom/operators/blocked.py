"""Exact work on all pairs of vectors of a group, in blocks that are multiplied as matrices.

Rows of a group (a week, say) are dealt by a hash of their id into blocks of about BLOCK; a block is one row that carries
ids, tags and a matrix. Two blocks meet by an equi-join on the group and the block's number, so a task holds two blocks at
a time, a large group is many tasks, and no pair of vectors is ever a row. Vectors of different lengths never meet.
Ids are longs, distinct within a table; rows without an id, without a vector or with a component that is no number are
left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom import session
from weekloom.operators.similar import few

BLOCK = 1024
#: Decimal places of a score or distance by which rows are ordered; what is equal there is a tie.
PLACES = 9

Measure = Callable[[np.ndarray, np.ndarray], np.ndarray]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    return unit(a) @ unit(b).T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, rounded, so that equal rows are at 0 whatever the block they are in."""
    square = np.square(a).sum(1)[:, None] + np.square(b).sum(1)[None, :] - 2 * a @ b.T
    far = np.sqrt(np.maximum(square, 0))
    near = np.argwhere(far < 1e-5 * (1 + np.abs(a).max(initial=0)))  # there a difference of squares is too coarse
    for i, j in near:
        far[i, j] = np.linalg.norm(a[i] - b[j])
    return np.round(far, PLACES)


def nearness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return -distances(a, b)


def usable(df: DataFrame, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    return df.withColumn(vector, v).where(F.col("id").isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def sizes(df: DataFrame, keys: list[str], block: int) -> DataFrame:
    """keys, dim and the number of blocks of each group."""
    return df.groupBy(*keys, "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))


def packed(df: DataFrame, keys: list[str], counts: DataFrame) -> DataFrame:
    """keys, dim, blocks, block, ids, tags, extra, x: a row for each block. df: keys, dim, id, tag (long), extra (double), v."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    names = [*keys, "dim", "blocks", "block"]

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        ids, tags, extra = (table.column(c).to_numpy()[order] for c in ("id", "tag", "extra"))
        x = table.column("v").combine_chunks()
        x = (pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
        images = [pa.array([y.tobytes()], pa.binary()) for y in (ids.astype("<i8"), tags.astype("<i8"), extra.astype("<f8"), x.astype("<f8"))]
        return pa.table([*(table.column(c).slice(0, 1).combine_chunks() for c in names), *images], names=[*names, "ids", "tags", "extra", "x"])

    dealt = df.join(few(counts), [*keys, "dim"]).withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks").cast("int"))
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "dim int, blocks int, block int, ids binary, tags binary, extra binary, x binary"])
    return dealt.groupBy(*names).applyInArrow(pack, schema)


def prepared(df: DataFrame, keys: list[str], vector: str, tag: str | None = None, extra: str | None = None) -> DataFrame:
    """keys, id, tag, extra, v and dim, as packed() takes them. A null tag is -1."""
    tags = F.coalesce(F.col(tag).cast("long"), F.lit(-1)) if tag else F.lit(-1).cast("long")
    other = F.col(extra).cast("double") if extra else F.lit(0.0)
    rows = df.select(*keys, F.col("id").cast("long").alias("id"), tags.alias("tag"), other.alias("extra"), F.col(vector).alias("v"))
    return usable(rows, "v").withColumn("dim", F.size("v"))


class Image:
    """A block in a task."""

    def __init__(self, batch: pa.RecordBatch, row: int, prefix: str = ""):
        read = lambda c, kind: np.frombuffer(batch.column(prefix + c)[row].as_buffer(), kind)
        self.ids, self.tags, self.extra = read("ids", "<i8"), read("tags", "<i8"), read("extra", "<f8")
        self.x = read("x", "<f8").reshape(len(self.ids), -1)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores in order, equal ones by id; -inf is no score."""
    scores = np.round(scores, PLACES)
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    at = at[scores[at] > -np.inf]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def met(rows: DataFrame, queries: DataFrame, keys: list[str], vector: str, tag: str | None = None, block: int = BLOCK) -> DataFrame:
    """Every block of queries beside every block of rows of its keys: ids, tags, extra and x, and the same with q_."""
    there = session.stored(prepared(rows, keys, vector, tag), "rows")
    counts = session.stored(sizes(there, keys, block), "sizes")
    asked = session.stored(prepared(queries, keys, vector, tag), "asked")
    index = packed(there, keys, counts)
    # A query's block meets every block of its group, one after the other.
    ours = packed(asked, keys, sizes(asked, keys, block)).drop("blocks").withColumnRenamed("block", "_own")
    ours = ours.join(few(counts), [*keys, "dim"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    ours = ours.select(*keys, "dim", "block", *(F.col(c).alias(f"q_{c}") for c in ("ids", "tags", "extra", "x")))
    return index.drop("blocks").join(ours.hint("shuffle_merge"), [*keys, "dim", "block"])


def nearest(rows: DataFrame, queries: DataFrame, keys: list[str], vector: str, k: int, measure: Measure = cosines, tag: str | None = None, block: int = BLOCK) -> DataFrame:
    """(query_id, id, score, rank): the k best rows of each query among the rows of its keys, exactly.

    rows, queries: keys, id, the vector, and the tag. With a tag, a query with one (not null) asks for rows of that tag
    alone: the tags of a block are compared with it as a bitmap. A row is never its own hit. Ties go to the smaller id.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                here, query = Image(batch, row), Image(batch, row, "q_")
                scores = measure(query.x, here.x)
                allowed = (query.ids[:, None] != here.ids[None, :]) & ((query.tags[:, None] == -1) | (query.tags[:, None] == here.tags[None, :]))
                scores = np.where(allowed, scores, -np.inf)
                at = [best_of(s, here.ids, k) for s in scores]
                own = np.repeat(np.arange(len(at)), [len(a) for a in at])
                place = np.concatenate(at) if at else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays([pa.array(query.ids[own]), pa.array(here.ids[place]), pa.array(scores[own, place])], names=["query_id", "id", "score"])

    found = met(rows, queries, keys, vector, tag, block).mapInArrow(find, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", PLACES)), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def tiers(rows: DataFrame, queries: DataFrame, keys: list[str], vector: str, tag: str, least: float, block: int = BLOCK) -> DataFrame:
    """(query_id, tier, n, first_id) by pair of blocks: how many rows of a query's keys are near it (a cosine of `least`) and of
    its tag (tier 0), near it (1), or neither (2), and the smallest id of these. A row is never its own hit."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                here, query = Image(batch, row), Image(batch, row, "q_")
                near = cosines(query.x, here.x) >= least
                tagged = (query.tags[:, None] == here.tags[None, :]) & (query.tags[:, None] != -1)
                tier = np.where(query.ids[:, None] == here.ids[None, :], -1, np.where(near & tagged, 0, np.where(near, 1, 2)))
                for k in range(3):
                    is_k = tier == k
                    n = is_k.sum(axis=1)
                    some = n > 0  # ids of a block ascend
                    yield pa.RecordBatch.from_arrays([pa.array(query.ids[some]), pa.array(np.full(some.sum(), k, np.int32)), pa.array(n[some].astype(np.int64)), pa.array(here.ids[is_k.argmax(axis=1)[some]])], names=["query_id", "tier", "n", "first_id"])

    return met(rows, queries, keys, vector, tag, block).mapInArrow(count, "query_id long, tier int, n long, first_id long")
