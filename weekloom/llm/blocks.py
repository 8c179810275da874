"""Searches of a stated query set against all rows, in blocks.

Rows are dealt by a hash of their id into groups of about `rows_per_group`, queries into blocks of `queries_per_block`;
each side becomes one binary row for each block. Every query block meets every group by an equi-join on the group's
number, so a task holds one group and one query block at a time, whatever the input. A group answers each query with
its own k best; the k best of all groups are the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm import common


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and x (array<double>) of the vectors that aren't null and have only finite components."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.col(vector_col).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(fine & F.col("id").isNotNull())


def matrix(batch: pa.RecordBatch | pa.Table, ids: str = "id", vectors: str = "x") -> tuple[np.ndarray, np.ndarray]:
    """ids, and vectors as a matrix of doubles."""
    column = batch.column(vectors)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return batch.column(ids).to_numpy(), flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


Build = Callable[[np.ndarray, np.ndarray], bytes]
#: opened index, query ids, query vectors, k -> query positions, found ids, scores
Probe = Callable[[object, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def search(rows: DataFrame, queries: DataFrame, build: Build, opened: Callable[[bytes], object], probe: Probe, k: int, score: str, rows_per_group: int = 16384, queries_per_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, best first, ties to the smaller id.

    rows, queries: id and x, as from usable(). build makes the image of a group's index, opened() reads it, and probe
    answers queries with it. An image of some 16 MB travels once for every queries_per_block queries, which is a few KB
    for each query and group, and little beside the scores that a query computes there.
    """
    spark = rows.sparkSession
    common.small_batches(spark)
    rows, queries = rows.withColumn("dim", F.size("x")), queries.withColumn("dim", F.size("x"))
    n, q = rows.count(), queries.count()
    groups, blocks = max(1, -(-n // rows_per_group)), max(1, -(-q // queries_per_block))

    def built(table: pa.Table) -> pa.Table:
        ids, x = matrix(table)
        order = np.argsort(ids, kind="stable")
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "g": table.column("g").slice(0, 1), "index": pa.array([build(ids[order], x[order])], pa.binary())})

    def blocked(table: pa.Table) -> pa.Table:
        ids, x = matrix(table)
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "qids": pa.array([ids.astype("<i8").tobytes()], pa.binary()), "qx": pa.array([x.astype("<f8").tobytes()], pa.binary())})

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, index = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                group = batch.column("dim")[row].as_py(), batch.column("g")[row].as_py()
                if group != own:
                    own, index = group, opened(batch.column("index")[row].as_buffer().to_pybytes())
                ids = np.frombuffer(batch.column("qids")[row].as_buffer(), "<i8")
                x = np.frombuffer(batch.column("qx")[row].as_buffer(), "<f8").reshape(len(ids), -1)
                at, found, values = probe(index, ids, x, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(found), pa.array(values)], names=["query_id", "vec_id", "score"])

    def dealt(df: DataFrame, many: int, salt: int, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(many)).cast("int"))

    index = dealt(rows, groups, 1, "g").groupBy("dim", "g").applyInArrow(built, "dim int, g int, index binary")
    asked = dealt(queries, blocks, 2, "b").groupBy("dim", "b").applyInArrow(blocked, "dim int, qids binary, qx binary")
    asked = asked.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = index.join(asked.hint("shuffle_merge"), ["dim", "g"]).select("dim", "g", "index", "qids", "qx").mapInArrow(probed, f"query_id long, vec_id long, score {score}")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
