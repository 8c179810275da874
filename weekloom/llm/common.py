"""Helpers shared by the training-data operators: tables, folds, checkpoints and Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom import session

#: Rows and bytes that one Arrow batch hands to Python, so that a batch of whole texts stays at a few MB.
ARROW_ROWS, ARROW_BYTES = 512, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, whatever the length of its texts, and lets its workers import us.

    The bounds are settings of the session, read when a result runs, so they stay; they are only ever lowered, and say
    nothing on what a query returns.
    """
    session.prepare(spark)
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


new_path, stored = session.new_path, session.stored


def unused(columns: list[str], name: str) -> str:
    """`name`, or a longer name, that is none of these columns in any spelling."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 5. Fold 0 is held out of every fit."""
    return (F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5).cast("int")


def held_out(doc_id: str | Column) -> Column:
    return fold(doc_id) == 0


def drawn(rows: int, most: int, *keys: str) -> Column:
    """A condition that holds for about `most` of so many rows, chosen by a hash of the keys, alike on every run.

    The share is set from a count, so no row is sorted or sent anywhere to draw the sample. Rows with equal keys are
    drawn together: bounded() holds the rest where one row is repeated very often.
    """
    share = (1 << 31) if rows <= most else int(most / rows * (1 << 31))
    return F.pmod(F.xxhash64(*keys, F.lit(7)), F.lit(1 << 31)) < share


def bounded(sample: DataFrame, most: int) -> DataFrame:
    """A sample of about `most` rows, with a limit that acts only where copies of one row were drawn together."""
    return sample.limit(2 * most + 1000)


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, back to back, and n + 1 offsets into them. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def text_of(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]
