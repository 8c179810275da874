"""Stage tables: what several queries read is a written table, made by the first query that needs it.

The stages of the pipeline (facts, frequencies, baseline, z-scores, contexts) are tables of the session's shared folder.
A stage is made anew when a table that it comes from has changed, or when its own files are gone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekloom import session

_made: dict[tuple[str, str, str], tuple[str, str]] = {}


def stage(spark: SparkSession, folder: str, name: str, make: Callable[[SparkSession, str], DataFrame], *sources: str) -> DataFrame:
    """The table `name` over an input folder: make(spark, folder), written once for these files of its sources."""
    key = (spark.sparkContext.applicationId, folder, name)
    state = "|".join(session.state_of(spark, f"{folder}/{t}.parquet") for t in sources)
    was, path = _made.get(key, ("", ""))
    if was != state or not session.exists(spark, f"{path}/_SUCCESS"):
        path = session.new_path(spark, name)
        make(spark, folder).write.option("compression", "zstd").parquet(path)
        _made[key] = (state, path)
    return spark.read.parquet(path)
